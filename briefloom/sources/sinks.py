"""Sinks: table folders, JSON documents, the page for a browser, counters."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.consolidate import Star


def write_star(star: Star, folder: str) -> None:
    """All seven tables, rebuilt in full."""
    for name, table in star.tables().items():
        table.write.mode("overwrite").parquet(f"{folder}/{name}")


def write_document(document: DataFrame, path: str, indent: int = 2) -> None:
    """The one-row JSON document as an indented UTF-8 file; names seen once lose the two
    keys that only namesakes have."""
    data = json.loads(document.first()["json"])
    for p in data["people"]:
        if p["same_name_elsewhere"] is None:
            del p["same_name_elsewhere"], p["firm_verification"]
        elif p["firm_verification"].get("current_firm") is None:
            p["firm_verification"].pop("current_firm", None)
    Path(path).write_text(json.dumps(data, indent=indent, ensure_ascii=False), encoding="utf-8")


def append_records(rows: DataFrame, folder: str) -> None:
    rows.write.mode("append").parquet(folder)


def write_seen(urls: DataFrame, folder: str) -> None:
    """Sorted distinct URLs."""
    urls.select("url").distinct().orderBy("url").write.mode("overwrite").json(folder)


def render_page(template: str, document_path: str, out: str, token: str = "__DATA__") -> int:
    """Put a JSON document into a template's one placeholder; returns the bytes written."""
    data = Path(document_path).read_text(encoding="utf-8")
    text = json.dumps(json.loads(data), ensure_ascii=False).replace("</script", "<\\/script")
    page = Path(template).read_text(encoding="utf-8").replace(token, text, 1).encode()
    return Path(out).write_bytes(page)


def observed(df: DataFrame, name: str, **counts) -> tuple[DataFrame, Observation]:
    """``df`` with counters that its next action fills in: name=condition pairs."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count(F.when(c, 1)).alias(k) for k, c in counts.items()]), seen
