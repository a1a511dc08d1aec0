"""Optional second pass for people that the patterns miss.

A detector is any callable ``text -> [(name, end offset), ...]``; none is bundled.
Where it cannot be loaded the pass adds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..dims import DEFAULT, Dims


def supplement(paras: DataFrame, people: DataFrame, dims: Dims = DEFAULT, detector: Callable | None = None, reach: int = 40) -> DataFrame:
    """People of ``paras`` (ord, para, text, firm, law_firms) that only the detector finds.

    A candidate needs two words, must be no known firm, neither part of nor
    around a name already known, a role in parentheses within ``reach``
    characters, and a firm in effect that the article declares.  Names found in
    one paragraph are known in the next.  Works article by article (small groups).
    """
    known = people.groupBy(F.col("ord").alias("k_ord")).agg(F.collect_set(F.lower("name")).alias("known"))
    rows = paras.filter(F.array_contains("law_firms", F.col("firm"))).join(known, F.col("ord") == F.col("k_ord"), "left").select("ord", "para", "text", "firm", F.coalesce("known", F.array().cast("array<string>")).alias("known"))
    role_after = re.compile(r"\s*\(\s*(" + "|".join(map(re.escape, dims.roles)) + r")\s*[,;)]")
    firms = set(dims.known_firms)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("para")
        seen, out = set(pdf["known"].iloc[0]), []
        if detector is not None:
            for ord_, para, text, firm in zip(pdf["ord"], pdf["para"], pdf["text"], pdf["firm"], strict=True):
                found = []
                for at, (name, end) in enumerate(detector(text)):
                    low = name.lower()
                    m = role_after.search(text[end : end + reach])
                    if len(name.split()) >= 2 and low not in firms and m and not any(low in k or k in low for k in seen):
                        found.append((ord_, {"para": para, "at": 10_000 + at}, name, m[1], firm, "ner"))
                seen |= {f[2].lower() for f in found}
                out += {(f[2].lower(), f[3], f[4]): f for f in reversed(found)}.values()
        return pd.DataFrame(out, columns=["ord", "place", "name", "role", "firm", "source"])

    return rows.groupBy("ord").applyInPandas(one, people.schema)


def with_fallback(load: Callable[[], Callable]) -> Callable:
    """A detector loaded once per worker; one that cannot be loaded finds nothing."""
    cache: list[Callable] = []

    def detect(text: str) -> Iterator[tuple[str, int]]:
        if not cache:
            try:
                cache.append(load())
            except (ImportError, OSError):
                cache.append(lambda _: [])
        return cache[0](text)

    return detect
