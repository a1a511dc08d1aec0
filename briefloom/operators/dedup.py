"""Duplicates by several independent signals, in first-seen order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fingerprint, headline_key, normalize_url, slug, truthy
from ..plans.lineage import stored

LINK_SIGNALS = ("url", "slug", "headline")


def with_signals(rows: DataFrame) -> DataFrame:
    """``rows`` (url, headline, snippet) with their four signals; no fingerprint without a snippet."""
    return rows.withColumns({"s_url": normalize_url(F.col("url")), "s_slug": slug(F.col("url")), "s_headline": headline_key(F.col("headline")), "s_fingerprint": F.when(truthy(F.col("snippet")).isNotNull(), fingerprint(F.col("snippet")))})


def signals(rows: DataFrame, *keep: str) -> DataFrame:
    """(keep..., kind, key): the signals of rows made by ``with_signals``, one a row."""
    pairs = [F.struct(F.lit(k).alias("kind"), F.col(f"s_{k}").alias("key")) for k in (*LINK_SIGNALS, "fingerprint")]
    return rows.select(*keep, F.explode(F.array(*pairs)).alias("p")).select(*keep, "p.*").filter("key is not null")


def history_index(deals: DataFrame) -> DataFrame:
    """(kind, key), distinct, of the stored deals."""
    return signals(with_signals(deals)).distinct()


def unknown_links(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Rows none of whose link signals is in the index: three anti-joins on equality."""
    for kind in LINK_SIGNALS:
        known = index.filter(F.col("kind") == kind).select(F.col("key").alias("__key"))
        rows = rows.join(known, F.col(f"s_{kind}") == F.col("__key"), "left_anti")
    return rows


def greedy(rows: DataFrame, order: str = "ord") -> DataFrame:
    """Rows that an ordered scan keeps: a row goes if it shares a signal with an earlier kept one.

    Dropped rows register nothing, so this is the lexicographically first maximal
    independent set, not one row per component.  Each round keeps the undecided
    rows that are first in all their signals and drops those that share a signal
    with them, until none is undecided: the first undecided row wins in every round,
    so this ends.  Rows without a signal share none and are kept.  Signals are
    combined by min before the shuffle, so a signal of many rows is cheap.
    """
    named = stored(with_signals(rows), "greedy")
    left = stored(signals(named, order), "signals")
    kept = named.filter(F.coalesce(*(F.col(f"s_{k}") for k in (*LINK_SIGNALS, "fingerprint"))).isNull()).select(order)
    while not left.isEmpty():
        first = left.groupBy("kind", "key").agg(F.min(order).alias("__first"))
        marked = left.join(first, ["kind", "key"])
        now = stored(marked.groupBy(order).agg(F.min(F.col(order) == F.col("__first")).alias("win")).filter("win").select(order), "kept")
        taken = left.join(now, order, "left_semi").select("kind", "key").distinct()
        gone = left.join(taken, ["kind", "key"], "left_semi").select(order).distinct()
        left = stored(left.join(gone, order, "left_anti"), "signals")
        kept = kept.union(now)
    return named.join(kept.distinct(), order, "left_semi").select(*rows.columns)


def batch_filter(rows: DataFrame, index: DataFrame, order: str = "ord") -> DataFrame:
    """A batch with ``status``: added, duplicate, or failed (``error`` not null).

    Rows known by a link signal are not in the result.  Within the batch only
    content counts: of the rows with one fingerprint the first is added; rows
    without a fingerprint all are.  Failed rows register nothing.
    """
    new = unknown_links(with_signals(rows), index)
    ok = F.col("error").isNull()
    first = new.filter(ok & F.col("s_fingerprint").isNotNull()).groupBy(F.col("s_fingerprint").alias("__fp")).agg(F.min(order).alias("__first"))
    known = index.filter("kind = 'fingerprint'").select(F.col("key").alias("__known"))
    out = new.join(first, F.col("s_fingerprint") == F.col("__fp"), "left").join(known, F.col("s_fingerprint") == F.col("__known"), "left")
    again = F.col("__known").isNotNull() | (F.col("__first") < F.col(order))
    status = F.when(~ok, "failed").when(F.coalesce(again, F.lit(False)), "duplicate").otherwise("added")
    return out.withColumn("status", status).drop("__fp", "__first", "__known")
