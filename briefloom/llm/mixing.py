"""Mixing sources to target weights by weighted fair queueing.

Each document of a source, in shuffled order, gets a virtual finish time: the
source's cumulative tokens divided by its target, which is its weight in the
queue.  All sources' documents are range-sorted into one queue by that time, and
the queue is truncated where its cumulative tokens reach the total budget.  A
further epoch of a source queues its documents again behind the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Hexadecimal digits of the shuffle key that split a source: 4096 slices each.
SLICE_DIGITS = 3
#: Words of a document that are queued as one packet; a longer document is several.
PACKET = 256


def size_of(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    Sources in code-point order, null last, take the weights in turn.  Targets
    share ``share`` of all sizes by weight and stop at ``epochs`` times their
    source's size; the excess is shared again until none is above.  Sorted by
    ceiling over weight, the sources that stop form a prefix, so one ordered
    pass over the table of sources (its windows see a row a source) is exact.
    """
    by_name = W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    w = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    level = W.orderBy("ratio", "place")
    before = level.rowsBetween(W.unboundedPreceding, -1)
    after = level.rowsBetween(0, W.unboundedFollowing)
    rows = (
        totals.select("source", "source_size", w.alias("w"), F.row_number().over(by_name).alias("place"), F.sum("source_size").over(W.partitionBy()).alias("all_sizes"))
        .withColumn("ratio", F.col("source_size") * epochs / F.col("w"))
        .withColumn("level", (F.col("all_sizes") * share - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * epochs) / F.sum("w").over(after))
        .withColumn("stops", F.col("ratio") <= F.col("level"))
    )
    free = F.min(F.when(~F.col("stops"), F.struct("ratio", "place", "level"))).over(W.partitionBy())["level"]
    return rows.select("source", "source_size", F.when(F.col("stops"), (F.col("source_size") * epochs).cast("double")).otherwise(free * F.col("w")).alias("target"))


def in_sources(docs: DataFrame, key: Column, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, epochs: int = 2) -> tuple[DataFrame, DataFrame]:
    """``docs`` (with source and a long size) plus q_key, source_size, target and ``before``:
    the words of its source ahead of a document in the order of the shuffle ``key``,
    a string of hexadecimal digits; and the total budget (one row: budget).  A source
    is cut into slices by the key's first digits, so that no task sums a whole source."""
    rows = docs.withColumn("q_key", key).withColumn("q_slice", F.substring("q_key", 1, SLICE_DIGITS))
    slices = rows.groupBy("source", "q_slice").agg(F.sum("size").alias("slice_size"))
    goals = stored(targets(slices.groupBy("source").agg(F.sum("slice_size").alias("source_size")), weights, share, epochs), "targets")
    ahead = W.partitionBy("source").orderBy("q_slice").rowsBetween(W.unboundedPreceding, -1)
    slices = slices.withColumn("slice_before", F.coalesce(F.sum("slice_size").over(ahead), F.lit(0)))
    heads = slices.join(goals, slices["source"].eqNullSafe(goals["source"])).select(slices["source"].alias("h_source"), F.col("q_slice").alias("h_slice"), "slice_before", "source_size", "target")
    inside = W.partitionBy("source", "q_slice").orderBy("q_key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("in_slice", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    out = rows.join(heads, rows["source"].eqNullSafe(F.col("h_source")) & (F.col("q_slice") == F.col("h_slice")))
    out = out.withColumn("before", F.col("slice_before") + F.col("in_slice")).drop("h_source", "h_slice", "slice_before", "in_slice", "q_slice")
    # whole or half words by construction: a quarter keeps rounding noise from deciding
    return out, goals.agg(F.floor(F.sum("target") + 0.25).alias("budget"))


def shuffle_key(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def packets(rows: DataFrame, epochs: int, most: int | None = PACKET) -> DataFrame:
    """The queue's entries: ``rows`` (size > 0) once an epoch and ``most`` words, with
    q_epoch, q_words and q_finish, the virtual time at which the entry's last word is served."""
    out = rows.filter("size > 0").withColumn("q_epoch", F.explode(F.array(*[F.lit(e).cast("long") for e in range(epochs)])))
    if most is None:
        out = out.withColumn("q_words", F.col("size")).withColumn("q_end", F.col("size"))
    else:
        out = out.withColumn("q_start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(most).cast("long"))))
        out = out.withColumn("q_words", F.least(F.lit(most).cast("long"), F.col("size") - F.col("q_start"))).withColumn("q_end", F.col("q_start") + F.col("q_words")).drop("q_start")
    return out.withColumn("q_finish", (F.col("q_epoch") * F.col("source_size") + F.col("before") + F.col("q_end")) / F.col("target"))


def served(entries: DataFrame, budget: DataFrame) -> DataFrame:
    """``entries`` with q_served: the words of each that the truncated queue serves.

    The queue is range-sorted over all sources.  Partitions before the cut are
    served as a whole and those behind it not at all, by one sum a partition; only
    the partition that the cut falls into is summed row by row.
    """
    order = ["q_finish", "q_key", "doc_id", "size", "q_epoch", "q_end"]
    n = max(8, int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    queue = stored(entries.repartitionByRange(n, *order).withColumn("q_part", F.spark_partition_id()), "queue")
    sums = queue.groupBy(F.col("q_part").alias("s_part")).agg(F.sum("q_words").alias("s_words"))
    ahead = F.coalesce(F.sum("s_words").over(W.orderBy("s_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    heads = sums.select("s_part", "s_words", ahead.alias("s_before")).join(F.broadcast(budget))  # a row a partition; one row
    out = queue.join(F.broadcast(heads), F.col("q_part") == F.col("s_part"))
    cut = (F.col("s_before") < F.col("budget")) & (F.col("s_before") + F.col("s_words") > F.col("budget"))
    whole = out.filter(~cut).withColumn("q_served", F.when(F.col("s_before") < F.col("budget"), F.col("q_words")).otherwise(0))
    inside = F.coalesce(F.sum("q_words").over(W.partitionBy("q_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.col("budget") - F.col("s_before") - inside
    part = out.filter(cut).withColumn("q_served", F.greatest(F.lit(0), F.least(F.col("q_words"), left)))
    return whole.unionByName(part).drop("q_part", "s_part", "s_words", "s_before", "budget")


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, epochs: int = 2, most: int = PACKET) -> DataFrame:
    """(doc_id, source, size, source_size, target, before, taken) per document.

    ``taken`` is what the truncated queue serves of a document, over all epochs.
    A document's entries are packets of at most ``most`` words, so a source ends
    within one packet of its target.  No words (null or empty text): size and
    taken 0, not in the queue.  Equal finish times are ordered by shuffle key,
    doc_id, size, epoch and place in the document, so reruns agree.  Repeated rows
    are documents of their own; a null source is a source; no rows give no rows.
    """
    sized = stored(docs.select("doc_id", "source", size_of(F.col("text")).alias("size")), "sizes")
    rows, budget = in_sources(sized, shuffle_key(F.col("doc_id")), weights, share, epochs)
    rows = stored(rows, "shuffled")
    keep = ["doc_id", "source", "size", "source_size", "target", "before"]
    # before grows with every word of a source: the columns name one row, repeated ones too
    some = served(packets(rows.select(*keep, "q_key"), epochs, most), budget).groupBy(*keep).agg(F.sum("q_served").cast("long").alias("taken"))
    return some.unionByName(rows.filter("size = 0").select(*keep, F.lit(0).cast("long").alias("taken")))


def ordered_mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, epochs: int = 2) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row for each time that a document
    is served, range-sorted by virtual finish time.

    Whole documents only: of the queue's entries, the one that the cut falls into
    is in if half of it is served.  Texts without a word (null, empty) are never
    served.  Repeated rows are served as often as they are there; a null source is
    a source; no rows give no rows.
    """
    sized = stored(docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), F.xxhash64("text").alias("q_hash")), "sizes")
    rows, budget = in_sources(sized, shuffle_key(F.col("doc_id")), weights, share, epochs)
    plays = served(packets(stored(rows, "shuffled"), epochs, None), budget).filter(F.col("q_served") * 2 >= F.col("q_words"))
    # equal rows share one entry: the join below must not multiply them
    one = ["doc_id", "source", "q_hash"]
    plays = plays.groupBy(*one, "before").agg(F.sort_array(F.collect_list("q_finish")).alias("times"))  # one time an epoch
    plays = plays.groupBy(*one).agg(F.min_by("times", "before").alias("times"))
    plays = plays.select(*[F.col(c).alias(f"p_{c}") for c in one], "times")
    d = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", F.xxhash64("text").alias("q_hash"))
    on = d["doc_id"].eqNullSafe(F.col("p_doc_id")) & d["source"].eqNullSafe(F.col("p_source")) & (d["q_hash"] == F.col("p_q_hash"))
    out = d.join(plays, on).select("row", d["doc_id"].alias("q_id"), F.explode("times").alias("q_time"))
    n = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return out.repartitionByRange(n, "q_time", "q_id").sortWithinPartitions("q_time", "q_id").select("row.*")
