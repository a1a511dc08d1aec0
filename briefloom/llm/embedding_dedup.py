"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Vectors of unit length are projected on many random directions.  A pair at the
threshold falls into the same query-centred window of a direction with a known
probability, so the number of windows in which a pair collides separates near
pairs from others; pairs that reach a count calibrated for recall are verified
by their cosine.  To find colliding pairs without comparing all, leading
directions compete in groups: a vector's cell is, group by group, the direction
of its largest projection and the sign.  A vector is in one cell of every table,
and tables are gone through one after another, so that at any time a vector is
on disk once beside the table of all vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected_components
from .tables import mark, release, stored

COSINE = 0.95
TILE = 2048
#: Vectors that a cell should hold, and leading directions that can compete in a group.
CELL, LEADS = 2048, (4, 8, 16, 32, 64)
#: Projections are integers of this many steps a unit, so that all tasks agree on them.
SCALE = 1 << 20


@dataclass(frozen=True)
class Plan:
    """``tables`` sets of ``groups`` of ``leads`` leading directions, ``counters`` counting ones."""

    cosine: float
    leads: int
    groups: int
    tables: int
    counters: int
    least: int
    window: float

    @property
    def steps(self) -> int:
        """The window in steps of a quantized projection."""
        return round(self.window * SCALE)

    @property
    def leading(self) -> int:
        """The number of leading directions, which come before the counting ones."""
        return self.tables * self.groups * self.leads


@cache
def chance(leads: int, cosine: float, tries: int = 20_000) -> float:
    """A lower bound, by trial, of the probability that a pair has the largest of ``leads`` projections in common."""
    r = np.random.default_rng([7, leads])
    a, b = r.standard_normal((2, tries, leads))
    b = cosine * a + math.sqrt(1 - cosine * cosine) * b
    p = float((largest(a) == largest(b)).mean())
    return p - 2 * math.sqrt(p * (1 - p) / tries)


def largest(x: np.ndarray) -> np.ndarray:
    """Place and sign of the number of largest magnitude along the last axis."""
    at = np.abs(x).argmax(axis=-1)
    return 2 * at + (np.take_along_axis(x, at[..., None], -1)[..., 0] < 0)


def calibrate(n: int, cosine: float = COSINE, recall: float = 0.99, counters: int = 16) -> Plan:
    """Window, tables and count for ``n`` vectors, from the binomial law at the threshold.

    More vectors get more leading directions, and groups of them, so that a cell
    holds about ``CELL`` vectors; the tables then make up for the pairs that one
    table misses.  Up to two cells' vectors are one cell.
    """
    window = 2 * math.sqrt(2 - 2 * cosine)
    p = math.erf(2 / math.sqrt(2))
    groups, leads, tables = 0, 1, 1
    if n > 2 * CELL:
        groups = max(1, math.ceil(math.log(n / CELL) / math.log(2 * LEADS[-1])))
        leads = next((x for x in LEADS if (2 * x) ** groups >= n / CELL), LEADS[-1])
        tables = math.ceil(math.log((1 - recall) / 2) / math.log(1 - chance(leads, cosine) ** groups))
    tail, least = 0.0, counters + 1
    while tail < 1 - (1 - recall) / 2 and least > 0:
        least -= 1
        tail += math.comb(counters, least) * p**least * (1 - p) ** (counters - least)
    return Plan(cosine, leads, groups, tables, counters, least, window)


@cache
def directions(dim: int, n: int) -> np.ndarray:
    return np.random.default_rng([11, dim]).standard_normal((dim, n))


def project(plan: Plan, x: np.ndarray) -> np.ndarray:
    """Quantized projections, one row per counting direction."""
    r = directions(x.shape[1], plan.leading + plan.counters)[:, plan.leading :]
    return np.ascontiguousarray(np.rint((x @ r).T * SCALE).astype(np.int32))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cells(plan: Plan, x: np.ndarray) -> np.ndarray:
    """The cell of each vector in each table (vectors x tables)."""
    r = directions(x.shape[1], plan.leading + plan.counters)[:, : plan.leading]
    best = largest((x @ r).reshape(len(x), plan.tables, plan.groups, plan.leads)) if plan.groups else np.zeros((len(x), plan.tables, 0), np.int64)
    return (best * (2 * plan.leads) ** np.arange(plan.groups)).sum(axis=2).astype(np.int64)


def coded(classes: DataFrame, plan: Plan, kind: type = np.float64) -> DataFrame:
    """(cid, n, cells, codes, vec): each class with the keys of its cells, one per table, and the
    same as bytes.  ``vec`` is the vector as given, in numbers of ``kind``, which must hold it exactly."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                lists = part.column(2)
                lengths = np.diff(lists.offsets.to_numpy())
                flat, first = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths) - lengths
                for dim in np.unique(lengths):
                    rows = np.flatnonzero(lengths == dim)
                    given = flat[first[rows][:, None] + np.arange(dim)].astype(np.float64)
                    table = np.arange(plan.tables) * 1_000_003 + int(dim)
                    key = (cells(plan, _unit(given)) * 1_442_695_040_888_963_407 + table * 6_364_136_223_846_793_005).astype(np.int64)
                    of = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * plan.tables), pa.array(key.reshape(-1)))
                    raw = [[r.tobytes() for r in x] for x in (key, given.astype(kind))]
                    take = pa.array(rows)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), of, *(pa.array(x, pa.binary()) for x in raw)], ["cid", "n", "cells", "codes", "vec"])

    return classes.select("cid", "n", "embedding").mapInArrow(put, "cid long, n long, cells array<long>, codes binary, vec binary")


def _tile(plan: Plan, t: int, one: tuple, other: tuple | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, their linked weight, and edges that span the links of a tile of table ``t``: between
    ``one`` and ``other`` (ids, weights, codes, vectors), or within ``one`` if other is None.

    A pair belongs to the first table in which it shares a cell, so no pair counts twice.
    """
    q_id, q_n, q_code, q = one
    d_id, d_n, d_code, d = other or one
    pq = project(plan, q)
    pd = project(plan, d) if other else pq
    ids, where = np.unique(np.concatenate([q_id, d_id]), return_inverse=True)
    wq, wd = where[: len(q)], where[len(q) :]
    root, weight = np.arange(len(ids)), np.zeros(len(ids), np.int64)
    edges = []
    step = max(1, (1 << 20) // max(1, len(d)))
    for lo in range(0, len(q), step):
        hi, from_ = min(len(q), lo + step), 0 if other else lo
        hit = q[lo:hi] @ d[from_:].T >= plan.cosine
        hit &= q_id[lo:hi, None] != d_id[None, from_:]
        if not other:
            hit &= np.arange(lo, hi)[:, None] < np.arange(from_, len(d))[None, :]
        i, k = np.nonzero(hit)
        i, k = i + lo, k + from_
        for u in range(t):
            ok = q_code[i, u] != d_code[k, u]
            i, k = i[ok], k[ok]
        count = np.zeros(len(i), np.int8)
        for j in range(plan.counters):
            count += np.abs(pq[j][i] - pd[j][k]) <= plan.steps
        ok = count >= plan.least
        x, y = wq[i[ok]], wd[k[ok]]
        weight += np.bincount(x, weights=d_n[k[ok]], minlength=len(ids)).astype(np.int64)
        weight += np.bincount(y, weights=q_n[i[ok]], minlength=len(ids)).astype(np.int64)
        while len(x):
            x, y = root[x], root[y]
            ok = x != y
            x, y = x[ok], y[ok]
            if not len(x):
                break
            parent = np.arange(len(ids))
            np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
            moved = np.flatnonzero(parent != np.arange(len(ids)))
            edges.append(np.c_[ids[moved], ids[parent[moved]]])
            while (parent != parent[parent]).any():
                parent = parent[parent]
            root = parent[root]
    e = np.concatenate(edges) if edges else np.zeros((0, 2), np.int64)
    return ids[weight > 0], weight[weight > 0], e[:, 0], e[:, 1]


def _links_of_table(rows: DataFrame, plan: Plan, t: int, kind: type) -> DataFrame:
    """``find_links`` of one table, from ``coded`` rows.

    Cells are cut into slices of about ``TILE`` vectors, and pairs of slices are
    tiles, so that a cell with a third of all vectors is worked on by many tasks.
    """
    cell = F.col("cells")[t]
    rows = rows.select(cell.alias("cell"), "cid", "n", "codes", "vec")
    # at most a row for each TILE vectors
    large = rows.groupBy(F.col("cell").alias("m_cell")).agg(F.ceil(F.count("*") / TILE).alias("k")).filter("k > 1")
    rows = rows.join(F.broadcast(large), F.col("cell") == F.col("m_cell"), "left").withColumn("k", F.coalesce("k", F.lit(1).cast("long")))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("cid"), F.col("k"))).withColumn("across", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
    rows = rows.select("cell", F.least("own", "across").alias("i"), F.greatest("own", "across").alias("j"), (F.col("own") > F.col("across")).alias("second"), "cid", "n", "codes", "vec")

    def tile(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        parts = []
        second = table.column("second").to_numpy()
        within = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        for side in (second == False,) if within else (~second, second):  # noqa: E712
            x = table.filter(pa.array(side))
            vec, codes = (np.frombuffer(b"".join(x.column(c).to_pylist()), of).reshape(x.num_rows, -1) if x.num_rows else np.zeros((0, 1), of) for c, of in (("vec", kind), ("codes", np.int64)))
            parts.append((x.column("cid").to_numpy(), x.column("n").to_numpy(), codes, vec.astype(np.float64)))
        if min(len(x[0]) for x in parts) < (2 if within else 1):
            who = w = a = b = np.zeros(0, np.int64)
        else:
            parts = [(*x[:3], _unit(x[3])) for x in parts]
            who, w, a, b = _tile(plan, t, parts[0], None if within else parts[1])
        none = np.zeros(len(a), np.int64)
        return pa.table({"cid": pa.array(np.concatenate([who, a])), "other": pa.concat_arrays([pa.nulls(len(who), pa.int64()), pa.array(b)]), "n": pa.array(np.concatenate([w, none]))})

    return rows.groupBy("cell", "i", "j").applyInArrow(tile, "cid long, other long, n long")


def find_links(classes: DataFrame, plan: Plan, kind: type = np.float64) -> DataFrame:
    """(cid, other, n): per tile, the linked weight of a class (other null), and edges.

    Each table's vectors are dealt to its cells after the files of the table before are gone.
    """
    rows = stored(coded(classes, plan, kind), "vectors")
    found = []
    for t in range(plan.tables):
        found.append(stored(_links_of_table(rows, plan, t, kind), "links"))
        # Spark removes the files of a shuffle when the driver's JVM finds that nothing refers to it
        classes.sparkSession.sparkContext._jvm.System.gc()
    return reduce(DataFrame.union, found)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = 0.99) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors are linked if their cosine in double precision is at least ``cosine``
    and the projections found them; ``calibrate`` sets the probability that a pair
    at the threshold is found to about ``recall``, closer pairs are found more
    often.  Equal vectors, by two 64-bit hashes, form a class first and are all
    linked.  Vectors that are null, empty, zero or hold a null or non-finite
    component, and vectors of different lengths, are not linked.  Rows that repeat
    a vec_id share a node.
    """
    x = F.col("embedding")
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    good = F.coalesce((F.size(x) > 0) & ~F.exists(x, bad) & F.exists(x, lambda v: v != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    rows = vectors.select("vec_id", F.when(good, x).alias("embedding"))
    rows = rows.select("vec_id", "embedding", *(F.when(F.col("embedding").isNotNull(), F.xxhash64(F.lit(i), "embedding")).alias(f"h{i}") for i in (1, 2)))
    named = rows.filter("embedding is not null")
    keys = named.groupBy("h1", "h2").agg(F.min("vec_id").alias("cid"), F.count("*").alias("n"))
    classes = named.groupBy("h1", "h2").agg(F.min("vec_id").alias("cid"), F.count("*").alias("n"), F.first("embedding").alias("embedding"))
    since = mark()
    kind = np.float32 if vectors.schema["embedding"].dataType.elementType == T.FloatType() else np.float64
    found = stored(find_links(classes, calibrate(named.count(), cosine, recall), kind), "links")
    release(since, found)
    comp = connected_components(found.filter("other is not null").select(F.col("cid").alias("a"), F.col("other").alias("b")))
    other = found.filter("other is null").groupBy(F.col("cid").alias("l_id")).agg(F.sum("n").alias("n_other"))
    named = keys.join(comp, F.col("cid") == F.col("node"), "left").join(other, F.col("cid") == F.col("l_id"), "left")
    named = named.select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), (F.col("n") - 1 + F.coalesce("n_other", F.lit(0))).alias("c_links"), F.coalesce("component", "cid").alias("component"))
    out = rows.drop("embedding").join(named, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left")
    label = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("c_links", F.lit(0)).cast("long").alias("n_links"), label.alias("component_id"), F.coalesce(F.col("vec_id") == label, F.lit(True)).alias("kept"))
