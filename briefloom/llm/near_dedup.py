"""MinHash near-duplicate detection with tensored banding.

Two collections of ``half_keys`` short keys, each of ``width`` minhashes, are
computed per document; a table key is a pair of them, one from each collection.
So ``half_keys ** 2`` tables of ``2 * width`` minhashes cost ``2 * half_keys *
width`` minhashes, the square root of what separate tables need.  Candidates are
verified on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected_components
from .kernels import LOWER, SPACE, buffers, chunks, mix, prefix_hash, span_hash, words
from .tables import mark, release, stored

WORDS, PERCENT = 5, 85
#: At the threshold 0.85 a pair meets in a table with probability 1 - 7e-5.
HALF_KEYS, WIDTH = 8, 2
#: A block: members of a group, and about as many shingles, that a task compares with another block.
TILE, TILE_SHINGLES = 1024, 1 << 20
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
SPACE_FREE = ~SPACE


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each document, and their number per document.

    A-Z count as a-z; a document of fewer than ``k`` words has its whole sequence
    as its one shingle, one without words has none.
    """
    data = LOWER[data]
    s, e, _, counts = words(data, off, SPACE_FREE)
    w = span_hash(prefix_hash(data), s, e)
    first = np.cumsum(counts) - counts
    acc = np.zeros(max(0, len(w) - k + 1), np.uint64)
    for j in range(k):
        acc = acc * _STEP + w[j : j + len(acc)]
    acc = mix(acc)
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    start = np.cumsum(n) - n
    out = np.empty(int(n.sum()), np.uint64)
    long = counts >= k
    src = np.repeat(first[long] - (np.cumsum(n[long]) - n[long]), n[long]) + np.arange(int(n[long].sum()))
    out[np.repeat(long, n)] = acc[src]
    for d in np.flatnonzero((counts > 0) & ~long):
        h = np.full(1, counts[d], np.uint64)
        for x in w[first[d] : first[d] + counts[d]]:
            h = mix(h * _STEP + x)
        out[start[d]] = h[0]
    for lo, size in zip(start[n > 1].tolist(), n[n > 1].tolist(), strict=True):
        out[lo : lo + size].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[start[n > 0]] = True
    seen = np.zeros(len(out) + 1, np.int64)
    np.cumsum(new, out=seen[1:])
    return out[new], seen[start + n] - seen[start]


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(7)
    return r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 1 << 63, n, dtype=np.uint64)


def half_keys(sets: np.ndarray, n: np.ndarray, half: int = HALF_KEYS, width: int = WIDTH) -> np.ndarray:
    """(documents with a shingle) x (2 * half) keys; column order: collection U, then V."""
    head = (np.cumsum(n) - n)[n > 0]
    a, b = _seeds(2 * half * width)
    out = np.zeros((len(head), 2 * half), np.uint64)
    if not len(head):
        return out
    for i in range(2 * half * width):
        v = sets * a[i]
        v += b[i]
        v ^= v >> np.uint64(29)
        low = np.minimum.reduceat(v, head)
        out[:, i // width] = mix(out[:, i // width] * _STEP + low + np.uint64(i + 1))
    return out


def signatures(docs: DataFrame, half: int = HALF_KEYS, width: int = WIDTH, k: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, us, vs): set size, 128-bit hash of the set, half keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, off in chunks(b.column(1)):
                sets, n = shingle_sets(data, off, k)
                keys = np.zeros((hi - lo, 2 * half), np.uint64)
                sums = np.zeros((2, hi - lo), np.uint64)
                some = n > 0
                if some.any():
                    keys[some] = half_keys(sets, n, half, width)
                    head = (np.cumsum(n) - n)[some]
                    sums[0, some] = np.add.reduceat(mix(sets), head)
                    sums[1, some] = np.add.reduceat(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), head)
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * half), pa.array(np.ascontiguousarray(x).view(np.int64).reshape(-1))) for x in (keys[:, :half], keys[:, half:])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), *(pa.array(x.view(np.int64)) for x in sums), *lists], ["doc_id", "n_shingles", "s1", "s2", "us", "vs"])

    return docs.select("doc_id", "text").mapInArrow(sign, "doc_id long, n_shingles long, s1 long, s2 long, us array<long>, vs array<long>")


def table_rows(classes: DataFrame) -> DataFrame:
    """(key, cid) of the tables: pairs of a U key and a V key that each occur in two classes.

    A table key can only be shared if both of its halves are, so halves of one
    class alone are left out before the pairs are formed.
    """
    parts = []
    for side in ("us", "vs"):
        rows = classes.select("cid", F.explode(side).alias("h"))
        shared = rows.groupBy("h").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).filter("lo < hi").select(F.col("h").alias("s"))
        parts.append(rows.join(shared, F.col("h") == F.col("s")).groupBy("cid").agg(F.collect_set("h").alias(side)))
    pairs = parts[0].join(parts[1], "cid").select("cid", F.explode("us").alias("u"), "vs").select("cid", "u", F.explode("vs").alias("v"))
    return pairs.select(F.xxhash64("u", "v").alias("key"), "cid")


def _fits(a: Column, b: Column, percent: int) -> Column:
    """Whether set sizes allow the similarity at all."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def sets_of(texts: DataFrame, k: int = WORDS) -> DataFrame:
    """``texts`` (text, ...) with the text replaced by ``shingles``, its sorted 64-bit shingle hashes."""
    rest = [f for f in texts.schema if f.name != "text"]

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, off in chunks(b.column(len(rest))):
                sets, n = shingle_sets(data, off, k)
                each = [x.tobytes() for x in np.split(sets, np.cumsum(n)[:-1])]
                yield pa.RecordBatch.from_arrays([*(b.column(i).slice(lo, hi - lo) for i in range(len(rest))), pa.array(each, pa.binary())], [*(f.name for f in rest), "shingles"])

    return texts.select(*(f.name for f in rest), "text").mapInArrow(shingle, T.StructType([*rest, T.StructField("shingles", T.BinaryType())]))


def tiles(members: DataFrame, tile: int | None = None, most: int | None = None) -> DataFrame:
    """(hub, i, j, right, cid, comp, shingles): the blocks i and j of a hub that meet in a task.

    A group is cut into as many blocks as its members and its shingles need; a set
    is sent once for each block of its group, so a group of one block is sent once.
    """
    size = F.ceil(F.greatest(F.count("*") / (tile or TILE), F.sum(F.length("shingles") / 8) / (most or TILE_SHINGLES)))
    count = members.groupBy(F.col("hub").alias("c_hub")).agg(size.alias("blocks"))
    rows = members.join(count, F.col("hub") == F.col("c_hub"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return rows.select("hub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("right"), "cid", "comp", "shingles")


def across(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join the components of members (hub, cid, comp, shingles) of one hub.

    A task numbers the shingles of two blocks and counts the intersections of a
    member with all others at once.  Sets are whole, so what it emits is verified;
    once two components are joined in a task, their pairs are not looked at again.
    """
    rows = tiles(members)

    def compare(right: np.ndarray, cid: np.ndarray, comp: np.ndarray, shingles: pa.Array) -> list[tuple[int, int]]:
        comp = np.unique(comp, return_inverse=True)[1]
        left = np.flatnonzero(~right)
        other = np.flatnonzero(right) if right.any() else left
        if not len(left) or comp.max() == 0:
            return []
        raw, off = buffers(shingles)
        n = np.diff(off) // 8
        ids = np.unique(raw[off[0] : off[-1]].view(np.uint64), return_inverse=True)[1]
        head = np.cumsum(n) - n
        spans = [ids[h : h + m] for h, m in zip(head.tolist(), n.tolist(), strict=True)]
        flag = np.zeros(int(ids.max()) + 1, bool)
        found = []
        for x in left:
            y = other[(comp[other] != comp[x]) & (np.minimum(n[other], n[x]) * 100 >= np.maximum(n[other], n[x]) * percent)]
            if other is left:
                y = y[y > x]
            if not len(y):
                continue
            flag[spans[x]] = True
            inter = np.add.reduceat(flag[np.concatenate([spans[i] for i in y])], np.cumsum(n[y]) - n[y], dtype=np.int64)
            flag[spans[x]] = False
            for i in y[inter * 100 >= (n[y] + n[x] - inter) * percent]:
                if comp[i] != comp[x]:
                    found.append((int(max(cid[x], cid[i])), int(min(cid[x], cid[i]))))
                    comp[comp == comp[i]] = comp[x]
        return found

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def groups(table: pa.Table, final: bool):
            g = [table.column(c).to_numpy() for c in ("hub", "i", "j")]
            new = np.r_[True, (g[0][1:] != g[0][:-1]) | (g[1][1:] != g[1][:-1]) | (g[2][1:] != g[2][:-1])]
            head = np.append(np.flatnonzero(new), len(new))
            last = len(head) - 1 if final else len(head) - 2
            cols = [table.column(c).to_numpy() for c in ("right", "cid", "comp")]
            sets = table.column("shingles")
            got = [p for lo, hi in zip(head[:last].tolist(), head[1 : last + 1].tolist(), strict=True) if hi - lo > 1 for p in compare(*(c[lo:hi] for c in cols), sets.slice(lo, hi - lo))]
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in got], pa.int64()), pa.array([p[1] for p in got], pa.int64())], ["a", "b"]), table.slice(int(head[last]))

        for b in batches:
            if b.num_rows:
                out, rest = groups(pa.Table.from_batches([*held, b]), False)
                held = rest.to_batches()
                yield out
        if held:
            yield groups(pa.Table.from_batches(held), True)[0]

    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "hub", "i", "j").sortWithinPartitions("hub", "i", "j").mapInArrow(stream, "a long, b long").distinct()


def verify(pairs: DataFrame, texts: DataFrame, k: int = WORDS) -> DataFrame:
    """(x, y, inter, uni): intersection and union of the full shingle sets of pairs (x, y)."""
    left = pairs.join(texts.select(F.col("cid").alias("x"), F.col("text").alias("tx")).hint("merge"), "x")
    both = left.join(texts.select(F.col("cid").alias("y"), F.col("text").alias("ty")).hint("merge"), "y").select("x", "y", "tx", "ty")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                got = []
                for col in (part.column(2), part.column(3)):
                    each: list[np.ndarray] = []
                    for _, _, data, off in chunks(col):
                        sets, n = shingle_sets(data, off, k)
                        each += np.split(sets, np.cumsum(n)[:-1])
                    got.append(each)
                inter = [int(np.isin(p, q, assume_unique=True).sum()) for p, q in zip(*got, strict=True)]
                union = [len(p) + len(q) - i for p, q, i in zip(*got, inter, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(inter, pa.int64()), pa.array(union, pa.int64())], ["x", "y", "inter", "uni"])

    return both.mapInArrow(compare, "x long, y long, inter long, uni long")


def links(classes: DataFrame, docs: DataFrame, percent: int = PERCENT, k: int = WORDS) -> DataFrame:
    """Verified edges (a, b) that connect every linked candidate pair of classes.

    A table's bucket is not expanded into pairs.  The buckets that have the same
    least member form a group with it as hub.  Members are compared with the hub,
    so n near copies cost n comparisons; members that are still in different
    components are compared block by block on their shingle sets, so no link
    between candidates is lost.  All joins with texts are sort-merge joins at any
    size: neither side has a bound.
    """
    sizes = classes.select("cid", "n_shingles")
    raw = table_rows(classes)
    per = raw.groupBy("key").agg(F.min("cid").alias("hub"), F.max("cid").alias("top"), F.count("*").alias("n"), F.sum(F.xxhash64("cid") % 1_000_000_007).alias("s")).filter("hub < top")
    # tables often repeat one set of members: one of them is enough
    per = per.groupBy("hub", "top", "n", "s").agg(F.min("key").alias("k")).select("k", "hub")
    members = stored(raw.join(per, F.col("key") == F.col("k")).select("hub", "cid").distinct().join(sizes, "cid"), "groups")
    ids = members.select("cid").distinct().hint("merge")
    texts = stored(docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("cid")).select("cid", "text").dropDuplicates(["cid"]), "texts")
    on = sizes.select(F.col("cid").alias("y"), F.col("n_shingles").alias("ny"))
    pairs = members.filter("cid <> hub").select(F.col("cid").alias("x"), F.col("hub").alias("y"), F.col("n_shingles").alias("nx")).join(on, "y").filter(_fits(F.col("nx"), F.col("ny"), percent))
    done = verify(pairs.select("x", "y"), texts, k).filter(F.col("inter") * 100 >= F.col("uni") * percent)
    edges = stored(done.select(F.col("x").alias("a"), F.col("y").alias("b")), "verified")
    open_ = still_open(members, edges).select("hub", "cid", "comp").join(texts.hint("merge"), "cid")
    return edges.union(stored(across(sets_of(open_, k), percent), "verified"))


def still_open(members: DataFrame, edges: DataFrame) -> DataFrame:
    """``members`` (hub, cid, ...) of the groups that span several components, with ``comp``."""
    comp = stored(connected_components(edges), "components")
    named = members.join(comp, F.col("cid") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "cid")).drop("node", "component")
    wide = named.groupBy(F.col("hub").alias("w_hub")).agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 < c1").select("w_hub")
    return stored(named.join(wide, F.col("hub") == F.col("w_hub")).drop("w_hub"), "open")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, half: int = HALF_KEYS, width: int = WIDTH, k: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their
    shingle sets; component_id is the smallest doc_id reachable.  Equal sets form
    a class first, so copies cost one aggregate.  Null and empty texts have no
    shingle and are linked with nothing.  Rows that repeat a doc_id count as one
    document, whose component they share.
    """
    since = mark()
    sig = stored(signatures(docs, half, width, k), "signatures")
    some = sig.filter("n_shingles > 0 and doc_id is not null")
    classes = stored(some.groupBy("n_shingles", "s1", "s2").agg(F.min("doc_id").alias("cid"), F.first("us").alias("us"), F.first("vs").alias("vs")), "classes")
    comp = connected_components(links(classes, docs, percent, k))
    release(since, sig, classes, comp)
    named = classes.join(comp, F.col("cid") == F.col("node"), "left").select(F.col("n_shingles").alias("c_n"), F.col("s1").alias("c1"), F.col("s2").alias("c2"), F.coalesce("component", "cid").alias("component"))
    rows = sig.select("doc_id", "n_shingles", "s1", "s2")
    out = rows.join(named, (F.col("n_shingles") == F.col("c_n")) & (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")) & F.col("doc_id").isNotNull(), "left")
    label = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", label.alias("component_id"), F.coalesce(F.col("doc_id") == label, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are the first document of their component.

    One row is kept where a kept document is given more than once; rows without
    a doc_id are all kept.  Other columns, whatever their names, stay as they are.
    """
    kept = near_duplicates(docs, percent).filter("kept and doc_id is not null").select(F.col("doc_id").alias("k_id")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id")
    one = rows.join(kept, F.col("doc_id") == F.col("k_id")).groupBy("doc_id").agg(F.first("row").alias("row"))
    return one.select("row.*").union(rows.filter("doc_id is null").select("row.*"))
