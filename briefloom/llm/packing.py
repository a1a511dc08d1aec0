"""Packing documents into sequences by cutting-stock column generation.

Documents are cut at multiples of the capacity; what is left over is packed.  A
linear program over patterns of the histogram of lengths is solved by column
generation (revised simplex, new patterns priced by a knapsack dynamic program);
its patterns are rounded down, the few pieces left are packed first-fit
decreasing, and ranked documents take the places of their length class.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import stored

CAPACITY, END_ID = 2048, 1
#: Lengths are classed by multiples of UNIT tokens: 256 classes at any corpus size.
UNIT = 8


@cache
def _encoders(name: str):
    """The tokenizer and, over the same vocabulary, a faster encoder of plain text."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path(name))
    with open(public_tokenizers.path(name.replace(".json", ".tiktoken")), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return slow, tiktoken.Encoding("pack", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, name: str = "byte_bpe_50k.json") -> np.ndarray:
    """Token ids as ``tokenizers`` gives them.

    Texts of Latin characters without the special token's string take the
    faster encoder, whose splits are the same there; all others the tokenizer.
    """
    slow, fast = _encoders(name)
    if "<|" not in text and (text.isascii() or max(text) < "ɐ"):
        return np.asarray(fast.encode_ordinary(text), np.uint32)
    return np.asarray(slow.encode(text, add_special_tokens=False).ids, np.uint32)


def cut(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str = "byte_bpe_50k.json") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): pieces of at most ``capacity`` ids.

    A null text is empty and gives one piece, the end id.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            who, start, length, crc, total = [], [], [], [], []
            for i, text in enumerate(b.column(1)):
                ids = np.append(encode(text.as_py() or "", tokenizer), np.uint32(end_id)).astype("<u4")
                for at in range(0, len(ids), capacity):
                    part = ids[at : at + capacity]
                    who.append(i)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    total.append(len(ids))
            cols = [b.column(0).take(pa.array(who, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select("doc_id", "text").mapInArrow(pieces, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def price(sizes: np.ndarray, value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the best value and how often it takes each size."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        n = int(np.searchsorted(sizes, c, side="right"))
        if n:
            got = best[c - sizes[:n]] + value[:n]
            k = int(got.argmax())
            if got[k] > best[c] + 1e-12:
                best[c], last[c] = got[k], k
    counts, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            counts[last[c]] += 1
            c -= int(sizes[last[c]])
    return float(best[capacity]), counts


def solve(demand: dict[int, int], capacity: int, gap: float = 2e-4) -> list[tuple[np.ndarray, int]]:
    """Patterns (counts by ascending size, times used) that cover ``demand`` exactly.

    Column generation stops when the bound of the priced-out pattern proves the
    linear program solved to within ``gap`` or half a sequence.
    """
    sizes = np.array(sorted(k for k, v in demand.items() if v), np.int64)
    left = np.array([demand[int(s)] for s in sizes], np.int64)
    m = len(sizes)
    if not m:
        return []
    per = capacity // sizes
    columns = np.diag(per).astype(np.int64)
    inverse, x = np.diag(1.0 / per), left / per
    for _ in range(40 * m):
        dual = inverse.sum(axis=0)
        value, a = price(sizes, np.maximum(dual, 0), capacity)
        total = x.sum()
        if value <= 1 + 1e-9 or total - total / value <= max(0.5, gap * total):
            break
        d = inverse @ a
        up = np.flatnonzero(d > 1e-9)
        r = up[np.argmin(x[up] / d[up])]
        step = x[r] / d[r]
        x = np.maximum(x - step * d, 0)
        x[r] = step
        row = inverse[r] / d[r]
        inverse -= np.outer(d, row)
        inverse[r] = row
        columns[:, r] = a
    out = []
    for j in np.argsort(-x, kind="stable"):
        a = columns[:, j]
        used = a > 0
        times = int(min(np.floor(x[j] + 1e-7), (left[used] // a[used]).min())) if used.any() else 0
        if times:
            out.append((a.copy(), times))
            left -= a * times
    return out + _first_fit(sizes, left, capacity)


def _first_fit(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """The pieces that rounding leaves, largest first, each bin filled before the next."""
    out: dict[bytes, list] = {}
    left = left.copy()
    while left.any():
        room, a = capacity, np.zeros(len(sizes), np.int64)
        for k in range(len(sizes) - 1, -1, -1):
            n = min(int(left[k]), room // int(sizes[k]))
            a[k], room = n, room - n * int(sizes[k])
        times = max(1, int((left[a > 0] // a[a > 0]).min()))
        left -= a * times
        out.setdefault(a.tobytes(), [a, 0])[1] += times
    return [(a, n) for a, n in out.values()]


def places(demand: dict[int, int], capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each size: first rank, number in a sequence, and first sequence of each of its patterns."""
    sizes = sorted(k for k, v in demand.items() if v)
    got: dict[int, list[tuple[int, int, int]]] = {s: [] for s in sizes}
    rank, sequence = dict.fromkeys(sizes, 0), 0
    for a, times in solve(demand, capacity):
        for k, s in enumerate(sizes):
            if a[k]:
                got[s].append((rank[s], int(a[k]), sequence))
                rank[s] += int(a[k]) * times
        sequence += times
    return {s: tuple(np.array(c, np.int64) for c in zip(*v, strict=True)) for s, v in got.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """``pieces`` plus sequence_id and offset, without a gap in any sequence.

    Ranks within a length class follow a hash of the piece.  They are counted in
    4096 slices of each class, so that one length that a third of all documents
    share is ranked by many tasks.  The driver sees 256 counts.
    """
    rows = pieces.withColumn("u", F.ceil(F.col("length") / unit).cast("int")).withColumn("h", F.xxhash64("doc_id", "start", "ids_crc32")).withColumn("slice", F.pmod("h", F.lit(4096)))
    counts = rows.groupBy("u", "slice").agg(F.count("*").alias("n"))
    demand = {r["u"]: r["n"] for r in counts.groupBy("u").agg(F.sum("n").alias("n")).collect()}
    table = pieces.sparkSession.sparkContext.broadcast(places(demand, capacity // unit))
    before = W.partitionBy("u").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    heads = counts.select(F.col("u").alias("h_u"), F.col("slice").alias("h_slice"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("head"))
    rank = F.row_number().over(W.partitionBy("u", "slice").orderBy("h", "doc_id", "start", "ids_crc32")) - 1
    rows = rows.withColumn("in_slice", rank).join(heads, (F.col("u") == F.col("h_u")) & (F.col("slice") == F.col("h_slice")))
    rows = rows.withColumn("rank", F.col("head") + F.col("in_slice")).select(*pieces.columns, "u", "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u, r = b.column("u").to_numpy(), b.column("rank").to_numpy()
            sequence = np.zeros(len(u), np.int64)
            for s in np.unique(u):
                first, per, base = table.value[int(s)]
                here = np.flatnonzero(u == s)
                k = np.searchsorted(first, r[here], side="right") - 1
                sequence[here] = base[k] + (r[here] - first[k]) // per[k]
            yield b.append_column("sequence_id", pa.array(sequence))

    from pyspark.sql.types import LongType, StructField, StructType

    placed = rows.mapInArrow(place, StructType([*rows.schema.fields, StructField("sequence_id", LongType())]))
    inside = W.partitionBy("sequence_id").orderBy(F.desc("u"), "rank").rowsBetween(W.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).select(*pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str = "byte_bpe_50k.json", unit: int = UNIT) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) for every piece.

    Repeated rows are documents of their own; an empty table gives no rows.
    """
    return pack(stored(cut(docs, capacity, end_id, tokenizer), "pieces"), capacity, unit)
