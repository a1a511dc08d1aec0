"""Removal of repeated byte strings of a minimum length, exact over all documents.

1. Anchors.  From every window of ``length`` bytes the K-gram with the least hash
   is an anchor, so equal windows share an anchor at the same offset.  Anchors
   are grouped by hash over all documents, each with a hash of its context (the
   bytes that windows through it can reach).
2. An occurrence whose whole context occurred before is removed as it stands.
   Only contexts that differ while they share an anchor, at the edges of repeated
   passages, are looked at closer; they are gathered in bundles by the 512-byte
   block where the anchor first occurs.
3. In a block of bundles, a Burrows-Wheeler transform is extended backward
   breadth-first: the boundaries between suffixes with common prefixes of 0, 1,
   2, ... bytes are derived from those with one byte less.  At ``length`` the
   expansion stops: what is still undivided are classes of equal windows, of which
   the earliest start stays.
4. A bundle of more than a block is divided first, by the bytes that all windows
   within some distance of an anchor share; equal windows stay together.  What is
   still more than a block is divided again at a smaller distance, down to single
   windows.  So blocks are bounded, and every block is decided by the transform.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.lineage import sequence_ids
from .kernels import buffers, chunks, mix, powers, prefix_hash, span_hash
from .tables import mark, release, stored

LENGTH, GRAM = 100, 20
BLOCK = 512
#: Places whose hashes are compared together; they fit the cache.
CACHED = 1 << 14
#: Bytes of bundles that are transformed together; bytes of contexts from which a bundle is
#: divided; and the window starts that the parts have, division by division.
TOGETHER, DIVIDE, WIDTHS = 1 << 20, 6 << 20, (27, 9, 1)


def document_keys(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``docs`` with a long ``key`` in the order of doc_id, one per (doc_id, text), and
    whether each row has a key of its own.

    That is doc_id itself where ids are unique and not null.  Otherwise null
    sorts first, and texts that share an id are ordered by a hash of the text;
    ranks come from a distributed sort.
    """
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.filter("n > 1 or doc_id is null").isEmpty():
        return docs.withColumn("key", F.col("doc_id")), True
    named = docs.withColumn("k_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = named.select(F.col("doc_id").alias("r_id"), F.col("k_hash").alias("r_hash")).distinct()
    ranks = stored(sequence_ids(rows, [F.asc_nulls_first("r_id"), F.asc("r_hash")], "key"), "keys")
    return named.join(ranks, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("k_hash") == F.col("r_hash"))).drop("r_id", "r_hash", "k_hash"), False


def anchor_places(prefix: np.ndarray, off: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the anchors of a buffer of documents, their hashes and their documents."""
    n, w = len(prefix) - gram, length - gram + 1
    none = np.zeros(0, np.int64)
    if n < w:
        return none, none.view(np.uint64), none
    inverse, count = powers(len(prefix))[1], n - w + 1
    m = np.empty(count, np.uint32)
    for lo in range(0, count, CACHED):  # least hash, then last place, of each run of w grams, by doubling
        end = min(count, lo + CACHED) + w - 1
        low = mix((prefix[lo + gram : end + gram] - prefix[lo:end]) * inverse[lo:end])
        low &= np.uint64(0xFFFFFFFF00000000)
        low |= np.arange(n - 1 - lo, n - 1 - end, -1, dtype=np.uint64)
        size = 1
        while size * 2 <= w:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < w:
            low = np.minimum(low[: len(low) - (w - size)], low[w - size :])
        m[lo : lo + CACHED] = low.astype(np.uint32)
    size = np.diff(off)
    first = np.zeros(len(m) + 1, np.int32)  # a window must not cross documents
    long = np.flatnonzero(size >= length)
    np.add.at(first, off[long], 1)
    np.add.at(first, off[long] + size[long] - length + 1, -1)
    inside = np.cumsum(first[:-1]) > 0
    got = m[inside]
    at = n - 1 - np.unique(got[np.r_[True, got[1:] != got[:-1]]] if len(got) else got).astype(np.int64)[::-1]
    h = mix((prefix[at + gram] - prefix[at]) * inverse[at])
    return at, h, np.searchsorted(off, at, side="right") - 1


def anchors(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(a, c, d, s, e): anchors with context hash c, document d and context [s, e).

    Where a and c repeat within the texts read together, the first stays; the
    others are certain repeats and come as merged intervals [s, e), c being null.
    """
    reach = length - gram

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy()
            for lo, hi, data, off in chunks(b.column(1)):
                prefix = prefix_hash(data)
                at, a, doc = anchor_places(prefix, off, length, gram)
                if not len(at):
                    continue
                s, e = np.maximum(off[doc], at - reach), np.minimum(off[doc + 1], at + gram + reach)
                c = span_hash(prefix, s, e) ^ mix((at - s).astype(np.uint64))
                d = keys[lo:hi][doc]
                order = np.lexsort((at, d, c, a))
                a, c, d, s, e = a[order], c[order], d[order], (s - off[doc])[order], (e - off[doc])[order]
                new = np.r_[True, (a[1:] != a[:-1]) | (c[1:] != c[:-1])]
                x, y, z = merge(d[~new], s[~new], e[~new], length)
                a = np.concatenate([a[new], mix(x.view(np.uint64) ^ y.astype(np.uint64))])
                cols = [a.view(np.int64), np.concatenate([c[new].view(np.int64), np.zeros(len(x), np.int64)]), *(np.concatenate([p[new], q]) for p, q in ((d, x), (s, y), (e, z)))]
                mask = np.r_[np.zeros(int(new.sum()), bool), np.ones(len(x), bool)]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1], mask=mask), pa.array(cols[2]), pa.array(cols[3].astype(np.int32)), pa.array(cols[4].astype(np.int32))], ["a", "c", "d", "s", "e"])

    return docs.select("key", "text").mapInArrow(find, "a long, c long, d long, s int, e int")


def merge(d: np.ndarray, s: np.ndarray, e: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of intervals of at least ``least`` bytes, document by document."""
    ok = e - s >= least
    d, s, e = d[ok], s[ok], e[ok]
    if not len(d):
        return d, s, e
    order = np.lexsort((s, d))
    d, s, e = d[order], s[order].astype(np.int64), e[order].astype(np.int64)
    doc = np.cumsum(np.r_[0, d[1:] != d[:-1]])
    lift = doc * (int(e.max()) + 1)  # documents one after another: a running maximum stays inside one
    far = np.maximum.accumulate(e + lift)
    new = np.r_[True, (s + lift)[1:] > far[:-1]]
    head = np.flatnonzero(new)
    last = np.r_[head[1:] - 1, len(d) - 1]
    return d[head], s[head], far[last] - lift[head]


def resolve(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(d, s, e, bundle): repeats (bundle null) and the contexts to be looked at closer.

    Reads anchors range by range of their hash; a group that fills many batches is
    reduced to its distinct contexts as it comes.
    """

    def settle(a, c, d, s, e, final):
        """Repeats, open contexts with their bundle, and (unless final) what to keep of the group."""
        order = np.lexsort((s, d, a))
        a, c, d, s, e = a[order], c[order], d[order], s[order], e[order]
        new = np.r_[True, a[1:] != a[:-1]]
        g = np.cumsum(new) - 1
        o = np.lexsort((np.arange(len(a)), c, g))
        first = np.zeros(len(a), bool)
        first[o[np.r_[True, (g[o][1:] != g[o][:-1]) | (c[o][1:] != c[o][:-1])]]] = True
        rep = ~first
        out = merge(d[rep], s[rep], e[rep], length)
        if not final:
            return out, None, (a[first], c[first], d[first], s[first], e[first])
        head = np.flatnonzero(new)
        kinds = np.add.reduceat(first.astype(np.int64), head)
        show = first & (kinds[g] > 1) & (e - s >= length)
        with np.errstate(over="ignore"):
            bundle = mix(d[head].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (s[head] // BLOCK).astype(np.uint64)).view(np.int64)[g]
        return out, (d[show], s[show], e[show], bundle[show]), None

    def batch_of(rep, show) -> pa.RecordBatch:
        d, s, e = (np.concatenate([r, x]) if show else r for r, x in zip(rep, (show or rep)[:3], strict=True))
        bundle = np.concatenate([np.zeros(len(rep[0]), np.int64), show[3]]) if show else np.zeros(len(rep[0]), np.int64)
        mask = np.arange(len(d)) < len(rep[0])
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(bundle, mask=mask)], ["d", "s", "e", "bundle"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            c_col = b.column(1)
            sure = c_col.is_null().to_numpy(zero_copy_only=False)
            a, c, d, s, e = b.column(0).to_numpy(), c_col.fill_null(0).to_numpy(), *(b.column(i).to_numpy() for i in (2, 3, 4))
            if sure.any():
                yield batch_of((d[sure], s[sure], e[sure]), None)
                a, c, d, s, e = a[~sure], c[~sure], d[~sure], s[~sure], e[~sure]
            if not len(a):
                continue
            # hold back the last group: it may go on in the next batch
            cut = int(np.searchsorted(a, a[-1])) if a[0] != a[-1] else 0
            parts = (a, c, d, s, e)
            if cut or (held and held[-1][0][0] != a[0]):
                ready = [*held, tuple(x[:cut] for x in parts)]
                held = [tuple(x[cut:] for x in parts)]
                rep, show, _ = settle(*(np.concatenate(x) for x in zip(*ready, strict=True)), True)
                yield batch_of(rep, show)
            else:
                held.append(parts)
                if len(held) > 64:
                    rep, _, keep = settle(*(np.concatenate(x) for x in zip(*held, strict=True)), False)
                    held = [keep]
                    yield batch_of(rep, None)
        if held:
            rep, show, _ = settle(*(np.concatenate(x) for x in zip(*held, strict=True)), True)
            yield batch_of(rep, show)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "a").sortWithinPartitions("a").mapInArrow(stream, "d long, s int, e int, bundle long")


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a byte string sorted by ``depth`` bytes at least: by 8 bytes, and then by
    the ranks of two or, where three fit a number, three parts sorted before."""
    n = len(text)
    padded = np.concatenate([text, np.full(8, 255, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = (key << np.uint64(8)) | padded[j : j + n]
    have, parts = 8, 3 if n < 1 << 21 else 2
    while True:
        order = np.argsort(key)
        if have >= depth:
            return order
        step = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.r_[False, step[1:] != step[:-1]], dtype=np.uint64)
        # beyond the end all bytes are 255: the largest rank there is
        longer = np.concatenate([rank, np.full((parts - 1) * have, rank.max(initial=0) + np.uint64(1), np.uint64)])
        key = rank
        for j in range(1, parts):
            key = (key << np.uint64(64 // parts)) | longer[j * have : j * have + n]
        have *= parts


def window_classes(order: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """For each place of the sorted suffixes, whether a new class of ``length``-byte prefixes begins.

    ``lcp[LF(j)] = 1 + min(lcp[i + 1 .. j])``, i being the place before j with the
    same byte in the transform.  Taken by increasing value: place LF(j) becomes a
    boundary at the first value with a boundary in (i, j].  The last boundary up to
    j decides that, so at each value only the classes that begin at the boundaries
    of the value before are looked at.
    """
    n = len(text)
    bwt = text[order - 1]
    by_byte = np.argsort(bwt, kind="stable")
    same = np.r_[False, bwt[by_byte][1:] == bwt[by_byte][:-1]]
    boundary = ~same  # value 0: another first byte
    after = np.empty(n, np.int32)  # LF
    after[by_byte] = np.arange(n, dtype=np.int32)
    before = np.full(n, n, np.int32)  # i, or n if there is none
    before[by_byte[1:][same[1:]]] = by_byte[:-1][same[1:]]
    fresh = np.flatnonzero(boundary).astype(np.int32)
    for _ in range(1, length):
        if not len(fresh):
            break
        starts = np.flatnonzero(boundary).astype(np.int32)
        if 20 * len(fresh) > len(starts):
            new = np.zeros(n, bool)
            new[fresh] = True
            at = np.flatnonzero(new[starts])
        else:
            at = np.searchsorted(starts, fresh)
        size = np.append(starts[1:], np.int32(n))[at] - fresh
        total = np.cumsum(size, dtype=np.int32)
        head = np.repeat(fresh, size)
        j = np.repeat(fresh - total + size, size)
        j += np.arange(len(j), dtype=np.int32)
        to = after[j[before[j] < head]]
        fresh = np.sort(to[~boundary[to]])
        boundary[fresh] = True
    return boundary


def repeated_windows(text: np.ndarray, place: np.ndarray, valid: np.ndarray, length: int) -> np.ndarray:
    """Starts of valid windows that equal a valid window with a smaller ``place``."""
    if len(text) < length or not valid.any():
        return np.zeros(0, np.int64)
    order = suffix_order(text, length)
    new = window_classes(order, text, length)
    group = np.cumsum(new) - 1
    ok = valid[order]
    order, group = order[ok], group[ok]
    head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    low = np.minimum.reduceat(place[order], head)
    late = place[order] > np.repeat(low, np.diff(np.r_[head, len(order)]))
    return np.sort(order[late])


def expand(regions: DataFrame, length: int = LENGTH) -> DataFrame:
    """(d, s, e): repeats within the bundles of regions (bundle, d, s, body).

    Bodies of a bundle that are equal byte by byte are held once, the earliest: the
    others are repeats as they stand.
    """

    def flush(bodies: dict[tuple, tuple], repeats: list[tuple]) -> pa.RecordBatch:
        held = [(d, s, body) for (_, body), (d, s) in bodies.items()]
        d = np.array([x[0] for x in held], np.int64)
        s = np.array([x[1] for x in held], np.int64)
        sizes = np.array([len(x[2]) for x in held], np.int64)
        text = np.frombuffer(b"".join(x[2] + b"\xff" for x in held), np.uint8)
        head = np.cumsum(sizes + 1) - sizes - 1
        who = np.repeat(np.arange(len(held)), sizes + 1)
        inner = np.arange(len(text)) - head[who]
        place = (np.unique(d, return_inverse=True)[1][who] << 32) | (s[who] + inner)
        valid = inner + length <= sizes[who]
        late = repeated_windows(text, place, valid, length)
        at = s[who[late]] + inner[late]
        more = np.array(repeats, np.int64).reshape(-1, 3)
        x, y, z = merge(np.concatenate([d[who[late]], more[:, 0]]), np.concatenate([at, more[:, 1]]), np.concatenate([at + length, more[:, 2]]), length)
        return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y.astype(np.int32)), pa.array(z.astype(np.int32))], ["d", "s", "e"])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        repeats: list[tuple] = []
        size, last = 0, None
        for b in batches:
            for bundle, d, s, body in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if (size >= TOGETHER and bundle != last) or len(repeats) >= 100_000:
                    full = size >= TOGETHER and bundle != last
                    yield flush(held if full else {}, repeats)
                    repeats = []
                    if full:
                        held, size = {}, 0
                last, old = bundle, held.get((bundle, body))
                if old is None:
                    size += len(body)
                    held[bundle, body] = (d, s)
                elif old != (d, s):  # a division can give a part twice
                    held[bundle, body] = min(old, (d, s))
                    late = max(old, (d, s))
                    repeats.append((*late, late[1] + len(body)))
        if held:
            yield flush(held, repeats)

    n = int(regions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return regions.repartition(n, "bundle").sortWithinPartitions("bundle").mapInArrow(stream, "d long, s int, e int")


def cut_regions(docs: DataFrame) -> DataFrame:
    """(bundle, d, s, body) from documents with a list ``spots`` of (bundle, s, e)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = buffers(b.column(1))
            lists = b.column(2)
            spots = lists.flatten()
            bundle, s, e = (spots.field(i).to_numpy() for i in range(3))
            doc = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            # merge overlapping contexts of a document in one bundle
            order = np.lexsort((s, bundle, doc))
            doc, bundle, s, e = doc[order], bundle[order], s[order].astype(np.int64), e[order].astype(np.int64)
            if not len(doc):
                continue
            key = np.cumsum(np.r_[0, (doc[1:] != doc[:-1]) | (bundle[1:] != bundle[:-1])])
            k, x, y = merge(key, s, e)
            first = np.searchsorted(key, k)
            start = off[doc[first]]
            body = [raw[p:q].tobytes() for p, q in zip((start + x).tolist(), (start + y).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(bundle[first]), b.column(0).take(pa.array(doc[first])), pa.array(x.astype(np.int32)), pa.array(body, pa.binary())], ["bundle", "d", "s", "body"])

    return docs.select("key", "text", "spots").mapInArrow(cut, "bundle long, d long, s int, body binary")


def per_document(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame | None]:
    """(p_key, cover, spots) of documents (key, text): repeats, and contexts to look at
    closer; and the bundles (h_bundle) of more than ``DIVIDE`` bytes, None if there are none."""
    found = stored(resolve(anchors(texts, length, gram), length), "repeats")
    repeat = F.when(F.col("bundle").isNull(), F.struct("s", "e"))
    spot = F.when(F.col("bundle").isNotNull(), F.struct("bundle", "s", "e"))
    per = found.groupBy(F.col("d").alias("p_key")).agg(F.collect_list(repeat).alias("cover"), F.collect_list(spot).alias("spots"))
    size = F.sum((F.col("e") - F.col("s")).cast("long"))
    hot = stored(found.filter("bundle is not null").groupBy(F.col("bundle").alias("h_bundle")).agg(size.alias("size")).filter(F.col("size") > DIVIDE).select("h_bundle"), "hot")
    return per, None if hot.isEmpty() else hot


def look_closer(rows: DataFrame, hot: DataFrame | None = None, length: int = LENGTH) -> DataFrame:
    """``rows`` (key, text, cover, spots, ...) with all repeats in ``cover``; only the texts
    of documents with spots are shuffled."""
    open_ = F.coalesce(F.size("spots"), F.lit(0)) > 0
    hard = rows.filter(open_)
    regions = cut_regions(hard)
    if hot is None:
        more = expand(regions, length)
    else:
        more = divided(stored(regions, "regions"), hot, length)
    closer = more.groupBy(F.col("d").alias("p_key")).agg(F.collect_list(F.struct("s", "e")).alias("more"))
    joined = hard.join(closer, F.col("key") == F.col("p_key"), "left")
    joined = joined.withColumn("cover", F.concat("cover", F.coalesce("more", F.array().cast("array<struct<s:int,e:int>>"))))
    return rows.filter(~open_).drop("spots").unionByName(joined.drop("spots", "p_key", "more"))


def divided(regions: DataFrame, hot: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(d, s, e): repeats of regions (bundle, d, s, body), the bundles ``hot`` in parts.

    Parts are tables, and division goes on only with those that are still more
    than a block.  The last division makes each window a part of its own.
    """
    own = F.col("bundle") == F.col("h_bundle")
    more = expand(regions.join(hot, own, "left_anti"), length)
    rows = regions.join(hot, own, "left_semi")
    for width in WIDTHS:
        parts = stored(divide(rows, width, length, gram), "parts")
        sure = parts.filter("bundle is null").select("d", "s", (F.col("s") + F.length("body")).alias("e"))
        parts = parts.filter("bundle is not null")
        size = F.sum(F.length("body").cast("long"))
        hot = stored(parts.groupBy(F.col("bundle").alias("h_bundle")).agg(size.alias("size")).filter(F.col("size") > DIVIDE).select("h_bundle"), "hot")
        if width == 1 or hot.isEmpty():
            return more.unionByName(sure).unionByName(expand(parts, length))
        more = more.unionByName(sure).unionByName(expand(parts.join(hot, own, "left_anti"), length))
        rows = parts.join(hot, own, "left_semi")
    return more


def divide(regions: DataFrame, width: int, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(bundle, d, s, body): the windows of ``regions``, ``width`` starts of one anchor to a part.

    A part's bundle is a hash of the bytes that all its windows share, so equal
    windows, which have equal anchors, meet in one bundle.  Of equal parts read
    together the first stays; the others are certain repeats and have no bundle.
    """
    reach = length - gram

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, off in chunks(b.column(3)):
                prefix = prefix_hash(data)
                at, _, doc = anchor_places(prefix, off, length, gram)
                low = np.repeat(np.arange(0, reach + 1, width), len(at))  # distances of starts from the anchor
                at, doc = np.tile(at, reach // width + 1), np.tile(doc, reach // width + 1)
                high = np.minimum(low + width - 1, reach)
                first, last = np.maximum(off[doc], at - high), np.minimum(off[doc + 1] - length, at - low)
                ok = first <= last
                at, doc, low, high, first, last = (x[ok] for x in (at, doc, low, high, first, last))
                core = span_hash(prefix, at - low, at - high + length)
                bundle = mix(core + low.astype(np.uint64)).view(np.int64)
                d, start = b.column(1).to_numpy()[lo:hi][doc], b.column(2).to_numpy()[lo:hi][doc] + first - off[doc]
                seen: set[tuple] = set()
                raw, new = [], []
                size = last - first  # regions can overlap: the same part of the same document goes once
                order = np.lexsort((size, start, d, bundle))
                same = [x[order] for x in (size, start, d, bundle)]
                order = order[np.r_[True, np.any([x[1:] != x[:-1] for x in same], axis=0)]] if len(order) else order
                order = order[np.lexsort((start[order], d[order]))]
                for x, y, k in zip(first[order].tolist(), (last[order] + length).tolist(), bundle[order].tolist(), strict=True):
                    body = data[x:y].tobytes()
                    raw.append(body)
                    new.append((k, body) not in seen)
                    seen.add((k, body))
                yield pa.RecordBatch.from_arrays([pa.array(bundle[order], mask=~np.array(new, bool)), pa.array(d[order]), pa.array(start[order].astype(np.int32)), pa.array(raw, pa.binary())], ["bundle", "d", "s", "body"])

    return regions.mapInArrow(cut, "bundle long, d long, s int, body binary")


def strip(covered: DataFrame, carry: str) -> DataFrame:
    """(carry, n_removed, n_spans, kept_sha256, kept) of documents (text, cover, carry) without their
    repeats; ``kept`` is text, without the bytes that are no part of a whole UTF-8 character."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = buffers(b.column(1))
            lists = b.column(2)
            spans = lists.flatten()
            bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            s, e = (spans.field(i).to_numpy().astype(np.int64) for i in range(2))
            removed, count, digest, kept = [], [], [], []
            for i in range(b.num_rows):
                lo, hi = bounds[i], bounds[i + 1]
                _, x, y = merge(np.zeros(hi - lo, np.int64), s[lo:hi], e[lo:hi])
                body = raw[off[i] : off[i + 1]]
                mask = np.zeros(len(body) + 1, np.int32)
                np.add.at(mask, x, 1)
                np.add.at(mask, y, -1)
                rest = body[np.cumsum(mask)[:-1] == 0].tobytes()
                removed.append(len(body) - len(rest))
                count.append(len(x))
                digest.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.string())], [carry, "n_removed", "n_spans", "kept_sha256", "kept"])

    schema = T.StructType([covered.schema[carry], T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.StringType())])
    return covered.select(carry, "text", "cover").mapInArrow(apply, schema)


def digests(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``.

    A byte goes if a string of ``length`` bytes that covers it also starts earlier
    (smaller doc_id, or same document and earlier start), judged on the input.
    Null texts are empty.  Rows equal in doc_id and text are one document with a
    result per row; different texts under one doc_id are ordered by a hash.
    """
    keyed, unique = document_keys(docs.select("doc_id", "text"))
    texts = keyed.select("key", "text")
    texts = texts if unique else texts.dropDuplicates(["key"])
    since = mark()
    per, hot = per_document(texts, length, gram)
    some = stored(texts.join(per, F.col("key") == F.col("p_key")).drop("p_key"), "repeating")
    release(since, some, *([hot] if hot else []))
    gone = strip(look_closer(some, hot, length), "key").select(F.col("key").alias("r_key"), "n_removed", "n_spans", "kept_sha256")
    raw = F.coalesce("text", F.lit("")).cast("binary")
    rows = keyed.select("doc_id", "key", F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("all_sha256"))
    out = rows.join(gone, F.col("key") == F.col("r_key"), "left")
    zero = F.lit(0).cast("long")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated bytes taken out of their texts (broken characters at
    the cuts are dropped); rows of which nothing is left go.  n_chars, if there,
    follows the new text.  Other columns, whatever their names, stay as they are."""
    rest = [c for c in docs.columns if c != "text"]
    keyed, unique = document_keys(docs.select("doc_id", "text", F.struct(*rest).alias("rest")))
    texts = keyed.select("key", "text")
    since = mark()
    per, hot = per_document(texts if unique else texts.dropDuplicates(["key"]), length, gram)
    rows = stored(keyed.select("key", "text", "rest").join(per, F.col("key") == F.col("p_key"), "left").drop("p_key"), "repeating")
    release(since, rows, *([hot] if hot else []))
    rows = look_closer(rows, hot, length)
    has = F.coalesce(F.size("cover"), F.lit(0)) > 0
    cut = strip(rows.filter(has), "rest").withColumn("text", F.col("kept")).filter("text <> ''")

    def column(c: str, changed: bool):
        if c == "text":
            return F.col("text")
        old = F.col("rest").getField(c).alias(c)
        return F.length("text").cast(docs.schema[c].dataType).alias(c) if changed and c == "n_chars" else old

    same = rows.filter(~has).select(*(column(c, False) for c in docs.columns))
    return same.unionByName(cut.select(*(column(c, True) for c in docs.columns)))
