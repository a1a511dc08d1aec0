"""Scoring texts with a small causal self-attention model in numpy.

A text is its lower-cased words and one end; each word is the subword ids of a
space and the word in a public byte-level vocabulary.  The model is one block of
causal self-attention over windows of ids.  It gives the probability of the next
id's class; an id's share of its class comes from counts over all training
texts.  Windows overlap: each id is scored once, with at least ``WINDOW -
STRIDE`` ids before it except at a text's start.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kernels import LOWER, SPACE, buffers, chunks, mix, powers, prefix_hash, span_hash, words
from .tables import held_out, mark, release, stored

VOCABULARY, END = 50257, 50256
WINDOW, STRIDE, WIDTH = 32, 24, 16
CLASSES, OWN_CLASS, OWN_INPUT, INPUTS = 64, 48, 2048, 2560
#: Words whose counts are broadcast; the others are looked up by a join.
TOP_WORDS = 1 << 17
#: Training rounds: sixteenths of all training texts, and Adam's rate.  Every text is in one round.
ROUNDS = ((1, 0.01), (3, 0.01), (12, 0.005))
#: Windows of a training step, and windows whose matrices are formed together (they fit the cache).
BATCH, PART = 64, 64
#: Ids of documents whose windows are listed together for scoring.
SCORED = 1 << 16
#: Counts of a task that are added up together before they go to others.
COMBINED = 1 << 20
#: Bytes of text whose distinct words are encoded together.
READ_BYTES = 6 << 20
END_WORD = np.uint64(0x454E44)  # stands for the end among the word hashes
#: What each subword id, and each place, adds to the hash of the ids before it; see ``word_keys``.
_ID_KEY = mix(np.arange(1, VOCABULARY + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
#: Bits of a slot of the tables of frequent words.
SLOT = 18


@cache
def _encoder():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    starts = np.zeros(VOCABULARY, bool)
    for token, i in ranks.items():
        starts[i] = token[:1] == b" "
    return tiktoken.Encoding("lm", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), starts


def gather(data: np.ndarray, start: np.ndarray, end: np.ndarray, lead: int) -> np.ndarray:
    """The bytes [start, end) of each span, each after one byte ``lead``."""
    n = end - start + 1
    head = np.cumsum(n) - n
    src = np.repeat(start - head - 1, n) + np.arange(int(n.sum()))
    src[head] = 0
    out = data[src] if len(data) else np.zeros(len(src), np.uint8)
    out[head] = lead
    return out


def word_ids(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat subword ids of the words, each after a space, and the number per word."""
    enc, starts = _encoder()
    text = gather(data, start, end, 0x20).tobytes().decode("utf-8")
    ids = np.asarray(enc.encode_ordinary(text), np.int64)
    head = np.flatnonzero(starts[ids]) if len(ids) else np.zeros(0, np.int64)
    if len(head) == len(start):
        return ids, np.diff(np.append(head, len(ids)))
    # a word with Unicode white space can blur the borders: one word at a time
    each = [enc.encode_ordinary(" " + data[s:e].tobytes().decode("utf-8")) for s, e in zip(start, end, strict=True)]
    return np.array([i for x in each for i in x], np.int64), np.array([len(x) for x in each], np.int64)


@dataclass
class Chunk:
    """Words of a run of documents: distinct hashes, each word's place among them and its
    document, and the subword ids of the distinct words."""

    counts: np.ndarray
    distinct: np.ndarray
    inverse: np.ndarray
    doc: np.ndarray
    ids: np.ndarray
    per: np.ndarray


def read_chunk(data: np.ndarray, off: np.ndarray) -> Chunk:
    data = LOWER[data]
    s, e, doc, counts = words(data, off, ~SPACE)
    h = span_hash(prefix_hash(data), s, e)
    order = np.argsort(h)  # np.unique would sort stably, at twice the time
    new = np.r_[True, h[order[1:]] != h[order[:-1]]] if len(h) else np.zeros(0, bool)
    first = order[new]
    distinct, inverse = h[first], np.empty(len(h), np.int64)
    inverse[order] = np.cumsum(new) - 1
    ids, per = word_ids(data, s[first], e[first])
    return Chunk(counts, distinct, inverse, doc, ids, per)


def word_keys(ids: np.ndarray, head: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of words by their subword ids, words being spans [head, end) of ``ids``.

    Ids stand for bytes, so words are equal if and only if their ids are.
    """
    prefix = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum(_ID_KEY[ids] * powers(len(ids) + 1)[0][: len(ids)], out=prefix[1:])
    return span_hash(prefix, head, end)


def words_of_ids(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The key of each word of the documents ``ids``, and their number per document.

    A word's first subword, and no other, begins with the space before the word.
    """
    first = _encoder()[1][ids]
    head = np.flatnonzero(first)
    edge = np.flatnonzero(first | (ids == END))
    after = edge[np.flatnonzero(first[edge]) + 1]  # a word ends where the next one or the document's end is
    off = np.append(0, np.cumsum(lengths))
    per = np.diff(np.searchsorted(head, off))
    return word_keys(ids, head, after), per


def sequences(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of the documents, each closed by END, and their lengths."""
    head = np.cumsum(c.per) - c.per
    n = c.per[c.inverse]
    first = np.cumsum(c.counts) - c.counts
    total = np.append(0, np.cumsum(n))
    lengths = total[first + c.counts] - total[first]
    at = np.repeat(head[c.inverse] - total[:-1], n) + np.arange(int(n.sum()))
    flat = c.ids[at] if len(at) else np.zeros(0, np.int64)
    return np.insert(flat, np.cumsum(lengths), END), lengths + 1


def tokenize(docs: DataFrame) -> DataFrame:
    """Each row's subword ids, and the counts of the training rows, in one pass over the texts.

    Rows of documents (kind null): doc_id, held_out, place (for the training round),
    and ids as 16-bit numbers, which is all that is read of a text later.  Rows of counts,
    some per task: kind 0 words (by ``word_keys``, ends included), kind 1 subword ids, with
    numbers of 64 bits in keys and times.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "held_out", "place", "ids", "kind", "keys", "times"]
        types = [pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
        for b in batches:
            training = ~b.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, data, off in chunks(b.column(3), READ_BYTES):
                c = read_chunk(data, off)
                ids, lengths = sequences(c)
                ids = ids.astype(np.uint16)
                each = [x.tobytes() for x in np.split(ids, np.cumsum(lengths)[:-1])]
                n, learn = hi - lo, training[lo:hi]
                times = np.append(np.bincount(c.inverse[learn[c.doc]], minlength=len(c.distinct)), learn.sum())
                of_ids = np.bincount(ids[np.repeat(learn, lengths)], minlength=VOCABULARY)
                end = np.cumsum(c.per)
                tables = [(np.append(word_keys(c.ids, end - c.per, end), END_WORD), times), (np.arange(VOCABULARY), of_ids)]
                parts = [b.column(i).slice(lo, n) for i in range(3)] + [pa.array(each, pa.binary()), *(pa.nulls(n, t) for t in types[4:])]
                yield pa.RecordBatch.from_arrays(parts, names)
                some = [[x[t > 0].astype(k).tobytes() for x, k in ((keys, np.uint64), (t, np.int64))] for keys, t in tables]
                yield pa.RecordBatch.from_arrays([pa.nulls(2, t) for t in types[:4]] + [pa.array([0, 1], pa.int32()), pa.array([x[0] for x in some], pa.binary()), pa.array([x[1] for x in some], pa.binary())], names)

    place = F.pmod(F.xxhash64("doc_id"), F.lit(sum(n for n, _ in ROUNDS))).cast("int")
    rows = docs.select("doc_id", held_out(F.col("doc_id"), 1).alias("held_out"), place.alias("place"), "text")
    return rows.mapInArrow(read, "doc_id long, held_out boolean, place int, ids binary, kind int, keys binary, times binary")


def count_tokens(tokens: DataFrame) -> DataFrame:
    """(kind, key, n) over all training rows."""

    def combined(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keys, times = np.concatenate(keys), np.concatenate(times)
        order = np.argsort(keys)
        keys = keys[order]
        head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        return keys[head], np.add.reduceat(times[order], head)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def flush(kind: int) -> pa.RecordBatch:
            keys, n = combined(*held.pop(kind))
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(n)], ["kind", "key", "n"])

        for b in batches:
            for kind, keys, times in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if keys:
                    some = held.setdefault(kind, ([], []))
                    some[0].append(np.frombuffer(keys, np.int64))
                    some[1].append(np.frombuffer(times, np.int64))
                    if sum(map(len, some[0])) > COMBINED:
                        yield flush(kind)
        for kind in list(held):
            yield flush(kind)

    rows = tokens.filter("kind is not null").select("kind", "keys", "times")
    return rows.mapInArrow(unpack, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def stored_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and their number per document, from a binary column of 16-bit numbers."""
    raw, off = buffers(column)
    return raw[off[0] : off[-1]].view(np.uint16), np.diff(off) // 2


def windows(ids: np.ndarray, lengths: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs and targets (windows x WINDOW), which targets each window scores, its document."""
    n = np.maximum(1, -(-(lengths - (WINDOW - stride)) // stride))
    doc = np.repeat(np.arange(len(lengths)), n)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * stride
    head = (np.cumsum(lengths) - lengths)[doc] + start
    around = np.lib.stride_tricks.sliding_window_view(np.pad(ids, (1, WINDOW)), WINDOW)  # of any place, from the id before it
    given, target = around[head], around[head + 1]
    given[start == 0, 0] = END
    at = np.arange(WINDOW)
    scored = at < (lengths[doc] - start)[:, None]
    scored[start > 0, : WINDOW - stride] = False
    return given, target, scored, doc


def exp_and_sum(x: np.ndarray, again: Callable[[], np.ndarray], keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """exp(x - top), 0 where ``keep`` is 0, its sums by row, and top: 0 where these sums are
    in range without it, else each row's largest number.  Overwrites x; ``again`` gives it anew."""
    for exact in (False, True):
        top = np.zeros(x.shape[:-1], x.dtype)
        if exact:
            x = again()
            if keep is not None:
                x[..., keep == 0] = -np.inf
            top = x.max(axis=-1)
            x -= top[..., None]
        with np.errstate(over="ignore", invalid="ignore"):
            np.exp(x, out=x)
            if keep is not None:
                x *= keep
            total = (x.reshape(-1, x.shape[-1]) @ np.ones(x.shape[-1], x.dtype)).reshape(x.shape[:-1])
        if total.min(initial=1) > 1e-30 and total.max(initial=1) < 1e30:
            break
    return x, total, top


def with_one(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The rows of x + y, each with a 1 after it."""
    out = np.empty((*x.shape[:-1], x.shape[-1] + 1), x.dtype)
    out[..., -1] = 1
    np.add(x, y, out=out[..., :-1])
    return out.reshape(-1, out.shape[-1])


def summed_products(x: np.ndarray, y: np.ndarray, rows: int = 8 * WINDOW) -> np.ndarray:
    """x.T @ y from ``rows`` rows at a time, in which long thin matrices are multiplied faster."""
    n = len(x) // rows * rows
    out = y[n:].T @ x[n:]
    out += (y[:n].reshape(-1, rows, y.shape[1]).transpose(0, 2, 1) @ x[:n].reshape(-1, rows, x.shape[1])).sum(axis=0)
    return out.T


#: 1 at the places of a window up to each place, 0 at those after it.
EARLIER = np.tril(np.ones((WINDOW, WINDOW), np.float32))
#: The places of an input row's pairs of numbers in the flat input table.
PAIRS = np.arange(INPUTS * WIDTH // 2).reshape(INPUTS, WIDTH // 2)


@dataclass
class Vocabulary:
    """Class and log share of every id, and the row of the input table that it uses."""

    cls: np.ndarray
    share: np.ndarray
    row: np.ndarray

    @staticmethod
    def of(counts: np.ndarray) -> Vocabulary:
        order = np.argsort(-counts, kind="stable")
        cls = np.empty(VOCABULARY, np.int16)
        cls[order[:OWN_CLASS]] = np.arange(OWN_CLASS)
        rest = order[OWN_CLASS:]
        mass = np.cumsum(counts[rest] + 0.5)
        cls[rest] = OWN_CLASS + np.minimum(CLASSES - OWN_CLASS - 1, (mass / mass[-1] * (CLASSES - OWN_CLASS)).astype(np.int16))
        w = counts + 0.5
        share = np.log(w / np.bincount(cls, weights=w, minlength=CLASSES)[cls])
        row = (OWN_INPUT + np.arange(VOCABULARY) % (INPUTS - OWN_INPUT)).astype(np.int16)
        row[order[:OWN_INPUT]] = np.arange(OWN_INPUT)
        return Vocabulary(cls, share, row)


@dataclass
class Network:
    """One block of causal self-attention, a residual, and class logits."""

    p: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(prior: np.ndarray, seed: int = 5, dtype=np.float32) -> Network:
        r = np.random.default_rng(seed)
        g = lambda *s: (r.standard_normal(s) * 0.1).astype(dtype)
        return Network({"emb": g(INPUTS, WIDTH), "pos": g(WINDOW, WIDTH), "qkv": g(WIDTH, 3 * WIDTH) * 2, "mix": g(WIDTH, WIDTH) * 2, "out": g(WIDTH, CLASSES), "bias": np.log(prior).astype(dtype)})

    def projection(self) -> np.ndarray:
        """The weights of queries, keys and values, with the attention's scale in the queries
        and ``mix`` in the values, so that the attention's output is mixed already."""
        w = self.p["qkv"].copy()
        w[:, :WIDTH] *= WIDTH**-0.5
        w[:, 2 * WIDTH :] = w[:, 2 * WIDTH :] @ self.p["mix"]
        return w

    def classes(self) -> np.ndarray:
        """The weights of the logits, and in the last row the bias."""
        return np.concatenate([self.p["out"], self.p["bias"][None]])

    @staticmethod
    def attend(q: np.ndarray, k: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The attention's weights before division by their sums, what to multiply them by for
        that, and the output, from queries (of a window's last places) and all keys and values."""
        products = lambda: q @ k.transpose(0, 2, 1)
        s, total, _ = exp_and_sum(products(), products, EARLIER[WINDOW - q.shape[1] :])
        part = (1 / total)[..., None]
        o = s @ v
        o *= part  # a row of the output is half as long as one of the weights
        return s, part, o

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What an input row, and what a place, adds to queries, keys, values with a 1 after
        them and the residual with a 0; and ``classes``."""
        p, w = self.p, self.projection()
        none = np.zeros((WIDTH, 1), w.dtype)
        w = np.concatenate([w, none, np.eye(WIDTH, dtype=w.dtype), none], axis=1)
        of_place = p["pos"] @ w
        of_place[:, 3 * WIDTH] = 1
        return p["emb"] @ w, of_place, self.classes()

    def log_probs(self, rows: np.ndarray, cls: np.ndarray, scored: np.ndarray | None = None, tables: tuple | None = None, since: int = 0) -> np.ndarray:
        """Natural log of the probability of each target's class, or flat of the ``scored``
        targets'; ``cls`` and ``scored`` are those of the places from ``since`` on."""
        of_row, of_place, classes = tables or self.tables()
        x = of_row.take(rows, axis=0)
        x += of_place
        o = self.attend(x[:, since:, :WIDTH], x[..., WIDTH : 2 * WIDTH], x[..., 2 * WIDTH : 3 * WIDTH + 1])[-1]
        o += x[:, since:, 3 * WIDTH + 1 :]
        h, target = o.reshape(-1, WIDTH + 1), cls.reshape(-1)
        at = np.arange(cls.size) if scored is None else np.flatnonzero(scored)
        some = len(at) < 0.9 * cls.size  # picking nearly all would cost more than it saves
        if some:
            h, target = h.take(at, axis=0), target[at]
        logits = lambda: h @ classes
        z = logits()
        t = z.reshape(-1)[np.arange(len(z)) * CLASSES + target]
        _, total, top = exp_and_sum(z, logits)
        t -= top
        t -= np.log(total)
        if scored is None:
            return t.reshape(cls.shape)
        return t if some else t[at]

    def gradients(self, rows: np.ndarray, cls: np.ndarray, scored: np.ndarray, part: int = PART, g: dict[str, np.ndarray] | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss of the scored targets and its gradients (in ``g``, if given), from ``part`` windows at a time."""
        n, loss, dx = max(1, int(scored.sum())), 0.0, np.empty((*rows.shape, WIDTH), self.p["emb"].dtype)
        g = g or {k: np.empty_like(x) for k, x in self.p.items()}
        for x in g.values():
            x.fill(0)
        for lo in range(0, len(rows), part):
            s = slice(lo, lo + part)
            loss += self._part(rows[s], cls[s].reshape(-1), scored[s].reshape(-1), n, g, dx[s])
        two = np.result_type(dx, np.complex64)  # two numbers are added at a time
        np.add.at(g["emb"].reshape(-1).view(two), PAIRS.take(rows, axis=0).reshape(-1), dx.reshape(-1).view(two))
        return loss / n, g

    def _part(self, rows: np.ndarray, cls: np.ndarray, w: np.ndarray, n: int, g: dict[str, np.ndarray], dx: np.ndarray) -> float:
        """Summed loss; adds to ``g`` and fills ``dx``, the gradient of what goes into the block."""
        p, weights = self.p, self.projection()
        x = p["emb"].take(rows, axis=0)
        x += p["pos"]
        flat_x = x.reshape(-1, WIDTH)
        qkv = (flat_x @ weights).reshape(*rows.shape, 3 * WIDTH)
        q, k, v = (qkv[..., i : i + WIDTH] for i in range(0, 3 * WIDTH, WIDTH))
        s, share, o = self.attend(q, k, v)
        h, classes = with_one(o, x), self.classes()
        logits = lambda: h @ classes
        z, at = logits(), np.arange(len(h)) * CLASSES + cls
        t = z.reshape(-1)[at]
        z, total, top = exp_and_sum(z, logits)
        t -= top
        # the gradient of a row of logits is z times ``per``, which multiplies the shorter rows instead
        z.reshape(-1)[at] -= total
        per = (w / (n * total)).astype(z.dtype)[:, None]
        h *= per
        g["out"] += summed_products(h[:, :-1], z)
        g["bias"] += per[:, 0] @ z
        dh = z @ p["out"].T.copy()
        dh *= per
        do = dh.reshape(o.shape) * share
        ds = do @ v.transpose(0, 2, 1)
        ds -= ((do * o).reshape(-1, WIDTH) @ np.ones(WIDTH, z.dtype)).reshape(*rows.shape, 1)
        ds *= s
        d = np.empty((*rows.shape, 3 * WIDTH), z.dtype)
        np.matmul(ds, k, out=d[..., :WIDTH])
        np.matmul(ds.transpose(0, 2, 1), q, out=d[..., WIDTH : 2 * WIDTH])
        np.matmul(s.transpose(0, 2, 1), do, out=d[..., 2 * WIDTH :])
        d = d.reshape(-1, 3 * WIDTH)
        of_weights = summed_products(flat_x, d).copy()
        of_weights[:, :WIDTH] *= WIDTH**-0.5
        of_mixed = of_weights[:, 2 * WIDTH :].copy()
        g["mix"] += p["qkv"][:, 2 * WIDTH :].T @ of_mixed
        of_weights[:, 2 * WIDTH :] = of_mixed @ p["mix"].T
        g["qkv"] += of_weights
        np.add(dh.reshape(x.shape), (d @ weights.T).reshape(x.shape), out=dx)
        g["pos"] += dx.sum(axis=0)
        return -float((t - np.log(total))[w].sum())

    def flat(self) -> np.ndarray:
        return np.concatenate([x.reshape(-1) for x in self.p.values()])

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """The weights' shapes and names on the numbers of ``flat``."""
        cuts = np.cumsum([x.size for x in self.p.values()])[:-1]
        return {k: part.reshape(x.shape) for (k, x), part in zip(self.p.items(), np.split(flat, cuts), strict=True)}

    def with_weights(self, flat: np.ndarray) -> Network:
        return Network(self.views(flat.astype(self.p["emb"].dtype)))


class Adam:
    """The moments of a network's weights; a step changes the weights in place."""

    def __init__(self, network: Network):
        self.network, self.steps = network, 0
        self.w = network.flat()
        network.p = network.views(self.w)
        self.m, self.u, self.d = np.zeros_like(self.w), np.zeros_like(self.w), np.zeros_like(self.w)
        self.g = network.views(self.d)

    def step(self, rows: np.ndarray, cls: np.ndarray, scored: np.ndarray, rate: float) -> float:
        loss, _ = self.network.gradients(rows, cls, scored, g=self.g)
        self.steps += 1
        lr = rate * (1 - 0.999**self.steps) ** 0.5 / (1 - 0.9**self.steps)
        m, u, d = self.m, self.u, self.d  # ten and a thousand times the moments
        m *= 0.9
        m += d
        d *= d
        u *= 0.999
        u += d
        np.sqrt(u, out=d)
        d += 1e-8 * 1000**0.5
        np.divide(m, d, out=d)
        d *= lr * 0.1 * 1000**0.5
        self.w -= d
        return loss


class Frequent:
    """Counts of frequent words by tables of 2 ** SLOT slots: a word is in the first table that
    had its slot free, more frequent ones first, and tables are added until every word is in one."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.tables = []
        left = np.argsort(-n, kind="stable")
        while len(left):
            slot = self.slot(keys[left], len(self.tables))
            _, first = np.unique(slot, return_index=True)
            here, times = np.full(1 << SLOT, 0, np.uint64), np.full(1 << SLOT, -1, np.int64)
            here[slot[first]], times[slot[first]] = keys[left[first]], n[left[first]]
            self.tables.append((here, times))
            left = np.delete(left, first)

    @staticmethod
    def slot(keys: np.ndarray, table: int) -> np.ndarray:
        """Other bits of the key for each table, and other mixtures of them after the third."""
        for _ in range(table // 3):
            keys = mix(keys + np.uint64(1))
        return ((keys >> np.uint64(64 - SLOT * (table % 3 + 1))) & np.uint64((1 << SLOT) - 1)).astype(np.int64)

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key, -1 for those that are in no table."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for i, (here, times) in enumerate(self.tables):
            mine = keys[left]
            slot = self.slot(mine, i)
            hit = (here[slot] == mine) & (times[slot] >= 0)
            out[left[hit]] = times[slot[hit]]
            left = left[~hit]
        return out


@dataclass
class Scorer:
    vocabulary: Vocabulary
    network: Network
    top: Frequent  # the most frequent words
    complete: bool  # whether ``top`` has every training word

    def texts(self, ids: np.ndarray, lengths: np.ndarray, batch: int = PART) -> np.ndarray:
        """log10 probability of each document, from flat ids and their number per document."""
        tables, out = self.network.tables(), np.zeros(len(lengths))
        end = np.cumsum(lengths)
        lo = 0
        while lo < len(lengths):  # documents of about ``SCORED`` ids, whose windows fit the cache
            first = end[lo] - lengths[lo]
            hi = max(lo + 1, int(np.searchsorted(end, first + SCORED, side="right")))
            given, target, scored, doc = windows(ids[first : end[hi - 1]], lengths[lo:hi])
            rows, cls = self.vocabulary.row[given], self.vocabulary.cls[target]
            begins = scored[:, 0]  # the windows at a text's start; the others score no place before ``WINDOW - STRIDE``
            of_window, per = np.empty(len(doc)), scored.sum(axis=1)
            for since, some in ((0, np.flatnonzero(begins)), (WINDOW - STRIDE, np.flatnonzero(~begins))):
                parts = [some[i : i + batch] for i in range(0, len(some), batch)]
                lp = [self.network.log_probs(rows[w], cls[w, since:], scored[w, since:], tables, since) for w in parts]
                if lp:  # every window scores a place
                    of_window[some] = np.add.reduceat(np.concatenate(lp), np.cumsum(per[some]) - per[some], dtype=np.float64)
            out[lo:hi] = np.bincount(doc, weights=of_window, minlength=hi - lo)
            lo = hi
        out += np.bincount(np.repeat(np.arange(len(lengths)), lengths), self.vocabulary.share[ids], len(lengths))
        return out / np.log(10)


def learn_round(tokens: DataFrame, vocabulary: Vocabulary, start: Network, rate: float, batch: int = BATCH) -> Network:
    """``start`` trained on every id of every text: each task goes once over its texts
    from the same weights, and the results are averaged.  An input row's vector is
    averaged by how often the tasks were given it, all else by windows.

    Sums are formed in 16 tasks first, so the driver holds 16 of them at any number
    of tasks.
    """
    context = tokens.sparkSession.sparkContext
    shared = context.broadcast((vocabulary, start))
    given_rows = start.p["emb"].shape[0]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, begin = shared.value
        network = begin.with_weights(begin.flat())
        adam, r, seen = Adam(network), np.random.default_rng(3), np.zeros(given_rows + 1)
        for b in batches:
            for lo, hi, _, _ in chunks(b.column(0)):
                given, target, scored, _ = windows(*stored_ids(b.column(0).slice(lo, hi - lo)), WINDOW)
                rows, cls = v.row[given], v.cls[target]
                order = r.permutation(len(rows))
                for at in range(0, len(order), batch):
                    i = order[at : at + batch]
                    adam.step(rows[i], cls[i], scored[i], rate)
                seen[:-1] += np.bincount(rows[scored], minlength=given_rows)
                seen[-1] += len(rows)
        if seen[-1]:
            yield pa.RecordBatch.from_arrays([pa.array([seen.tobytes()], pa.binary()), pa.array([(network.flat() * spread(seen)).tobytes()], pa.binary())], ["n", "w"])

    def spread(seen: np.ndarray) -> np.ndarray:
        """The weight of each number in ``Network.flat``, whose first part is the input table."""
        emb = np.repeat(seen[:-1], WIDTH)
        return np.concatenate([emb, np.full(size - len(emb), seen[-1])])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, w = np.zeros(given_rows + 1), np.zeros(size)
        for b in batches:
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                n, w = n + np.frombuffer(x), w + np.frombuffer(y)
        if n[-1]:
            yield pa.RecordBatch.from_arrays([pa.array([n.tobytes()], pa.binary()), pa.array([w.tobytes()], pa.binary())], ["n", "w"])

    size = len(start.flat())
    got = tokens.select("ids").mapInArrow(learn, "n binary, w binary").repartition(16).mapInArrow(add, "n binary, w binary").collect()
    shared.unpersist()
    if not got:
        return start
    weight = spread(sum(np.frombuffer(r["n"]) for r in got))
    total = sum(np.frombuffer(r["w"]) for r in got)
    return start.with_weights(np.where(weight > 0, total / np.maximum(weight, 1), start.flat()))


def fit(tokens: DataFrame, counts: DataFrame, top_words: int = TOP_WORDS) -> tuple[Scorer, int, int]:
    """The scorer, N and V.

    Counts of words and ids cover all training texts, and so does the network's
    training: ``ROUNDS`` deals the texts by a hash, each to one round, and a round
    starts from what the rounds before have learned (see ``learn_round``).
    """
    counted = counts.filter("kind = 0")
    times = counted.groupBy("n").agg(F.count("*").alias("v")).toArrow()  # at most sqrt(2 N) rows
    n, v = (times[x].to_numpy() for x in ("n", "v"))
    order = np.argsort(-n)
    least = n[order[: 1 + int((np.cumsum(v[order]) < top_words).sum())]].min(initial=np.iinfo(np.int64).max)  # the last one's count
    ids = np.zeros(VOCABULARY, np.int64)
    for r in counts.filter("kind = 1").select("key", "n").collect():  # 50,257 rows at most
        ids[r["key"]] = r["n"]
    top = counted.filter((F.col("n") >= int(least)) | (F.col("key") == int(END_WORD))).orderBy(F.col("key") != int(END_WORD), F.desc("n"), "key").limit(top_words).select("key", "n").toArrow()
    key = top["key"].to_numpy().view(np.uint64)
    vocabulary = Vocabulary.of(ids)
    prior = np.bincount(vocabulary.cls, weights=ids + 0.5, minlength=CLASSES)
    network = Network.fresh(prior / prior.sum())
    low = 0
    for parts, rate in ROUNDS:
        network = learn_round(tokens.filter(f"kind is null and not held_out and place >= {low} and place < {low + parts}"), vocabulary, network, rate)
        low += parts
    scorer = Scorer(vocabulary, network, Frequent(key, top["n"].to_numpy()), len(key) < top_words)
    return scorer, int((n * v).sum()), int(v.sum())


def score(docs: DataFrame, top_words: int = TOP_WORDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row.

    ``base_score`` is the smoothed unigram log10 probability of words and end;
    ``score`` the attention model's log10 probability of the same sequence as
    subword ids.  Words beyond the ``top_words`` most frequent are looked up by a
    join, so every count is exact.  Null is the empty text: one end.  Repeated
    rows give a row each; without training rows N and V are 0, and base scores
    use log10((0 + 0.5) / (0 + 0.5 * (0 + 1))) = 0 a token.
    """
    since = mark()
    tokens = stored(tokenize(docs), "tokens")
    counts = stored(count_tokens(tokens), "counts")
    scorer, total, distinct = fit(tokens, counts, top_words)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            for lo, hi, _, _ in chunks(b.column(2)):
                ids, lengths = stored_ids(b.column(2).slice(lo, hi - lo))
                keys, per = words_of_ids(ids, lengths)
                known, base, rare, times, rare_n = _base(m, keys, per)
                edge = pa.array(np.append(0, np.cumsum(rare_n)).astype(np.int32))
                score = m.texts(ids, lengths)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + hi - lo)), b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(per + 1), pa.array(known), pa.array(base), pa.ListArray.from_arrays(edge, pa.array(rare.view(np.int64))), pa.ListArray.from_arrays(edge, pa.array(times)), pa.array(score)], ["rid", "doc_id", "held_out", "n_tokens", "known", "base", "rare", "times", "score"])
                row += hi - lo

    rows = tokens.filter("kind is null").select("doc_id", "held_out", "ids")
    rows = stored(rows.mapInArrow(judge, "rid long, doc_id long, held_out boolean, n_tokens long, known long, base double, rare array<long>, times array<long>, score double"), "scores")
    release(since, counts, rows)
    seen = counts.filter("kind = 0").select(F.col("key").alias("c_key"), F.col("n").alias("c"))
    rare = rows.select("rid", F.inline(F.arrays_zip("rare", "times")).alias("h", "k")).join(seen, F.col("h") == F.col("c_key"), "left")
    rare = rare.groupBy(F.col("rid").alias("r_rid")).agg(F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("r_base"), F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("r_known"))
    out = rows.join(rare, F.col("rid") == F.col("r_rid"), "left")
    zero = float(np.log10(total + 0.5 * (distinct + 1)))
    base = F.col("base") + F.coalesce("r_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(zero)
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("r_known", F.lit(0))).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def _base(m: Scorer, keys: np.ndarray, per: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per document: known tokens and sum of log10(c + 0.5) of its end and its frequent
    words; the keys of its other words, each once, how often it has them, and their number."""
    n = m.top.counts(keys)
    end = max(0, int(m.top.counts(np.array([END_WORD]))[0]))  # in ``top`` if it was counted
    sure = (n >= 0) | m.complete  # other words are certain if all are in ``top``
    n = np.maximum(n, 0)
    docs = len(per)
    doc = np.repeat(np.arange(docs), per)
    base = np.bincount(doc, weights=np.where(sure, np.log10(n + 0.5), 0.0), minlength=docs) + np.log10(end + 0.5)
    seen = np.bincount(doc[n > 0], minlength=docs) + int(end > 0)
    rare, of = keys[~sure], doc[~sure]
    order = np.lexsort((rare, of))
    rare = rare[order]  # ``of`` ascends already
    head = np.flatnonzero(np.r_[True, (rare[1:] != rare[:-1]) | (of[1:] != of[:-1])][: len(rare)])
    return seen, base, rare[head], np.diff(np.append(head, len(rare))), np.bincount(of[head], minlength=docs)
