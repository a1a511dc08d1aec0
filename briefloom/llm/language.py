"""Language identification with string kernels.

A text's features are the presence of its letter n-grams, n = 1, 2, 3 (a blended
spectrum), hashed to fixed tables.  The kernel of two texts is the number of
n-grams they share over the geometric mean of their numbers of n-grams.  Nystrom
landmarks turn it into short vectors, one-versus-rest ridge regression learns a
score per language there, and whole batches are scored by matrix products.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .kernels import chunks
from .tables import held_out

#: Table sizes (powers of two) for 1-, 2- and 3-grams, and where each begins.
SIZES = (512, 4096, 16384)
STARTS = (0, 512, 4608)
WIDTH = sum(SIZES)
#: Bounds of the labelled sample that the classifier is fitted on: texts a language, texts in
#: all (so fewer a language if there are many), and languages (the most frequent).
PER_LANGUAGE, SAMPLE, LANGUAGES, LANDMARKS = 256, 4096, 512, 192
#: Rows whose features are numbers, not bits, at one time.
BLOCK = 256
UNDETERMINED = "und"


@cache
def letter_codes() -> np.ndarray:
    """For each code point: 0 if it is no letter, else an odd code of its lower case."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if unicodedata.category(c)[0] == "L":
            out[i] = (ord(c.lower()[0]) * 0x9E3779B1 & 0xFFFFFFFF) | 1
    return out


def presence(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, presence matrix of uint8, whether a row has a letter)."""
    codes = letter_codes()
    for lo, hi, data, off in chunks(column):
        lead = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
        at = lead[off]
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        x = codes[points]
        # runs of non-letters count as one boundary
        keep = np.ones(len(x), bool)
        keep[1:] = (x[1:] != 0) | (x[:-1] != 0)
        kept = np.zeros(len(x) + 1, np.int64)
        np.cumsum(keep, out=kept[1:])
        x, at = x[keep], kept[at]
        doc = np.repeat(np.arange(hi - lo), np.diff(at))
        out = np.zeros((hi - lo, WIDTH), np.uint8)
        flat = out.reshape(-1)
        for n, size, start in zip((1, 2, 3), SIZES, STARTS, strict=True):
            if len(x) < n:
                continue
            h = x[: len(x) - n + 1].copy()
            for j in range(1, n):
                h = h * np.uint32(0x85EBCA6B) + x[j : len(x) - n + 1 + j]
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            idx = (h >> np.uint32(32 - size.bit_length() + 1)).astype(np.int64)
            first = doc[: len(idx)]
            ok = first == doc[n - 1 :]
            if n == 1:
                ok &= x != 0
            flat[(first * WIDTH + start + idx)[ok]] = 1
        letters = out[:, : SIZES[0]].any(axis=1)
        out[~letters] = 0
        yield lo, hi, out, letters


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # m x WIDTH, presence over sqrt(size)
    weights: np.ndarray  # m x languages

    def scores(self, flags: np.ndarray) -> np.ndarray:
        """Ridge scores of presence rows: kernel with the landmarks times weights."""
        x = flags.astype(np.float32)
        norm = np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
        return (x @ self.landmarks.T / norm) @ self.weights


def fit(bits: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = 1e-3) -> Model:
    """Kernel ridge regression in the span of ``landmarks`` training rows, from packed
    presence bits (a row each); only ``BLOCK`` rows and the landmarks are unpacked at a time."""

    def features(rows: np.ndarray) -> np.ndarray:
        x = np.unpackbits(rows, axis=1).astype(np.float32)
        return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))

    langs = sorted(set(labels))
    by = {a: [i for i, b in enumerate(labels) if a == b] for a in langs}
    turns = [by[a][k] for k in range(max(map(len, by.values()), default=0)) for a in langs if k < len(by[a])]
    if not turns:
        return Model([], np.zeros((0, WIDTH), np.float32), np.zeros((0, 0), np.float32))
    marks = features(bits[turns[:landmarks]])
    value, vector = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = value > 1e-6 * value[-1]
    root = vector[:, good] / np.sqrt(value[good])  # Nystrom map: kernel row @ root
    size, place = root.shape[1], {a: k for k, a in enumerate(langs)}
    left, right = np.zeros((size, size)), np.zeros((size, len(langs)))
    for lo in range(0, len(bits), BLOCK):
        z = (features(bits[lo : lo + BLOCK]) @ marks.T).astype(np.float64) @ root
        part = labels[lo : lo + BLOCK]
        y = np.full((len(part), len(langs)), -1.0)
        y[np.arange(len(part)), [place[a] for a in part]] = 1
        weight = 1 / np.array([len(by[a]) for a in part])[:, None]  # languages count alike
        left += z.T @ (weight * z)
        right += z.T @ (weight * y)
    beta = np.linalg.solve(left + ridge * len(langs) * np.eye(size), right)
    return Model(langs, marks, (root @ beta).astype(np.float32))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS, sample: int = SAMPLE, languages: int = LANGUAGES) -> Model:
    """Fit on at most ``per_language`` different texts of each language, ``sample`` in all
    (one a language at least), of the ``languages`` most frequent languages.

    Rows count if text and lang are not null, the text has a letter and
    crc32(doc_id) mod 5 is not 0; those with the smallest hash are taken, repeated
    rows as one.  Only their presence bits (2.6 KB a row) come to the driver.
    """
    docs = docs.select("doc_id", "text", "lang")
    rows = docs.filter("text is not null and lang is not null").filter(~held_out(F.col("doc_id")))
    common = [r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()]
    each = max(1, min(per_language, sample // max(1, len(common))))
    rows = rows.filter(F.col("lang").isin(common)).select("doc_id", "lang", F.xxhash64("text").alias("t"), F.xxhash64("doc_id", "lang").alias("h")) if common else rows.limit(0).selectExpr("doc_id", "lang", "0L t", "0L h")
    rank = F.row_number().over(W.partitionBy("lang").orderBy("h", "doc_id", "t"))
    chosen = rows.withColumn("rank", rank).filter(F.col("rank") <= each).select(F.col("doc_id").alias("c_id"), F.col("lang").alias("c_lang"), F.col("t").alias("c_t")).distinct()
    on = F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("lang") == F.col("c_lang")) & (F.xxhash64("text") == F.col("c_t"))
    texts = docs.join(F.broadcast(chosen), on).select("text", "lang", "doc_id")  # ``sample`` rows at most

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, flags, letters in presence(b.column(0)):
                packed = np.packbits(flags, axis=1)
                some = pa.array(letters)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in packed], pa.binary()).filter(some), b.column(1).slice(lo, hi - lo).filter(some), b.column(2).slice(lo, hi - lo).filter(some)], ["bits", "lang", "doc_id"])

    got = texts.mapInArrow(bits, "bits binary, lang string, doc_id long").groupBy("lang", "bits").agg(F.min("doc_id").alias("doc_id")).collect()
    got.sort(key=lambda r: (r["lang"], r["doc_id"] is None, r["doc_id"], r["bits"]))
    packed = np.frombuffer(b"".join(r["bits"] for r in got), np.uint8).reshape(len(got), WIDTH // 8)
    return fit(packed, [r["lang"] for r in got], landmarks)


def classify(model: Model, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score (softmax share of the best ridge score, 0 for ``und``)."""
    langs: list[str] = []
    scores = []
    for lo, hi, flags, letters in presence(column):
        if not model.languages:
            langs += [UNDETERMINED] * (hi - lo)
            scores.append(np.zeros(hi - lo))
            continue
        s = np.concatenate([model.scores(flags[i : i + 256]) for i in range(0, hi - lo, 256)]).astype(np.float64)
        best = s.argmax(axis=1)
        p = 1 / np.exp(4 * (s - s.max(axis=1, keepdims=True))).sum(axis=1)
        langs += [model.languages[k] if ok else UNDETERMINED for k, ok in zip(best, letters, strict=True)]
        scores.append(np.where(letters, p, 0.0))
    return langs, np.concatenate(scores) if scores else np.zeros(0)


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row; lang, source and doc_id are no inputs.

    Null texts and texts without a letter are ``und`` with score 0, as is every
    text if no row can be learned from.  Repeated rows each give a row.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, per_language, landmarks))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = classify(model.value, b.column(2))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, min_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose text has a language: not ``und``, score at least ``min_score``."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs))
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = classify(model.value, b.column(at))
            yield b.filter(pa.array([a != UNDETERMINED for a in langs], pa.bool_()) if not min_score else pa.array([a != UNDETERMINED and s >= min_score for a, s in zip(langs, scores, strict=True)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
