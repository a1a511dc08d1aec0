"""License scans with a positional index of rare words.

A template is the mandatory phrase of a notice, the part that tells licenses apart;
``*`` in it stands for at most ``SLACK`` words.  Templates are indexed by the words
before the ``*``: each has postings (template, position) and an inverse frequency.
A file's words with the highest inverse frequency are looked up, postings are
intersected by relative position, so that words in the template's order at the
template's distances add up, and a candidate becomes a label only if the whole
phrase stands where the alignment says.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .kernels import ALNUM, LOWER, chunks, prefix_hash, span_hash, words

BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))


#: Words that may stand at the ``*`` of a phrase, as in "License (the License), Version".
SLACK = 2


@dataclass(frozen=True)
class Template:
    label: str
    phrase: str


def _versions(label: str, n: int, names: tuple[str, ...], short: tuple[str, ...]) -> tuple[Template, ...]:
    """The usual ways to give version ``n`` of a license by its long and short names."""
    forms = [f"{x} {v}" for x in names for v in (f"* version {n}", f"{n}", f"v{n}", f"v {n}")]
    forms += [f"version {n} of the {x}" for x in names] + [f"version {n} 0 of the {x}" for x in names]
    forms += [f for x in short for f in (f"{x} version {n}", f"{x} {n} 0", f"{x} v{n}", f"{x}v{n}")]
    return tuple(Template(label, f) for f in forms)


_FSF = "gnu general public license as published by the free software foundation"

#: Short notices in our own words or as commonly given in file headers.
TEMPLATES = (
    *_versions("apache-2.0", 2, ("apache license", "apache software license"), ()),
    Template("apache-2.0", "apache 2 0 license"),
    Template("apache-2.0", "identifier apache 2 0"),
    Template("mit", "mit license"),
    Template("mit", "permission is hereby granted free of charge"),
    Template("cc-by-nc-4.0", "cc by nc 4 0"),
    Template("cc-by-nc-4.0", "creative commons attribution noncommercial 4 0"),
    Template("cc-by-nc-4.0", "creative commons attribution non commercial 4 0"),
    Template("cc-by-4.0", "cc by 4 0"),
    Template("cc-by-4.0", "creative commons attribution 4 0"),
    Template("cc-by-sa-4.0", "cc by sa 4 0"),
    Template("cc-by-sa-4.0", "creative commons attribution sharealike 4 0"),
    Template("cc-by-sa-4.0", "creative commons attribution share alike 4 0"),
    Template("cc0-1.0", "cc0 1 0"),
    *_versions("gpl-3.0", 3, ("gnu general public license",), ("gpl",)),
    Template("gpl-3.0", _FSF + " * version 3"),
    *_versions("gpl-2.0", 2, ("gnu general public license",), ("gpl",)),
    Template("gpl-2.0", _FSF + " * version 2"),
    Template("lgpl", "lesser general public license"),
    Template("lgpl", "library general public license"),
    Template("lgpl", "lgpl"),
    Template("bsd", "redistribution and use in source and binary forms"),
    Template("bsd", "bsd license"),
    *_versions("mpl-2.0", 2, ("mozilla public license",), ("mpl",)),
    Template("all-rights-reserved", "all rights reserved"),
)


def _hashes(text: str) -> np.ndarray:
    data = LOWER[np.frombuffer(text.encode(), np.uint8)]
    s, e, _, _ = words(data, np.array([0, len(data)]), ALNUM)
    return span_hash(prefix_hash(data), s, e)


class Index:
    """Postings of the phrases' words; ``rare`` words of each are looked up."""

    def __init__(self, templates: tuple[Template, ...] = TEMPLATES, rare: int = 4):
        self.templates = templates
        self.labels = [t.label for t in templates]
        parts = [tuple(_hashes(x) for x in t.phrase.partition("*")[::2]) for t in templates]
        bodies = [head for head, _ in parts]
        vocabulary, df = np.unique(np.concatenate([np.unique(b) for b in bodies]), return_counts=True)
        idf = np.log1p(len(bodies) / df)
        post: dict[int, list[tuple[int, int, float]]] = {}
        self.total = np.zeros(len(bodies))
        self.length = np.array([len(b) for b in bodies])
        for t, body in enumerate(bodies):
            weight = idf[np.searchsorted(vocabulary, body)]
            top = np.argsort(-weight, kind="stable")[:rare]
            self.total[t] = weight[top].sum()
            for q in top:
                post.setdefault(int(body[q]), []).append((t, int(q), float(weight[q])))
        self.words = np.array(sorted(post), np.uint64)
        lists = [post[int(w)] for w in self.words]
        self.first = np.cumsum([0, *map(len, lists)])
        self.post = [np.array([p[k] for x in lists for p in x]) for k in range(3)]
        self.parts = parts

    def find(self, wh: np.ndarray, doc: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, template, share of the rare weight) of the verified alignments."""
        at = np.searchsorted(self.words, wh)
        at[at == len(self.words)] = 0
        hit = np.flatnonzero(self.words[at] == wh)
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if not len(hit):
            return none
        k = at[hit]
        reps = np.diff(self.first)[k]
        rows = np.repeat(hit, reps)
        p = np.arange(len(rows)) - np.repeat(np.cumsum(reps) - reps, reps) + np.repeat(self.first[k], reps)
        t = self.post[0][p].astype(np.int64)
        start = rows - self.post[1][p].astype(np.int64)
        # the document joins the key: words of one alignment in two documents do not add up
        order = np.lexsort((t, start, doc[rows]))
        d, s, t, w = doc[rows][order], start[order], t[order], self.post[2][p][order]
        new = np.r_[True, (d[1:] != d[:-1]) | (s[1:] != s[:-1]) | (t[1:] != t[:-1])]
        head = np.flatnonzero(new)
        share = np.add.reduceat(w, head) / self.total[t[head]]
        ok = share >= least
        d, s, t, share = d[head][ok], s[head][ok], t[head][ok], np.minimum(share[ok], 1)
        good = np.zeros(len(d), bool)
        for i in range(len(d)):
            head, tail = self.parts[t[i]]
            stands = lambda a, ph: a >= 0 and a + len(ph) <= len(wh) and doc[a] == d[i] == doc[a + len(ph) - 1] and bool((wh[a : a + len(ph)] == ph).all())  # noqa: B023, E731
            good[i] = stands(s[i], head) and (not len(tail) or any(stands(s[i] + len(head) + g, tail) for g in range(SLACK + 1)))
        return d[good], t[good], share[good]


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, base: tuple[tuple[str, str], ...] = BASE, least: float = 0.6) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row.

    Whole texts, A-Z lower-cased, null as empty.  Words longer than any template
    word cannot match; files without words have empty label lists, null first and
    last word and score 0.  ``score`` is the best share of a phrase's rare
    weight found in place; 1 if a base phrase stands in the text.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        phrases = [(_hashes(p), label) for p, label in base]
        for b in batches:
            for lo, hi, data, off in chunks(b.column(1)):
                data = LOWER[data]
                s, e, doc, counts = words(data, off, ALNUM)
                wh = span_hash(prefix_hash(data), s, e)
                n = hi - lo
                first_of = np.cumsum(counts) - counts
                n_base, lowest, highest = np.zeros(n, np.int64), np.full(n, -1), np.full(n, -1)
                labels: dict[int, set[str]] = {}
                score = np.zeros(n)
                for ph, label in phrases:
                    m = len(wh) - len(ph) + 1
                    if m <= 0:
                        continue
                    at = np.flatnonzero(wh[:m] == ph[0])
                    for j in range(1, len(ph)):
                        at = at[wh[at + j] == ph[j]]
                    at = at[doc[at] == doc[at + len(ph) - 1]]
                    d, w = doc[at], at - first_of[doc[at]]
                    np.add.at(n_base, d, 1)
                    for x, y in zip(d.tolist(), w.tolist(), strict=True):
                        labels.setdefault(x, set()).add(label)
                        lowest[x] = y if lowest[x] < 0 else min(lowest[x], y)
                        highest[x] = max(highest[x], y)
                    score[d] = 1
                base_labels = [",".join(sorted(labels.get(i, ()))) for i in range(n)]
                for d, t, share in zip(*index.find(wh, doc, least), strict=True):
                    labels.setdefault(int(d), set()).add(index.labels[t])
                    score[d] = max(score[d], share)
                none = n_base == 0
                cols = [b.column(0).slice(lo, n), pa.array(counts, pa.int64()), pa.array(n_base, pa.int64()), pa.array(lowest, pa.int64(), mask=none), pa.array(highest, pa.int64(), mask=none), pa.array(base_labels, pa.string()), pa.array([",".join(sorted(labels.get(i, ()))) for i in range(n)], pa.string()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.select("doc_id", "text").mapInArrow(judge, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
