"""Operators on documents against brute force, with awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from briefloom.llm import attention_lm, language, licenses, media, mixing, near_dedup, packing, substring_dedup

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
R = random.Random(3)
VOCAB = [a + b + c for a in ("ba", "ko", "ti", "re") for b in ("na", "lu", "so") for c in ("", "m", "x", "é")]


def prose(n):
    return " ".join(R.choice(VOCAB) for _ in range(n))


def edit(text, k):
    words = text.split(" ")
    for _ in range(k):
        words[R.randrange(len(words))] = "edited"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    base, passage, long = prose(200), prose(60), prose(9000)
    texts = [base, edit(base, 2), edit(base, 4), base, base.upper(), edit(base, 40), None, "", " \n\t ", "one two", "ONE two", "one two three", "1234 5678", long, long + " end", prose(80) + passage + prose(80), prose(40) + passage, prose(300)]
    langs = ["aa", "bb", None]
    out = [(i, t, langs[i % 3], f"src{i % 4}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    near = [prose(150) for _ in range(4)]
    out += [(100 + i, edit(near[i % 4], i // 4), "aa", "src1", 0) for i in range(24)]
    return out + [out[0], out[7]]  # rows given twice


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    clash = ("key", "size", "score", "cid", "row", "rest", "taken", "component_id", "q_time", "k_id", "target", "r_key", "text_", "start", "u", "c_id", "c_lang", "h", "rank", "rid", "hub", "c")
    return df.withColumns({c: F.lit(c) for c in clash})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def words_of(text):
    return WORD.findall((text or "").translate(LOW))


def shingles(text):
    w = words_of(text)
    return {tuple(w)} - {()} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_components(rows):
    ids = {i: shingles(t) for i, t, *_ in rows}
    comp = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, x in ids.items():
            for b, y in ids.items():
                if x and y and comp[a] > comp[b] and 100 * len(x & y) >= 85 * len(x | y):
                    comp[a], changed = comp[b], True
    return comp, {i: len(s) for i, s in ids.items()}


def test_near_dedup(docs, rows):
    comp, sizes = brute_components(rows)
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {(i, sizes[i], comp[i], comp[i] == i) for i in comp}


def test_near_dedup_tiles_and_hot_groups(spark, monkeypatch):
    """Every member near the base, few near each other: links go through the base."""
    base = prose(150)
    rows = [(i, edit(base, 3) if i else edit(base, 1), None, None, 0) for i in range(60)] + [(60, base, None, None, 0)]
    monkeypatch.setattr(near_dedup, "TILE", 8)
    comp, _ = brute_components(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df).collect()} == comp


def test_near_dedup_of_nothing(empty):
    assert near_dedup.near_duplicates(empty).collect() == [] and near_dedup.keep_one(empty).collect() == []


def test_keep_one(docs, rows):
    comp, _ = brute_components(rows)
    got = near_dedup.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(i for i in comp if comp[i] == i)


def test_tables_come_from_pairs_of_half_keys():
    """A pair at the threshold meets in a table nearly always."""
    r = np.random.default_rng(0)
    met = 0
    for _ in range(200):
        common, rest = r.integers(0, 1 << 63, 170, dtype=np.uint64), r.integers(0, 1 << 63, 30, dtype=np.uint64)
        a, b = np.r_[common, rest[:15]], np.r_[common, rest[15:]]
        x, y = near_dedup.half_keys(np.r_[a, b], np.array([len(a), len(b)]))
        same = x == y
        met += same[: near_dedup.HALF_KEYS].any() and same[near_dedup.HALF_KEYS :].any()
    assert met >= 199


def brute_repeats(rows, length):
    seen, out = {}, {}
    for i, text in sorted({(i, t or "") for i, t, *_ in rows}):
        b = text.encode()
        mask = np.zeros(len(b) + 1, int)
        for s in range(len(b) - length + 1):
            if b[s : s + length] in seen:
                mask[s] += 1
                mask[s + length] -= 1
            else:
                seen[b[s : s + length]] = 1
        gone = np.cumsum(mask)[:-1] > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone]) if b else b""
        spans = int((gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0)
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


@pytest.mark.parametrize("length,gram", [(100, 20), (30, 8)])
def test_substring_dedup(docs, rows, length, gram):
    want = brute_repeats(rows, length)
    got = substring_dedup.digests(docs, length, gram).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == {i: v[:4] for i, v in want.items()}


def test_substring_dedup_of_unique_ids(spark, rows, monkeypatch):
    own = [r for r in rows[:-2] if r[1] is not None]
    df = spark.createDataFrame(own, "doc_id long, text string, lang string, source string, n_chars long")
    want = {i: v[1:4] for i, v in brute_repeats(own, 100).items()}
    for most, widths in ((6 << 20, (27, 9, 1)), (3000, (27, 9, 1)), (0, (27, 9, 1)), (0, (1,))):  # whole bundles, some and all in parts, single windows
        monkeypatch.setattr(substring_dedup, "DIVIDE", most)
        monkeypatch.setattr(substring_dedup, "WIDTHS", widths)
        assert {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substring_dedup.digests(df).collect()} == want


def test_substring_dedup_ids(spark, empty):
    text = prose(40)
    df = spark.createDataFrame([(None, text), (1, text), (1, text + "x"), (2, text)], "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in substring_dedup.digests(df).collect()))
    n = len(text.encode())
    assert got == [(0, n, 0), (1, n, n), (1, n + 1, n), (2, n, n)]
    assert substring_dedup.digests(empty).collect() == []


def test_remove_repeats(docs, rows):
    want = {i: v[4].decode(errors="ignore") for i, v in brute_repeats(rows, 100).items() if v[4] or not v[0]}
    got = substring_dedup.remove_repeats(docs)
    assert got.columns == docs.columns
    assert {r["doc_id"]: r["text"] or "" for r in got.collect()} == want


def test_remove_repeats_keeps_replacement_characters(spark):
    """U+FFFD of the text itself stays; only bytes broken by a cut go."""
    passage = prose(40)
    own = [(1, passage + " é", None, None, 0), (2, "a\ufffdb " + passage + " c\ufffdd", None, None, 0), (3, "ê" * 60, None, None, 0), (4, "x" + "ê" * 55 + "y\ufffd", None, None, 0)]
    df = spark.createDataFrame(own, "doc_id long, text string, lang string, source string, n_chars long")
    want = {i: v[4].decode(errors="ignore") for i, v in brute_repeats(own, 100).items()}
    got = {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(df).collect()}
    assert got == {i: t for i, t in want.items() if t} and got[2].count("\ufffd") == 2 and got[4].endswith("y\ufffd")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=0, max_size=60), min_size=1, max_size=6), st.integers(2, 12))
def test_transform_finds_repeated_windows(texts, length):
    parts = [t.encode() for t in texts]
    text = np.frombuffer(b"".join(p + b"\xff" for p in parts), np.uint8)
    sizes = np.array([len(p) for p in parts])
    who = np.repeat(np.arange(len(parts)), sizes + 1)
    inner = np.arange(len(text)) - (np.cumsum(sizes + 1) - sizes - 1)[who]
    valid = inner + length <= sizes[who]
    place = np.arange(len(text), dtype=np.int64)
    seen, want = set(), []
    for i in np.flatnonzero(valid):
        w = text[i : i + length].tobytes()
        want += [i] if w in seen else []
        seen.add(w)
    assert substring_dedup.repeated_windows(text, place, valid, length).tolist() == want


def test_language_id(docs, rows, spark, empty):
    got = {r["doc_id"]: r for r in language.identify(docs).collect()}
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in ("aa", "bb", "und") for r in got.values())
    for i, t, *_ in rows:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert (got[i]["lang_pred"] == "und") == (not any(c.isalpha() for c in t or ""))
    kept = language.keep_known(docs)
    assert kept.columns == docs.columns and kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in rows)
    nothing = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in language.identify(nothing).collect()] == [("und", 0.0)]
    assert language.identify(empty).collect() == []


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang_pred <> 'und'").toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() > 0.97


def test_kernel_is_the_normalized_intersection():
    texts = ["ab abc", "abd", "xyz q", "ab abc"]
    flags = next(language.presence(pa.array(texts)))[2]
    model = language.fit(np.packbits(flags, axis=1), ["a", "a", "b", "a"], landmarks=4)
    x = flags.astype(float) / np.sqrt(flags.sum(axis=1, keepdims=True))
    assert np.allclose((flags @ model.landmarks.T) / np.sqrt(flags.sum(axis=1, keepdims=True)), x @ model.landmarks.T.astype(float), atol=1e-5)
    assert [model.languages[k] for k in model.scores(flags).argmax(axis=1)] == ["a", "a", "b", "a"]


def test_media_round_trip(docs, rows):
    got = {r["doc_id"]: r for r in media.describe_media(media.store_texts(docs)).collect()}
    for i, t, *_ in rows:
        raw = (t or "").encode()
        payload = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert len(r["feature"]) == 16
    assert got[0]["feature"] == got[3]["feature"]


@pytest.mark.parametrize("row_filter", media.FILTERS)
def test_png_filters(row_filter):
    x = np.random.default_rng(1).integers(0, 256, (7, 13), dtype=np.uint8)
    data = media.encode_png(x, row_filter, idat_bytes=20)
    assert (media.decode_png(data) == x).all()
    for at in (20, len(data) // 2, len(data) - 6):
        with pytest.raises(ValueError):
            media.decode_png(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])
    with pytest.raises(ValueError):
        media.decode_png(data[:-12])


def test_licenses(spark, docs, rows):
    texts = ["Licensed under CC BY-NC 4.0. All rights reserved", "cc, by! and GENERAL public\nlicense", "Released under the MIT License.", "mit license", "the general public", None, "cc by cc by", "x " * 50 + "This work is licensed under the GNU General Public License, version 3."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan(df).collect()}
    assert [got[i]["base_labels"] for i in range(8)] == ["cc-by,reserved", "cc-by,gpl", "", "", "", "", "cc-by", "gpl"]
    assert got[0]["labels"] == "all-rights-reserved,cc-by,cc-by-nc-4.0,reserved" and got[2]["labels"] == "mit" and got[7]["labels"] == "gpl,gpl-3.0" and got[4]["labels"] == ""
    assert [(got[i]["n_words"], got[i]["n_base"], got[i]["first_word"], got[i]["last_word"]) for i in (0, 1, 5, 6)] == [(10, 2, 2, 7), (6, 2, 0, 3), (0, 0, None, None), (4, 2, 0, 2)]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    found = {r["doc_id"]: r["n_words"] for r in licenses.scan(docs).collect()}
    assert found == {i: len(word.findall((t or "").translate(LOW))) for i, t, *_ in rows}


def test_licenses_in_usual_words(spark):
    header = "you can redistribute it and/or modify it under the terms of the GNU %sGeneral Public License as published by the Free Software Foundation; either version %d of the License"
    cases = {
        "Licensed under the Apache License 2.0": "apache-2.0",
        "Apache License 2.0": "apache-2.0",
        "see Apache License v2.0 here": "apache-2.0",
        'the Apache License (the "License"), Version 2.0': "apache-2.0",
        "Apache License, Version 1.1": "",
        "Mozilla Public License 2.0": "mpl-2.0",
        "terms of the Mozilla Public License, v. 2.0.": "mpl-2.0",
        "Mozilla Public License 1.1": "",
        "Licensed under the GNU General Public License version 3": "gpl,gpl-3.0",
        "version 2 of the GNU General Public License": "gpl,gpl-2.0",
        header % ("", 3): "gpl,gpl-3.0",
        header % ("", 2): "gpl,gpl-2.0",
        header % ("Lesser ", 3): "gpl,lgpl",
        "GPLv3": "gpl-3.0",
        "the MIT license applies": "mit",
        "CC BY-NC-SA 4.0": "cc-by",
        "Creative Commons Attribution 4.0 International": "cc-by-4.0",
        "apache helicopter license plate version 2 0": "",
        "Apache License": "",
        "Apache version 2.4": "",
        "SPDX-License-Identifier: Apache-2.0": "apache-2.0",
    }
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: (r["labels"], r["score"] > 0) for r in licenses.scan(df).collect()}
    assert [got[i] for i in range(len(cases))] == [(x, x != "") for x in cases.values()]


def test_license_places_by_brute_force(spark, empty):
    """Base places of whole documents, word by word."""
    phrases = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    docs = [tuple(r) for r in docs] + [(-1, "CC-BY cc by, All rights RESERVED;general public license" * 3), (-2, None), (-2, None), (-3, "")]
    got = licenses.scan(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    want = Counter()
    for i, t in docs:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
        at = [(k, label) for p, label in phrases.items() for k in range(len(words)) if tuple(words[k : k + len(p)]) == p]
        places = [k for k, _ in at]
        want[i, len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))] += 1
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got) == want
    assert sum(k[2] * n for k, n in want.items()) > 9
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in got)
    assert licenses.scan(empty).collect() == []


def test_encoders_agree_on_whole_documents(spark):
    """The faster encoder gives the tokenizer's ids on every document of a table, and on awkward texts."""
    slow = packing._encoders("byte_bpe_50k.json")[0]
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += ["a\u00a0b \u0085c\u200bd", "don't DON'T 12345 x²", "  \n\n \t x  ", "ſ ǆ ɐ", "e\u0301 é", "<|endoftext|> a"]
    for text in texts:
        assert packing.encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_mixing(docs, rows, spark):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes.setdefault(r["source"], [0, 0, r["target"], r["source_size"]])
        sizes[r["source"]][0] += r["size"]
        sizes[r["source"]][1] += r["taken"]
    assert all(s == size and abs(target - taken) <= mixing.PACKET and target <= 2 * size for s, taken, target, size in sizes.values())
    total = sum(s[0] for s in sizes.values())
    assert total == sum(len(WORD.findall(r[1] or "")) for r in rows)
    assert abs(sum(s[2] for s in sizes.values()) - 1.5 * total) < 1e-6
    key = lambda r: (str(r["doc_id"]), r["before"])
    assert sorted(map(tuple, mixing.mix(docs.repartition(7)).select("doc_id", "before", "taken").collect()), key=str) == sorted(((r["doc_id"], r["before"], r["taken"]) for r in got), key=str), key
    mixed = mixing.ordered_mix(docs)
    assert mixed.columns == docs.columns
    longest = max(r["size"] for r in got)
    for source, (_, _, target, _) in sizes.items():
        words = sum(len(WORD.findall(r["text"])) for r in mixed.collect() if r["source"] == source)
        assert abs(words - target) <= longest


def test_queue_by_brute_force(spark):
    """The queue served packet by packet in the order of virtual finish times; ties by the shuffle key."""
    texts = [(i, " ".join(["w"] * n), s) for i, (n, s) in enumerate([(700, "a"), (3, "a"), (0, "a"), (40, "b"), (41, "b"), (300, None), (7, "c"), (512, "c")])]
    texts += [(3, texts[3][1], "b"), (None, "x y", "b"), (9, None, "a")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string").withColumn("target", F.lit("clash"))
    got = mixing.mix(docs).collect()
    goal = {r["source"]: (r["target"], r["source_size"]) for r in got}
    queue = []
    for r in got:
        key = hashlib.md5(("" if r["doc_id"] is None else str(r["doc_id"])).encode()).hexdigest()
        for e in range(2):
            for a in range(0, r["size"], mixing.PACKET):
                w = min(mixing.PACKET, r["size"] - a)
                queue.append(((e * r["source_size"] + r["before"] + a + w) / r["target"], key, r["doc_id"] or -1, r["size"], e, a + w, w, (r["source"], r["before"])))
    left, want = int(sum(t for t, _ in goal.values()) + 0.25), Counter()
    for *_, w, row in sorted(queue):
        want[row] += min(w, left)
        left -= min(w, left)
    assert left == 0
    assert all(r["taken"] == (want[(r["source"], r["before"])] if r["size"] else 0) for r in got)
    assert len(got) == len(texts) and {goal[s][1] for s in ("a", "b", "c", None)} == {703, 123, 519, 300}
    none = docs.filter("doc_id = 77")
    assert mixing.mix(none).count() == 0 and mixing.ordered_mix(none).count() == 0
    mixed = mixing.ordered_mix(docs)
    assert mixed.columns == docs.columns and Counter(r["doc_id"] for r in mixed.collect())[3] in (2, 3, 4)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=9))
def test_water_filling(sizes):
    """Targets by the definition: share by weight, stop at twice the size, share the rest again."""
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    left, target, free = 1.5 * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        over = {i for i in free if weights[i] * left / sum(weights[j] for j in free) >= 2 * sizes[i]}
        if not over:
            for i in free:
                target[i] = weights[i] * left / sum(weights[j] for j in free)
            break
        for i in over:
            target[i] = 2.0 * sizes[i]
        left -= sum(target[i] for i in over)
        free -= over
    assert abs(sum(target) - 1.5 * sum(sizes)) < 1e-6
    test_water_filling.cases.append((sizes, target))


test_water_filling.cases = []


def test_targets_in_spark(spark):
    for sizes, want in test_water_filling.cases[:4] + [([0, 0], [0.0, 0.0])]:
        df = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        assert np.allclose([got[f"s{i}"] for i in range(len(sizes))], want)


def test_packing(docs, rows, empty):
    got = packing.pack_documents(docs).collect()
    tokenizer = packing._encoders("byte_bpe_50k.json")[0]
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t, *_ in rows}
    assert sum(r["length"] for r in got) == sum(len(want[r[0]]) for r in rows)
    spans = {}
    for r in got:
        ids = want[r["doc_id"]]
        piece = ids[r["start"] : r["start"] + r["length"]]
        assert r["doc_tokens"] == len(ids) and len(piece) == r["length"] and zlib.crc32(np.array(piece, "<u4").tobytes()) == r["ids_crc32"]
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in spans.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack_documents(empty).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 400), min_size=1, max_size=12))
def test_cutting_stock(demand):
    made, used = dict.fromkeys(demand, 0), 0
    sizes = sorted(demand)
    for a, times in packing.solve(demand, 32):
        assert times > 0 and int((a * np.array(sizes)).sum()) <= 32
        used += times
        for s, n in zip(sizes, a.tolist(), strict=True):
            made[s] += n * times
    assert made == demand
    assert used <= sum(s * n for s, n in demand.items()) / 32 * 2 + len(demand) + 1


def test_knapsack():
    value, counts = packing.price(np.array([3, 5, 7]), np.array([0.4, 0.8, 1.0]), 10)
    assert (round(value, 9), counts.tolist()) == (1.6, [0, 2, 0])


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text(" \n\t'stABé.,1<|>", max_size=40) | st.just("a<|endoftext|>b"))
def test_fast_encoder_equals_tokenizer(text):
    slow = packing._encoders("byte_bpe_50k.json")[0]
    assert packing.encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def test_language_model_counts(docs, rows):
    tokens = {i: [*words_of(t), None] for i, t, *_ in rows}
    count = {}
    for i, *_ in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            for w in tokens[i]:
                count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    for top in (1 << 17, 10):
        got = attention_lm.score(docs, top_words=top).collect()
        assert len(got) == len(rows)
        for r in got:
            t = tokens[r["doc_id"]]
            want = sum(np.log10((count.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in t)
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(w in count for w in t), n)
            assert abs(r["base_score"] - want) < 1e-6 and np.isfinite(r["score"]) and r["score"] < 0


def test_language_model_of_nothing(empty, spark):
    assert attention_lm.score(empty).collect() == []
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    only = spark.createDataFrame([(held[0], None), (held[1], "word")], "doc_id long, text string")
    assert [(r["train_tokens"], r["base_score"]) for r in attention_lm.score(only).collect()] == [(0, 0.0), (0, 0.0)]


def test_language_sample_is_bounded(spark, monkeypatch):
    """Repeated rows count once, many languages share the sample, rare ones beyond the bound are not learned."""
    seen = []
    monkeypatch.setattr(language, "fit", lambda bits, labels, landmarks: seen.append(labels))
    same = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("the same text").alias("text"), F.lit("aa").alias("lang"))
    many = spark.range(2000).select("id", F.concat(F.lit("text "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("t"), F.concat(F.lit("l"), (F.col("id") % 40).cast("string")).alias("l")).toDF("doc_id", "text", "lang")
    language.train(same)
    language.train(many, sample=80)
    language.train(many.union(many.limit(10)), languages=4)
    assert [len(x) for x in seen][:2] == [1, 80] and len(set(seen[1])) == 40 and len(set(seen[2])) == 4


def test_tiles_send_a_set_once_a_block(spark):
    sets = spark.range(5000).select(F.lit(7).alias("hub"), F.col("id").alias("cid"), F.col("id").alias("comp"), F.expr("cast(repeat('x', 8 * 100) as binary)").alias("shingles"))
    blocks = -(-5000 // near_dedup.TILE)
    assert near_dedup.tiles(sets).count() == 5000 * blocks
    assert near_dedup.tiles(sets.limit(1000)).count() == 1000
    assert near_dedup.tiles(sets.limit(1000), most=30_000).count() == 1000 * 4
    load = near_dedup.tiles(sets).groupBy("i", "j").agg(F.sum(F.length("shingles")).alias("n")).agg(F.max("n")).first()[0]
    assert load < 2.6 * near_dedup.TILE * 800


def test_network_learns_from_all_training_texts(spark):
    """An order of words that only the last round's texts have is learned."""
    cycle = "time people world house water night money story".split()
    r = np.random.default_rng(6)
    mixed = lambda n: " ".join(r.choice(cycle, n))
    place = {x["i"]: x["p"] for x in spark.range(200).select(F.col("id").alias("i"), F.pmod(F.xxhash64("id"), F.lit(16)).alias("p")).collect()}
    rows = [(i, " ".join(cycle * 150) if place[i] >= 4 else mixed(1200)) for i in range(200)]
    held = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    rows += [(held[0], " ".join(cycle * 20)), (held[1], mixed(160))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {x["doc_id"]: x["score"] for x in attention_lm.score(df).collect()}
    assert got[held[0]] > 0.8 * got[held[1]]  # log10: the learned order is likelier


def test_scores_by_brute_force(spark, docs, rows):
    """Scores against plain loops in double precision: one id, one head of attention at a time."""
    m = attention_lm
    tokens = m.tokenize(docs)
    scorer, _, _ = m.fit(tokens, m.count_tokens(tokens))
    p, v = {k: x.astype(np.float64) for k, x in scorer.network.p.items()}, scorer.vocabulary
    some = [r for r in rows if len(r[1] or "") < 3000][:12]
    data = "".join(r[1] or "" for r in some).encode()
    off = np.cumsum([0] + [len((r[1] or "").encode()) for r in some])
    got = scorer.texts(*m.sequences(m.read_chunk(np.frombuffer(data, np.uint8), off)))
    for r, score in zip(some, got, strict=True):
        ids = [i for w in words_of(r[1]) for i in m._encoder()[0].encode_ordinary(" " + w)] + [m.END]
        total = 0.0
        for t, target in enumerate(ids):
            # the first window that scores place t begins at a multiple of STRIDE
            start = 0 if t < m.WINDOW else -(-(t - m.WINDOW + 1) // m.STRIDE) * m.STRIDE
            given = [m.END if j == 0 else ids[j - 1] for j in range(start, t + 1)]
            x = [p["emb"][v.row[g]] + p["pos"][j] for j, g in enumerate(given)]
            q = (x[-1] @ p["qkv"])[: m.WIDTH]
            keys = [y @ p["qkv"] for y in x]
            e = np.exp([q @ k[m.WIDTH : 2 * m.WIDTH] / m.WIDTH**0.5 for k in keys])
            o = sum(a * k[2 * m.WIDTH :] for a, k in zip(e / e.sum(), keys, strict=True))
            z = (x[-1] + o @ p["mix"]) @ p["out"] + p["bias"]
            total += z[v.cls[target]] - np.log(np.exp(z).sum()) + v.share[target]
        assert abs(total / np.log(10) - score) < 1e-3 * max(1, abs(score))
    # classes and shares are a distribution over all ids
    assert abs(np.bincount(v.cls, np.exp(v.share), m.CLASSES) - 1).max() < 1e-9


def test_large_scores_stay_finite():
    net = attention_lm.Network.fresh(np.full(attention_lm.CLASSES, 1 / attention_lm.CLASSES))
    for x in net.p.values():
        x *= 300
    rows = np.arange(2 * attention_lm.WINDOW).reshape(2, -1)
    got = net.log_probs(rows, rows % attention_lm.CLASSES)
    assert np.isfinite(got).all() and (got <= 0).all() and got.min() < -100
    loss, g = net.gradients(rows, rows % attention_lm.CLASSES, np.ones(rows.shape, bool))
    assert np.isfinite(loss) and all(np.isfinite(x).all() for x in g.values())


def test_windows_score_each_id_once():
    lengths = np.array([1, 5, 24, 32, 33, 100])
    given_, target, scored, doc = attention_lm.windows(np.arange(lengths.sum()), lengths)
    assert sorted(target[scored].tolist()) == list(range(lengths.sum()))
    assert (given_[scored & (given_ != attention_lm.END)] + 1 == target[scored & (given_ != attention_lm.END)]).all()


def test_attention_gradients():
    r = np.random.default_rng(2)
    net = attention_lm.Network.fresh(np.full(attention_lm.CLASSES, 1 / attention_lm.CLASSES), dtype=np.float64)
    rows = r.integers(0, 40, (2, attention_lm.WINDOW))
    cls = r.integers(0, attention_lm.CLASSES, rows.shape)
    scored = r.random(rows.shape) < 0.8
    _, g = net.gradients(rows, cls, scored)
    for name, x in net.p.items():
        at = tuple(r.integers(0, min(n, 40)) for n in x.shape)
        old, step = x[at], 1e-5
        x[at] = old + step
        high = net.gradients(rows, cls, scored)[0]
        x[at] = old - step
        low = net.gradients(rows, cls, scored)[0]
        x[at] = old
        assert abs((high - low) / (2 * step) - g[name][at]) < 1e-6, name


def test_attention_is_causal_and_learns():
    r = np.random.default_rng(4)
    ids = np.tile(r.integers(0, 30, 7), 4000)
    given_, target, scored, _ = attention_lm.windows(ids, np.array([len(ids)]))
    net = attention_lm.Network.fresh(np.full(attention_lm.CLASSES, 1 / attention_lm.CLASSES))
    rows = np.minimum(given_, attention_lm.INPUTS - 1)
    adam = attention_lm.Adam(net)
    losses = [adam.step(rows[i : i + 8], target[i : i + 8], scored[i : i + 8], 0.01) for i in range(0, len(rows), 8)]
    assert np.mean(losses[-20:]) < np.mean(losses[:20]) / 2
    a = net.log_probs(rows[:1], target[:1])
    changed = rows[:1].copy()
    changed[:, 20:] = 5
    assert np.allclose(a[:, :20], net.log_probs(changed, target[:1])[:, :20], atol=1e-5)


def test_words_are_read_from_ids(spark):
    """After tokenizing, only ids are read: the words, their number and their equality come from them."""
    m = attention_lm
    texts = ["", "one two one", "a b 　x a b\t  a<|endoftext|>b", "Two  TWO two\n", "      ", "\U0001f600 1,000 it's"]
    raw = [t.encode() for t in texts]
    c = m.read_chunk(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    keys, per = m.words_of_ids(*m.sequences(c))
    words = [w for t in texts for w in words_of(t)]
    assert per.tolist() == [len(words_of(t)) for t in texts] and len(keys) == len(words)
    assert len(set(zip(words, keys.tolist(), strict=True))) == len(set(words)) == len(set(keys.tolist()))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert "text" not in m.tokenize(df).columns


def test_counts_of_frequent_words():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 300_000, dtype=np.uint64)) << np.uint64(1)
    keys[:3000] = (keys[:3000] & np.uint64((1 << 46) - 1)) | np.uint64(5 << 46)  # one slot of the first table
    keys = np.append(np.unique(keys), np.uint64(0) if keys.min() else np.uint64(1))
    n = np.arange(len(keys)) % 1000
    table = attention_lm.Frequent(keys, n)
    assert (table.counts(keys) == n).all() and (table.counts(keys + np.uint64(1)) == -1).all()
    assert attention_lm.Frequent(keys[:0], n[:0]).counts(keys[:2]).tolist() == [-1, -1]


def test_suffixes_are_sorted_four_times(monkeypatch):
    """Blocks of a few megabytes take four sorts for 100 bytes, and classes are those of equal windows."""
    r = np.random.default_rng(8)
    parts = [r.integers(97, 100, 150, dtype=np.uint8).tobytes() for _ in range(12)]
    text = np.frombuffer(b"".join(parts[i][: r.integers(100, 151)] + b"\xff" for i in r.integers(0, 12, 40)), np.uint8)
    sorts, sort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda *a, **k: (sorts.append(1), sort(*a, **k))[1])
    order = substring_dedup.suffix_order(text, 100)
    monkeypatch.undo()
    assert len(sorts) <= 4 and sorted(order.tolist()) == list(range(len(text)))
    raw = text.tobytes()
    got = np.cumsum(substring_dedup.window_classes(order, text, 100))
    classes = {}
    for place, i in zip(got.tolist(), order.tolist(), strict=True):
        if b"\xff" not in raw[i : i + 100] and i + 100 <= len(raw):
            classes.setdefault(raw[i : i + 100], set()).add(place)
    assert len(classes) > 100 and all(len(x) == 1 for x in classes.values())
    assert len(set.union(*classes.values())) == len(classes)


def test_anchors_in_parts(monkeypatch):
    """Anchors do not depend on how many places are compared at a time, and no more are."""
    r = np.random.default_rng(4)
    off = np.array([0, 40, 3000, 3099, 8000])
    prefix = substring_dedup.prefix_hash(r.integers(97, 101, off[-1], dtype=np.uint8))
    want = substring_dedup.anchor_places(prefix, off, 100, 20)
    sizes, least = [], np.minimum
    monkeypatch.setattr(substring_dedup, "CACHED", 64)
    monkeypatch.setattr(np, "minimum", lambda a, b: (sizes.append(np.size(a)), least(a, b))[1])
    got = substring_dedup.anchor_places(prefix, off, 100, 20)
    assert max(sizes) <= 64 + 80 and all((x == y).all() for x, y in zip(got, want, strict=True))


def test_classes_are_as_many_as_before_the_cut():
    """Attention tells 64 classes apart, 48 of them ids of their own, from up to 32 ids."""
    m = attention_lm
    cls = m.Vocabulary.of(np.arange(m.VOCABULARY)[::-1].copy()).cls
    sizes = np.bincount(cls, minlength=m.CLASSES)
    assert len(sizes) >= 64 and (sizes == 1).sum() >= 48 and sizes.min() > 0 and m.WINDOW >= 32


def test_scoring_works_on_scored_places(monkeypatch):
    """Attention asks for the places that a window scores: 24 of 32 after a text's first window."""
    m, r = attention_lm, np.random.default_rng(5)
    v = m.Vocabulary.of(np.arange(m.VOCABULARY))
    scorer = m.Scorer(v, m.Network.fresh(np.full(m.CLASSES, 1 / m.CLASSES)), m.Frequent(np.zeros(0, np.uint64), np.zeros(0, np.int64)), True)
    n = m.WINDOW + 10 * m.STRIDE
    ids, sizes, exp = r.integers(0, m.VOCABULARY, n), [], np.exp
    want = scorer.texts(ids, np.array([n]))
    monkeypatch.setattr(np, "exp", lambda x, **k: (sizes.append(np.size(x)), exp(x, **k))[1])
    assert scorer.texts(ids, np.array([n])) == want
    assert sum(sizes) == (m.WINDOW + 10 * m.STRIDE) * m.WINDOW + n * m.CLASSES


def test_gradients_in_single_precision():
    """Parts, blocks of rows and what remains of them add up to the gradients in double precision."""
    m, r = attention_lm, np.random.default_rng(7)
    x, y = r.random((m.WINDOW * 11, 5)), r.random((m.WINDOW * 11, 3))
    assert np.allclose(m.summed_products(x, y), x.T @ y) and np.allclose(m.summed_products(x[:40], y[:40]), x[:40].T @ y[:40])
    rows, cls = r.integers(0, 50, (75, m.WINDOW)).astype(np.int16), r.integers(0, m.CLASSES, (75, m.WINDOW)).astype(np.int16)
    scored = r.random(rows.shape) < 0.7
    nets = [m.Network.fresh(np.full(m.CLASSES, 1 / m.CLASSES), dtype=t) for t in (np.float32, np.float64)]
    nets[1].p = {k: x.astype(np.float64) for k, x in nets[0].p.items()}
    (loss, g), (want_loss, want) = (net.gradients(rows, cls, scored) for net in nets)
    assert abs(loss - want_loss) < 1e-4
    assert all(g[k].dtype == np.float32 and abs(g[k] - want[k]).max() < 1e-6 + 1e-4 * abs(want[k]).max() for k in want)


def test_rare_words_are_looked_up_once_a_document():
    """The join gets each rare word of a document once, with its number of places."""
    m = attention_lm
    raw = [b"a b b c a b", b"", b"b c c", b"d"]
    c = m.read_chunk(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    keys, per = m.words_of_ids(*m.sequences(c))
    a, b, other, d = keys[0], keys[1], keys[3], keys[-1]
    top = m.Frequent(np.array([a, m.END_WORD]), np.array([7, 4]))
    known, base, rare, times, n = m._base(m.Scorer(None, None, top, False), keys, per)
    assert known.tolist() == [3, 1, 1, 1] and n.tolist() == [2, 0, 2, 1]
    got = [dict(zip(k.tolist(), t.tolist(), strict=True)) for k, t in zip(np.split(rare, np.cumsum(n)[:-1]), np.split(times, np.cumsum(n)[:-1]), strict=True)]
    assert got == [{b: 3, other: 1}, {}, {b: 1, other: 2}, {d: 1}]
    assert np.allclose(base, np.log10(4.5) + np.array([2, 0, 0, 0]) * np.log10(7.5))
