"""URL filter, embeddings, components, and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from briefloom.llm import embedding_dedup, url_filter
from briefloom.llm.components import connected_components


def judged(spark, urls):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({c: F.lit(1) for c in ("host", "path", "rule", "verdict", "short")})
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    return {r["page_id"]: tuple(r)[1:] for r in url_filter.judge_pages(pages, rules).collect()}


def test_url_rules(spark):
    cases = {
        "https://a.EXAMPLE.net/en/1?x#y": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "http://example.net/fr/": ("example.net", "/fr/", "net/", "block"),
        "http://notexample.com/de/1": ("notexample.com", "/de/1", None, "allow"),
        "http://www.example.com/de/1": ("www.example.com", "/de/1", "example.com/de/", "block"),
        "http://x.org/fr/": ("x.org", "/fr/", "org/fr/", "allow"),
        "http://x.net": ("x.net", "", None, "allow"),
        "http://x.net?a=/": ("x.net", "", None, "allow"),
        "x.net/": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "http://net/": ("net", "/", "net/", "block"),
        "http://www.net/" + "a/" * 3000: ("www.net", "/" + "a/" * 3000, "net/", "block"),
        "ftp://a://b.net/": ("a:", "//b.net/", None, "allow"),
    }
    got = judged(spark, list(cases) + ["http://net/"])
    assert [got[i] for i in range(len(cases))] == list(cases.values()) and len(got) == len(cases) + 1


def test_url_rules_by_length_and_without_rules(spark):
    rules = spark.createDataFrame([("b.net", "/", "allow"), ("net", "/ab", "block"), ("net", "/ab", "allow")], "host string, path string, verdict string")
    urls = spark.createDataFrame([("http://b.net/abc",), ("http://c.net/abc",)], "url string")
    got = {r["url"]: (r["rule"], r["verdict"]) for r in url_filter.filter_urls(urls, rules).collect()}
    assert got == {"http://b.net/abc": ("b.net/", "allow"), "http://c.net/abc": ("net/ab", "block")}
    assert {r["verdict"] for r in url_filter.filter_urls(urls, rules.limit(0), default="block").collect()} == {"block"}
    assert url_filter.filter_urls(urls.limit(0), rules).collect() == []


def test_components_equal_union_find(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 60)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {x["node"]: x["component"] for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute(vectors, cosine=0.95):
    good = {}
    for i, v in vectors:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            good[i] = x / np.linalg.norm(x)
    near = {i: [j for j in good if j != i and len(good[j]) == len(good[i]) and good[i] @ good[j] >= cosine] for i in good}
    comp = {i: i for i, _ in vectors}
    changed = True
    while changed:
        changed = False
        for i, js in near.items():
            low = min([comp[i], *(comp[j] for j in js)])
            if low < comp[i]:
                comp[i], changed = low, True
    return {i: (len(near.get(i, ())), comp[i]) for i, _ in vectors}


@pytest.mark.parametrize("tile", [2048, 16])
def test_embeddings(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    r = np.random.default_rng(6)
    vectors = [(i, r.standard_normal(32).tolist()) for i in range(60)]
    vectors += [(100 + i, (np.array(vectors[i % 3][1]) + r.standard_normal(32) * 0.1).tolist()) for i in range(60)]
    vectors += [(200, vectors[0][1]), (201, (2 * np.array(vectors[0][1])).tolist()), (202, None), (203, []), (204, [0.0] * 32), (205, [None] * 32), (206, [float("nan")] * 32), (207, [float("inf")] * 32), (208, [1.0, 2.0]), (209, [1.0, 2.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumns({"n": F.lit(1), "cid": F.lit("x")}).repartition(4)
    got = {x["vec_id"]: (x["n_links"], x["component_id"]) for x in embedding_dedup.near_duplicates(df).collect()}
    assert got == brute(vectors)


def test_no_embeddings(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_recall_at_the_threshold(spark):
    """Pairs just over the threshold, the hardest ones, are found as calibrated."""
    r = np.random.default_rng(8)
    rows = []
    for i in range(300):
        a, b = r.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (0.951 * a + np.sqrt(1 - 0.951**2) * b).tolist())]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.filter("n_links = 1").count() >= 0.97 * len(rows)


@pytest.mark.parametrize("size", [51_282, 1_000_000])
def test_recall_of_the_plans_of_large_tables(spark, size):
    """Pairs just over the threshold among others, with the plan that a table of ``size`` vectors gets."""
    r = np.random.default_rng(9)
    rows = [(1000 + i, r.standard_normal(64).tolist(), 1) for i in range(200)]
    for i in range(200):
        a, b = r.standard_normal((2, 64))
        a /= np.linalg.norm(a)
        b -= (b @ a) * a
        rows += [(2 * i, a.tolist(), 1), (2 * i + 1, (0.951 * a + np.sqrt(1 - 0.951**2) * b / np.linalg.norm(b)).tolist(), 1)]
    classes = spark.createDataFrame(rows, "cid long, embedding array<double>, n long")
    plan = embedding_dedup.calibrate(size)
    assert plan.leads > 1
    found = embedding_dedup.find_links(classes, plan).filter("other is null").groupBy("cid").agg(F.sum("n").alias("n")).collect()
    linked = {x["cid"] for x in found if x["n"]}
    assert linked <= set(range(400)) and len(linked) >= 0.97 * 400


def test_pipeline_stages_take_empty_tables(spark):
    import corpus_pipeline

    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    junk = spark.createDataFrame([(1, "12 34", "en", "s", 5), (2, None, None, None, 0)], none.schema)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, none, "")
        assert got.count() == 0
        if name != "packing":
            assert got.columns == list(corpus_pipeline.COLUMNS)
    assert corpus_pipeline.STAGES[0][1](spark, junk, "").count() == 0


def test_pipeline(spark):
    """Every stage by brute force, each on what the one before kept."""
    import corpus_pipeline
    from test_documents import WORD, brute_components, brute_repeats

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).withColumn("extra", F.lit(1))
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language_id"](spark, docs, sf_dir).collect()
    assert known[0].asDict().keys() == set(corpus_pipeline.COLUMNS)
    assert {r["doc_id"] for r in known} == {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    known = spark.createDataFrame(known)
    one = stages["near_dedup"](spark, known, sf_dir).collect()
    comp, _ = brute_components([tuple(r) for r in known.select("doc_id", "text").collect()])
    assert sorted(r["doc_id"] for r in one) == sorted(i for i in comp if comp[i] == i)
    one = spark.createDataFrame(one)
    rest = stages["substring_dedup"](spark, one, sf_dir).collect()
    want = {i: v[4].decode(errors="ignore") for i, v in brute_repeats([tuple(r) for r in one.select("doc_id", "text").collect()], 100).items() if v[4]}
    assert {r["doc_id"]: r["text"] for r in rest} == want and all(r["n_chars"] == len(r["text"]) for r in rest)
    rest = spark.createDataFrame(rest)
    mix = stages["mixing"](spark, rest, sf_dir).collect()
    size = lambda rows: sum(len(WORD.findall(r["text"])) for r in rows)
    assert abs(size(mix) - 1.5 * size(rest.collect())) < 0.1 * size(rest.collect()) + 3000
    packed = stages["packing"](spark, spark.createDataFrame(mix), sf_dir).collect()
    assert sum(1 for r in packed if r["start"] == 0) == len(mix)


def test_pipeline_links_near_copies_from_0_80(spark):
    """Pairs between 0.80 and 0.85 lose a document, pairs under 0.80 do not."""
    import corpus_pipeline

    rows = []
    for i in range(20):
        base = [f"w{i}x{k}" for k in range(200)]
        other = [f"v{i}x{k}" for k in range(40)]
        for j, m in enumerate((0, 20, 30)):  # Jaccard with the base: 1, 176 / 216, 166 / 226
            rows.append((3 * i + j, " ".join(base[: 200 - m] + other[10 : 10 + m])))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(0)})
    df = df.filter("doc_id % 3 < 2").union(df.filter("doc_id % 3 = 2").withColumn("text", F.regexp_replace("text", "v", "u")).withColumn("doc_id", F.col("doc_id") + 1000))
    one = dict(corpus_pipeline.STAGES)["near_dedup"](spark, df, "")
    assert sorted(r["doc_id"] for r in one.collect()) == sorted([3 * i for i in range(20)] + [3 * i + 1002 for i in range(20)])


def test_pipeline_is_registered():
    import __spark_entry__ as driver

    assert {f"op{n}_" for n in range(1, 11)} <= {k.split("_")[0] + "_" for k in driver.queries()} and "pipeline" in driver.queries()


def test_vectors_are_stored_once_and_pairs_count_once(spark, monkeypatch):
    """No table holds copies of vectors (links take two rows and an edge a pair), and a pair that many tables find is one link."""
    sizes, keep = [], embedding_dedup.stored

    def stored(df, name):
        out = keep(df, name)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(embedding_dedup, "stored", stored)
    r = np.random.default_rng(12)
    x = r.standard_normal((100, 32))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([x, x + r.standard_normal(x.shape) * 0.01]))]
    classes = spark.createDataFrame(rows, "cid long, embedding array<double>, n long")
    found = embedding_dedup.find_links(classes, embedding_dedup.calibrate(1_000_000))
    assert found.count() and max(sizes) <= 1.5 * len(rows)
    links = {y["cid"]: y["n"] for y in found.filter("other is null").groupBy("cid").agg(F.sum("n").alias("n")).collect()}
    assert links == dict.fromkeys(range(200), 1)
