"""Dedup and increments (T13, T14) and properties of the greedy scan."""

import random

import pytest
from pyspark.sql import functions as F

from briefloom.operators import dedup
from briefloom.streaming import incremental

SCHEMA = "ord long, url string, headline string, snippet string"


def row(ord_, slug, headline, snippet=None, host="n"):
    return (ord_, f"https://{host}{ord_}/{slug}", headline, snippet)


def scan(rows):
    """The ordered scan, by brute force."""
    seen, kept = set(), []
    for o, url, head, snip in sorted(rows):
        keys = {("u", url.lower()), ("s", url.split("/")[-1].lower()), ("h", head.lower())} | ({("f", snip.lower())} if snip else set())
        if not keys & seen:
            seen |= keys
            kept.append(o)
    return kept


def test_greedy_is_not_transitive(spark):
    rows = [row(1, "s1", "h1", "a"), row(2, "s1", "h2", "b"), row(3, "s2", "h2", "c")]
    assert sorted(r["ord"] for r in dedup.greedy(spark.createDataFrame(rows, SCHEMA)).collect()) == [1, 3]


@pytest.mark.parametrize("parts", [1, 8])
def test_greedy_equals_scan(spark, parts):
    r = random.Random(5)
    rows = [row(i, f"s{r.randint(0, 25)}", f"h{r.randint(0, 25)}", r.choice([None, "", f"t{r.randint(0, 30)}"])) for i in range(80)]
    got = dedup.greedy(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    assert sorted(x["ord"] for x in got) == scan(rows)


def test_greedy_of_nothing(spark):
    assert dedup.greedy(spark.createDataFrame([], SCHEMA)).collect() == []


def test_batch_filter(spark):
    rows = [row(1, "s", "h1", "A"), row(2, "s", "h2", "B"), row(4, "t", "h4", "a"), row(5, "u", "h5", "E")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("error", F.when(F.col("ord") == 5, "x"))
    empty = spark.createDataFrame([], "kind string, key string")
    got = {r["ord"]: r["status"] for r in dedup.batch_filter(df, empty).collect()}
    assert got == {1: "added", 2: "added", 4: "duplicate", 5: "failed"}


def page(ord_, slug, headline, body):
    return (ord_, f"https://n/deals/{slug}", headline, f"<article><p>{body}</p></article>" if body is not None else None)


def test_ingest_in_two_runs(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "state")
    write = lambda rows: spark.createDataFrame(rows, "ord long, url string, headline string, html string").coalesce(1).write.mode("append").parquet(source)
    write([page(1, "a", "Acme Legal advises Widget on IPO", "one"), page(2, "b", "Zed Law advises Gadget on QIP", "One"), page(3, "c", "Zed Law advises X on IPO", None)])
    incremental.ingest(spark, source, folder)
    state = incremental.State(spark, folder)
    deals = lambda: sorted(r["ord"] for r in state.read("deals", "ord long").collect())
    seen = lambda: sorted(r["url"][-1] for r in state.read("seen", "url string").collect())
    assert (deals(), seen()) == ([1], ["a", "b"])
    write([page(4, "a", "again", "new"), page(5, "c", "Zed Law advises X on IPO", "back"), page(6, "z", "acme legal  advises widget on ipo", "new too")])
    incremental.ingest(spark, source, folder)
    assert (deals(), seen()) == ([1, 5], ["a", "b", "c"])
    incremental.ingest(spark, source, folder)
    assert deals() == [1, 5]


def test_run_again_replaces_a_batch(spark, tmp_path):
    state = incremental.State(spark, str(tmp_path))
    rows = spark.createDataFrame([page(1, "a", "Acme Legal advises Widget on IPO", "one")], "ord long, url string, headline string, html string")
    for _ in range(2):
        incremental.run_batch(rows, 0, state)
    assert state.read("deals", "ord long").count() == 1


def test_seen_without_a_record(spark, tmp_path):
    state = incremental.State(spark, str(tmp_path))
    state.register_seen(spark.createDataFrame([("https://n/deals/a",)], "url string"))
    rows = spark.createDataFrame([page(1, "x/a", "h", "one")], "ord long, url string, headline string, html string")
    assert incremental.run_batch(rows, 0, state).count() == 0


def test_reparse_keeps_old_records_on_failure(spark):
    from briefloom.schemas import DEAL

    deals = spark.createDataFrame([(1, "Acme Legal advises Widget on IPO", "https://n/a"), (2, "old", "https://n/b")], "ord long, headline string, url string")
    deals = deals.select("ord", *[F.col(f.name) if f.name in deals.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in DEAL.fields])
    pages = spark.createDataFrame([("https://n/a", "<p>Ann Lee (Partner)</p>")], "url string, html string")
    got = {r["ord"]: r for r in incremental.reparse_all(deals, pages).collect()}
    assert got[1]["people"][0]["name"] == "Ann Lee" and got[2]["headline"] == "old"


def test_greedy_keeps_rows_without_a_signal(spark):
    df = spark.createDataFrame([(1, None, None, None), (2, None, None, None), (3, "https://a.in/x", None, None), (4, "https://a.in/x", None, None)], "ord long, url string, headline string, snippet string")
    assert sorted(r["ord"] for r in dedup.greedy(df).collect()) == [1, 2, 3]


def test_a_batch_parses_a_page_once(spark, monkeypatch):
    from briefloom.streaming import incremental

    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def counted(html):
        calls.add(1)
        return [html]

    monkeypatch.setattr(incremental, "paragraphs_of", counted)
    pages = spark.createDataFrame([(i, f"https://x.example/{i}", f"H {i}", "text") for i in range(5)], "ord long, url string, headline string, html string").repartition(2).cache()
    assert incremental.parse(pages).count() == 5
    rows = incremental.parse(pages).collect()
    assert len(rows) == 5 and calls.value == 10
