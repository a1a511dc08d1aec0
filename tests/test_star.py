"""Consolidation and directory (T15 to T17), sources and sinks."""

import json

import pytest
from pyspark.sql import functions as F

from briefloom.operators import consolidate
from briefloom.plans import directory
from briefloom.plans.lineage import sequence_ids
from briefloom.schemas import DEAL
from briefloom.sources import documents, html, sinks


def deal(headline, url="u", client=None, firms=(), types=(), people=(), snippet=None):
    who = [dict(zip(("name", "role", "firm", "client"), p + (None,) * (4 - len(p)), strict=True)) for p in people]
    return {"headline": headline, "url": url, "client": client, "law_firms": list(firms), "transaction_types": list(types), "people": who, "snippet": snippet}


def star(spark, deals, parts=3):
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(deals)], "ord long, v string")
    rows = rows.select("ord", F.from_json("v", DEAL).alias("d")).select("ord", "d.*").repartition(parts)
    return consolidate.star(rows)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("parts", [1, 8])
def test_one_url_is_one_deal(spark, parts):
    s = star(spark, [deal("H1", types=["IPO"], firms=["ACL"], people=[("Ann Lee", "Partner")]), deal("H2", types=["merger"], people=[("Bo Ray", None, "his chambers"), ("ann lee", "Counsel", "Acme Legal"), ("x",)])], parts)
    assert rows(s.deals, "id", "headline") == [(1, "H1")]
    assert rows(s.deal_types, "deal_id", "type") == [(1, "IPO"), (1, "merger")]
    assert sorted((r["name"], r["role"], r["firm_id"]) for r in s.people.collect()) == [("Ann Lee", "Partner", 1), ("Bo Ray", None, None)]
    assert s.person_deals.count() == 2
    assert tuple(s.counters.first()) == (1, 0)


def test_null_urls(spark):
    s = star(spark, [deal("H", "u1", snippet="s", types=["IPO"]), deal("H", None, snippet="s", types=["QIP"]), deal("H", None, types=["merger"]), deal("H", "", types=["a"]), deal("G", "", types=["b"])])
    assert s.deals.count() == 4
    assert rows(s.deal_types, "deal_id", "type") == [(1, "IPO"), (1, "QIP"), (3, "merger"), (4, "a"), (4, "b")]


def test_moves_register_people_only(spark):
    s = star(spark, [deal("Ann Lee joins Zed Law", firms=["Zed Law"], types=["IPO"], people=[("Ann Lee", None)]), deal("Ann Lee joins Zed Law", "v", client="Widget", firms=["Roe LLP"])])
    assert rows(s.firms, "id", "name") == [(1, "Zed Law"), (2, "Roe")]
    assert (s.deals.count(), s.deal_types.count(), s.people.count(), s.person_deals.count()) == (1, 0, 1, 0)


def test_roles_fold(spark):
    titles = [[None, "Partner"], ["Partner", None], ["Counsel", "Principal Associate"], ["Partner (Head)", "Associate"], ["Paralegal", "Intern"], [None, ""], ["", None]]
    data = [(g, i, t) for g, ts in enumerate(titles) for i, t in enumerate(ts)]
    df = spark.createDataFrame(data, "g long, i long, t string").groupBy("g").agg(consolidate.best_role(F.col("t"), F.struct("i")).alias("r"))
    assert [r["r"] for r in df.orderBy("g").collect()] == ["Partner", "Partner", "Counsel", "Associate", "Paralegal", "", None]


def test_same_names_and_hierarchy(spark):
    s = star(spark, [
        deal("One", "a", client="W", firms=["Zed Law"], types=["IPO", "merger"], people=[("Ann Lee", "Partner"), ("Cy Dee", None, "Roe")]),
        deal("Two", "b", firms=["Zed Law"], types=["merger"], people=[("Bo Ray", None), ("Ann Lee", None, "Roe", "Own")]),
        deal("Three", "c", firms=["Zed Law"], people=[("Dee Oak", None), ("Eli Fir", None, "his chambers")]),
    ])
    people = directory.people_table(s)
    assert [r["practice_groups"] for r in directory.hierarchy(s.firms, people).filter("firm = 'Zed Law'").collect()] == [[("Mergers & Acquisitions", [1, 3]), ("Capital Markets", [1]), ("Unclassified", [5])]]
    crossed = {(r["name"], r["firm"]): r for r in directory.same_name(people, spark.createDataFrame([("Ann Lee", ("SAME_PERSON_MOVED", "x", "Roe"))], "name string, verdict struct<verdict:string,evidence:string,current_firm:string>")).collect()}
    assert [x["firm"] for x in crossed["Ann Lee", "Zed Law"]["same_name_elsewhere"]] == ["Roe"]
    assert crossed["Ann Lee", "Roe"]["firm_verification"]["verdict"] == "SAME_PERSON_MOVED"
    assert crossed["Bo Ray", "Zed Law"]["same_name_elsewhere"] is None
    assert crossed["Ann Lee", "Roe"]["clients"] == ["Own"]
    assert tuple(directory.statistics(s, people).first()) == (6, 2, 3, 2)


def test_document_and_page(spark, tmp_path):
    s = star(spark, [deal("One </script>", "a", firms=["Zed Law"], people=[("Ann Lee", "Partner"), ("Ann Lee", None, "Roe")])])
    none = documents.read_verdicts(spark, None)
    out, page = tmp_path / "d.json", tmp_path / "p.html"
    sinks.write_document(directory.document(s, none), str(out))
    data = json.loads(out.read_text(encoding="utf-8"))
    assert [p["firm_verification"] for p in data["people"]] == [dict(zip(("verdict", "evidence"), directory.UNRESEARCHED, strict=True))] * 2
    (tmp_path / "t.html").write_text("<script>__DATA__</script>", encoding="utf-8")
    assert sinks.render_page(str(tmp_path / "t.html"), str(out), str(page)) == len(page.read_bytes())
    assert page.read_text(encoding="utf-8").count("</script") == 1
    sinks.write_star(s, str(tmp_path / "star"))
    assert spark.read.parquet(str(tmp_path / "star/people")).count() == 2


def test_json_sources(spark, tmp_path):
    a, b, v, seen = (str(tmp_path / n) for n in ("a.json", "b.json", "v.json", "s.json"))
    (tmp_path / "a.json").write_text(json.dumps([deal("B"), deal("A")]))
    (tmp_path / "v.json").write_text(json.dumps({"_readme": "text", "Ann": {"verdict": "UNVERIFIED", "evidence": "e"}}))
    (tmp_path / "s.json").write_text(json.dumps(["x", "y", "x"]))
    assert [r["headline"] for r in documents.read_deals(spark, a, b).orderBy("ord").collect()] == ["B", "A"]
    (tmp_path / "b.json").write_text(json.dumps([{"headline": "C"}]))
    assert [r["headline"] for r in documents.read_deals(spark, a, b).orderBy("ord").collect()] == ["B", "A", "C"]
    assert [(r["name"], r["verdict"]["evidence"]) for r in documents.read_verdicts(spark, v).collect()] == [("Ann", "e")]
    assert rows(documents.read_seen(spark, seen), "url") == [("x",), ("y",)]
    assert documents.read_seen(spark, b + "-").count() == 0
    (tmp_path / "b.json").write_text("[{broken")
    with pytest.raises(Exception, match="(?i)malformed"):
        documents.read_deals(spark, b).collect()


def test_html_sources(spark):
    page = '<p>out</p><script>"<p>no</p>"</script><article><p>one <b>bold<br> <p>two</p><div itemprop="articleBody">x</div></article><p>after</p>'
    body = '<div itemprop="articleBody"><p>in</p></div><p>out</p>'
    pages = spark.createDataFrame([(1, page), (2, body), (3, "<p>a<p>b"), (4, None)], "page_id long, html string")
    got = {r["page_id"]: r["p"] for r in pages.select("page_id", html.paragraphs_of("html").alias("p")).collect()}
    assert got == {1: ["one bold", "two"], 2: ["in"], 3: ["a", "b"], 4: []}
    links = '<a href="/deals/x">first text long enough here</a><a href="/deals/y">short</a><a href="https://other/deals/z">somewhere else entirely now</a><a href="/deals/x">last text long enough here</a><a href="/news/q">outside of the section here</a>'
    found = html.scan_links(spark.createDataFrame([(1, links)], "page_id long, html string")).collect()
    assert [(r["pos"], r["href"], r["text"]) for r in found] == [(0, "https://news.example.com/deals/x", "last text long enough here")]


def test_sequence_ids_are_dense(spark):
    df = sequence_ids(spark.range(1000).withColumn("k", F.col("id") * 7919 % 1000).drop("id"), ["k"], "n")
    assert all(r["n"] == r["k"] + 1 for r in df.collect())


def test_observed_counts(spark):
    df, seen = sinks.observed(spark.range(10), "count", even=F.col("id") % 2 == 0)
    df.collect()
    assert seen.get == {"rows": 10, "even": 5}


def test_broken_pages_cost_themselves_only(spark):
    from briefloom.dims import DEFAULT
    from briefloom.sources import html
    from briefloom.streaming.incremental import parse

    good = f"<a href='{DEFAULT.site_root}{DEFAULT.section}/a-b'>{'long text ' * 9}</a><article><p>Words</p></article>"
    pages = [(1, good), (2, "<![foo[x]]>" + good), (3, "<a href='http://[x'>" + "y" * 90 + "</a>" + good)]
    df = spark.createDataFrame(pages, "page_id long, html string")
    assert {r["page_id"] for r in html.scan_links(df).collect()} == {1, 3}
    articles = df.select(df.page_id.alias("ord"), df.page_id.cast("string").alias("url"), df.page_id.cast("string").alias("headline"), "html")
    assert {r["ord"]: r["error"] for r in parse(articles).collect()} == {1: None, 2: "page cannot be parsed", 3: None}


def test_bare_names_are_skipped(spark):
    from briefloom.operators.consolidate import star

    people = [("x\n", None, None, None), ("\u00a0", None, None, None), ("Ann Lee", None, None, None)]
    row = (0, "Acme Legal advises", None, None, "u", None, ["Acme Legal"], [], people)
    kinds = "ord long, headline string, client string, source string, url string, snippet string, law_firms array<string>, transaction_types array<string>, people array<struct<name:string,role:string,firm:string,client:string>>"
    s = star(spark.createDataFrame([row], kinds))
    assert [r["name"] for r in s.people.collect()] == ["Ann Lee"] and s.counters.first()["skipped_people"] == 2


def test_bridges_need_no_join_of_rows(spark):
    s = star(spark, [deal("One", "a", types=["IPO"], firms=["ACL"], people=[("Ann Lee", None)]), deal("Two", None, types=["merger"]), deal("Two", None, types=["QIP"])])
    plans = [t._jdf.queryExecution().optimizedPlan().toString() for t in (s.deal_types, s.deal_practice_areas)]
    assert not any("Join" in p for p in plans), "rows joined with rows, which Spark may broadcast"
    assert rows(s.deal_types, "deal_id", "type") == [(1, "IPO"), (2, "QIP"), (2, "merger")]


def test_summary_is_the_people_table_without_lists_of_deals(spark):
    s = star(spark, [
        deal("One", "a", client="W", firms=["Zed Law"], types=["IPO", "merger"], people=[("Ann Lee", "Partner"), ("Cy Dee", None, "Roe")]),
        deal("Two", "b", client="V", firms=["Zed Law"], types=["merger"], people=[("Bo Ray", None), ("Ann Lee", None, "Roe", "Own"), ("Ann Lee", None)]),
        deal("Three", "c", client="W", firms=["Zed Law"], people=[("Ann Lee", None), ("Eli Fir", None, "his chambers")]),
        deal("Ann Lee joins Zed Law", "d", firms=["Zed Law"], people=[("Gus Oak", None)]),
    ])
    same = ["id", "name", "firm", "role", "role_bucket", "transaction_types", "practice_areas", "clients", "snapshot"]
    want = sorted((*[r[c] for c in same], len(r["deals"])) for r in directory.people_table(s).collect())
    small = directory.summary(s)
    assert sorted(tuple(r[c] for c in [*same, "n_deals"]) for r in small.collect()) == want
    assert "headline" not in {f.name for c in small.schema for f in getattr(getattr(c.dataType, "elementType", None), "fields", [])}


def test_namesakes_are_counted_without_lists(spark):
    people = spark.createDataFrame([(1, "Ann Lee"), (2, "ANN LEE"), (4, "Bo Ray"), (8, "ann lee")], "id long, name string")
    known = spark.createDataFrame([("ANN LEE", ("SAME_PERSON_MOVED", "x", "Roe"))], "name string, verdict struct<verdict:string,evidence:string,current_firm:string>")
    groups = directory.namesakes(people, known, F.sum("id").alias("sum"))
    assert [(r["low"], r["n"], r["sum"], r["firm_verification"]["verdict"]) for r in groups.collect()] == [("ann lee", 3, 11, "SAME_PERSON_MOVED")]
    assert "collect_list" not in groups._jdf.queryExecution().optimizedPlan().toString()


def test_statistics_need_no_table_of_people(spark):
    s = star(spark, [
        deal("One", "a", firms=["Zed Law"], types=["IPO", "merger"], people=[("Ann Lee", None), ("Cy Dee", None, "Roe")]),
        deal("Two", "b", firms=["Zed Law"], types=["financing"]),
        deal("Three", "c", firms=["Zed Law"], types=["IPO"], people=[("Bo Ray", None)]),
    ])
    out = directory.statistics(s)
    assert tuple(out.first()) == tuple(directory.statistics(s, directory.people_table(s)).first()) == (3, 2, 3, 2)
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()
