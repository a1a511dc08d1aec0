"""Golden cases of the scalar functions (T1 to T7)."""

from pyspark.sql import functions as F

from briefloom.functions import firms, text


def test_canonical_firm(column):
    cases = {
        "": None, ",": None, "  ACL ": "Acme Legal", "Acme Legal (formerly Old Co) LLP": "Acme Legal", "Acme Legal LLP, Mumbai": "Acme Legal",
        "Zed Law, Mumbai.": "Zed Law, Mumbai", "Zed Law LLP.": "Zed Law", "Zed, LLP": "Zed", "LLP": "Llp", "ZED AND SONS": "Zed and Sons", "THE ZED LAW": "the Zed Law",
        "His chambers in Delhi": None, "In-House": None, "Widget Ltd (in-house)": None, "Widget (in house team)": "Widget (in house team)", None: None,
    }
    assert column(firms.canonical_firm, list(cases)) == list(cases.values())


def test_second_pass_drops_the_city(column):
    assert column(lambda c: firms.canonical_firm(firms.canonical_firm(c)), ["Zed Law, Mumbai."]) == ["Zed Law"]


def test_alias_join_equals_literal_aliases(spark, column):
    names = ["ACL", "Zed Law LLP", "in-house", None, ""]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i long, n string")
    aliases = spark.createDataFrame([("acl", "Acme Legal")], "key string, canonical string")
    got = [r["o"] for r in firms.canonical_by_join(rows, "n", "o", aliases).orderBy("i").collect()]
    assert got == column(firms.canonical_firm, names)


def test_names(column):
    assert column(text.normalize_name, ["  Ann   Lee., ", ". ."]) == ["Ann Lee", ""]
    names = ["Ann Lee", "Lee", "Ann and Bo", "Two Lawyers", "Chad de Souza", "Ann lee", None]
    assert column(text.looks_like_name, names) == [True, False, False, False, True, False, False]


def test_role_bucket(column):
    cases = {"Founding & Managing Partner": "Managing Partner", "Co-founder": "Founder", "Senior Founding Partner": "Founder", "Associate Counsel": "Counsel", "Associate Partner": "Associate Partner", "Advocate on Record": "Advocate", "Paralegal": "Other", None: None, "": None}
    assert column(text.role_bucket, list(cases)) == list(cases.values())


def test_snapshot(column):
    short, long = "x" * 110, "x" * 111
    assert column(text.snapshot, [short, long, "a b - -", "w " * 80]) == [short, "x" * 107 + "...", "a b", ("w " * 53).strip() + "..."]


def test_personnel_moves(column):
    yes = ["Ann Lee joins Acme Legal as Partner", "Ann Lee rejoins Acme Legal", "Acme hires Ann Lee as partner", "Widget CEO steps down", "Ann Lee moves to Acme as Partner"]
    no = ["Acme joins hands with Zed", "Ann Lee moved to Acme as Partner", "Ann Lee resigned", "Ann launch own firm", None]
    assert column(text.is_move, yes + no) == [True] * len(yes) + [False] * len(no)


def test_move_needs_no_client(spark):
    rows = spark.createDataFrame([("Ann quits Acme", "Widget"), ("Ann quits Acme", ""), ("Ann quits Acme", None)], "h string, c string")
    assert [r[0] for r in rows.select(text.is_move_record(F.col("h"), F.col("c"))).collect()] == [False, True, True]


def test_url_keys(column):
    urls = ["https://X.com/A/b-c/?q=1#t", "https://x.com/d/B-C/", "HTTP://x.com:80//", None]
    assert column(text.normalize_url, urls) == ["https://x.com/A/b-c", "https://x.com/d/B-C", "http://x.com:80", None]
    assert column(text.slug, urls) == ["?q=1#t", "b-c", "x.com:80", None]


def test_types_and_areas(column):
    assert ["|".join(r) for r in column(text.transaction_types, ["A demerger and stake acquisition by tripod"])] == ["IPO|acquisition|stake acquisition|merger|demerger"]
    assert column(text.practice_areas, [["merger", "IPO", "merger", "nothing"], [], None], "array<string>") == [["Capital Markets", "Mergers & Acquisitions"], [], []]


def test_fingerprint_folds(column):
    a, b = column(text.fingerprint, ["  A\n b ", "a B"])
    assert a == b
