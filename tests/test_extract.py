"""Golden cases of the extractors (T8 to T12)."""

from pyspark.sql import functions as F

from briefloom.operators import extract


def test_parse_headline(column):
    cases = {
        "Acme Legal, Zed Law act on Widget ₹230 crore Series A fundraise": (["Acme Legal", "Zed Law"], "Widget", ["Series A", "fundraise"]),
        "Acme Legal advises Widget on acquisition of Gadget": (["Acme Legal"], "Widget", ["acquisition"]),
        "Gadget Stake Sale: Acme Legal, Zed Law act on Widget": (["Acme Legal", "Zed Law"], "Widget", []),
        "Samo: Partners advises Widget on IPO": (["Samo: Partners"], "Widget", ["IPO"]),
        "Roe and Partners advises Widget on QIP": (["Roe", "Partners"], "Widget", ["QIP"]),
        "Acme Legal advises Widget on demerger and stake acquisition": (["Acme Legal"], "Widget", ["acquisition", "stake acquisition", "merger", "demerger"]),
        "Acme Legal advises ₹500 crore fund": (["Acme Legal"], "", []),
        "Widget raises 15 million in investment": ([], None, []),
        "Gadget sold for 525 crore, Acme Legal advise": ([], None, []),
        None: ([], None, []),
    }
    got = column(extract.parse_headline, list(cases))
    assert [(r["law_firms"], r["client"], r["transaction_types"]) for r in got] == list(cases.values())


def test_parse_move(column):
    cases = {
        "Ann Lee joins Acme Legal as Partner in Mumbai": [("Ann Lee", "Partner", "Acme Legal", "joined")],
        "Ann Lee and Bo Ray join Acme Legal as Partners": [],
        "Ann Lee resigns from Acme Legal": [("Ann Lee", None, "Acme Legal", "left")],
        "Ann Lee promoted as senior associate at Acme Legal": [("Ann Lee", "Senior Associate", "Acme Legal", "at")],
        "Former Acme Legal lawyer Ann Lee sets up her own chambers": [("Ann Lee", "Advocate", "Chambers of Ann Lee", "founded")],
        "Widget buys Gadget": [],
    }
    assert [[tuple(p) for p in r] for r in column(extract.parse_move, list(cases))] == list(cases.values())


def test_paren_credits(column):
    cases = {
        "Ann Lee (Partner), Bo J Ray (Senior Associate), Cy de Souza (Partner, Head – West)": [("Ann Lee", "Partner"), ("Bo J Ray", "Senior Associate"), ("Cy de Souza", "Partner")],
        "Ann Lee (Senior Associate Designate)": [],
        "Lee (Partner)": [],
        "Kyung (Won) Lee (Partner)": [("Kyung Lee", "Partner")],
        "Team Head Ann Lee (Partner)": [("Team Head Ann Lee", "Partner")],
        None: [],
    }
    got = column(lambda c: extract.paren_credits(extract.strip_nicknames(c)), list(cases))
    assert [[tuple(p) for p in r] for r in got] == list(cases.values())


def test_plural_credits(column):
    cases = {
        "Associates Ann Lee, Bo Ray and Cy Dee. The firm": [("Ann Lee", "Associate"), ("Bo Ray", "Associate"), ("Cy Dee", "Associate")],
        "Associates Ann K. Lee": [("Ann K", "Associate")],
        "Partners Ann Lee and Associates Bo Ray": [("Ann Lee", "Partner"), ("Associates Bo Ray", "Partner")],
        "Associates O'Neil Roy, Bo Ray": [],
        "Senior Associates Ann Lee, Solo and Élise von Roe helped": [("Ann Lee", "Senior Associate"), ("Élise von Roe", "Senior Associate")],
        None: [],
    }
    assert [[tuple(p) for p in r] for r in column(extract.plural_credits, list(cases))] == list(cases.values())


def test_long_credit_lists(column):
    """A list of 20,000 names neither recurses nor loses a name."""
    names = [f"Ann{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} Lee{chr(97 + i // 676 % 26)}{chr(97 + i // 17576)}" for i in range(20000)]
    got = column(extract.plural_credits, ["Partners " + ", ".join(names[:-1]) + " and " + names[-1] + ". More."])[0]
    assert [r["name"] for r in got] == names


def test_firm_context_is_carried_forward(spark):
    paragraphs = ["Team news.", "Zed Law also advised Widget.", "Credits.", "Acme Legal and Zed Law advised Widget.", "The Firm advised Widget."]
    rows = spark.createDataFrame([(1, paragraphs, ["Acme Legal", "Zed Law"])], "ord long, paragraphs array<string>, law_firms array<string>")
    got = [r["firm"] for r in extract.attribute(rows).orderBy("para").collect()]
    assert got == ["Acme Legal", "Zed Law", "Zed Law", "Zed Law", "Zed Law"]


def articles(spark):
    rows = [
        (1, "https://n/deals/a", "Acme Legal, Zed Law act on Widget IPO", ["Ann Lee (Partner) and Acme Legal (Partner).", "Zed Law also advised Gadget. Associates Bo Ray, Cy Dee.", "ann Lee (Partner) Ann Lee (Partner)"]),
        (2, "https://n/deals/b", "Dee Oak joins Zed Law as Counsel", ["Ann Lee (Partner)"]),
        (3, "https://n/deals/c", "Acme Legal advises promoter as CEO steps down", []),
    ]
    return spark.createDataFrame(rows, "ord long, url string, headline string, paragraphs array<string>")


def test_parse_articles(spark):
    got = {r["ord"]: r for r in extract.parse_articles(articles(spark)).collect()}
    people = [(p["name"], p["role"], p["firm"]) for p in got[1]["people"]]
    assert people == [("Ann Lee", "Partner", "Acme Legal"), ("Bo Ray", "Associate", "Zed Law"), ("Cy Dee", "Associate", "Zed Law"), ("Ann Lee", "Partner", "Zed Law")]
    assert (got[2]["client"], got[2]["law_firms"], got[2]["people"][0]["name"]) == (None, ["Zed Law"], "Dee Oak")
    assert got[3]["client"] == "promoter as CEO steps down" and got[3]["people"] == []


def test_detector_fills_gaps_only(spark):
    rows = spark.createDataFrame([(1, ["Ann Lee (Partner)", "élan Vital (Partner, x) of ann lee (Partner)", "élan Vital (Counsel)"], ["Acme Legal"])], "ord long, paragraphs array<string>, law_firms array<string>")

    def detector(text):
        return [(n, text.index(n) + len(n)) for n in ("élan Vital", "ann lee") if n in text]

    got = extract.extract_people(rows, detector=detector).filter(F.col("source") == "ner").collect()
    assert [(r["name"], r["role"]) for r in got] == [("élan Vital", "Partner")]
    assert extract.extract_people(rows).filter("source is not null").count() == 0


def test_detector_that_cannot_be_loaded(spark):
    from briefloom.operators.ner import with_fallback

    def load():
        raise ImportError

    assert list(with_fallback(load)("Ann Lee (Partner)")) == []
