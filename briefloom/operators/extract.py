"""Text to entities: headlines, credits, firm attribution, people, articles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..dims import DEFAULT, Dims
from ..functions.firms import canonical_firm, split_firms
from ..functions.text import is_move_article, looks_like_name, normalize_name, snippet, transaction_types, truthy
from .ner import supplement

_VERB = r"(?iU)^(.+?)\s+(?:acts? on|(?:advise|assist|represent)s?)\s+(.+)$"
_NAME, _FIRM = r"([A-Za-z][-'’.\w ]+?)", r"[A-Za-z][-'’.,&\w ]+"
_CREDIT = "struct<name:string,role:string>"


def parse_headline(headline: Column, dims: Dims = DEFAULT) -> Column:
    """struct(law_firms, client, transaction_types) of ``<firms> <verb> <rest>``.

    Without the verb, or with nothing after it: no firms, null client, no types.
    """
    firms, rest = F.regexp_extract(headline, _VERB, 1), F.regexp_extract(headline, _VERB, 2)
    after = F.substring_index(firms, ":", -1)
    listed = F.contains(firms, F.lit(":")) & (F.contains(after, F.lit(",")) | F.contains(F.lower(after), F.lit(" and ")))
    firms = F.when(listed, F.trim(after)).otherwise(firms)
    client = F.trim(F.substring_index(rest, " on ", 1))
    client = F.trim(F.regexp_replace(client, r"(?sU)(?:[₹$]|\s+\d).*$", ""))
    hit = F.coalesce(F.rlike(headline, F.lit(_VERB)), F.lit(False))
    none = F.array().cast("array<string>")
    return F.struct(F.when(hit, split_firms(firms, dims)).otherwise(none).alias("law_firms"), F.when(hit, client).alias("client"), F.when(hit, transaction_types(headline, dims)).otherwise(none).alias("transaction_types"))


def parse_move(headline: Column, dims: Dims = DEFAULT) -> Column:
    """array of at most one struct(name, role, firm, relation) of a move headline.

    Four shapes in order; the first that matches with a real name counts.  Of a
    lawyer who quits, the firm is the one left (relation ``left``).
    """
    h = F.trim(F.regexp_replace(headline, r"(?U)^\s+|\s+$", ""))
    gap = lambda shape: "(?iU)^" + shape.replace("~", r"\s+")
    shapes = (
        (gap(rf"{_NAME}~(?:re-?)?joins?~({_FIRM}?)~as~([A-Za-z ]+?)(?:~in~[A-Za-z ]+)?$"), 1, 3, 2, "joined"),
        (gap(rf"{_NAME}~(?:quits|resigns(?:~from)?)~({_FIRM})$"), 1, None, 2, "left"),
        (gap(rf"{_NAME}~(?:promoted|elevated)~(?:as|to)~([A-Za-z ]+?)~at~({_FIRM})$"), 1, 2, 3, "at"),
        (gap(rf"(?:Former~{_FIRM}?~lawyer~)?{_NAME}~sets?~up~(?:own|their|her|his)?\s*(?:own~)?chambers"), 1, None, None, "founded"),
    )
    found = []
    for shape, name_at, role_at, firm_at, relation in shapes:
        name = normalize_name(F.regexp_extract(h, shape, name_at))
        role = truthy(F.initcap(F.trim(F.regexp_extract(h, shape, role_at)))) if role_at else F.lit(None).cast("string")
        if firm_at:
            firm = canonical_firm(F.regexp_extract(h, shape, firm_at), dims)
        else:
            firm, role = canonical_firm(F.concat(F.lit("Chambers of "), name), dims), F.lit("Advocate")
        person = F.struct(name.alias("name"), role.alias("role"), firm.alias("firm"), F.lit(relation).alias("relation"))
        found.append(F.when(F.rlike(h, F.lit(shape)) & looks_like_name(name, dims), person))
    return F.filter(F.array(F.coalesce(*found)), lambda p: p.isNotNull())


def strip_nicknames(paragraph: Column, dims: Dims = DEFAULT) -> Column:
    """Without single words in parentheses, unless the word is a role."""
    single = "|".join(r for r in dims.roles if " " not in r)
    return F.regexp_replace(paragraph, rf"(?U)\s\((?!(?:{single})\))[A-Za-z]+\)", "")


def paren_credits(paragraph: Column, dims: Dims = DEFAULT) -> Column:
    """array of struct(name, role) for every ``Name (Role[, more])``."""
    word = r"[A-Z][-'’a-zA-Z]*"
    inner = "|".join([word, *dims.particles])
    shape = rf"(?U)({word}(?:\s+(?:{inner})){{1,4}})\s*\(({'|'.join(dims.roles)})(?:[;,][^)]*)?[)]"
    names, roles = (F.regexp_extract_all(paragraph, F.lit(shape), F.lit(i)) for i in (1, 2))
    return F.coalesce(F.zip_with(names, roles, lambda n, r: F.struct(F.trim(n).alias("name"), r.alias("role"))), F.array().cast(f"array<{_CREDIT}>"))


def plural_credits(paragraph: Column, dims: Dims = DEFAULT) -> Column:
    """array of struct(name, role) for lists such as ``Associates A B, C D and E F.``

    The tokens are joined by single spaces; a list is a marker, then separators
    and name words, up to a word that ends a sentence or is neither.  Inside a
    list markers are name words like others.  Names need two words.  The repeated
    group is possessive: it never has to give a word back, and so the matcher loops
    instead of recursing, at any length of a list.
    """
    tokens = F.array_join(F.filter(F.split(F.replace(paragraph, F.lit(","), F.lit(" , ")), r"(?U)\s+"), lambda w: w != ""), " ")
    markers = "|".join(sorted(dims.plurals, key=lambda m: (-len(m.split()), m)))
    lead = "|".join([r"-*(?:\p{Lu}|\p{Lt})[\p{L}-]*", *(f"(?i:{p})" for p in dims.particles)])
    plain, closing = rf"\.*(?:{lead})(?![^ ])", rf"\.*(?:{lead})\.+(?![^ ])"
    shape = rf"(?<![^ ])({markers})(?![^ ])((?: (?:,|and|{plain})(?![^ ]))*+(?: {closing})?)"
    found, lists = (F.regexp_extract_all(tokens, F.lit(shape), F.lit(i)) for i in (1, 2))
    role = F.create_map(*[F.lit(x) for pair in dims.plurals.items() for x in pair])
    names = lambda text: F.filter(F.transform(F.split(F.concat(text, F.lit(" ")), r" (?:,|and)(?= )"), lambda n: F.trim(F.regexp_replace(n, r"\.+(?= |$)", ""))), lambda n: F.contains(n, F.lit(" ")))
    each = F.zip_with(found, lists, lambda m, text: F.transform(names(text), lambda n: F.struct(n.alias("name"), F.element_at(role, m).alias("role"))))
    return F.coalesce(F.flatten(each), F.array().cast(f"array<{_CREDIT}>"))


_CONTEXT = r"(?U)^([A-Z][-'’.,&\w ]*?)\s+(?:is (?:advising|representing)|advise[ds]|represent(?:ed|s)|act(?:ed|s) (?:as|for))\b"


def firm_context(paragraph: Column, firms: Column, dims: Dims = DEFAULT) -> Column:
    """The one declared firm that a paragraph's opening ``<firm> advised ...`` means, or null."""
    p = F.regexp_replace(paragraph, r"(?U)^\s+|\s+$", "")
    raw = F.trim(F.regexp_extract(p, _CONTEXT, 1))
    firm = F.lower(F.when(~F.lower(raw).isin("the firm", "the firm also"), canonical_firm(raw, dims)))
    match = F.array_distinct(F.filter(firms, lambda f: F.contains(firm, F.lower(f)) | F.contains(F.lower(f), firm)))
    return F.when(firm.isNotNull() & (F.size(match) == 1), F.get(match, F.lit(0)))


def carry_forward(value: Column, fallback: Column, group: str, order: str) -> Column:
    """The last value that is not null, up to and with a row; before the first, the fallback."""
    so_far = W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return F.coalesce(F.last(value, ignorenulls=True).over(so_far), fallback)


def attribute(articles: DataFrame, dims: Dims = DEFAULT) -> DataFrame:
    """(ord, para, text, firm) of articles (ord, paragraphs, law_firms): the firm in effect.

    It starts as the article's first firm and is carried forward from each
    paragraph that names another; articles are small, so the window is.
    """
    rows = articles.select("ord", "law_firms", F.posexplode("paragraphs").alias("para", "raw"))
    rows = rows.withColumn("text", strip_nicknames(F.col("raw"), dims))
    firm = carry_forward(firm_context(F.col("text"), F.col("law_firms"), dims), F.get(F.col("law_firms"), F.lit(0)), "ord", "para")
    return rows.select("ord", "para", "text", firm.alias("firm"), "law_firms")


def extract_people(articles: DataFrame, dims: Dims = DEFAULT, detector: Callable | None = None) -> DataFrame:
    """(ord, place, name, role, firm, source): people of articles, first mention of each.

    Parenthesis credits come before list credits of a paragraph.  A credit that
    names a known firm is none.  ``detector`` adds what it alone finds.
    """
    paras = attribute(articles, dims)
    both = F.concat(paren_credits(F.col("text"), dims), plural_credits(F.col("text"), dims))
    credits = paras.select("ord", "para", "firm", F.posexplode(both).alias("at", "c"))
    credits = credits.filter(~F.lower("c.name").isin(dims.known_firms)).select("ord", F.struct("para", "at").alias("place"), "c.name", "c.role", "firm")
    first = credits.groupBy("ord", F.lower("name").alias("low"), "role", "firm").agg(F.min(F.struct("place", "name")).alias("f"))
    people = first.select("ord", "f.place", "f.name", "role", "firm", F.lit(None).cast("string").alias("source"))
    return people if detector is None else people.unionByName(supplement(paras, people, dims, detector))


def parse_articles(articles: DataFrame, dims: Dims = DEFAULT, detector: Callable | None = None, source: str = "Example News") -> DataFrame:
    """Deal records (ord and the deal schema) of articles (ord, url, headline, paragraphs).

    A deal-shaped headline wins over move words in it; a move article has its
    person from the headline, null client, no types.
    """
    rows = articles.withColumn("h", parse_headline(F.col("headline"), dims)).withColumn("snippet", snippet(F.col("paragraphs"), dims.snippet_chars))
    rows = rows.withColumn("move", is_move_article(F.col("headline"), F.col("h.law_firms")))
    deals = rows.filter(~F.col("move")).select("ord", "url", "headline", "snippet", "paragraphs", "h.*")
    person = lambda p, client, src: F.struct(p["name"].alias("name"), p["role"].alias("role"), p["firm"].alias("firm"), client.alias("client"), src.alias("source"))
    null = F.lit(None).cast("string")
    people = extract_people(deals.select("ord", "paragraphs", "law_firms"), dims, detector)
    people = people.groupBy(F.col("ord").alias("p_ord")).agg(F.array_sort(F.collect_list(F.struct("place", "name", "role", "firm", "source"))).alias("found"))
    deals = deals.join(people, F.col("ord") == F.col("p_ord"), "left")
    people_of = F.coalesce(F.transform("found", lambda p: person(p, null, p["source"])), F.array().cast("array<struct<name:string,role:string,firm:string,client:string,source:string>>"))
    shape = ["ord", "headline", "client", F.lit(source).alias("source"), "url", "snippet", "law_firms", "transaction_types", "people"]
    deals = deals.withColumn("people", people_of).select(*shape)
    moves = rows.filter("move").withColumn("m", parse_move(F.col("headline"), dims))
    moves = moves.withColumn("law_firms", F.array_sort(F.array_distinct(F.filter(F.transform("m", lambda p: p["firm"]), lambda f: f.isNotNull()))))
    moves = moves.withColumns({"client": null, "transaction_types": F.array().cast("array<string>"), "people": F.transform("m", lambda p: person(p, null, null))})
    return deals.unionByName(moves.select(*shape))


