"""Scalar text functions, each a Column of Columns (no Python at run time).

``(?U)`` gives \\w, \\s and \\b their Unicode meaning where texts need it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..dims import DEFAULT, Dims


def truthy(c: Column) -> Column:
    """The value, null if it is null or empty."""
    return F.nullif(c, F.lit(""))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` needs it.

    Expressions inside lambdas are not shared by the optimizer, and a column used
    twice is copied twice: chains of them grow exponentially.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def squeeze(c: Column) -> Column:
    """White space collapsed to single spaces and trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def capitalize(w: Column) -> Column:
    return F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))


def normalize_name(c: Column) -> Column:
    """A personal name without stray punctuation around it."""
    return F.btrim(squeeze(c), F.lit(" .,;:-"))


def headline_key(c: Column) -> Column:
    return F.lower(squeeze(c))


def role_rank(role: Column, dims: Dims = DEFAULT) -> Column:
    """Rank of an exact title; unknown and null rank 0."""
    table = F.create_map(*[F.lit(x) for pair in dims.role_ranks.items() for x in pair])
    return F.coalesce(F.try_element_at(table, role), F.lit(0))


def role_bucket(role: Column, dims: Dims = DEFAULT) -> Column:
    """First bucket one of whose substrings the role has; ``Other`` if none, null without a role."""
    low = F.lower(role)
    out = F.when(truthy(role).isNull(), F.lit(None).cast("string"))
    for bucket, parts in dims.buckets:
        found = F.contains(low, F.lit(parts[0]))
        for p in parts[1:]:
            found |= F.contains(low, F.lit(p))
        out = out.when(found, F.lit(bucket))
    return out.otherwise(F.lit("Other"))


def snapshot(headline: Column, limit: int = 110, cut: int = 107) -> Column:
    """A headline shortened at a space before ``cut`` characters, if it is over ``limit``."""
    h = F.rtrim(squeeze(headline), F.lit(" -"))
    head = F.substring(h, 1, cut)
    at_space = F.regexp_extract(head, r"(?s)^(.*) ", 1)
    return F.when(F.length(h) <= limit, h).otherwise(F.concat(F.when(F.contains(head, F.lit(" ")), at_space).otherwise(head), F.lit("...")))


def practice_areas(kinds: Column, dims: Dims = DEFAULT) -> Column:
    """Sorted distinct areas of an array of transaction types; unknown types have none."""
    table = F.create_map(*[x for k, v in dims.areas.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    none = F.array().cast("array<string>")
    found = F.transform(F.coalesce(kinds, none), lambda k: F.coalesce(F.try_element_at(table, k), none))
    return F.array_sort(F.array_distinct(F.flatten(found)))


def transaction_types(headline: Column, dims: Dims = DEFAULT) -> Column:
    """Keywords that a headline contains, in the order of the keyword table."""
    low = F.lower(headline)
    return F.filter(F.array(*map(F.lit, dims.keywords)), lambda k: F.contains(low, F.lower(k)))


#: Signs of a career move; a blank stands for white space, an underscore for any of it or none.
_MOVES = (
    "(?:re-?)?joins?(?! hands)",
    "(?:quit|resign)s?",
    "steps? down",
    "(?:promoted|elevated) (?:as|to)",
    "appointed as",
    "named partner",
    "hires? .+ as partner",
    r"moves? to .+ as\s(?=\w)",
    "sets? up (?:own|their|her|his)?_(?:own )?chambers",
    "(?:starts?|launches) (?:their|her|his)?_own (?:chambers|firm|practice)",
)
MOVE = r"(?iU)\b(?:" + "|".join(_MOVES).replace(" ", r"\s+").replace("_", r"\s*") + r")(?:\b|(?<=\s))"


def is_move(headline: Column) -> Column:
    """Whether a headline tells of a career move rather than of a deal."""
    return F.coalesce(F.rlike(headline, F.lit(MOVE)), F.lit(False))


def is_move_record(headline: Column, client: Column) -> Column:
    """The builder's test: a move and no client."""
    return is_move(headline) & truthy(client).isNull()


def is_move_article(headline: Column, firms: Column) -> Column:
    """The scraper's test: a move and no firms parsed from the headline."""
    return is_move(headline) & (F.size(firms) == 0)


def slug(url: Column) -> Column:
    """Last path segment, lower-cased; a query or fragment stays in it."""
    return F.lower(F.substring_index(F.rtrim(url, F.lit("/")), "/", -1))


def normalize_url(url: Column) -> Column:
    """Scheme and host in lower case, path without closing slashes, no query or fragment."""
    shape = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)"
    scheme, host, path = (F.regexp_extract(url, shape, i) for i in (1, 2, 3))
    path = F.rtrim(path, F.lit("/"))
    return F.concat(F.when(scheme != "", F.concat(F.lower(scheme), F.lit(":"))).otherwise(F.lit("")), F.when(host != "", F.concat(F.lit("//"), F.lower(host))).otherwise(F.lit("")), path)


def fingerprint(text: Column, chars: int = 500) -> Column:
    """SHA-256 of the first characters of the folded text."""
    return F.sha2(F.substring(headline_key(text), 1, chars), 256)


def content_fingerprint(paragraphs: Column, chars: int = 500) -> Column:
    return fingerprint(F.array_join(paragraphs, " "), chars)


def snippet(paragraphs: Column, chars: int = 500) -> Column:
    return F.substring(F.array_join(paragraphs, " "), 1, chars)


def escape_script(json: Column) -> Column:
    """JSON text that cannot close the script element it is put into."""
    return F.replace(json, F.lit("</script"), F.lit("<\\/script"))


def looks_like_name(name: Column, dims: Dims = DEFAULT) -> Column:
    """Two words or more, none a word that no name has, each capitalized or a particle."""
    words = F.filter(F.split(squeeze(name), " "), lambda w: w != "")
    bare = lambda w: F.replace(F.btrim(w, F.lit(".")), F.lit("-"), F.lit(""))
    first = lambda w: F.substring(bare(w), 1, 1)
    lower_start = lambda w: (first(w) == F.lower(first(w))) & (first(w) != F.upper(first(w)))
    good = lambda w: ~F.lower(w).isin(dims.no_name) & (bare(w) != "") & (~lower_start(w) | F.lower(bare(w)).isin(dims.particles))
    return F.coalesce((F.size(words) >= 2) & F.forall(words, good), F.lit(False))
