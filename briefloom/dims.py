"""Dimensions of the extractors: small tables, passed as data, with synthetic defaults.

They are bounded by what people curate (tens to hundreds of entries), which is why
they may stand in expressions as literals.  An alias table that grows with the
data goes through ``functions.firms.canonical_by_join`` instead.
"""

from __future__ import annotations

from dataclasses import dataclass, field


def _split(text: str) -> list[str]:
    return [x.strip() for x in text.split("|")]


def _ranks() -> dict[str, int]:
    by_rank = {6: "Joint Managing Partner | Managing Partner", 5: "Senior Partner", 4: "Partner", 3: "Of Counsel | Counsel | Principal Associate | Associate Partner", 2: "Senior Associate", 1: "Associate"}
    return {title: rank for rank, titles in by_rank.items() for title in _split(titles)}


def _areas() -> dict[str, list[str]]:
    by_area = {
        "Banking & Finance": "financing",
        "Capital Markets": "QIP | IPO",
        "Corporate & Commercial": "joint development agreement | joint venture",
        "Mergers & Acquisitions": "buyout | divestment | demerger | amalgamation | merger | stake acquisition | acquisition",
        "Private Equity & Venture Capital": "investment | fundraise | " + " | ".join(f"Series {x}" for x in "EDCBA"),
        "Restructuring & Insolvency": "restructuring",
    }
    out: dict[str, list[str]] = {}
    for area, kinds in by_area.items():
        for kind in _split(kinds):
            out.setdefault(kind, []).append(area)
    return out


def _keywords() -> list[str]:
    """Tags in output order; the one kind that only structured sources carry is left out."""
    return [*_split("IPO | QIP"), *(f"Series {x}" for x in "ABCDE"), *_split("acquisition | stake acquisition | merger | amalgamation | demerger"), *_split("buyout | divestment | financing | joint venture"), *_split("fundraise | investment | restructuring")]


@dataclass(frozen=True)
class Dims:
    aliases: dict[str, str] = field(default_factory=lambda: {"acl": "Acme Legal", "acme legal": "Acme Legal", "samo: partners": "Samo: Partners", "zl": "Zed Law"})
    cities: list[str] = field(default_factory=lambda: _split("mumbai | pune | delhi | new delhi | noida | kolkata | chennai | hyderabad | bengaluru | bangalore | gurgaon | gurugram"))
    #: Phrases that stand for no firm.
    generic: list[str] = field(default_factory=lambda: [*(f"{a} counsel" for a in ("local", "foreign", "international", "independent", "in-house")), *(f"{a} chambers" for a in ("his", "her", "independent")), *(f"{a} law firms" for a in ("us", "international")), "in-house", "the firm", "the firm also"])
    small_words: list[str] = field(default_factory=lambda: _split("the | of | and | &"))
    role_ranks: dict[str, int] = field(default_factory=_ranks)
    #: Bucket and the substrings that put a role there, first match first.
    buckets: list[tuple[str, list[str]]] = field(default_factory=lambda: [("Managing Partner", ["managing partner"]), ("Senior Partner", ["senior partner"]), ("Founder", ["founding", "founder"])] + [(b, [b.lower()]) for b in _split("Associate Partner | Partner | Counsel | Principal Associate | Senior Associate | Associate | Senior Advocate | Advocate | Consultant")])
    areas: dict[str, list[str]] = field(default_factory=_areas)
    keywords: list[str] = field(default_factory=_keywords)
    #: Plural markers and the role that they give.
    plurals: dict[str, str] = field(default_factory=lambda: {f"{r}s": r for r in _split("Partner | Counsel | Associate | Senior Partner | Senior Associate | Principal Associate | Associate Partner")})
    particles: list[str] = field(default_factory=lambda: sorted(_split("von | van | der | del | de | la | al | bin")))
    #: Words that no personal name has.
    no_name: list[str] = field(default_factory=lambda: [*_split("a | the | and | some | few | many | several | multiple"), *_split("two | three | four | five | six | seven | eight"), *(f"{r}s" for r in ("lawyer", "partner", "associate", "advocate", "counsel"))])
    site_root: str = "https://news.example.com"
    section: str = "/deals"
    min_link_text: int = 20
    snippet_chars: int = 500

    @property
    def known_firms(self) -> list[str]:
        return sorted({v.lower() for v in self.aliases.values()})

    @property
    def roles(self) -> list[str]:
        """Longest first, so that a title is not cut to a part of it."""
        return sorted(self.role_ranks, key=lambda r: (-len(r.split()), -len(r), r))


DEFAULT = Dims()
