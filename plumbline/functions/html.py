"""Fields of web pages: patterns for single fields, the standard parser for paragraphs."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TITLE, HEADING = r"(?is)<title(?:\s[^>]*)?>(.*?)</title>", r"(?is)<h1(?:\s[^>]*)?>(.*?)</h1>"
HREF = r"""(?i)\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
# fixed values: words by which lines about the crew, about the visit and about a person begin or go on
CREDITS = ("режисьор", "режисура", "сценография", "костюми", "музика", "превод", "хореография", "участват", "в ролите", "изпълняват", "осветление", "автор", "продуцент", "художник", "с участието", "сценарий")
VISIT = ("билет", "билети", "цена", "цени", "продължителност", "времетраене", "премиера", "антракт", "награда", "награди", "работно време", "каса", "резервации", "очаквайте", "вход", "дата", "час", "място", "партньори", "спонсори")
PERSON = ("роден", "родена", "завършва", "дипломира", "български драматург", "български режисьор", "френски драматург", "английски драматург")
_BLOCK = {"p", "div", "br", "li", "h1", "h2", "h3", "td", "article", "section", "ul", "ol", "table", "tr"}
_SKIP = {"script", "style", "nav", "footer", "head"}


def title(html: Column) -> Column:
    return F.regexp_extract(html, TITLE, 1)


def headings(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(HEADING), F.lit(1))


def links(html: Column) -> Column:
    """Values of href, in double, single or no quotes."""
    return F.transform(F.regexp_extract_all(html, F.lit(HREF), F.lit(1)), lambda x: F.regexp_replace(x, "^[\"']|[\"']$", ""))


class _Paragraphs(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.now: list[str] = []
        self.skip = 0

    def flush(self) -> None:
        t = " ".join("".join(self.now).split())
        if t:
            self.out.append(t)
        self.now = []

    def handle_starttag(self, tag, attrs):
        if tag in _SKIP:
            self.skip += 1
        if tag in _BLOCK:
            self.flush()

    def handle_endtag(self, tag):
        if tag in _SKIP and self.skip:
            self.skip -= 1
        if tag in _BLOCK:
            self.flush()

    def handle_data(self, data):
        if not self.skip:
            self.now.append(data)


def paragraphs_of(page: str | None) -> list[str]:
    p = _Paragraphs()
    p.feed(page or "")
    p.close()
    p.flush()
    return p.out


def is_prose(t: str, least: int = 60) -> bool:
    """Sentences rather than credits, menus or boilerplate."""
    words = t.split()
    return len(t) >= least and len(words) >= 8 and t.count(":") * 8 < len(words) and sum(c.isalpha() or c.isspace() for c in t) >= 0.8 * len(t)


@F.pandas_udf(T.ArrayType(T.StringType()))
def paragraphs(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for p in pages:
        yield p.map(paragraphs_of)


@F.pandas_udf(T.StringType())
def lead(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The first paragraph of prose."""
    for p in pages:
        yield p.map(lambda x: next((t for t in paragraphs_of(x) if is_prose(t)), None))


def paragraph_kind(c: Column) -> Column:
    """What a paragraph is: credit, visit (dates, tickets, awards), epigraph, person, prose or short."""
    t = F.trim(c)
    words = F.regexp_extract_all(t, F.lit(r"\p{L}+"), F.lit(0))
    label = "|".join(CREDITS)
    capitals = F.size(F.filter(words, lambda w: F.rlike(w, F.lit(r"^\p{Lu}"))))
    marks = F.size(F.regexp_extract_all(t, F.lit(r"\s\p{Pd}\s|:"), F.lit(0)))
    credit = (
        F.rlike(t, F.lit(rf"(?iu)^\P{{L}}*(?:{label})(?!\p{{L}})")) | ((F.length(t) < 90) & F.rlike(t, F.lit(r"(?u)^[^.!?…]{1,60}\s\p{Pd}\s+\p{Lu}[\p{L}.-]+(?:\s+\p{Lu}[\p{L}.-]*){0,5}\P{L}*$")))
        | ((F.length(t) < 60) & F.endswith(t, F.lit(":"))) | ((F.size(F.regexp_extract_all(t, F.lit(rf"(?iu)(?<!\p{{L}})(?:{label})(?!\p{{L}})"), F.lit(0))) >= 2) & (marks >= 2) & (F.length(t) < 300))
        | ((F.size(words) >= 4) & (capitals / F.size(words) > 0.6) & ~F.rlike(t, F.lit(r"[.!?…]\s")))
    )
    visit = F.rlike(t, F.lit(r"(?iu)^\P{L}*(?:" + "|".join(VISIT) + r")(?!\p{L})")) | F.rlike(t, F.lit(r"(?iu)^\D{0,2}\d{1,2}(?:[./]\d{1,2}|\s+(?:януари|февруари|март|април|май|юни|юли|август|септември|октомври|ноември|декември))"))
    epigraph = F.rlike(t, F.lit(r"(?s)^[„“«\"][^“”»\"]*[“”»\"]?[\s.…!?]*$")) | F.rlike(t, F.lit(r"(?u)^\p{Lu}[\p{L} .-]{1,30}:\s*[„\"“«]")) | F.rlike(t, F.lit(r"^(?:…|\.\.\.)"))
    person = F.rlike(t, F.lit(r"(?iu)(?<!\p{L})(?:" + "|".join(PERSON) + r")(?!\p{L})"))
    prose = (F.length(t) >= 60) & F.rlike(t, F.lit(r"[.!?…]\P{L}*$|[.!?…]\s"))
    return F.when(credit, "credit").when(visit, "visit").when(epigraph, "epigraph").when(person, "person").when(prose, "prose").otherwise("short")
