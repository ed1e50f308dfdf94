"""Rules about one listed row: which score shows, what a row's attributes are, where an event takes place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import text

# fixed values: thresholds of the score display
IMDB_LEAST, TMDB_LEAST, STALE_BELOW, STALE_TMDB, STALE_GAP = 100, 10, 1000, 20, 2.0
# fixed values: formats and language versions of a screening
FORMATS = ("3d", "imax", "4dx", "screenx", "d-box")
DUBBED, SUBTITLED, NATIVE = ("dubbed", "bg-dub", "bg-dubbed"), ("first-subbed-lang-bg", "subbed"), "bulgarian"
# fixed values: towns whose name in a headline places an event outside
TOWNS = (
    "варн", "пловдив", "бургас", "стара загора", "старозагор", "русе", "русенск", "велико търново", "търновск", "благоевград", "плевен", "шумен", "габрово", "хасково", "сливен", "ямбол", "казанлък",
    "добрич", "кърджали", "смолян", "пазарджик", "перник", "кюстендил", "видин", "враца", "монтана", "ловеч", "търговище", "разград", "силистра", "созопол", "несебър", "балчик", "банско", "родоп", "севтополис",
)


def score_shown(score: Column, votes: Column, other: Column, other_votes: Column) -> Column:
    """A rating that may be shown: not from few votes, nor from some votes if another source with enough of them is far off; unknown votes may."""
    stale = (votes < STALE_BELOW) & (other_votes >= STALE_TMDB) & (F.abs(score - other) >= STALE_GAP - 1e-9)
    return F.when(votes.isNull(), score).when(votes < IMDB_LEAST, None).when(F.coalesce(stale, F.lit(False)), None).otherwise(score)


def second_score(score: Column, votes: Column) -> Column:
    return F.when(votes >= TMDB_LEAST, score)


def why_no_score(matched: Column, via: Column, imdb_id: Column, imdb_score: Column, imdb_votes: Column, votes: Column, miss: Column) -> Column:
    """Why a film shows no score, the first reason."""
    low = F.when(imdb_votes < IMDB_LEAST, "few IMDb votes").when(imdb_score.isNotNull(), "stale IMDb rating")
    few = F.when(votes > 0, "few TMDB votes")
    unmatched = F.when(via.isNotNull(), F.concat(F.lit("no TMDB match; "), F.coalesce(low, F.lit("no rating yet")))).when(imdb_id.isNotNull(), "no TMDB match, no rating for the venue's id").otherwise(F.coalesce(miss, F.lit("no match")))
    with_id = F.when(low.isNotNull() | few.isNotNull(), F.concat(F.lit("matched, below the floor: "), F.concat_ws(", ", low, few))).when(imdb_votes.isNotNull(), "matched, no rating published").otherwise("matched, no votes yet")
    without = F.when(few.isNull(), "matched without IMDb id, no votes yet").otherwise(F.concat(F.lit("matched without IMDb id, below the floor: "), few))
    return F.when(~matched, unmatched).when(imdb_id.isNotNull(), with_id).otherwise(without)


def scope(categories: Column, kinds: dict[str, str], sections: dict[str, str]) -> Column:
    """cinema or stage by an event's categories; of both the one section named, else both; null for none."""
    found = F.array_distinct(F.filter(F.transform(categories, lambda c: F.element_at(F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv]), c)), lambda x: x.isNotNull()))
    named = F.array_distinct(F.filter(F.transform(categories, lambda c: F.element_at(F.create_map(*[F.lit(x) for kv in sections.items() for x in kv]), c)), lambda x: x.isNotNull()))
    return F.when(F.size(found) == 1, F.get(found, F.lit(0))).when(F.size(found) >= 2, F.when(F.size(named) == 1, F.get(named, F.lit(0))).otherwise("both"))


def in_city(categories: Column, headline: Column, body: Column, venues: Column, own: tuple[str, ...], others: tuple[str, ...], city: str = "софия|sofia|софийск\\p{L}*") -> Column:
    """Whether an event is in the city: by category, then a headline that names another town only, then the text, then a known venue."""
    word = F.lit(rf"(?iu)(?<!\p{{L}})(?:{city})(?!\p{{L}})")
    town = F.lit(r"(?iu)(?<!\p{L})(?:" + "|".join(TOWNS) + r")\p{L}*")

    def has(names: tuple[str, ...]) -> Column:
        return F.arrays_overlap(categories, F.array(*map(F.lit, names)))

    return (
        F.when(has(own), "category").when(has(others), "no: other category").when(F.rlike(headline, town) & ~F.rlike(headline, word), "no: headline")
        .when(F.rlike(F.concat_ws(" ", headline, body), word), "text").when(F.size(venues) > 0, "venue").otherwise("no")
    )


def screening_attributes(attributes: Column) -> Column:
    """dub or sub, then formats, comma-joined; null if nothing is notable.  A film in the country's language is no version."""
    def any_of(names: tuple[str, ...]) -> Column:
        return F.arrays_overlap(attributes, F.array(*map(F.lit, names)))

    version = F.when(F.array_contains(attributes, NATIVE), None).when(any_of(DUBBED), "dub").when(any_of(SUBTITLED), "sub")
    formats = F.filter(attributes, lambda a: a.isin(*FORMATS))
    return F.nullif(F.array_join(F.filter(F.concat(F.array(version), formats), lambda x: x.isNotNull()), ","), F.lit(""))


def row_of(rows: DataFrame) -> DataFrame:
    """title, date, time, hall, price, url with empty ones null, and whether the title announces a premiere or preview; rows: the same raw."""
    def filled(c: str) -> Column:
        return F.nullif(text.one_space(F.coalesce(F.col(c), F.lit(""))), F.lit("")).alias(c)

    t = text.one_space(F.col("title"))
    return rows.select(
        t.alias("title"), "date", "time", *[filled(c) for c in ("hall", "price", "url")],
        F.rlike(t, F.lit("(?iu)(?<!пред)премиер")).alias("premiere"), F.rlike(t, F.lit("(?iu)предпремиер")).alias("preview"))


def needs_details(runtime: Column, director: Column, synopsis: Column, country: Column) -> Column:
    """Whether a record lacks a fact that a film page would give."""
    return runtime.isNull() | (F.coalesce(director, F.lit("")) == "") | (F.coalesce(synopsis, F.lit("")) == "") | (F.coalesce(country, F.lit("")) == "")


def stale_record(record_title: Column, title: Column, record_year: Column, year: Column, bled: Column) -> Column:
    """Whether a stored record is another film's or was read wrongly: title or year differ, or a label bled into a value."""
    return (F.coalesce(text.key(record_title), F.lit("")) != F.coalesce(text.key(title), F.lit(""))) | F.coalesce(F.abs(record_year - year) > 1, F.lit(False)) | F.rlike(F.coalesce(bled, F.lit("")), F.lit(r"(?iu)(?:режисьор|в ролите|сценарий|оператор|музика)\s*:"))


def clean_credit(c: Column) -> Column:
    """A credit's value without a label's remains, brackets and marks; null where nothing is left or it is no name."""
    t = text.one_space(F.regexp_replace(F.regexp_replace(c, r"(?iu)^\s*(?:режисьор|режисура|сценарий|в ролите|с участието на)\s*:?\s*", ""), r"\([^)]*\)", " "))
    t = F.regexp_replace(F.btrim(t, F.lit(" .,;:|-–—")), r"(?iu)\s+и\s+др$", "")
    return F.when((t != "") & F.rlike(t, F.lit(r"\p{L}{2,}")) & (F.length(t) <= 200), t)


def genres(c: Column, vocabulary: dict[str, str]) -> Column:
    """The known genres that a text names, in the vocabulary's words, each once in the order of the text."""
    words = F.transform(F.split(F.lower(c), r"[,/;|]"), lambda w: F.element_at(F.create_map(*[F.lit(x) for kv in vocabulary.items() for x in kv]), F.trim(w)))
    return F.array_distinct(F.filter(words, lambda w: w.isNotNull()))


def venue_of(name: Column, known: dict[str, str], outside: tuple[str, ...]) -> tuple[Column, Column]:
    """(app, outside or unknown; venue id): a folded name that is listed; nothing is guessed."""
    k = text.fold_venue(name)
    vid = F.element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), k)
    town = F.lit(r"(?iu)(?<!\p{L})(?:" + "|".join(TOWNS) + r")(?!\p{L})")
    return F.when(vid.isNotNull(), "app").when(k.isin(*outside) | F.rlike(k, town), "outside").otherwise("unknown"), vid


def own_slug(url: Column, venue: Column, param: str, site: str) -> Column:
    """A film page's link with the venue's own parameter, on that site only."""
    base = F.regexp_replace(F.regexp_replace(url, rf"([?&]){param}=[^&#]*&?", "$1"), r"[?&](?=#|$)", "")
    sep = F.when(F.contains(base, F.lit("?")), "&").otherwise("?")
    hash_, plain = F.regexp_extract(base, "(#.*)$", 1), F.regexp_replace(base, "#.*$", "")
    return F.when(F.contains(url, F.lit(site)), F.concat(plain, sep, F.lit(param + "="), venue, hash_)).otherwise(url)


_KEYWORD = r"(?iu)фестивал|\bфест\b|\bfest\b|festival|киномания|синелибри|cinelibri|нощ на театрите"


def event_name(headline: Column) -> Column:
    """The event's name in a headline's own words: the part that names a festival, without edition, lead and tail verbs."""
    head = text.one_space(headline)
    parts = F.filter(F.split(head, r"\s+\|\s+"), lambda p: p != "")
    part = F.coalesce(F.get(F.filter(parts, lambda p: F.rlike(p, F.lit(_KEYWORD))), F.lit(0)), F.get(parts, F.lit(0)), head)
    before, after = F.regexp_extract(part, "^([^:]*):", 1), F.trim(F.regexp_extract(part, "^[^:]*:(.*)$", 1))
    colon = F.contains(part, F.lit(":"))
    name = F.when(colon & F.rlike(before, F.lit(_KEYWORD)), before).when(colon & F.rlike(after, F.lit(r"(?iu)издание\s+на\s+")), after).otherwise(part)
    for p in (
        r"(?iu)^(?:започва|идва|стартира|предстои|открива\s+се|завръща\s+се)\s+", r"(?iu)^(?:.*?\s)?\d+\s*[-.]?\s*(?:\p{L}{1,4})?\s+издание\s+на\s+", r"(?iu)^(?:.*?\s)?(?:новото|поредното|юбилейното)\s+издание\s+на\s+",
        r"(?iu)^\d+\s*(?:[-.]?\s*(?:о|то|ия|ият|ата|тата|ти|ри|ви)|\.)\s+", r"(?iu)\s+(?:идва|започва|стартира|предстои|се\s+завръща|ще\s+се\s+проведе|представя|открива|превзема)\b.*$",
    ):
        name = F.regexp_replace(name, p, "")
    name = F.regexp_replace(name, r"(?iu)^(.*?(?:фестивал|\bфест\b|\bfest\b|festival)[^|:]*?\b20\d\d)\b.+$", "$1")
    name = F.regexp_replace(name, r"^[\s:.,\p{Pd}]+|[\s:.,\p{Pd}]+$", "")
    name = F.when(F.length(name) < 3, F.get(parts, F.lit(0))).otherwise(name)
    return F.concat(F.upper(F.substring(name, 1, 1)), F.substring(name, 2, 10_000))


def sentence_of(c: Column, phrase: Column) -> Column:
    """The sentence of a text that holds a phrase, its first occurrence."""
    i = F.instr(c, phrase)
    before = F.regexp_extract(F.substring(c, F.lit(1), i - 1), r"(?s)([^.!?;]*)$", 1)
    after = F.regexp_extract(F.substring(c, i + F.length(phrase), F.length(c)), r"(?s)^([^.!?;]*)", 1)
    return F.when(i > 0, F.concat(before, phrase, after)).otherwise("")


def without_native_title(rows: DataFrame) -> DataFrame:
    """Rows (kind, id, title) shown without a Cyrillic letter once festival names are off."""
    bare = text.strip_festival(F.col("title"))
    return rows.filter((F.col("title") != "") & ~text.has_cyrillic(F.when(bare != "", bare).otherwise(F.col("title"))))


def blurb(kind: Column, first: Column, last: Column, words: Column, names: Column) -> Column:
    """One factual line: kind, dates, places."""
    what = F.when(kind == "festival", "Фестивал").when(first != last, "Поредица").otherwise("Еднократно събитие")
    places = F.when(F.size(names) > 0, F.concat(F.lit(" Сред местата: "), F.array_join(names, ", "), F.lit("."))).otherwise("")
    return F.concat(what, F.lit(", "), words, F.lit("."), places)


def price_text(c: Column) -> Column:
    """A price as 18,00 € or 18,00–22,00 €, from the euro amounts a text prints; a short text without any as printed; else null."""
    amount, unit = r"(\d{1,4}(?:[.,]\d{1,2})?)", r"(?iu)\s*(?:€|евро|eur)"
    ranges = F.regexp_extract_all(c, F.lit(r"(?iu)" + amount + r"\s*(?:€\s*)?(?:до|\p{Pd})\s*\d{1,4}(?:[.,]\d{1,2})?\s*(?:€|евро|eur)"), F.lit(1))
    values = F.transform(F.concat(ranges, F.regexp_extract_all(c, F.lit(amount + unit), F.lit(1))), lambda x: F.replace(x, F.lit(","), F.lit(".")).cast("double"))
    values = F.filter(values, lambda v: v > 0)
    low, high = F.array_min(values), F.array_max(values)

    def fmt(v: Column) -> Column:
        return F.replace(F.format_string("%.2f", v), F.lit("."), F.lit(","))

    start = F.rlike(c, F.lit(r"(?iu)^\s*от\b")) & ~F.rlike(c, F.lit(r"(?iu)\bдо\b"))
    plain = text.one_space(c)
    return (
        F.when(low != high, F.concat(fmt(low), F.lit("–"), fmt(high), F.lit(" €"))).when(low.isNotNull(), F.concat(F.when(start, "от ").otherwise(""), fmt(low), F.lit(" €")))
        .when(F.length(plain).between(1, 24) & ~F.contains(plain, F.lit("лв")), plain)
    )


# fixed values: prepositions of place, and words that no venue's name needs
PLACE_WORDS = ("в", "във", "на", "към", "до", "пред", "от")
NAME_STOPS = ("на", "и", "в", "във", "с", "за", "от", "the", "of", "a")


def named_places(c: Column, forms: dict[str, list[str]]) -> Column:
    """Ids of venues that a text names in a place phrase, in its order: all words of a form stand in a short stretch, one or two words behind a preposition of place.

    forms: id to folded names.
    """
    words = F.split(text.fold_marks(c, "event"), " ")

    def place(own: list[str]) -> Column:
        stretch = 1 if len(own) == 1 else len(own) + 2

        def fits(i: Column) -> Column:
            whole = F.forall(F.array(*map(F.lit, own)), lambda w: F.array_contains(F.slice(words, i, F.lit(stretch)), w))
            before = F.slice(words, F.greatest(F.lit(1), i - 2), F.least(F.lit(2), i - 1))
            return F.get(words, i - 1).isin(*own) & whole & F.arrays_overlap(before, F.array(*map(F.lit, PLACE_WORDS)))

        return F.array_min(F.filter(F.sequence(F.lit(1), F.size(words)), fits))

    found = []
    for vid, names in forms.items():
        for name in names:
            at = place([w for w in name.split() if w not in NAME_STOPS])
            found.append(F.when(at.isNotNull(), F.struct(at.alias("at"), F.lit(vid).alias("id"))))
    hits = F.array_sort(F.filter(F.array(*found), lambda x: x.isNotNull()))
    return F.array_distinct(F.transform(hits, lambda x: x["id"]))
