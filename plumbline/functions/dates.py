"""Dates and times as programmes print them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: month and weekday words
MONTHS = "януари февруари март април май юни юли август септември октомври ноември декември".split()
MONTHS_EN = "january february march april may june july august september october november december".split()
WEEKDAYS = "понеделник вторник сряда четвъртък петък събота неделя".split()
WEEKDAYS_EN = "monday tuesday wednesday thursday friday saturday sunday".split()


def _date(y: Column, m: Column, d: Column) -> Column:
    """A date, null where there is no such day."""
    return F.try_to_date(F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")), "yyyy-MM-dd")


def month_number(c: Column) -> Column:
    """The month that a word names, in either language."""
    out = F.lit(None).cast("int")
    for words in (MONTHS, MONTHS_EN):
        for i, w in enumerate(words, 1):
            out = F.when(F.lower(c) == w, i).otherwise(out)
    return out


def nearest_date(day: Column, month: Column, today: Column, back: int = 45) -> Column:
    """The first such day on or after today less back days."""
    options = F.array(*[_date(F.year(today) + k, month, day) for k in (-1, 0, 1)])
    return F.array_min(F.filter(options, lambda x: x.isNotNull() & (x >= F.date_sub(today, back))))


def nearest_year(day: Column, month: Column, today: Column, back: int = 62) -> Column:
    """Such a day closest to today, of two equally close the earlier one, never more than back days ago."""
    options = F.array(*[_date(F.year(today) + k, month, day) for k in (-1, 0, 1)])
    fit = F.filter(options, lambda x: x.isNotNull() & (F.datediff(x, today) >= -back))
    return F.array_min(F.transform(fit, lambda x: F.struct(F.abs(F.datediff(x, today)).alias("gap"), x.alias("date"))))["date"]


def find_date(c: Column, today: Column) -> Column:
    """The first of an ISO date, a numeric d.m.y one and a day with a month word; a missing year is the nearest."""
    iso = F.try_to_date(F.regexp_extract(c, r"\b(\d{4}-\d{2}-\d{2})\b", 1), "yyyy-MM-dd")
    number = r"\b(\d{1,2})[./](\d{1,2})(?:[./](\d{4}))?\b"
    d, m, y = (F.regexp_extract(c, number, i).try_cast("int") for i in (1, 2, 3))
    numeric = F.when(y.isNotNull(), _date(y, m, d)).otherwise(nearest_date(d, m, today))
    word = r"(?iu)\b(\d{1,2})\.?\s+(\p{L}{3,})(?:\s+(\d{4}))?"
    wd, wm, wy = F.regexp_extract(c, word, 1).try_cast("int"), month_number(F.regexp_extract(c, word, 2)), F.regexp_extract(c, word, 3).try_cast("int")
    words = F.when(wy.isNotNull(), _date(wy, wm, wd)).otherwise(nearest_date(wd, wm, today))
    return F.coalesce(iso, numeric, words)


def times_in(c: Column) -> Column:
    """Clock times in a text as HH:MM, sorted, without repeats."""
    found = F.regexp_extract_all(c, F.lit(r"(?<![0-9:.])((?:[01]?[0-9]|2[0-3])[:.][0-5][0-9])(?![0-9:.])"), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.lpad(F.replace(x, F.lit("."), F.lit(":")), 5, "0"))))


def minutes(c: Column) -> Column:
    return F.split(c, ":")[0].cast("int") * 60 + F.split(c, ":")[1].cast("int")


def weekday_conflict(date: Column, c: Column) -> Column:
    """Whether a text names a weekday that isn't the date's."""
    out = F.lit(False)
    for words in (WEEKDAYS, WEEKDAYS_EN):
        named = F.regexp_extract(F.lower(c), "(" + "|".join(words) + ")", 1)
        out = out | ((named != "") & (F.array_position(F.array(*map(F.lit, words)), named) != F.weekday(date) + 1))
    return out


def local_date(ts: Column, zone: str = "Europe/Sofia") -> Column:
    """The local day of a UTC moment."""
    return F.to_date(F.from_utc_timestamp(ts.cast("timestamp"), zone))


def last_sunday(year: Column, month: int) -> Column:
    """The last Sunday of a month, on which clocks change."""
    return F.next_day(F.date_sub(F.last_day(F.make_date(year, F.lit(month), F.lit(1))), 7), "SU")


def summer(ts: Column) -> Column:
    """Whether a UTC moment falls in European summer time, by the rule: from 01:00 UTC on the last Sunday of March to that of October."""
    start = F.to_timestamp(F.concat(last_sunday(F.year(ts), 3).cast("string"), F.lit(" 01:00:00")))
    end = F.to_timestamp(F.concat(last_sunday(F.year(ts), 10).cast("string"), F.lit(" 01:00:00")))
    return (ts >= start) & (ts < end)


def offset_stamp(ts: Column, winter: int = 2) -> Column:
    """A UTC moment as local time with its offset, as 2026-10-09T06:15:00+03:00."""
    hours = winter + summer(ts).cast("int")
    local = F.timestamp_seconds(F.unix_timestamp(ts) + hours * 3600)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+"), F.lpad(hours.cast("string"), 2, "0"), F.lit(":00"))


def months_from(today: Column, n: int = 6) -> Column:
    """The first days of n months from today's on."""
    first = F.trunc(today, "month")
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.add_months(first, k))


_DAY, _MONTH = r"(?<!\d)(\d{1,2})", "(" + "|".join(MONTHS) + ")"
_TO, _END = r"\s*(?:\p{Pd}|до)\s*", r"(?!\p{L})"


def _anchored(day: Column, month: Column, published: Column) -> Column:
    """A day of the publication's year or the next, not more than 60 days before it."""
    options = F.array(*[_date(F.year(published) + k, month, day) for k in (0, 1)])
    return F.array_min(F.filter(options, lambda x: x.isNotNull() & (x >= F.date_sub(published, 60))))


def headline_dates(title: Column, published: Column) -> tuple[Column, Column]:
    """(first, last) of the one date or range that a headline holds; null for none, for several and for one with a year."""
    t = F.lower(title)
    cross, span, one = "(?u)" + _DAY + r"\s+" + _MONTH + _TO + r"(\d{1,2})\s+" + _MONTH + _END, "(?u)" + _DAY + _TO + r"(\d{1,2})\s+" + _MONTH + _END, "(?u)" + _DAY + r"\s+" + _MONTH + _END
    is_cross, is_span = F.rlike(t, F.lit(cross)), F.rlike(t, F.lit(span))

    def n(p: str, i: int) -> Column:
        return F.regexp_extract(t, p, i).try_cast("int")

    def month(p: str, i: int) -> Column:
        return month_number(F.regexp_extract(t, p, i))

    first = F.when(is_cross, _anchored(n(cross, 1), month(cross, 2), published)).when(is_span, _anchored(n(span, 1), month(span, 3), published)).otherwise(_anchored(n(one, 1), month(one, 2), published))
    last = F.when(is_cross, _anchored(n(cross, 3), month(cross, 4), published)).when(is_span, _date(F.year(first), month(span, 3), n(span, 2))).otherwise(first)
    rest = F.when(is_cross, F.regexp_replace(t, cross, " ")).when(is_span, F.regexp_replace(t, span, " ")).otherwise(F.regexp_replace(t, one, " "))
    several = F.rlike(rest, F.lit(one)) | (~is_cross & ~is_span & (F.size(F.regexp_extract_all(t, F.lit(one), F.lit(1))) != 1))
    dated = F.rlike(t, F.lit(r"(?u)\b\d{1,2}\s+" + _MONTH + r"\s+\d{4}"))
    last = F.when(last < first, F.add_months(last, 12)).otherwise(last)
    fine = ~several & ~dated & first.isNotNull() & last.isNotNull()
    return F.when(fine, first), F.when(fine, last)


def field_dates(c: Column) -> tuple[Column, Column]:
    """(first, last) of a field with one or two full dates."""
    p = r"(?u)(\d{1,2})\s+" + _MONTH + r"\s+(\d{4})"
    found = F.transform(F.regexp_extract_all(F.lower(c), F.lit(p), F.lit(0)), lambda x: _date(F.regexp_extract(x, p, 3).try_cast("int"), month_number(F.regexp_extract(x, p, 2)), F.regexp_extract(x, p, 1).try_cast("int")))
    found = F.filter(found, lambda x: x.isNotNull())
    a, b = F.get(found, F.lit(0)), F.get(found, F.size(found) - 1)
    fine = F.size(found).between(1, 2) & (a <= b)
    return F.when(fine, a), F.when(fine, b)


def date_words(first: Column, last: Column, words: list[str] = MONTHS) -> Column:
    """17–24 октомври 2026, and shorter or longer where the days, months or years are one or differ."""
    def name(d: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, words)), F.month(d))

    def day(d: Column) -> Column:
        return F.dayofmonth(d).cast("string")

    def year(d: Column) -> Column:
        return F.year(d).cast("string")

    whole = F.concat_ws(" ", day(last), name(last), year(last))
    same_month = F.trunc(first, "month") == F.trunc(last, "month")
    return (
        F.when(first.isNull() | last.isNull(), None).when(first == last, whole).when(same_month, F.concat(day(first), F.lit("–"), whole))
        .when(F.year(first) == F.year(last), F.concat(F.concat_ws(" ", day(first), name(first)), F.lit(" – "), whole)).otherwise(F.concat(F.concat_ws(" ", day(first), name(first), year(first)), F.lit(" – "), whole))
    )


def countdown(first: Column, today: Column) -> Column:
    n = F.greatest(F.lit(0), F.datediff(first, today))
    return F.when(n == 1, "СЛЕД 1 ДЕН").otherwise(F.concat(F.lit("СЛЕД "), n.cast("string"), F.lit(" ДНИ")))
