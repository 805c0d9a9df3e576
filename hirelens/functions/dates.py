"""Dates written in running text: tokens of a few kinds, read by a small state machine as one fold, in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAMES = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
MONTHS = {n: i for i, n in enumerate(_NAMES, 1)} | {n[:3]: i for i, n in enumerate(_NAMES, 1)} | {"sept": 9}
_WEEK = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
SOFT = ["of", "the", ",", ".", *_WEEK, *[d[:3] for d in _WEEK]]
RANGE = ["-", "–", "—", "&", "to", "until", "till", "and"]

_ISO = r"(?<![\dA-Za-z])\d{4}([-/.])\d{1,2}\1\d{1,2}(?!\d)"
_NUMERIC = r"(?<![\dA-Za-z])\d{1,2}([-/.])\d{1,2}\2\d{4}(?!\d)"
TOKEN = rf"(?i){_ISO}|{_NUMERIC}|\d+(?:st|nd|rd|th)?(?![a-z])|[a-z]+|[^\sa-z]"
YEARS = (1900, 2100)

_STATE = "struct<days:array<int>,month:int,loose:boolean,first:boolean,year:int,open:array<int>,range:boolean,best:timestamp>"


def _stamp(year: Column, month: Column, day: Column) -> Column:
    zero = F.lit(0)
    return F.try_make_timestamp(year, month, day, zero, zero, zero)


def _coded(token: Column) -> Column:
    """struct(kind, v, date): Day, Month, Year, Full date, Range mark, Soft mark, or X for what ends a date."""
    numbers = F.split(token, "[-/.]")
    part = lambda i: F.get(numbers, F.lit(i)).try_cast("int")
    full = (F.length(token) >= 8) & token.rlike(r"^\d+[-/.]\d+[-/.]\d+$")
    leading = F.length(F.get(numbers, F.lit(0))) == 4
    date = F.when(full & leading, _stamp(part(0), part(1), part(2))).when(full, F.coalesce(_stamp(part(2), part(1), part(0)), _stamp(part(2), part(0), part(1))))
    digits = F.regexp_extract(token, r"^(\d{1,2}|\d{4}$)(?:st|nd|rd|th)?$", 1)
    number = digits.try_cast("int")
    months = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    month = F.try_element_at(months, token)
    kind = (
        F.when(month.isNotNull(), "M")
        .when(token.isin(SOFT), "S")
        .when(token.isin(RANGE), "R")
        .when(full, "F")
        .when((F.length(digits) == 4) & number.between(*YEARS), "Y")
        .when(F.length(digits).between(1, 2) & number.between(1, 31), "D")
        .otherwise("X")
    )
    return F.struct(kind.alias("kind"), F.coalesce(month, number).alias("v"), date.alias("date"))


def _step(since: int):
    def step(s: Column, t: Column) -> Column:
        none, empty, no, yes = F.lit(None).cast("int"), F.array().cast("array<int>"), F.lit(False), F.lit(True)
        v = t["v"]
        # Days and open dates are sets: 31 and 372 at most, however long a text goes on.
        names = ["days", "month", "loose", "first", "year", "open", "range", "best"]

        def to(**new: Column) -> Column:
            return F.struct(*[(new[n] if n in new else s[n]).alias(n) for n in names]).cast(_STATE)

        def best(year: Column, opened: Column) -> Column:
            read = F.transform(opened, lambda o: F.when(year >= since, _stamp(year, F.floor(o / 100).cast("int"), o % 100)))
            return F.array_min(F.filter(F.concat(F.array(s["best"]), read), lambda d: d.isNotNull()))

        fresh = {"days": empty, "month": none, "loose": no, "first": no, "year": none, "open": empty, "range": no}
        # May 3 ..., May 3 to 5 ..., and of 2019 May 3 the date itself; else a day that waits for its month.
        of_month = s["loose"] | (s["first"] & s["range"] & s["month"].isNotNull())
        dated = F.array((s["month"] * 100 + v).cast("int"))
        in_year = to(days=empty, loose=no, range=no, best=best(s["year"], dated))
        day = F.when(of_month & s["year"].isNotNull(), in_year).when(of_month, to(days=empty, loose=no, range=no, open=F.array_union(s["open"], dated)))
        day = day.otherwise(to(days=F.when(s["range"], F.array_union(s["days"], F.array(v))).otherwise(F.array(v)), range=no))
        # A month without days before it is the first of the month unless days follow.
        opened = F.when(s["loose"], F.array_union(s["open"], F.array((s["month"] * 100 + 1).cast("int")))).otherwise(s["open"])
        has_days = F.size(s["days"]) > 0
        month = to(days=empty, month=v, loose=~has_days, first=~has_days, open=F.array_union(opened, F.transform(s["days"], lambda d: (v * 100 + d).cast("int"))), range=no)
        year = F.when(F.size(opened) > 0, to(**fresh, best=best(v, opened))).otherwise(to(**fresh | {"year": v}))
        whole = F.when(F.year(t["date"]) >= since, t["date"])
        full = to(**fresh, best=F.coalesce(F.least(s["best"], whole), s["best"], whole))
        kind = t["kind"]
        return (
            F.when(kind == "X", to(**fresh))
            .when(kind == "S", to(year=F.when(s["month"].isNotNull(), s["year"])))
            .when(kind == "R", to(range=yes))
            .when(kind == "D", day)
            .when(kind == "M", month)
            .when(kind == "Y", year)
            .otherwise(full)
        )

    return step


def earliest(c: Column, since: int) -> Column:
    """The earliest date of the year since or later that the text names, at midnight; null where there is none, or no text.

    Read are ISO dates, numeric dates (day first, unless only the other order is a date), and days, months and years in words: 1st of
    May, 2019; May 3, 2019; 12-14 May 2019; 12 May to 3 June 2019 (both in 2019); May 2019 (its first day); 2019 May 3. A date without a
    year, or one that the calendar does not have, is none. A text of any length is read once, from left to right.
    """
    coded = F.transform(F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0)), _coded)
    start = F.struct(F.array().alias("a"), F.lit(None).alias("b"), F.lit(False).alias("c"), F.lit(False).alias("d"), F.lit(None).alias("e"), F.array().alias("f"), F.lit(False).alias("g"), F.lit(None).alias("h")).cast(_STATE)
    return F.aggregate(coded, start, _step(since), lambda s: s["best"])
