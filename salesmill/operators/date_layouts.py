"""Dates in layouts nobody wrote down: the column itself says how its ambiguous values are meant.

`03/04/2021` may start with the day or the month; `13/04/2021` may not. One narrow aggregate counts, per column, separator
and place of the year, the values that allow one reading only. Values that allow both are read as most of those are, by
their own separator, else by any, else as the caller says. Values with one reading keep it. Everything is Spark built-ins:
counts are combined map-side and come back as one row, and a value is parsed by patterns and a lookup of month names.

Read: day, month and year as numbers with one separator (`/`, `-`, `.` or a space), the year first or last, four digits or
two (69 is 1969, 68 is 2068); eight digits; month names, English or Spanish, before or after the day; a time behind the
date, which is left out. Anything else, and dates that do not exist, are NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Month names in English and Spanish; three letters of each are read as well.
MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6,
    "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6,
    "julio": 7, "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12,
}
SEPARATORS = {"slash": "/", "dash": "-", "dot": ".", "space": " "}
LAST_OF_2000 = 68

TIME = r"(?:[ t]+\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?(?: ?[ap]\.?m\.?)?)?"
NUMBERS = rf"^(\d{{4}}|\d{{1,2}})([/\-. ])(\d{{1,2}})\2(\d{{4}}|\d{{1,2}}){TIME}$"
EIGHT = r"^(\d{4})(\d{2})(\d{2})$"
DAY_NAME = rf"^(\d{{1,2}})(?:st|nd|rd|th|º)?[\s\-/.,]*(?:de\s+)?([a-zé]{{3,10}})[\s\-/.,]*(?:del?\s+)?(\d{{4}}|\d{{2}}){TIME}$"
NAME_DAY = rf"^([a-zé]{{3,10}})[\s\-/.]*(\d{{1,2}})(?:st|nd|rd|th)?[\s\-/.,]+(\d{{4}}){TIME}$"
YEAR_NAME = rf"^(\d{{4}})[\s\-/.,]*([a-zé]{{3,10}})[\s\-/.]*(\d{{1,2}}){TIME}$"


def tidy(c: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))


def shape(c: Column) -> Column:
    """A value with digits as 9 and letters as a."""
    return F.regexp_replace(F.regexp_replace(c, r"\d", "9"), r"\p{L}", "a")


def shapes(df: DataFrame, column: str) -> DataFrame:
    """shape, n, an example: what a column's values look like, the commonest first."""
    found = df.where(F.col(column).isNotNull()).groupBy(shape(F.trim(column)).alias("shape"))
    return found.agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("example")).orderBy(F.col("n").desc(), "shape")


@dataclass(frozen=True)
class Layouts:
    """Whether the day stands before the month, by separator and place of the year."""

    day_first: dict[tuple[str, bool], bool]


PARTS = ["text", "first", "second", "third", "separator", "year_first", "a", "b"]


def _with_parts(df: DataFrame, columns: list[str]) -> tuple[DataFrame, dict[str, dict[str, str]]]:
    """`df` with columns that hold the parts of each value, and their names by column and part: a pattern runs once per value.

    text: the tidy value. first, second, third, separator: of an all-number date, as text, empty where it is none. a, b:
    the two numbers that are day and month, in their order. year_first: whether the year stands before them.
    """
    mark = "_part"
    while any(c.lower().startswith(mark) for c in df.columns):
        mark += "_"
    names = {c: {part: f"{mark}{n}{part}" for part in PARTS} for n, c in enumerate(columns)}
    df = df.withColumns({names[c]["text"]: tidy(F.col(c)) for c in columns})
    places = {"first": 1, "separator": 2, "second": 3, "third": 4}
    df = df.withColumns({n[part]: F.regexp_extract(n["text"], NUMBERS, i) for n in names.values() for part, i in places.items()})
    year_first = lambda first, third: (F.length(first) == 4) | ((F.length(third) < 4) & (F.col(first).try_cast("int") > 31))
    df = df.withColumns({n["year_first"]: year_first(n["first"], n["third"]) for n in names.values()})
    pairs = {}
    for n in names.values():
        pairs[n["a"]] = F.when(F.col(n["year_first"]), F.col(n["second"])).otherwise(F.col(n["first"])).try_cast("int")
        pairs[n["b"]] = F.when(F.col(n["year_first"]), F.col(n["third"])).otherwise(F.col(n["second"])).try_cast("int")
    return df.withColumns(pairs), names


def infer_layouts(df: DataFrame, columns: list[str], day_first: bool = False) -> dict[str, Layouts]:
    """The layouts of several columns, from one aggregate over them. `day_first` settles columns without evidence."""
    counts = []
    df, names = _with_parts(df.select(*dict.fromkeys(columns)), columns)
    for n, column in enumerate(columns):
        a, b, year_first, separator = [F.col(names[column][part]) for part in ("a", "b", "year_first", "separator")]
        days = (a > 12) & a.between(13, 31) & b.between(1, 12), (b > 12) & b.between(13, 31) & a.between(1, 12)
        for name, text in SEPARATORS.items():
            for before in (False, True):
                here = (separator == text) & (year_first == F.lit(before))
                counts += [F.count_if(here & d).alias(f"{n}_{name}_{before}_{i}") for i, d in enumerate(days)]
    found = df.agg(*counts).first()
    out = {}
    for n, column in enumerate(columns):
        seen = {(name, before): [found[f"{n}_{name}_{before}_{i}"] for i in (0, 1)] for name in SEPARATORS for before in (False, True)}
        decided = {}
        for (name, before), own in seen.items():
            any_separator = [sum(v[i] for (_, y), v in seen.items() if y == before) for i in (0, 1)]
            # With the year first the month follows it unless the values say otherwise.
            default = day_first and not before
            decided[name, before] = next((day > month for day, month in (own, any_separator) if day != month), default)
        out[column] = Layouts(decided)
    return out


def _date(year: Column, month: Column, day: Column) -> Column:
    short = year.try_cast("int")
    full = F.when(F.length(year) == 4, short).otherwise(F.when(short <= LAST_OF_2000, short + 2000).otherwise(short + 1900))
    padded = [F.lpad(c.cast("string"), n, "0") for c, n in ((full, 4), (month, 2), (day, 2))]
    return F.concat(padded[0], F.lit("-"), padded[1], F.lit("-"), padded[2]).try_cast("date")


def parse(parts: dict[str, str], layouts: Layouts) -> Column:
    """The date of a value whose parts are in columns of these names, read as `layouts` says."""
    s, first, third, separator, a, b, year_first = [F.col(parts[x]) for x in ("text", "first", "third", "separator", "a", "b", "year_first")]
    chosen = F.lit(False)
    for (name, before), day_first in layouts.day_first.items():
        if day_first:
            chosen = chosen | ((separator == SEPARATORS[name]) & (year_first == F.lit(before)))
    day_first = F.when(a > 12, F.lit(True)).when(b > 12, F.lit(False)).otherwise(chosen)
    year = F.when(year_first, first).otherwise(third)
    numbers = _date(year, F.when(day_first, b).otherwise(a), F.when(day_first, a).otherwise(b))
    names = F.create_map(*[F.lit(x) for name, n in (MONTHS | {m[:3]: n for m, n in MONTHS.items()} | {"sept": 9}).items() for x in (name, n)])
    named = lambda pattern, y, m, d: _date(
        F.regexp_extract(s, pattern, y), F.try_element_at(names, F.regexp_extract(s, pattern, m)), F.regexp_extract(s, pattern, d)
    )
    eight = [F.regexp_extract(s, EIGHT, i) for i in (1, 2, 3)]
    return (
        F.when(s.rlike(NUMBERS), numbers)
        .when(s.rlike(EIGHT), _date(*eight))
        .when(s.rlike(DAY_NAME), named(DAY_NAME, 3, 2, 1))
        .when(s.rlike(NAME_DAY), named(NAME_DAY, 3, 1, 2))
        .when(s.rlike(YEAR_NAME), named(YEAR_NAME, 1, 2, 3))
    )


def parse_columns(df: DataFrame, columns: list[str], day_first: bool = False) -> DataFrame:
    """`df` with `columns` as dates, each read by its own evidence: one aggregate, then one projection."""
    layouts = infer_layouts(df, columns, day_first)
    found, names = _with_parts(df, columns)
    return found.withColumns({c: parse(names[c], layouts[c]) for c in columns}).drop(*[name for parts in names.values() for name in parts.values()])
