"""Date and timestamp parsing per profile.

Parsing has two steps. `date_text` tidies the raw text; it is projected on its own, so that the tests of
the second step all read one finished column. `date_value` recognises the layout by an anchored pattern,
rewrites it to year-month-day and casts once. Spark's string-to-date cast is a hand-written scanner, so no
formatter runs (or throws) per format, and the pattern keeps the cast from accepting any other shape.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from salesmill.functions.numeric import INTEGER
from salesmill.functions.text import drop_chars, strip

ISO = r"^\d{4}-\d{1,2}-\d{1,2}$"
EIGHT_DIGITS = r"^[0-9]{8}$"

# Shape of each accepted date layout and its rewrite to year-month-day.
REWRITES = {
    "M/d/y": (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$1-$2"),
    "d-M-y": (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", "$3-$2-$1"),
    "M-d-y": (r"^(\d{1,2})-(\d{1,2})-(\d{4})$", "$3-$1-$2"),
    "d/M/y": (r"^(\d{1,2})/(\d{1,2})/(\d{4})$", "$3-$2-$1"),
    "y/M/d": (r"^(\d{4})/(\d{1,2})/(\d{1,2})$", "$1-$2-$3"),
    "yyyyMMdd": (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
}

# Layouts tried when no listed format fits (English months, ISO date with a time).
MONTH_NAME = r"^[0-9A-Za-z]+ [0-9A-Za-z]+,? \d{4}$"
MONTH_NAME_FORMATS = ["d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "MMMM d yyyy"]
ISO_MAYBE_TIME = r"^(\d{4}-\d{1,2}-\d{1,2})([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?)?$"
SLASHED_MAYBE_TIME = r"^(\d{4}/\d{1,2}/\d{1,2})([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,9})?)?)?$"


def _rewrite(c: Column, *layouts: str) -> Column:
    for layout in layouts:
        pattern, target = REWRITES[layout]
        c = F.regexp_replace(c, pattern, target)
    return c


def _iso(c: Column) -> Column:
    return F.when(c.rlike(ISO), c.try_cast("date"))


def _date_of(c: Column, *layouts: str) -> Column:
    """Y-M-D text, or the first of `layouts` that fits, to a date; only a fitting layout is rewritten, once.

    What a layout is rewritten to is Y-M-D, which fits no other.
    """
    value = F.when(c.rlike(ISO), c.try_cast("date"))
    for layout in layouts:
        value = value.when(c.rlike(REWRITES[layout][0]), _rewrite(c, layout).try_cast("date"))
    return value


def free_form_date(s: Column) -> Column:
    """Dates outside the fixed formats: year first with a time or slashes, and English month names."""
    iso = F.regexp_extract(s, ISO_MAYBE_TIME, 1)
    slashed = F.replace(F.regexp_extract(s, SLASHED_MAYBE_TIME, 1), F.lit("/"), F.lit("-"))
    name = F.initcap(F.lower(s))
    named = F.coalesce(*[F.try_to_timestamp(name, F.lit(f)) for f in MONTH_NAME_FORMATS]).cast("date")
    return (
        F.when(iso != "", iso.try_cast("date"))
        .when(slashed != "", slashed.try_cast("date"))
        .when(s.rlike(MONTH_NAME), named)
    )


def datamart_text(c: Column) -> Column:
    """White space around a date is ignored, except around eight digits."""
    return F.when(c.rlike(EIGHT_DIGITS), _rewrite(c, "yyyyMMdd")).otherwise(strip(c))


def datamart_date(s: Column) -> Column:
    """Y-M-D, M/D/Y, D-M-Y."""
    return _date_of(s, "M/d/y", "d-M-y")


def external_text(c: Column) -> Column:
    return strip(drop_chars(c, "external"))


def chunked_date(s: Column) -> Column:
    """A date at the start of the text, the rest ignored; both M/D/Y and dashes read month first.

    A value that starts like one of these but is no real date is NULL and is not tried any further.
    """
    iso = F.regexp_extract(s, r"^(\d{4}-\d{1,2}-\d{1,2})", 1)
    month_first = r"^(\d{1,2})([/-])(\d{1,2})\2(\d{4}).*$"
    digits = r"^(\d{4})(\d{2})(\d{2}).*$"
    return (
        F.when(iso != "", iso.try_cast("date"))
        .when(s.rlike(month_first), F.regexp_replace(s, month_first, "$4-$1-$3").try_cast("date"))
        .when(s.rlike(digits), F.regexp_replace(s, digits, "$1-$2-$3").try_cast("date"))
        .otherwise(free_form_date(s))
    )


def microbatch_date(s: Column) -> Column:
    """Seven fixed formats, day or month first as listed, and the free-form layouts."""
    iso = F.regexp_extract(s, ISO_MAYBE_TIME, 1)
    return F.when(iso != "", iso.try_cast("date")).otherwise(
        F.coalesce(
            _date_of(s, "M/d/y", "d-M-y", "yyyyMMdd", "y/M/d"),
            _date_of(s, "d/M/y", "M-d-y"),
            free_form_date(s),
        )
    )


def datetime_value(s: Column, separators: str) -> Column:
    """`Y-M-D h:m:s` with one of the given separators, as a zone-free timestamp."""
    shape = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}[{separators}]\d{{1,2}}:\d{{1,2}}:\d{{1,2}}$"
    return F.when(s.rlike(shape), s.try_cast("timestamp_ntz"))


DATE_TEXT = {
    "datamart": datamart_text,
    "external": external_text,
    "chunked": strip,
    "microbatch": strip,
    "lines": strip,
}

DATE_VALUE = {
    "datamart": datamart_date,
    "external": _iso,
    "chunked": chunked_date,
    "microbatch": microbatch_date,
    "lines": lambda s: s,
}

# What may stand between date and time where the time is kept.
TIME_SEPARATORS = {"datamart": " T", "external": " "}


def date_text(c: Column, profile: str) -> Column:
    return DATE_TEXT[profile](c)


def date_value(s: Column, profile: str) -> Column:
    return DATE_VALUE[profile](s)


def timestamp_value(s: Column, profile: str) -> Column:
    """Date and time, or midnight in the profiles that read only the date."""
    if profile in TIME_SEPARATORS:
        return datetime_value(s, TIME_SEPARATORS[profile])
    return date_value(s, profile).cast("timestamp_ntz")


def modified_date_value(s: Column, profile: str, as_of: Column) -> Column:
    """As `date_value`; `datamart` puts `as_of` where nothing could be read."""
    value = date_value(s, profile)
    return F.coalesce(value, as_of) if profile == "datamart" else value


def parse_date(c: Column, profile: str) -> Column:
    return date_value(date_text(c, profile), profile)


def parse_timestamp(c: Column, profile: str) -> Column:
    return timestamp_value(date_text(c, profile), profile)


def anio_mes(d: Column) -> Column:
    """Year and month as one YYYYMM integer; NULL for a NULL date."""
    return (F.year(d) * 100 + F.month(d)).cast("int")


def anio_mes_text(c: Column) -> Column:
    """YYYYMM from fixed character positions of unparsed text; month 01 for texts shorter than 7."""
    month = F.when(F.length(c) >= 7, F.substring(c, 6, 2)).otherwise(F.lit("01"))
    digits = F.concat(F.substring(c, 1, 4), month)
    return F.when((F.length(c) >= 4) & digits.rlike(INTEGER), digits.try_cast("int"))


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def window_start(as_of: Column, days: int = 60) -> Column:
    return F.date_sub(as_of, days)
