"""Text repair: one `clean_text` per profile."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from salesmill.functions import rules


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def _is_plain(edge: Column) -> Column:
    """The text starts with a visible ASCII character, which is what most values do."""
    return (edge >= F.lit("!")) & (edge < F.lit("\x7f"))


def strip(c: Column) -> Column:
    """Trim Unicode white space from both ends (`F.trim` alone removes only U+0020).

    Trimming a list of characters is slow, so only text that may still start or end with one gets it.
    """
    t = F.trim(c)
    return F.when(_is_plain(t) & _is_plain(F.substring(t, -1, 1)), t).otherwise(F.btrim(t, F.lit(rules.WHITESPACE)))


def strip_inline(c: Column) -> Column:
    """As `strip`, naming its input only once: for expressions that are large and seldom evaluated."""
    return F.btrim(c, F.lit(rules.WHITESPACE))


def drop_chars(c: Column, profile: str) -> Column:
    """Delete every character of the profile's mis-encoding class."""
    for ch in rules.STRIPPED_CHARS[profile]:
        c = F.replace(c, F.lit(ch), F.lit(""))
    return c


def replace_all(c: Column, profile: str) -> Column:
    """Apply the profile's literal replacements in their order."""
    for old, new in rules.REPLACEMENTS[profile]:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def collapse_spaces(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def repair_text(c: Column, profile: str) -> Column:
    """First half of `clean_text`. Every repaired sequence has a character beyond ASCII, so ASCII text is left alone."""
    repair = drop_chars if profile in rules.STRIPPED_CHARS else replace_all
    return F.when(is_ascii(c), c).otherwise(repair(c, profile))


def finish_text(c: Column, profile: str) -> Column:
    """Second half of `clean_text`: trim, and in some profiles collapse white space and upper-case."""
    text = strip(c)
    if profile in ("chunked", "microbatch"):
        text = collapse_spaces(text)
    return F.upper(text) if profile == "microbatch" else text


def clean_text(c: Column, profile: str) -> Column:
    """Repair a text column as `profile` does; NULL stays NULL and '' stays ''."""
    return finish_text(repair_text(c, profile), profile)
