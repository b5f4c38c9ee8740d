"""Tolerant number casts, null flags and order-independent sums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

INTEGER = r"^\s*[+-]?\d+\s*$"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Wide enough for any price with ten decimals and 28 integer digits.
EXACT_TYPE = "decimal(38,10)"


def to_long(c: Column) -> Column:
    """Integer text to bigint; fractions and anything else are NULL.

    The pattern is for speed only: a failing cast raises and catches an exception for each value.
    """
    return F.when(c.rlike(INTEGER), c.try_cast("bigint"))


def to_double(c: Column) -> Column:
    """Decimal or scientific notation to double; the pattern keeps out `1d`, `NaN` and `Infinity`."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def null_flag(c: Column) -> Column:
    return c.isNull().cast("int")


def _inexact(c: Column) -> Column:
    """True where a double is not carried exactly by EXACT_TYPE."""
    return c.isNotNull() & ~F.coalesce(c.try_cast(EXACT_TYPE).cast("double") == c, F.lit(False))


def sum_parts(c: Column) -> dict[str, Column]:
    """Mergeable partial state of a sum: exact part, float part, values the exact part cannot hold, count.

    The exact part is NULL where even the sum of exact values no longer fits.
    """
    return {
        "s_exact": F.try_sum(c.try_cast(EXACT_TYPE)),
        "s_float": F.sum(c),
        "n_inexact": F.count_if(_inexact(c)),
        "n": F.count(c),
    }


def merge_parts() -> dict[str, Column]:
    """Aggregates that merge rows made by `sum_parts`; a part that overflowed makes its merged sum a float one."""
    overflowed = F.col("s_exact").isNull() & (F.col("n") > F.col("n_inexact"))
    return {
        "s_exact": F.try_sum("s_exact"),
        "s_float": F.sum("s_float"),
        "n_inexact": F.coalesce(F.sum(F.col("n_inexact") + overflowed.cast("long")), F.lit(0)),
        "n": F.coalesce(F.sum("n"), F.lit(0)),
    }


def _total(exact: Column, floating: Column, n_inexact: Column) -> Column:
    return F.when((n_inexact == 0) & exact.isNotNull(), exact.cast("double")).otherwise(floating)


def parts_mean(s_exact="s_exact", s_float="s_float", n_inexact="n_inexact", n="n") -> Column:
    """Mean from `sum_parts` columns; NULL for an empty group."""
    total = _total(F.col(s_exact), F.col(s_float), F.col(n_inexact))
    return F.when(F.col(n) > 0, total / F.col(n))


def parts_sum(s_exact="s_exact", s_float="s_float", n_inexact="n_inexact") -> Column:
    """Sum from `sum_parts` columns; NULL for an empty group."""
    return _total(F.col(s_exact), F.col(s_float), F.col(n_inexact))


def exact_sum(c: Column) -> Column:
    """Sum of doubles that does not depend on row order or task retries while decimals can carry it.

    Adds decimals wherever every value of the group is one and the sum fits, and falls back to the float sum,
    which depends on the order in its last digits, elsewhere.
    """
    p = sum_parts(c)
    return _total(p["s_exact"], p["s_float"], p["n_inexact"])


def exact_avg(c: Column) -> Column:
    """Mean on top of `exact_sum`; NULL where there is no value."""
    return F.when(F.count(c) > 0, exact_sum(c) / F.count(c))


def round_money(c: Column, strict: bool = False) -> Column:
    """Two decimals, half up; `strict` rounds half to even as numpy does."""
    return F.bround(c, 2) if strict else F.round(c, 2)
