"""Category normalization from ordered rule tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from salesmill.functions import rules
from salesmill.functions.text import repair_text, strip, strip_inline


def exact_label(key: Column, table: list[tuple[str, list[str]]]) -> Column:
    """Label whose variants include `key`, else NULL: one probe of a constant map."""
    pairs = [F.lit(x) for label, variants in table for v in variants for x in (v, label)]
    return F.try_element_at(F.create_map(*pairs), key)


def contains_label(key: Column, table: list[tuple[str, list[str]]]) -> Column:
    """Label of the first rule with a variant that occurs in `key`, else NULL."""
    rules_ = [(reduce(or_, [key.contains(v) for v in variants]), F.lit(label)) for label, variants in table]
    chain = F.when(*rules_[0])
    for condition, label in rules_[1:]:
        chain = chain.when(condition, label)
    return chain


def datamart_category(c: Column, column: str) -> Column:
    fallback = strip_inline(repair_text(c, "datamart"))
    if column == "currency":
        fallback = F.upper(fallback)
    label = exact_label(F.lower(c), rules.DATAMART_CATEGORIES[column])
    return F.coalesce(label, fallback, F.lit(rules.DATAMART_DEFAULTS[column]))


def external_category(c: Column, column: str) -> Column:
    if column == "currency":
        return F.coalesce(c, F.lit(rules.DEFAULT_CURRENCY))
    label = contains_label(F.lower(c), rules.EXTERNAL_CATEGORIES[column])
    named = F.coalesce(label, F.upper(strip_inline(repair_text(c, "external"))))
    return F.coalesce(named, F.lit(rules.DEFAULT_REGION)) if column == "region" else named


def microbatch_key(c: Column) -> Column:
    return strip(F.upper(c))


def microbatch_label(key: Column, column: str) -> Column:
    """Label for a `microbatch_key`; the key itself where no rule matches."""
    label = contains_label(key, rules.MICROBATCH_CATEGORIES[column])
    return F.coalesce(label, key, F.lit(rules.MISSING_CATEGORY))


def microbatch_category(c: Column, column: str) -> Column:
    if column == "currency":
        return F.coalesce(c, F.lit(rules.DEFAULT_CURRENCY))
    if column == "region":
        return F.coalesce(c, F.lit(rules.DEFAULT_REGION))
    return microbatch_label(microbatch_key(c), column)


CATEGORIZERS = {
    "datamart": datamart_category,
    "external": external_category,
    "microbatch": microbatch_category,
}

# Columns each profile normalizes, the default-only cells included.
CATEGORY_COLUMNS = {
    "datamart": list(rules.DATAMART_CATEGORIES),
    "external": list(rules.EXTERNAL_CATEGORIES) + ["currency"],
    "microbatch": list(rules.MICROBATCH_CATEGORIES) + ["currency", "region"],
}
