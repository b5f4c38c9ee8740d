"""Column functions on the literal edge rows, with the expected result of every profile."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesmill.functions import dates, numeric, rules
from salesmill.functions.categories import CATEGORIZERS
from salesmill.functions.text import clean_text, strip

PROFILES = ["datamart", "external", "chunked", "microbatch", "lines"]


def apply(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x")).alias("y")).collect()]


def test_code_points():
    assert [ord(c) for c in (rules.A_TILDE, rules.PLUS_MINUS, rules.CENT, rules.A_CIRC, rules.N_TILDE)] == [
        0xC3, 0xB1, 0xA2, 0xE2, 0xF1,
    ]


TEXT = {
    "Ã±Ã±STÃ±": ["ST", "ST", "ññSTñ", "ÑÑSTÑ", "ññSTñ"],
    "  LÃ¢mina  gris ": ["Lmina  gris", "L¢mina  gris", "Lmina gris", "L¢MINA GRIS", "Lmina  gris"],
    "UÃ±ER0ââ": ["UER0ââ", "UER0", "UñER0ââ", "USER0", "UñER0ââ"],
    "José": ["José", "José", "José", "JOSÉ", "José"],
    "": ["", "", "", "", ""],
    None: [None] * 5,
}


@pytest.mark.parametrize("i, profile", list(enumerate(PROFILES)))
def test_text(spark, i, profile):
    assert apply(spark, TEXT, lambda c: clean_text(c, profile)) == [v[i] for v in TEXT.values()]


def test_strip_takes_all_white_space(spark):
    given = ["\t a b\n", "\u00a0\u00f1\u3000", "\u00a0 ", "x", None]
    assert apply(spark, given, strip) == ["a b", "\u00f1", "", "x", None]


def day(text):
    return dt.date.fromisoformat(text) if text else None


JAN5, JAN15 = "2023-01-05", "2023-01-15"
DATES = {
    "2023-01-05": [JAN5, JAN5, JAN5, JAN5, 202301],
    "2023-1-5": [JAN5, JAN5, JAN5, JAN5, None],
    "01/15/2023": [JAN15, None, JAN15, JAN15, None],
    "15-01-2023": [JAN15, None, None, JAN15, None],
    "05-01-2023": [JAN5, None, "2023-05-01", JAN5, None],
    "20230115": [JAN15, None, JAN15, JAN15, 202311],
    "202301159": [None, None, JAN15, None, 202311],
    "31/12/2023": [None, None, None, "2023-12-31", None],
    "12-31-2023": [None, None, "2023-12-31", "2023-12-31", None],
    # The last two values of this row and the next come from the free-form layouts.
    "2023/01/05": [None, None, JAN5, JAN5, 202301],
    "2023-02-30": [None, None, None, None, 202302],
    "2023-01-05 10:11:12": [None, None, JAN5, JAN5, 202301],
    "5 January 2023": [None, None, JAN5, JAN5, None],
    "Jan 5, 2023": [None, None, JAN5, JAN5, None],
    "not-a-date": [None, None, None, None, None],
    "": [None] * 5,
    None: [None] * 5,
}


@pytest.mark.parametrize("i, profile", list(enumerate(PROFILES[:4])))
def test_dates(spark, i, profile):
    got = apply(spark, DATES, lambda c: dates.parse_date(c, profile))
    assert got == [day(v[i]) for v in DATES.values()]


def test_month_from_text(spark):
    assert apply(spark, DATES, dates.anio_mes_text) == [v[4] for v in DATES.values()]


def test_white_space_around_dates(spark):
    given = [" 2023-01-05 ", "\t01/15/2023", " 20230115"]
    assert apply(spark, given, lambda c: dates.parse_date(c, "datamart")) == [day(JAN5), day(JAN15), None]


def test_timestamps(spark):
    given = ["2023-01-05 10:11:12", "2023-01-05T10:11:12", "2023-01-05", "bad", "2023-02-30 10:11:12", None]
    at = dt.datetime(2023, 1, 5, 10, 11, 12)
    midnight = dt.datetime(2023, 1, 5)
    expected = {
        "datamart": [at, at, None, None, None, None],
        "external": [at, None, None, None, None, None],
        "chunked": [midnight, midnight, midnight, None, None, None],
        "microbatch": [midnight, midnight, midnight, None, None, None],
    }
    for profile, want in expected.items():
        assert apply(spark, given, lambda c: dates.parse_timestamp(c, profile)) == want, profile


def test_modified_date_falls_back(spark):
    from salesmill.operators.clean import clean

    df = spark.createDataFrame([("a", "2023-01-05", m) for m in ("x", "20230115", "01/15/2023", None)], "transaction_id string, date string, modified_date string")
    got = [r.modified_date for r in clean(df, "datamart", "2020-02-02").collect()]
    assert got == [day("2020-02-02"), day("2020-02-02"), day(JAN15), day("2020-02-02")]


CATEGORIES = [
    ("region", "oeste", "oeste", "ESTE", "oeste"),
    ("region", "west", "Occidente", "OESTE", "west"),
    ("region", "norte de mexico", "Norte", "MEXICO", "norte de mexico"),
    ("region", None, "Centro", "MEXICO", "MEXICO"),
    ("customer_segment", " corporate ", "corporate", "CORPORATE", "EMPRESARIAL"),
    ("customer_segment", None, "Otros", None, "NO_ESPECIFICADO"),
    ("product_category", "plate", "plate", "PLACA", "PLACA"),
    ("status", "done", "done", "COMPLETADO", "COMPLETADO"),
    ("currency", "gbp", "GBP", "gbp", "gbp"),
]


@pytest.mark.parametrize("column, value, datamart, external, microbatch", CATEGORIES)
def test_categories(spark, column, value, datamart, external, microbatch):
    got = [apply(spark, [value], lambda c: CATEGORIZERS[p](c, column))[0] for p in ("datamart", "external", "microbatch")]
    assert got == [datamart, external, microbatch]


def test_payment(spark):
    got = [apply(spark, ["wire transfer"], lambda c: CATEGORIZERS[p](c, "payment_method"))[0] for p in ("datamart", "external")]
    assert got == ["wire transfer", "TRANSFERENCIA"]


def test_numbers(spark):
    given = ["12", " 7 ", "-3", "12.5", "3.0", "abc", "", None, "1d", "1.5f", "NaN", "Infinity", "1e3", ".5", "99999999999999999999"]
    assert apply(spark, given, numeric.to_long) == [12, 7, -3] + [None] * 12
    assert apply(spark, given, numeric.to_double) == [
        12.0, 7.0, -3.0, 12.5, 3.0, None, None, None, None, None, None, None, 1000.0, 0.5, 1e20,
    ]


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e15, -1e15]
    for rows in (values, values[::-1], values[2:] + values[:2]):
        df = spark.createDataFrame([(v,) for v in rows], "x double").coalesce(1)
        assert df.agg(numeric.exact_sum(F.col("x"))).first()[0] == 0.6
        assert df.agg(numeric.exact_avg(F.col("x"))).first()[0] == 0.6 / 5


def test_exact_sum_falls_back_beyond_decimals(spark):
    df = spark.createDataFrame([(1e30,), (1e-15,), (None,)], "x double")
    assert df.agg(numeric.exact_sum(F.col("x"))).first()[0] == 1e30
    assert spark.createDataFrame([(None,)], "x double").agg(numeric.exact_sum(F.col("x"))).first()[0] is None


def test_round_money(spark):
    row = spark.range(1).select(numeric.round_money(F.lit(0.125)), numeric.round_money(F.lit(0.125), strict=True)).first()
    assert tuple(row) == (0.13, 0.12)
