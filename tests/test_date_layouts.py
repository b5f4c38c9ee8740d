"""Layouts settled by a column's own values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesmill.operators.date_layouts import infer_layouts, parse_columns, shapes


def parsed(spark, *values, day_first=False):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r.v.isoformat() if r.v else None for r in parse_columns(df, ["v"], day_first).collect()]


def test_evidence_settles_ambiguous_values(spark):
    assert parsed(spark, "03/04/2021", "13/04/2021") == ["2021-04-03", "2021-04-13"]
    assert parsed(spark, "03/04/2021", "04/13/2021") == ["2021-03-04", "2021-04-13"]
    assert parsed(spark, "03/04/2021") == ["2021-03-04"] and parsed(spark, "03/04/2021", day_first=True) == ["2021-04-03"]
    # The majority decides; a value with one reading keeps it.
    assert parsed(spark, "01/02/2021", "13/02/2021", "14/02/2021", "02/15/2021") == ["2021-02-01", "2021-02-13", "2021-02-14", "2021-02-15"]
    # Separators have their own evidence, and borrow that of others where they have none.
    assert parsed(spark, "01/02/2021", "13/02/2021", "01-02-2021", "02-13-2021", "01.02.2021") == [
        "2021-02-01", "2021-02-13", "2021-01-02", "2021-02-13", "2021-01-02",
    ]
    assert parsed(spark, "01/02/2021", "13/02/2021", "01.02.2021")[2] == "2021-02-01"
    # So has the place of the year.
    assert parsed(spark, "13/02/2021", "2021/02/03", "2021.02.03", "2021.13.02") == ["2021-02-13", "2021-03-02", "2021-03-02", "2021-02-13"]
    assert parsed(spark, "13/02/2021", "2021/02/03") == ["2021-02-13", "2021-02-03"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("5 March 1998", "1998-03-05"), ("March 5, 1998", "1998-03-05"), ("mar 05 1998", "1998-03-05"), ("5-Mar-98", "1998-03-05"),
        ("5 de enero de 1998", "1998-01-05"), ("2 sept 2020", "2020-09-02"), ("21st Dic 2020", "2020-12-21"), ("1998 August 3", "1998-08-03"),
        ("  2021-1-5  ", "2021-01-05"), ("20210105", "2021-01-05"), ("2021-01-05T10:11:12", "2021-01-05"), ("2021-01-05 10:11:12.123", "2021-01-05"),
        ("1/5/21 3:04 PM", "2021-01-05"), ("1/5/68", "2068-01-05"), ("1/5/69", "1969-01-05"), ("69-1-5", "1969-01-05"), ("1 5 2021", "2021-01-05"),
        ("2021-02-30", None), ("31/04/2021", None), ("13/13/2021", None), ("5 Foo 1998", None), ("1/5-2021", None), ("1234567", None), ("", None), ("n/a", None), (None, None),
    ],
)
def test_values(spark, text, want):
    assert parsed(spark, text) == [want]


def test_columns_are_settled_apart_in_one_pass(spark):
    df = spark.createDataFrame([("03/04/2021", "03/04/2021"), ("13/04/2021", "04/13/2021"), (None, "x")], "a string, b string")
    layouts = infer_layouts(df, ["a", "b"])
    assert layouts["a"].day_first["slash", False] and not layouts["b"].day_first["slash", False]
    got = parse_columns(df, ["a", "b"]).first()
    assert (got.a, got.b) == (dt.date(2021, 4, 3), dt.date(2021, 3, 4))
    assert parse_columns(df.limit(0), ["a"]).collect() == []


def test_shapes(spark):
    df = spark.createDataFrame([("1/2/2021",), ("3/4/2021",), ("5 März",), (None,)], "v string")
    assert [tuple(r) for r in shapes(df, "v").collect()] == [("9/9/9999", 2, "1/2/2021"), ("9 aaaa", 1, "5 März")]


def test_patterns_run_once_per_value(spark):
    """The parts of a value come from one projection, however many places use them; a caller's columns may have their names."""
    df = spark.createDataFrame([("13/04/2021", "x"), ("03/04/2021", "y"), (None, "z")], "d string, _part0text string")
    found = parse_columns(df, ["d"])
    assert found.columns == ["d", "_part0text"]
    assert [str(r.d) for r in found.collect()] == ["2021-04-13", "2021-04-03", "None"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"\2(") == 5  # the pattern of numbers: a test and four parts
