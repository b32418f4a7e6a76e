from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.functions import (
    coded,
    day_of,
    first_date,
    guarded_pct,
    lenient_int,
    mean_of_pct,
    real_or_null,
    tidy,
    whole_or_null,
)


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    rows = df.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
    return [row.r for row in rows]


def cast_without_ansi(spark, texts):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        return values(spark, texts, lambda c: c.cast("int"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


NUMBERS = [
    "12", "12.0", " 7 ", "-3.9", "+5", "x", "", None, "NaN", "1e3", "99999999999", ".5", "-.5",
    ".", "-", "5.", "5.x", "\t8\n", "2.99996", "2147483647.9", "-2147483648", "-2147483649",
    "2147483648.0", "- 5", "5 5", "-0.9", "1.2.3", "0000000000000012", "0x1F", "1_000", "1,5",
]


def test_lenient_int_equals_the_cast_without_ansi(spark):
    assert values(spark, NUMBERS, lenient_int) == cast_without_ansi(spark, NUMBERS)


@settings(
    max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text("0123456789+-. \tex", max_size=13), min_size=50, max_size=200))
def test_lenient_int_on_random_text(spark, texts):
    assert values(spark, texts, lenient_int) == cast_without_ansi(spark, texts)


def test_lenient_int_truncates_and_keeps_ansi_on(spark):
    assert values(spark, ["2.99996", "-3.9", "12.0"], lenient_int) == [2, -3, 12]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2021-01-05", date(2021, 1, 5)),
        ("2021-01-05 00:00:00", date(2021, 1, 5)),
        ("2021-01-05T00:00:00.000", date(2021, 1, 5)),
        ("2020-3-18", date(2020, 3, 18)),
        ("2020-03-18 foo", date(2020, 3, 18)),
        ("2020-03-18foo", None),
        ("2020-02-30", None),
        ("2020-13-01", None),
        ("2020", None),
        ("18/03/2020", None),
        (" 2020-03-18", None),
        ("unknown", None),
        ("", None),
        (None, None),
    ],
)
def test_day_of(spark, text, expected):
    assert values(spark, [text], day_of) == [expected]


def test_day_of_equals_splitting_and_parsing(spark):
    texts = ["2021-01-05 00:00:00", "2021-01-05T00:00:00.000", "2021-01-05", "unknown", "", None]

    def by_split(c):
        return F.try_to_date(F.split(c, "[T ]").getItem(0), "yyyy-MM-dd")

    assert values(spark, texts, day_of) == values(spark, texts, by_split)


def test_first_date_takes_the_first_format_that_fits(spark):
    texts = ["2021-01-05", "05/01/2021", "2021/01/05", "01-05-2021", "31/02/2021", "", None]
    expected = [date(2021, 1, 5)] * 3 + [None] * 4
    assert values(spark, texts, first_date) == expected
    assert values(spark, ["05.01.2021"], lambda c: first_date(c, ["dd.MM.yyyy"])) == [
        date(2021, 1, 5)
    ]


def test_coded_passes_unknown_codes_through(spark):
    assert values(spark, ["0", "1", "9", None], lambda c: coded(c, {"0": "ALL", "1": "M"})) == [
        "ALL",
        "M",
        "9",
        None,
    ]
    assert values(spark, ["a"], lambda c: coded(c, {})) == ["a"]


def test_tidy(spark):
    assert values(spark, [" m ", "F", None], tidy) == ["M", "F", None]


def test_guarded_pct(spark):
    df = spark.createDataFrame(
        [(1, 3), (1, 0), (1, None), (None, 4), (1, 32), (5, 5)], "part long, whole long"
    )
    rows = df.select(guarded_pct(F.col("part"), F.col("whole")).alias("r")).collect()
    assert [r.r for r in rows] == [33.33, None, None, None, 3.13, 100.0]


def test_mean_of_pct_is_exact_and_skips_nulls(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,), (0.3,)], "r double")
    assert df.agg(mean_of_pct(F.col("r")).alias("m")).first().m == 0.6 / 3
    assert df.where("r > 9").agg(mean_of_pct(F.col("r")).alias("m")).first().m is None


def test_coercion_truncates_and_blanks_what_is_no_number(spark):
    texts = ["12.9", "-3.9", "7", "NaN", "Infinity", "x", "", None, "1e3"]
    assert values(spark, texts, whole_or_null) == [
        12, -3, 7, None, None, None, None, None, 1000,
    ]
    assert values(spark, ["1.5", "NaN", "x", None], real_or_null) == [1.5, None, None, None]
