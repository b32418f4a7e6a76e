import logging

import pytest
from pyspark.sql import functions as F

from feedlake.feeds import LINE_LIST, PANEL
from feedlake.operators.quality import (
    FeedRejected,
    counted,
    dedupe_rows,
    handle_nulls,
    in_range,
    null_counts,
    quality_report,
    range_filter,
    require_headers,
    require_rows,
    warn_if_unexpected,
)


def headers(spark, *names):
    return spark.createDataFrame([], ", ".join(f"`{n}` string" for n in names))


def test_empty_feed_is_refused(spark):
    require_rows(spark.range(1), "feed")
    with pytest.raises(FeedRejected, match="no rows"):
        require_rows(spark.range(0), "feed")


def test_required_panel_headers(spark):
    require_headers(headers(spark, *PANEL.required), PANEL)
    with pytest.raises(FeedRejected, match="rea, rad"):
        require_headers(headers(spark, "dep", "sexe", "jour", "hosp", "dc"), PANEL)


def test_linelist_needs_a_date_and_a_location_header(spark):
    require_headers(headers(spark, "Fecha_X", "CIUDAD"), LINE_LIST)
    require_headers(headers(spark, "update_time", "municipio_nom"), LINE_LIST)
    with pytest.raises(FeedRejected, match="date"):
        require_headers(headers(spark, "departamento"), LINE_LIST)
    with pytest.raises(FeedRejected, match="location"):
        require_headers(headers(spark, "fecha"), LINE_LIST)


def test_unexpected_columns_only_warn(spark, caplog):
    assert warn_if_unexpected(headers(spark, "date", "country"), PANEL)
    with caplog.at_level(logging.WARNING):
        assert not warn_if_unexpected(headers(spark, "country"), PANEL)
    assert "panel" in caplog.text


def test_counts_ride_along_with_the_action(spark):
    rows, before = counted(spark.range(100), "before")
    kept, after = counted(rows.where("id % 3 = 0"), "after")
    kept.write.format("noop").mode("overwrite").save()
    assert (before.get["rows"], after.get["rows"]) == (100, 34)


def test_quality_report(spark):
    raw = spark.createDataFrame(
        [
            ("01", "0", "2020-03-18", "1", None, None),
            (None, "0", "2020-03-18", "1", None, None),
            ("01", "0", "bad", "x", "", None),
        ],
        "dep string, sexe string, jour string, hosp string, rea string, dc string",
    )
    assert tuple(quality_report(raw, PANEL, "P").first()) == ("panel", 3, 2, 1, 2, False)
    assert tuple(quality_report(raw.where("hosp = 'x'"), PANEL, "P").first()) == (
        "panel",
        1,
        0,
        1,
        1,
        True,
    )
    assert tuple(quality_report(raw.limit(0), PANEL, "P").first()) == ("panel", 0, 0, 0, 0, True)


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert tuple(null_counts(df, ["a", "b"]).first()) == (1, 2)


def test_dedupe_collapses_a_hot_row(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.lit(None).cast("string").alias("v"),
    )
    assert dedupe_rows(df).count() == df.distinct().count() == 20_001


def test_range(spark):
    df = spark.createDataFrame([(-1,), (0,), (120,), (121,), (None,)], "age int")
    kept = range_filter(df, "age").orderBy("age").collect()
    assert [r.age for r in kept] == [None, 0, 120]
    assert range_filter(df, "age", keep_null=False).count() == 2
    flags = [r.f for r in df.select(in_range("age").alias("f")).collect()]
    assert flags == [False, True, True, False, None]
    assert range_filter(df, "age", 121, 130, keep_null=False).count() == 1


def test_null_strategies(spark):
    df = spark.createDataFrame(
        [(1, 2, "x", 1.0), (None, None, None, None)], "a int, b long, c string, d double"
    )
    assert handle_nulls(df, "keep").count() == 2
    assert handle_nulls(df, "drop", ["a"]).count() == 1
    with pytest.raises(ValueError, match="name the columns"):
        handle_nulls(df, "drop")
    assert tuple(handle_nulls(df, "fill").orderBy("a").first()) == (0, 0, "UNKNOWN", None)
    assert tuple(handle_nulls(df, "fill", ["c"]).orderBy("c").first()) == (
        None,
        None,
        "UNKNOWN",
        None,
    )
    with pytest.raises(ValueError, match="guess"):
        handle_nulls(df, "guess")
