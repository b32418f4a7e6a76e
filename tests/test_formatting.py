from datetime import date

from pyspark.sql import types as T

from feedlake.feeds import LINE_LIST, PANEL
from feedlake.operators.formatting import format_feed, typed_feed

DAY = date(2024, 1, 31)


def panel(spark, rows):
    columns = ["dep", "sexe", "jour", "hosp", "rea", "rad", "dc", "note"]
    fields = [T.StructField(c, T.StringType()) for c in columns]
    return spark.createDataFrame(rows, T.StructType(fields))


def test_panel_values(spark):
    raw = panel(
        spark,
        [
            ("01", "0", "2020-03-18", "12.0", "3", " 7 ", "x", "kept"),
            ("02", "1", "2020-3-19", None, None, "5", "4", None),
            ("03", "9", "2020-03-20T00:00", "", "", "5", "n/a", None),
            ("2A", "2", "bad", "1", None, None, None, None),
        ],
    )
    rows = format_feed(raw, PANEL, "X", DAY).orderBy("department_code").collect()
    assert [tuple(r) for r in rows] == [
        ("01", "ALL", date(2020, 3, 18), 12, 3, 7, None, "kept", "X", DAY),
        ("02", "M", date(2020, 3, 19), None, None, 5, 4, None, "X", DAY),
        ("2A", "F", None, 1, None, None, None, None, "X", DAY),
    ]


def test_rows_without_any_deciding_measure_go_only_in_the_filter(spark):
    raw = panel(spark, [("01", "0", "2020-03-18", None, None, "9", None, None)])
    assert typed_feed(raw, PANEL, "X", DAY).count() == 1
    assert format_feed(raw, PANEL, "X", DAY).count() == 0


def test_nothing_is_filtered_when_no_deciding_column_exists(spark):
    raw = spark.createDataFrame([("01", "a"), ("02", None)], "dep string, other_column string")
    rows = format_feed(raw, PANEL, "X", DAY)
    assert rows.count() == 2
    assert rows.columns == ["department_code", "other_column", "country", "ingestion_date"]


def test_linelist_values(spark):
    raw = spark.createDataFrame(
        [
            ("2021-01-05 00:00:00", "1", "45", " m ", "Recuperado", "2021-02-01T00:00:00.000"),
            ("2021-01-05T00:00:00.000", "2", "N/A", "F", "Fallecido", None),
            ("unknown", "3", "30", "f", "Activo", None),
            ("2021-01-06", "4", "30.7", None, "Leve", "x"),
            ("2021-01-06", "5", None, "x", "N/A", ""),
            ("2021-01-06", "6", None, "x", " Activo", ""),
        ],
        "fecha_reporte_web string, id_de_caso string, edad string, sexo string, estado string, "
        "fecha_recuperado string",
    )
    rows = format_feed(raw, LINE_LIST, "Y", DAY).orderBy("case_id").collect()
    day = date(2021, 1, 5)
    after = date(2021, 1, 6)
    assert [tuple(r)[:6] for r in rows] == [
        (day, "1", 45, "M", "RECOVERED", date(2021, 2, 1)),
        (day, "2", None, "F", "DECEASED", None),
        (after, "4", 30, None, "Leve", None),
        (after, "5", None, "X", "UNKNOWN", None),
        (after, "6", None, "X", " Activo", None),
    ]


def test_full_feeds_have_their_declared_schemas(spark):
    for feed in (PANEL, LINE_LIST):
        empty = spark.createDataFrame([], feed.raw_schema)
        formatted = format_feed(empty, feed, "X", DAY).schema
        declared = feed.formatted_schema
        assert [(f.name, f.dataType) for f in formatted] == [
            (f.name, f.dataType) for f in declared
        ]


def test_ingestion_date_defaults_to_today(spark):
    raw = panel(spark, [("01", "0", "2020-03-18", "1", None, None, None, None)])
    today = spark.sql("select current_date() as d").first().d
    assert format_feed(raw, PANEL, "X").first().ingestion_date == today
