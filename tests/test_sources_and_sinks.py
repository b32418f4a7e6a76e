import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedlake.feeds import COMBINED_SCHEMA, PANEL
from feedlake.plans import shared
from feedlake.sinks import (
    INDEX_FIELDS,
    bulk_lines,
    index_mapping,
    land_snapshot,
    reconcile,
    to_documents,
    write_bulk,
    write_csv,
    write_metrics,
    write_partitioned,
    write_sorted,
    write_table,
)
from feedlake.sinks.tables import LINE_BREAK
from feedlake.sources import (
    capped,
    detect_separator,
    latest_snapshot,
    read_daily_csv,
    read_detected_csv,
    read_snapshot,
    read_text_csv,
)


def saved(tmp_path, text, encoding="utf-8"):
    path = tmp_path / "feed.csv"
    path.write_bytes(text.encode(encoding))
    return str(path)


@pytest.mark.parametrize(
    ("header", "sep"),
    [
        ("a;b;c", ";"),
        ("a,b,c", ","),
        ("a\tb\tc", "\t"),
        ("alone", ","),
        ("a;b,c", ","),
        ("a;b\tc", "\t"),
        ("a,b\tc", ","),
        ("a;b;c,d", ";"),
        ("a;b\tc\td;e,f", "\t"),
    ],
)
def test_separator_detection(spark, tmp_path, header, sep):
    assert detect_separator(spark, saved(tmp_path, f"{header}\n1;2;3;4;5;6\n")) == sep


def test_detected_csv_keeps_all_text(spark, tmp_path):
    df = read_detected_csv(spark, saved(tmp_path, "dep;hosp\n01;12.0\n2A;\n"))
    assert df.dtypes == [("dep", "string"), ("hosp", "string")]
    assert [tuple(r) for r in df.collect()] == [("01", "12.0"), ("2A", None)]


def test_fallback_separator_when_the_likeliest_gives_one_column(spark, tmp_path):
    df = read_detected_csv(spark, saved(tmp_path, '"a,b,c";d\n1;2\n'))
    assert df.columns == ["a,b,c", "d"]


def test_single_column_file_stays_single(spark, tmp_path):
    assert read_detected_csv(spark, saved(tmp_path, "alone\n1\n")).columns == ["alone"]


def test_encoding(spark, tmp_path):
    path = saved(tmp_path, "dep,ciudad\n1,Bogotá\n", "iso-8859-1")
    assert read_text_csv(spark, path, encoding="ISO-8859-1").first().ciudad == "Bogotá"


def test_all_part_files_of_a_directory_are_read(spark, tmp_path):
    path = str(tmp_path / "parts")
    spark.range(100).repartition(5).write.option("header", True).csv(path)
    assert len(list(Path(path).glob("part-*.csv"))) == 5
    assert read_text_csv(spark, path).count() == 100


def test_part_files_with_other_headers_are_refused(spark, tmp_path):
    for name, header in (("1.csv", "a,b"), ("2.csv", "b,a")):
        (tmp_path / name).write_text(f"{header}\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_text_csv(spark, str(tmp_path)).collect()


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_text_csv(spark, str(tmp_path / "absent"))


def panel(spark, *regions):
    return spark.createDataFrame([(r, " m ") for r in regions], "dep string, sexe string")


def test_snapshots(spark, tmp_path):
    raw = str(tmp_path / "raw")
    with pytest.raises(FileNotFoundError):
        latest_snapshot(spark, raw, PANEL)
    land_snapshot(panel(spark, "old"), raw, PANEL, "2023-12-31")
    land_snapshot(panel(spark, "new", "n2"), raw, PANEL, date(2024, 1, 2), sep=";")
    Path(raw, "panel", "notes").mkdir()
    assert latest_snapshot(spark, raw, PANEL) == "2024-01-02"
    by_day = read_snapshot(spark, raw, PANEL, "2023-12-31")
    assert [tuple(r) for r in by_day.collect()] == [("old", " m ")]
    assert read_snapshot(spark, raw, PANEL).count() == 2
    Path(raw, "panel", "2024-02-01").mkdir()  # left without data by a failed write
    assert latest_snapshot(spark, raw, PANEL) == "2024-01-02"
    assert read_snapshot(spark, raw, PANEL).count() == 2
    for absent in ("2025-01-01", "2024-02-01"):
        with pytest.raises(FileNotFoundError, match=absent):
            read_snapshot(spark, raw, PANEL, absent)


def test_line_breaks_in_cells_are_replaced(spark, tmp_path):
    raw = str(tmp_path / "raw")
    rows = spark.createDataFrame([("01", "x\ny"), ("02", "a\r\nb\rc")], "dep string, note string")
    land_snapshot(rows, raw, PANEL, "2024-01-01")
    read = read_snapshot(spark, raw, PANEL, "2024-01-01").orderBy("dep")
    assert [tuple(r) for r in read.collect()] == [
        ("01", f"x{LINE_BREAK}y"),
        ("02", f"a{LINE_BREAK}b{LINE_BREAK}c"),
    ]


def test_only_the_chosen_snapshot_is_scanned(spark, tmp_path):
    raw = str(tmp_path / "raw")
    for day in ("2024-01-01", "2024-01-02"):
        land_snapshot(panel(spark, day), raw, PANEL, day)
    files = read_snapshot(spark, raw, PANEL).inputFiles()
    assert files and all("2024-01-02" in f for f in files)


def test_landing_again_replaces_the_day(spark, tmp_path):
    raw = str(tmp_path / "raw")
    for regions in (("a", "b"), ("c",)):
        land_snapshot(panel(spark, *regions), raw, PANEL, "2024-01-01")
    assert [r.dep for r in read_snapshot(spark, raw, PANEL).collect()] == ["c"]


def test_capped(spark):
    df = spark.range(1000).repartition(9)
    assert sorted(r.id for r in capped(df, 5, ["id"]).collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.id for r in capped(df, 700, ["id"]).collect()) == list(range(700))
    assert capped(df, 5000, ["id"]).count() == 1000
    assert capped(df, 0, ["id"]).count() == 0
    same = df.selectExpr("id % 2 as k")
    assert capped(same, 7, ["k"]).count() == 7


def combined(spark, *rows):
    return spark.createDataFrame(list(rows), COMBINED_SCHEMA)


STAMP = datetime(2024, 1, 31, 12)
ROWS = [
    (date(2020, 3, 31), "P", None, 10, 1, 5, 2, None, 2, None, None, None, STAMP),
    (date(2020, 4, 1), "L", 3, None, None, 1, 0, 2, 1, 30.5, 33.33, 0.0, STAMP),
    (date(2021, 4, 1), "L", 4, None, None, 1, 0, 2, 1, 31.0, 25.0, 0.0, STAMP),
]


def test_csv_round_trip_with_schema_and_inferred(spark, tmp_path):
    df = combined(spark, *ROWS)
    path = str(tmp_path / "csv")
    write_csv(df.repartition(3), path)
    assert sorted(map(tuple, read_daily_csv(spark, path).collect())) == sorted(map(tuple, ROWS))
    inferred = read_daily_csv(spark, path, infer=True)
    assert dict(inferred.dtypes)["total_deaths"] == "int"
    assert inferred.count() == 3


def test_single_csv_file(spark, tmp_path):
    write_csv(combined(spark, *ROWS).repartition(3), str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "one").glob("part-*.csv"))) == 1


def test_parquet_is_snappy_and_sorted(spark, tmp_path):
    path = str(tmp_path / "daily")
    write_sorted(combined(spark, *reversed(ROWS)), path)
    assert all(".snappy." in f for f in spark.read.parquet(path).inputFiles())
    assert spark.read.parquet(path).schema.simpleString() == COMBINED_SCHEMA.simpleString()
    write_table(combined(spark, ROWS[0]), path, mode="append")
    assert spark.read.parquet(path).count() == 4


def test_partitioned_overwrite_replaces_only_its_months(spark, tmp_path):
    path = str(tmp_path / "by_month")
    write_partitioned(combined(spark, *ROWS), path)
    assert (tmp_path / "by_month" / "year=2020" / "month=4").exists()
    newer = (date(2020, 4, 2), "L", 9, None, None, 1, 0, 2, 1, 31.0, 25.0, 0.0, STAMP)
    write_partitioned(combined(spark, newer), path, files=10)
    dates = sorted(r.date for r in spark.read.parquet(path).collect())
    assert dates == [date(2020, 3, 31), date(2020, 4, 2), date(2021, 4, 1)]
    write_partitioned(combined(spark, newer), path, mode="append")
    assert spark.read.parquet(path).count() == 4


def test_metrics_file(spark, tmp_path):
    metrics = spark.range(1).select(F.lit(1.5).alias("rmse"), F.lit(-0.1).alias("r2"))
    write_metrics(metrics, str(tmp_path / "metrics"))
    [part] = (tmp_path / "metrics").glob("part-*.json")
    assert json.loads(part.read_text()) == {"rmse": 1.5, "r2": -0.1}


def test_documents_have_every_field_and_explicit_nulls(spark):
    rows = to_documents(combined(spark, *ROWS), keep=["date"]).orderBy("date").collect()
    first = json.loads(rows[0].document)
    assert list(first) == list(INDEX_FIELDS)
    assert first["date"] == "2020-03-31"
    assert first["total_cases"] is None and first["avg_age"] is None
    assert json.loads(rows[1].document)["mortality_rate"] == 33.33


def test_documents_from_text_are_coerced(spark):
    text = spark.createDataFrame(
        [("P", "12.9", "NaN", "x")],
        "country string, total_cases string, avg_age string, regions_count string",
    )
    document = json.loads(to_documents(text).first().document)
    assert document == {"country": "P", "total_cases": 12, "regions_count": None, "avg_age": None}
    zero = json.loads(to_documents(text, "zero").first().document)
    assert zero == {"country": "P", "total_cases": 12, "regions_count": 0, "avg_age": 0.0}
    with pytest.raises(ValueError, match="maybe"):
        to_documents(text, "maybe")


def test_bulk_files_keep_pairs_together_and_hold_one_batch(spark, tmp_path):
    documents = spark.range(1200).select(F.to_json(F.struct("id")).alias("document"))
    path = str(tmp_path / "index")
    for _ in range(2):  # the second run replaces the first
        write_bulk(documents.coalesce(1), path, "days", batch=500)
    files = sorted((tmp_path / "index" / "bulk").glob("part-*"))
    lines = [f.read_text().splitlines() for f in files]
    assert sorted(len(part) // 2 for part in lines) == [200, 500, 500]
    for part in lines:
        assert all(json.loads(line) == {"index": {"_index": "days"}} for line in part[::2])
        assert all(set(json.loads(line)) == {"id"} for line in part[1::2])
    ids = {json.loads(line)["id"] for part in lines for line in part[1::2]}
    assert ids == set(range(1200))
    [mapping] = (tmp_path / "index" / "mapping").glob("part-*")
    assert json.loads(mapping.read_text()) == index_mapping()


def test_bulk_line(spark):
    documents = spark.createDataFrame([('{"a":1}',)], "document string")
    assert bulk_lines(documents, "i").first().value == '{"index":{"_index":"i"}}\n{"a":1}'


def test_reconcile_shows_rows_missing_on_either_side(spark):
    source = spark.createDataFrame([("a",), ("a",), ("b",)], "country string")
    target = spark.createDataFrame([("a",), ("c",), ("b",)], "country string")
    rows = reconcile(source, target).orderBy("country").collect()
    assert [tuple(r) for r in rows] == [
        ("a", 2, 1, False),
        ("b", 1, 1, True),
        ("c", 0, 1, False),
    ]


def test_settled_table_lives_in_the_shared_folder(spark):
    df = shared.settle(spark.range(10).withColumn("k", F.col("id") % 3), "numbers")
    folder = spark.conf.get(shared.CHECKPOINT_DIR)
    assert df.count() == 10
    assert all(folder in f for f in df.inputFiles())
    assert shared.scratch_path(spark, "x") != shared.scratch_path(spark, "x")


def test_release_deletes_only_this_applications_tables(spark):
    df = shared.settle(spark.range(3), "gone")
    other = Path(spark.conf.get(shared.CHECKPOINT_DIR), "feedlake", "another-application")
    other.mkdir(parents=True, exist_ok=True)
    [path] = {Path(f.removeprefix("file://")).parent for f in df.inputFiles()}
    assert path.exists()
    shared.release(spark)
    assert not path.exists() and other.exists()
    assert shared.settle(spark.range(3), "again").count() == 3
