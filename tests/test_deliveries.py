"""Appends, refreshes, caps and scans that must survive stops, repeats and broken rows."""

import random
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedlake.feeds import LINE_LIST, PANEL
from feedlake.functions import fingerprint
from feedlake.operators.combine import combine_daily
from feedlake.operators.daily import linelist_daily, panel_daily
from feedlake.operators.quality import (
    Cleaning,
    FeedRejected,
    clean,
    deduped_and_counted,
    published_cleaning,
)
from feedlake.operators.states import (
    changed_days,
    estimated_regions,
    linelist_states,
    merged,
    month_states,
    panel_states,
)
from feedlake.plans.jobs import Lake, format_snapshot, land
from feedlake.plans.refresh import DAILY, STATES, ranges, refresh_daily, stored
from feedlake.sinks import (
    append_batch,
    checked_documents,
    is_noted,
    land_snapshot,
    ledger,
    move_batch,
    note_batch,
    read_rejected,
    reconcile,
    stage_batch,
    write_checked_bulk,
    write_table,
)
from feedlake.sinks import batches as batches_module
from feedlake.sinks import documents as documents_module
from feedlake.sources import (
    capped,
    infer_types,
    inputs_present,
    limits,
    read_checked_csv,
    read_inferred_csv,
    read_text_csv,
)

# --- appends


def days(spark, first, count):
    start = date(2024, 1, 1).toordinal() + first
    rows = [(date.fromordinal(start + k), first + k) for k in range(count)]
    return spark.createDataFrame(rows, "date date, value int").repartition(2)


def values(spark, path):
    return sorted(r.value for r in spark.read.parquet(path).collect())


def test_a_batch_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "table")
    first = append_batch(days(spark, 0, 50), path, "first")
    assert (first["rows"], first["written"]) == (50, True)
    again = append_batch(days(spark, 0, 50), path, "first")
    assert (again["rows"], again["written"]) == (50, False)
    append_batch(days(spark, 20, 50), path, "second")  # same days, another batch
    assert values(spark, path) == sorted([*range(50), *range(20, 70)])
    noted = {r.batch: r.rows for r in ledger(spark, path).collect()}
    assert noted == {"first": 50, "second": 50}


@pytest.mark.parametrize("stop", ["staging", "staged", "moving", "moved", "noted"])
def test_an_append_goes_on_where_it_stopped(spark, tmp_path, monkeypatch, stop):
    path, rows = str(tmp_path / "table"), days(spark, 0, 100)
    append_batch(days(spark, 500, 10), path, "other")
    if stop == "staging":  # the rows are written but not marked as whole
        write_table(rows, f"{path}.staging/batch/year=2024/month=1")
    else:
        stage_batch(rows, path, "batch")
    if stop == "moving":
        assert not move_batch(spark, path, "batch", at_most=2)
    if stop in ("moved", "noted"):
        assert move_batch(spark, path, "batch")
    if stop == "noted":
        monkeypatch.setattr(batches_module.Store, "delete", lambda *_: None)
        note_batch(spark, path, "batch")
        monkeypatch.undo()
    assert is_noted(spark, path, "batch") == (stop == "noted")
    assert append_batch(rows, path, "batch")["written"] == (stop != "noted")
    assert values(spark, path) == [*range(100), *range(500, 510)]
    assert not Path(f"{path}.staging/batch").exists()


def test_staged_rows_are_not_in_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    append_batch(days(spark, 0, 5), path, "first")
    stage_batch(days(spark, 5, 5), path, "second")
    assert values(spark, path) == [0, 1, 2, 3, 4]
    assert [r.batch for r in ledger(spark, path).collect()] == ["first"]


def test_empty_batches_and_bad_names(spark, tmp_path):
    path = str(tmp_path / "table")
    assert ledger(spark, path).count() == 0
    assert append_batch(days(spark, 0, 0), path, "none") == {
        "batch": "none", "rows": 0, "files": [], "written": True,
    }
    assert not append_batch(days(spark, 0, 3), path, "none")["written"]
    for name in ("", "../up", "_hidden", "a/b"):
        with pytest.raises(ValueError, match="no name"):
            append_batch(days(spark, 0, 1), path, name)


def test_a_lost_file_is_an_error(spark, tmp_path):
    path = str(tmp_path / "table")
    stage_batch(days(spark, 0, 5), path, "batch")
    next(Path(f"{path}.staging/batch").rglob("part-*.parquet")).unlink()
    with pytest.raises(FileNotFoundError, match="neither staged nor in the table"):
        append_batch(days(spark, 0, 5), path, "batch")


# --- fingerprints


def test_fingerprints_stand_for_sets_of_rows(spark):
    def mark(rows):
        df = spark.createDataFrame(rows, "a string, b string, c double")
        return df.repartition(3).agg(*fingerprint(df.columns)).first()

    rows = [("x", None, 1.0), ("x", None, 1.0), (None, "x", 2.0), ("", "", None)]
    assert mark(rows) == mark(rows[::-1])
    others = [
        rows[1:], [*rows, rows[0]], [(None, "x", 1.0), *rows[1:]], [("x", "", 1.0), *rows[1:]],
        [*rows[:3], (None, None, None)], [("x", None, 1.5), *rows[1:]],
    ]
    assert all(mark(rows) != mark(other) for other in others)


def test_reconcile_sees_a_changed_cell(spark):
    schema = "country string, date date, n bigint"
    rows = [("A", date(2024, 1, k), k) for k in range(1, 9)] + [("B", None, None)]
    source = spark.createDataFrame(rows, schema)
    other = spark.createDataFrame([("A", date(2024, 1, 1), 2), *rows[1:]], schema)
    as_text = source.select([F.col(c).cast("string").alias(c) for c in source.columns])

    def told(target):
        rows = reconcile(source, target, values=True)
        return {r.country: (r.ok, r.values_equal) for r in rows.collect()}

    assert told(as_text) == {"A": (True, True), "B": (True, True)}
    assert told(other) == {"A": (True, False), "B": (True, True)}
    assert told(source.where("country = 'A'")) == {"A": (True, True), "B": (False, False)}
    extra = source.unionByName(source.limit(0).union(spark.createDataFrame(
        [("C", None, 1)], schema)))
    assert told(extra)["C"] == (False, False)


# --- day states and refresh

FORMATTED_PANEL = (
    "department_code string, sex string, date date, hospitalizations int, icu_patients int, "
    "deaths int, returned_home int, country string, ingestion_date date"
)
FORMATTED_CASES = (
    "report_date date, case_id string, department_name string, age int, status string, "
    "country string, ingestion_date date"
)


def feeds(spark, drop=(), change=()):
    panel, cases = [], []
    for k in range(120):
        day = date.fromordinal(date(2024, 1, 1).toordinal() + k)
        if (day.year, day.month) in drop:
            continue
        bonus = 100 if (day.year, day.month) in change else 0
        for region in range(4):
            panel.append((f"{region}", "ALL", day, k, 1, region + bonus, None, "P", day))
            panel.append((f"{region}", "M", day, k, 1, region, None, "P", day))
            status = ("DECEASED", "ACTIVE")[region % 2]
            cases.append((day, f"{k}.{region}", f"r{region}", 40 + region, status, "L", day))
    cases.append((None, "x", "r", 1, "ACTIVE", "L", date(2024, 1, 1)))
    return (
        spark.createDataFrame(panel, FORMATTED_PANEL),
        spark.createDataFrame(cases, FORMATTED_CASES),
    )


def deliver(lake, panel, cases):
    write_table(panel, lake.formatted(PANEL))
    write_table(cases, lake.formatted(LINE_LIST))


def files_of(lake, table):
    return {p: p.stat().st_mtime_ns for p in Path(lake.usage(table)).rglob("part-*.parquet")}


def rebuilt(panel, cases):
    daily = combine_daily(panel_daily(panel), linelist_daily(cases)).drop("processed_at")
    return sorted(map(repr, daily.collect()))


def kept(spark, lake):
    return sorted(map(repr, stored(spark, lake, DAILY).drop("processed_at").collect()))


def test_refresh_rewrites_changed_months_only(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    deliver(lake, *feeds(spark))
    assert refresh_daily(spark, lake)["months"] == ["2024-01", "2024-02", "2024-03", "2024-04"]
    before = {t: files_of(lake, t) for t in (DAILY, STATES)}
    assert refresh_daily(spark, lake)["months"] == []
    assert {t: files_of(lake, t) for t in (DAILY, STATES)} == before
    panel, cases = feeds(spark, drop=[(2024, 4)], change=[(2024, 2)])
    deliver(lake, panel, cases)
    assert refresh_daily(spark, lake)["months"] == ["2024-02", "2024-04"]
    assert kept(spark, lake) == rebuilt(panel, cases)
    for table in (DAILY, STATES):
        after = files_of(lake, table)
        same = [p for p, at in before[table].items() if after.get(p) == at]
        assert same and {p.parent.name for p in same} == {"month=1", "month=3"}
        assert {p.parent.name for p in after} == {"month=1", "month=2", "month=3"}


def test_refresh_stopped_before_its_states_is_repeated(spark, tmp_path, monkeypatch):
    from feedlake.plans import refresh

    lake = Lake(str(tmp_path / "lake"))
    deliver(lake, *feeds(spark))
    refresh_daily(spark, lake)
    panel, cases = feeds(spark, change=[(2024, 3)])
    deliver(lake, panel, cases)
    write = refresh.write_partitioned

    def stops(rows, path):
        if path.endswith(STATES):
            raise OSError("stopped")
        write(rows, path)

    monkeypatch.setattr(refresh, "write_partitioned", stops)
    with pytest.raises(OSError, match="stopped"):
        refresh_daily(spark, lake)
    monkeypatch.undo()
    assert refresh_daily(spark, lake)["months"] == ["2024-03"]
    assert kept(spark, lake) == rebuilt(panel, cases)


def test_days_without_a_total_row_have_no_daily_row(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    panel, cases = feeds(spark)
    deliver(lake, panel, cases)
    refresh_daily(spark, lake)
    april = F.month("date") == 4
    panel = panel.where(~april | (F.col("sex") == "M"))
    cases = cases.where("report_date is null or month(report_date) <> 4")
    deliver(lake, panel, cases)
    assert refresh_daily(spark, lake)["months"] == ["2024-04"]
    assert kept(spark, lake) == rebuilt(panel, cases)


def test_month_ranges():
    assert ranges([date(2024, 1, 1), date(2023, 12, 1), date(2024, 5, 1)]) == [
        (date(2023, 12, 1), date(2024, 2, 1)),
        (date(2024, 5, 1), date(2024, 6, 1)),
    ]


def test_states_of_parts_merge_into_the_whole(spark):
    panel, cases = feeds(spark)
    for states, rows, part in (
        (panel_states, panel, F.col("department_code") == "1"),
        (linelist_states, cases, F.col("age") == 41),
    ):
        whole = states(rows)
        parts = states(rows.where(part)).unionByName(states(rows.where(~part)))
        together = merged(parts, "date", "country")
        assert changed_days(whole, together).count() == 0
        assert changed_days(whole, states(rows.where(part))).count() == whole.count()
        left = sorted(map(tuple, estimated_regions(whole).collect()), key=repr)
        right = estimated_regions(together).select(*estimated_regions(whole).columns)
        assert left == sorted(map(tuple, right.collect()), key=repr)
    months = estimated_regions(month_states(linelist_states(cases))).collect()
    assert {r.regions_count for r in months} == {4}
    assert sum(r.total_cases for r in months) == 480


def test_sketches_count_many_regions(spark):
    rows = spark.range(200_000).selectExpr(
        "date'2024-01-01' + cast(id % 60 as int) as report_date", "string(id) as case_id",
        "string(id % 50000) as department_name", "1 as age", "'ACTIVE' as status", "'L' as country",
    )
    (ever,) = estimated_regions(merged(linelist_states(rows), "country")).collect()
    assert abs(ever.regions_count - 50_000) < 0.065 * 50_000


# --- row cap


def brute_cap(df, n, order_by):
    names = [*order_by, *[c for c in df.columns if c not in order_by]]

    def key(row):
        return [(row[c] is not None, row[c] if row[c] is not None else 0) for c in names]

    return sorted(map(repr, sorted(df.collect(), key=key)[:n]))


@pytest.mark.parametrize(
    ("n", "order_by"),
    [(0, ["a"]), (7, ["b"]), (400, ["a"]), (700, ["b"]), (500, ["d", "c"]), (900, ["a"])],
)
def test_cap_equals_sorting(spark, monkeypatch, n, order_by):
    monkeypatch.setattr(limits, "SAMPLE", 16)
    monkeypatch.setattr(limits, "REPEATS", 50)
    draw = random.Random(4)
    rows = [
        (draw.randrange(10**6), draw.choice(["x", "x", "y", None, "z"]), draw.randrange(3),
         draw.choice([None, datetime(2024, 1, draw.randint(1, 28), 3, 4, 5, 678)]))
        for _ in range(500)
    ] + [(5, "x", 1, None)] * 300
    df = spark.createDataFrame(rows, "a bigint, b string, c int, d timestamp").coalesce(2)
    found = capped(df, n, order_by, few=20)
    assert sorted(map(repr, found.collect())) == brute_cap(df, n, order_by)


def test_cap_is_a_filter_of_the_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(50_000).selectExpr("id as key", "id % 7 as other").repartition(6).write.parquet(path)
    df = capped(spark.read.parquet(path), 30_000, ["key"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PushedFilters: [Or(Or(IsNull(key),LessThan(key,29999))" in plan
    assert df.count() == 30_000 and df.agg(F.max("key")).scalar() is not None
    assert df.agg(F.max("key")).first()[0] == 29_999


# --- broken rows


def lines_of(tmp_path, *lines):
    path = tmp_path / "feed.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_broken_lines_are_set_aside(spark, tmp_path):
    sound = [
        '1;2;3', '1;"x;y";3', '1;"a\\"b";3', ';;', '"";"";""', '1;x"y;3', '1;"x"y;3', '1;"a""b";3',
        '"""q""";2;3', '1;2;"z"',
    ]
    broken = {
        "6;7;8;9": "surplus cells", "1;2": "missing cells", '1;"x;3': "unclosed quote",
        '1;2;"z': "unclosed quote", '"1;2;3': "unclosed quote", '1;2;"q";': "surplus cells",
        "1": "missing cells",
    }
    path = lines_of(tmp_path, "a;b;c", *sound, *broken)
    checked = read_checked_csv(spark, path)
    assert {r.line: r.reason for r in checked.rejects.collect()} == broken
    assert {r.file for r in checked.rejects.collect()} == {"feed.csv"}
    plain = read_text_csv(spark, lines_of(tmp_path, "a;b;c", *sound), ";")
    path = lines_of(tmp_path, "a;b;c", *sound, *broken)
    rows = sorted(map(repr, read_checked_csv(spark, path).rows.collect()))
    (tmp_path / "feed.csv").write_text("\n".join(["a;b;c", *sound]) + "\n")
    assert rows == sorted(map(repr, plain.collect()))
    assert len(rows) == len(sound)


def test_every_line_is_in_one_part(spark, tmp_path):
    draw = random.Random(6)
    lines = ["".join(draw.choices(['a', ',', '"', '\\"', '""', "b"], k=9)) + "," for _ in range(800)]
    checked = read_checked_csv(spark, lines_of(tmp_path, "p,q,r", *lines))
    assert checked.rows.count() + checked.rejects.count() == checked.lines.count() == 800


def test_part_files_with_other_headers_are_refused_here_too(spark, tmp_path):
    for name, header in (("1.csv", "a,b"), ("2.csv", "b,a")):
        (tmp_path / name).write_text(f"{header}\n1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_checked_csv(spark, str(tmp_path)).lines.collect()


def test_quarantine_and_cleaning_in_a_job(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    folder = Path(lake.raw, PANEL.name, "2024-01-31")
    folder.mkdir(parents=True)
    (folder / "part.csv").write_text(
        "dep;sexe;jour;hosp;rea;rad;dc\n"
        "01;0;2020-04-01;1;1;1;1\n01;0;2020-04-01;1;1;1;1\n"
        "01;0;02/04/2020;1;1;1;1\n;0;2020-04-03;1;1;1;1\n"
        "01;0;2020-04-04;1;1;1;1;9\n01;0\n"
    )
    plain = format_snapshot(spark, lake, PANEL, "P")
    assert (plain["rows_in"], plain["rows_out"]) == (6, 5)
    assert "left_out" not in plain and "quarantined" not in plain
    told = format_snapshot(
        spark, lake, PANEL, "P", cleaning=published_cleaning(PANEL), quarantine=True
    )
    assert (told["rows_in"], told["quarantined"], told["rows_out"]) == (4, 2, 2)
    assert told["left_out"] == {"null": 1, "duplicates": 1}
    days = [r.date for r in spark.read.parquet(lake.formatted(PANEL)).orderBy("date").collect()]
    assert days == [date(2020, 4, 1), date(2020, 4, 2)]
    reasons = {r.reason for r in spark.read.parquet(lake.quarantine(PANEL)).collect()}
    assert reasons == {"surplus cells", "missing cells"}


def test_cleaning_rules(spark):
    rows = [(1, 30), (1, 30), (2, 130), (3, None), (4, -1), (None, 5)]
    df = spark.createDataFrame(rows, "id int, age int")

    def run(rules):
        cleaned, counts = clean(df, rules)
        found = sorted(map(tuple, cleaned.collect()), key=repr)
        return found, {rule: count.get["rows"] for rule, count in counts.items()}

    assert run(Cleaning()) == (sorted(rows, key=repr), {})
    assert run(Cleaning(ranges={"age": (0, 120), "height": (0, 3)})) == (
        sorted([(1, 30), (1, 30), (3, None), (None, 5)], key=repr),
        {"out_of_range_age": 2},
    )
    assert run(Cleaning(nulls="drop", null_columns=("id",), remove_duplicates=True)) == (
        [(1, 30), (2, 130), (3, None), (4, -1)],
        {"null": 1, "duplicates": 1},
    )
    filled, _ = run(Cleaning(nulls="fill", null_columns=("age",)))
    assert (3, 0) in filled and (None, 5) in filled
    with pytest.raises(FeedRejected, match="absent"):
        clean(df, Cleaning(nulls="drop", null_columns=("absent",)))
    with pytest.raises(ValueError, match="name the columns"):
        clean(df, Cleaning(nulls="drop"))
    empty, count = deduped_and_counted(df.limit(0), "none")
    assert empty.collect() == [] and count.get["rows"] == 0


# --- documents


def test_documents_beyond_their_types_are_rejected(spark, tmp_path):
    schema = "date string, country string, total_cases decimal(25,0), avg_age double"
    rows = [
        ("2024-01-01", "A", 5, 1.5), ("2024-01-02", "A", 2**31 - 1, None),
        ("2024-01-03", "A", 2**31, 1.0), ("2024-01-04", "A", -(2**31) - 1, 1e39),
        ("2024-01-05", "A", 10**22, 1.0), ("no day", "B", None, float("nan")),
        (None, "C" * 40_000, 1, 1.0),
    ]
    from decimal import Decimal

    rows = [(d, c, None if n is None else Decimal(n), a) for d, c, n, a in rows]
    fields = {
        "date": "date", "country": "keyword", "total_cases": "integer", "avg_age": "float",
    }
    documents = checked_documents(spark.createDataFrame(rows, schema), fields=fields, keep=["date"])
    told = [sorted(r.problems) for r in documents.collect()]
    number, real = "total_cases is no 32-bit integer", "avg_age is no single-precision number"
    assert told == [
        [], [], [number], sorted([number, real]), [number], ["date is no date"],
        ["country is too long a keyword"],
    ]
    path = str(tmp_path / "index")
    assert write_checked_bulk(documents, path, "i", fields=fields) == {
        "given": 7, "written": 2, "rejected": 5,
    }
    assert read_rejected(spark, path).count() == 5


def test_lost_documents_are_an_error(spark, tmp_path, monkeypatch):
    documents = checked_documents(spark.createDataFrame([(1,), (2,)], "total_cases int"))
    write = documents_module.write_bulk
    monkeypatch.setattr(
        documents_module, "write_bulk", lambda df, *rest, **more: write(df.limit(1), *rest, **more)
    )
    with pytest.raises(RuntimeError, match="lost"):
        write_checked_bulk(documents, str(tmp_path / "index"), "i")


# --- inference and inputs


def test_types_are_the_meet_of_all_cells(spark, tmp_path):
    columns = {
        "int": ["1", "-2147483648", None],
        "bigint": ["1", "2147483648", "-9223372036854775808"],
        "double": ["1", "2.5", "1e300"],
        "real": [".5", "9223372036854775808.0", "Infinity"],
        "text": ["1", "x", "2"],
        "huge": ["1", "99999999999999999999", "2"],
        "date": ["2024-02-29", None, "1999-12-31"],
        "noday": ["2024-02-30", "2024-02-01", "2024-02-01"],
        "moment": ["2024-02-29", "2024-02-29 10:11:12", "2024-02-29T10:11:12.5Z"],
        "truth": ["true", "False", None],
        "mixed": ["true", "1", "2024-01-01"],
        "empty": [None, None, None],
    }
    expected = {
        "int": "int", "bigint": "bigint", "double": "double", "real": "double", "text": "string",
        "huge": "double", "date": "date", "noday": "string", "moment": "timestamp",
        "truth": "boolean", "mixed": "string", "empty": "string",
    }
    rows = list(zip(*columns.values(), strict=True))
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).repartition(3)
    path = str(tmp_path / "csv")
    df.write.option("header", True).csv(path)
    texts = read_text_csv(spark, path)
    types = infer_types(texts)
    assert {r.column: r.type for r in types.collect()} == expected
    plan = infer_types(texts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    typed = read_inferred_csv(spark, path)
    assert dict(typed.dtypes) == expected
    assert typed.agg(F.sum("bigint")).first()[0] == 1 + 2147483648 - 9223372036854775808
    assert {r.type for r in infer_types(texts.limit(0)).collect()} == {"string"}


def test_inputs_present(spark, tmp_path):
    (tmp_path / "hollow").mkdir()
    (tmp_path / "hollow" / "_SUCCESS").write_text("x")
    write_table(spark.range(3), str(tmp_path / "table"))
    paths = {name: str(tmp_path / name) for name in ("hollow", "table", "absent")}
    found = {r.input: (r.present, r.files > 0) for r in inputs_present(spark, paths).collect()}
    assert found == {"hollow": (True, False), "table": (True, True), "absent": (False, False)}


def test_landing_with_quarantine_loses_no_line(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    rows = [("01", "0", "2020-04-01", "1", 'a"b', "1\n2"), ("02", "0", "x;y", None, '"', "")]
    raw = spark.createDataFrame(rows, "dep string, sexe string, jour string, hosp string, rea string, dc string").withColumn("rad", F.lit("1"))
    land(raw, lake, PANEL, "2024-01-31")
    assert read_checked_csv(spark, f"{lake.raw}/panel/2024-01-31").rejects.count() == 0
    land_snapshot(raw, lake.raw, PANEL, "2024-02-01", sep=";")
    checked = read_checked_csv(spark, f"{lake.raw}/panel/2024-02-01")
    assert checked.rejects.count() == 0
    assert sorted(r.jour for r in checked.rows.collect()) == ["2020-04-01", "x;y"]
