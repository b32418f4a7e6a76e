import json
import shutil
from datetime import datetime
from pathlib import Path

import pytest

from feedlake.__main__ import main
from feedlake.feeds import LINE_LIST, PANEL
from feedlake.operators.quality import FeedRejected
from feedlake.plans.jobs import (
    Lake,
    combine,
    format_snapshot,
    index,
    land,
    model_trend,
    run_pipeline,
    run_stages,
)

DAY = "2024-01-31"


@pytest.fixture(scope="module")
def sources(tmp_path_factory):
    folder = tmp_path_factory.mktemp("sources")
    panel = ["dep;sexe;jour;hosp;rea;HospConv;SSR_USLD;autres;rad;dc"]
    for d in range(1, 31):
        panel += [
            f"01;0;2020-04-{d:02d};{10 * d};{d};;;;{d}.0;{2 * d}",
            f"01;1;2020-04-{d:02d};{4 * d};{d};;;;{d};{d}",
            f"02;0;2020-04-{d:02d};{5 * d};;;;;;",
            f"03;0;2020-04-{d:02d};;;;;;9;",
        ]
    cases = ["fecha_reporte_web,id_de_caso,departamento_nom,edad,sexo,estado"]
    for d in range(1, 11):
        cases += [
            f"2020-04-{d:02d} 00:00:00,{d}a,X,40,m,Fallecido",
            f"2020-04-{d:02d}T00:00:00.000,{d}b,Y,20,F,Recuperado",
            f"unknown,{d}c,Y,20,F,Recuperado",
        ]
    (folder / "panel.csv").write_text("\n".join(panel) + "\n")
    (folder / "cases.csv").write_text("\n".join(cases) + "\n")
    return folder


def read_sources(spark, folder):
    return (
        spark.read.csv(str(folder / "panel.csv"), header=True, sep=";"),
        spark.read.csv(str(folder / "cases.csv"), header=True),
    )


@pytest.fixture(scope="module")
def finished(spark, sources, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("lake")))
    results = run_pipeline(spark, lake, *read_sources(spark, sources), "P", "L", DAY)
    return lake, {r.name: r for r in results}


def test_every_stage_succeeds_and_counts(finished):
    _, results = finished
    assert all(r.ok for r in results.values()), [r.error for r in results.values()]
    assert list(results) == [
        "land_panel", "land_linelist", "format_panel", "format_linelist", "combine",
        "model_trend", "index",
    ]
    assert results["land_panel"].details["rows"] == 120
    formatted = results["format_panel"].details
    assert (formatted["rows_in"], formatted["rows_out"]) == (120, 90)
    formatted = results["format_linelist"].details
    assert (formatted["rows_in"], formatted["rows_out"]) == (30, 20)
    assert results["combine"].details["rows"] == 40
    assert results["index"].details["documents"] == 40


def test_all_outputs_exist(finished):
    lake, _ = finished
    for path in (
        f"{lake.raw}/panel/{DAY}", f"{lake.raw}/linelist/{DAY}", lake.formatted(PANEL),
        lake.formatted(LINE_LIST), lake.usage("daily_comparison"),
        lake.usage("daily_comparison_csv"), lake.usage("summary_stats"),
        lake.usage("summary_stats_csv"), lake.usage("trend_metrics"),
        lake.usage("trend_forecast"), lake.usage("index/bulk"),
    ):
        assert (Path(path) / "_SUCCESS").exists() and list(Path(path).glob("part-*")), path


def test_summary_values(spark, finished):
    lake, _ = finished
    rows = {r.country: r for r in spark.read.parquet(lake.usage("summary_stats")).collect()}
    assert (rows["P"].total_days, rows["P"].peak_hospitalizations) == (30, 450)
    assert (rows["P"].cumulative_deaths, rows["P"].latest_deaths) == (930, 60)
    assert (rows["L"].cumulative_cases, rows["L"].avg_mortality_rate) == (20, 50.0)


def test_trend_of_a_straight_line(spark, finished):
    lake, results = finished
    assert results["model_trend"].details["slope"] == pytest.approx(15.0)
    assert results["model_trend"].details["intercept"] == pytest.approx(15.0)
    metrics = spark.read.json(lake.usage("trend_metrics")).first()
    assert metrics.rmse == pytest.approx(0, abs=1e-6) and metrics.r2 == pytest.approx(1)
    forecast = spark.read.parquet(lake.usage("trend_forecast"))
    assert [r.predicted for r in forecast.orderBy("day_number").head(2)] == [465.0, 480.0]


def test_one_timestamp_for_all_copies(spark, finished):
    lake, _ = finished
    daily = spark.read.parquet(lake.usage("daily_comparison"))
    copy = spark.read.csv(lake.usage("daily_comparison_csv"), header=True, inferSchema=True)
    assert daily.select("processed_at").distinct().count() == 1
    assert copy.select("processed_at").distinct().count() == 1


def test_running_again_replaces_everything(spark, finished, sources):
    lake, before = finished
    after = run_pipeline(spark, lake, *read_sources(spark, sources), "P", "L", DAY)
    assert [r.ok for r in after] == [True] * 7
    assert after[4].details["rows"] == before["combine"].details["rows"]
    assert after[6].details["documents"] == before["index"].details["documents"]


def test_zero_dialect(spark, finished, tmp_path):
    lake, _ = finished
    other = Lake(str(tmp_path))
    shutil.copytree(lake.raw, other.raw)
    kept = format_snapshot(spark, other, PANEL, "P", DAY, all_rows=True)
    assert (kept["day"], kept["rows_in"], kept["rows_out"]) == (DAY, 120, 120)
    format_snapshot(spark, other, LINE_LIST, "L", DAY)
    assert combine(spark, other, missing="zero")["rows"] == 40
    daily = spark.read.parquet(other.usage("daily_comparison"))
    assert daily.where("country = 'P' and date = '2020-04-01'").first()[2:] == (
        0, 19, 2, 3, 11, 3, 0.0,
    )
    assert index(spark, other, missing="zero")["documents"] == 40
    assert model_trend(spark, other, "P")["slope"] == pytest.approx(19.0)
    [mapping] = Path(other.usage("index/mapping")).glob("part-*")
    assert json.loads(mapping.read_text())["mappings"]["properties"]["total_icu"] == {
        "type": "float"
    }
    with pytest.raises(ValueError, match="maybe"):
        combine(spark, other, missing="maybe")


def test_fixed_processing_time(spark, finished):
    lake, _ = finished
    stamp = datetime(2024, 1, 31, 12)
    combine(spark, lake, processed_at=stamp)
    daily = spark.read.parquet(lake.usage("daily_comparison"))
    assert {r.processed_at for r in daily.select("processed_at").collect()} == {stamp}


def test_later_stages_run_after_a_failure():
    def broken():
        raise RuntimeError("no disk")

    results = run_stages({"a": broken, "b": lambda: {"rows": 1}})
    assert [(r.ok, r.error, r.details) for r in results] == [
        (False, "RuntimeError: no disk", {}),
        (True, None, {"rows": 1}),
    ]


def test_a_refused_landing_is_not_replaced_by_an_older_day(spark, sources, tmp_path):
    lake = Lake(str(tmp_path))
    panel, _ = read_sources(spark, sources)
    land(panel, lake, PANEL, DAY)
    with pytest.raises(FeedRejected):
        land(panel.drop("rea"), lake, PANEL, "2024-02-01")
    with pytest.raises(FileNotFoundError, match="2024-02-01"):
        format_snapshot(spark, lake, PANEL, "P", "2024-02-01")
    assert format_snapshot(spark, lake, PANEL, "P")["day"] == DAY


def test_daily_csv_is_in_key_order(spark, finished):
    lake, _ = finished
    parts = sorted(Path(lake.usage("daily_comparison_csv")).glob("part-*.csv"))
    keys = [tuple(x.split(",")[:2]) for p in parts for x in p.read_text().splitlines()[1:]]
    assert len(keys) == 40 and keys == sorted(keys)


def test_missing_layers_are_reported(spark, tmp_path):
    results = run_stages(
        {
            "format": lambda: format_snapshot(spark, Lake(str(tmp_path)), PANEL, "P"),
            "combine": lambda: combine(spark, Lake(str(tmp_path))),
        }
    )
    assert [r.ok for r in results] == [False, False]
    assert "FileNotFoundError" in results[0].error and "PATH_NOT_FOUND" in results[1].error


def test_bad_feeds_are_not_landed_or_formatted(spark, tmp_path):
    lake = Lake(str(tmp_path))
    with pytest.raises(FeedRejected):
        land(spark.createDataFrame([("1",)], "dep string"), lake, PANEL, DAY)
    assert not Path(lake.raw).exists()
    unusable = spark.createDataFrame([("unknown", "X")], "fecha_x string, departamento string")
    unusable = unusable.withColumnRenamed("fecha_x", "fecha_reporte_web")
    land(unusable, lake, LINE_LIST, DAY)
    with pytest.raises(FeedRejected, match="formatted linelist has no rows"):
        format_snapshot(spark, lake, LINE_LIST, "L", DAY)
    assert not Path(lake.formatted(LINE_LIST)).exists()


def test_command_line(spark, sources, tmp_path, capsys):
    arguments = ["--root", str(tmp_path / "lake"), "--day", DAY]
    feeds = ["--panel", str(sources / "panel.csv"), "--linelist", str(sources / "cases.csv")]
    assert main(arguments + feeds) == 0
    assert main([*arguments, "--missing", "zero", "--panel-country", "P"]) == 0
    assert "index: ok" in capsys.readouterr().out
    assert main(["--root", str(tmp_path / "nothing")]) == 1
    [part] = (tmp_path / "lake/usage/trend_metrics").glob("part-*.json")
    assert set(json.loads(part.read_text())) == {"rmse", "r2"}
