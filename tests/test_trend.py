from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from feedlake.operators.trend import (
    fit_trend,
    future_days,
    predict_days,
    trend_coefficients,
    trend_features,
    trend_forecast,
    trend_metrics,
    trend_split,
)

FIRST = date(2020, 3, 18)


@pytest.fixture(scope="module")
def daily(spark):
    # The first day has no value, a second series starts earlier, one day is left out.
    rows = [(FIRST, "P", None)]
    rows += [
        (FIRST + timedelta(days=d), "P", 100 + 3 * d + (d * 37) % 11)
        for d in range(1, 60)
        if d != 20
    ]
    rows += [(FIRST - timedelta(days=9), "L", 5)]
    return spark.createDataFrame(rows, "date date, country string, total_hospitalizations long")


@pytest.fixture(scope="module")
def features(daily):
    return trend_features(daily, country="P")


def test_day_zero_is_the_first_date_even_without_a_value(daily, features):
    rows = features.orderBy("date").collect()
    assert rows[0].date == FIRST + timedelta(days=1)
    assert rows[0].day_number == 1
    assert len(rows) == 58
    assert trend_features(daily).orderBy("date").first().day_number == 0


def test_dates_may_be_text(daily, features):
    text = daily.withColumn("date", daily.date.cast("string"))
    assert sorted(trend_features(text, country="P").collect()) == sorted(features.collect())


def test_split_is_deterministic_and_whole(features):
    train, test = trend_split(features)
    assert train.count() + test.count() == features.count()
    assert {r.day_number % 5 for r in test.collect()} == {0}
    train_again, _ = trend_split(features.repartition(7))
    assert sorted(train.collect()) == sorted(train_again.collect())


def test_random_split_is_whole(features):
    train, test = trend_split(features, at_random=True)
    assert train.count() + test.count() == features.count()


def test_fit_equals_least_squares(features):
    train, _ = trend_split(features)
    rows = train.collect()
    slope, intercept = np.polyfit([r.day_number for r in rows], [r.label for r in rows], 1)
    model = fit_trend(train)
    assert model.coefficients[0] == pytest.approx(slope, rel=1e-9)
    assert model.intercept == pytest.approx(intercept, rel=1e-9)
    lazy = trend_coefficients(train).first()
    assert (lazy.slope, lazy.intercept) == pytest.approx((slope, intercept), rel=1e-9)


def test_metrics_equal_the_evaluator(features):
    train, test = trend_split(features)
    predicted = predict_days(fit_trend(train), test)
    row = trend_metrics(predicted).first()
    for name, value in (("rmse", row.rmse), ("r2", row.r2)):
        assert value == pytest.approx(RegressionEvaluator(metricName=name).evaluate(predicted))


def test_metrics_of_a_constant_label_have_no_r2(spark):
    predicted = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "label double, prediction double")
    assert tuple(trend_metrics(predicted).first()) == (1.0, None)


def test_forecast_follows_the_last_day(features):
    assert [r.day_number for r in future_days(features, 3).collect()] == [60, 61, 62]
    train, _ = trend_split(features)
    model = fit_trend(train)
    rows = trend_forecast(model, features).orderBy("day_number").collect()
    assert [r.day_number for r in rows] == list(range(60, 90))
    for row in rows:
        assert row.predicted == round(model.intercept + model.coefficients[0] * row.day_number)
