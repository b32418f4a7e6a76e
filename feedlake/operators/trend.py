"""Linear trend of a daily measure: features, split, fit, evaluation and forecast.

All inputs are day tables. Hand in a written one (the combined table, or ``plans.shared.settle``),
since fitting and evaluating read it several times.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Split, fit and forecast settings.
TEST_EVERY = 5
SPLIT_WEIGHTS = (0.8, 0.2)
SPLIT_SEED = 42
MAX_ITERATIONS = 100
FORECAST_DAYS = 30


def trend_features(
    daily: DataFrame, measure: str = "total_hospitalizations", country: str | None = None
) -> DataFrame:
    """Date, day number and label. Day 0 is the first date, even if it has no value itself.

    Dates may be text, as in the zero-filled form and in CSV copies.
    """
    series = daily.where(F.col("country") == country) if country else daily
    series = series.withColumn("date", F.col("date").try_cast("date"))
    first_day = series.agg(F.min("date")).scalar()
    return (
        series.where(F.col(measure).isNotNull())
        .select(
            "date",
            F.datediff("date", first_day).alias("day_number"),
            F.col(measure).cast("double").alias("label"),
        )
        .na.fill(0, ["day_number"])
    )


def is_test_day() -> Column:
    """Every fifth day. Unlike a random split it does not depend on partitions or row order."""
    return F.pmod("day_number", F.lit(TEST_EVERY)) == 0


def trend_split(features: DataFrame, at_random: bool = False) -> tuple[DataFrame, DataFrame]:
    """Training and test part, about 80 to 20."""
    if at_random:
        train, test = features.randomSplit(list(SPLIT_WEIGHTS), seed=SPLIT_SEED)
        return train, test
    return features.where(~is_test_day()), features.where(is_test_day())


def _vectors(days: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=["day_number"], outputCol="features").transform(days)


def fit_trend(train: DataFrame) -> LinearRegressionModel:
    """Ordinary least squares of the label on the day number, without regularisation."""
    return LinearRegression(maxIter=MAX_ITERATIONS).fit(_vectors(train))


def trend_coefficients(train: DataFrame) -> DataFrame:
    """Slope and intercept of the same fit as a lazy aggregation."""
    return train.agg(
        F.regr_slope("label", "day_number").alias("slope"),
        F.regr_intercept("label", "day_number").alias("intercept"),
    )


def predict_days(model: LinearRegressionModel, days: DataFrame) -> DataFrame:
    """Adds ``prediction`` to rows with a day number."""
    return model.transform(_vectors(days)).drop("features")


def trend_metrics(predicted: DataFrame) -> DataFrame:
    """One row with RMSE and R² of predictions against labels, from one pass."""
    error = F.col("label") - F.col("prediction")
    squared_error = error * error
    return predicted.agg(
        F.sqrt(F.avg(squared_error)).alias("rmse"),
        (1 - F.try_divide(F.avg(squared_error), F.var_pop("label"))).alias("r2"),
    )


def future_days(features: DataFrame, days: int = FORECAST_DAYS) -> DataFrame:
    """The day numbers that follow the last one."""
    last = F.max("day_number")
    return features.agg(F.sequence(last + 1, last + days).alias("ahead")).select(
        F.explode("ahead").alias("day_number")
    )


def trend_forecast(
    model: LinearRegressionModel, features: DataFrame, days: int = FORECAST_DAYS
) -> DataFrame:
    """Predictions for the days after the last one, rounded to whole numbers."""
    ahead = predict_days(model, future_days(features, days))
    return ahead.select("day_number", F.round("prediction", 0).alias("predicted"))
