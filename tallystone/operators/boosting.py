"""Gradient-boosted trees on lag features, forecasting several steps by feeding predictions back.

One model is fitted on all series together, each scaled by its own mean size, so the fit is a distributed job
whose work grows with the number of series. The recursive steps are projections of one row per series."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.operators.forecasting import KEYS, LAGS, ROLLING, expand_forecast, lag_features, naive_values

FEATURES = [*[f"lag_{k}" for k in LAGS], "rolling_mean", "month_sin", "month_cos", "trend_index"]
MIN_ROWS = 6
# Small shallow trees.
TREES, DEPTH, RATE = 50, 2, 0.1


def _scaled(arrays: DataFrame) -> DataFrame:
    size = F.aggregate("values", F.lit(0.0), lambda a, v: a + F.abs(v)) / F.size("values")
    scale = F.when(size > 0, size).otherwise(F.lit(1.0))
    return arrays.select(
        *KEYS, "last_period", scale.alias("scale"), F.transform("values", lambda v: v / scale).alias("history")
    )


def gradient_boosting(arrays: DataFrame, horizon: int, seed: int = 42) -> DataFrame:
    """Forecast of every series; one with fewer than six usable training rows repeats its last value."""
    enough = F.size("values") - max(LAGS) >= MIN_ROWS
    short = expand_forecast(arrays.where(~enough), "gradient_boosting", naive_values(horizon))
    scaled = _scaled(arrays.where(enough))
    if scaled.isEmpty():
        return short
    points = scaled.select(*KEYS, "last_period", F.size("history").alias("n"), F.posexplode("history").alias("i", "value"))
    series = points.select(
        *KEYS, F.expr("add_months(last_period, cast(i - n + 1 AS int))").alias("period"), "value"
    )
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    model = GBTRegressor(
        featuresCol="features", labelCol="target", predictionCol="prediction", maxIter=TREES, maxDepth=DEPTH,
        stepSize=RATE, seed=seed,
    ).fit(assembler.transform(lag_features(series)))

    state = scaled
    for step in range(1, horizon + 1):
        angle = 2 * F.pi() * F.month(F.add_months("last_period", step)) / 12
        state = state.select(
            *KEYS, "last_period", "scale", "history",
            *[F.element_at("history", -k).alias(f"lag_{k}") for k in LAGS],
            (sum((F.element_at("history", -k) for k in range(2, ROLLING + 1)), F.element_at("history", -1)) / ROLLING
             ).alias("rolling_mean"),
            F.sin(angle).alias("month_sin"), F.cos(angle).alias("month_cos"),
            F.size("history").cast("double").alias("trend_index"),
        )
        state = model.transform(assembler.transform(state)).select(
            *KEYS, "last_period", "scale", F.concat("history", F.array("prediction")).alias("history")
        )
    future = F.transform(F.slice("history", -horizon, horizon), lambda v: v * F.col("scale"))
    return expand_forecast(state, "gradient_boosting", future).unionByName(short)
