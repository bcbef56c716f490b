"""Monthly series, baseline forecasts, holdout evaluation, model choice and intervals.

A series is short (one value per month), so each is one row with an ordered array; every model is an expression
over that array and all series are forecast in one job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.config import Z_95, ForecastSettings
from tallystone.session import materialize

METRICS = (
    "revenue", "operating_expense", "accounts_receivable", "accounts_payable", "operating_cf", "ending_cash",
)
# Models in order of preference on equal error.
MODEL_RANK = ("naive", "seasonal_naive", "exponential_smoothing", "gradient_boosting")
KEYS = ["entity_id", "metric"]
LAGS = (1, 2, 3, 12)
ROLLING = 3

Model = Callable[[DataFrame, int], DataFrame]


def forecast_panel(statement: DataFrame, sheet: DataFrame, flow: DataFrame) -> DataFrame:
    """The six forecast metrics per entity and month."""
    on = ["entity_id", "period"]
    return (
        statement.select(*on, "revenue", "operating_expense")
        .join(sheet.select(*on, "accounts_receivable", "accounts_payable", F.col("cash").alias("ending_cash")), on)
        .join(flow.select(*on, "operating_cf"), on)
        .select(*on, *[F.col(m).cast("double").alias(m) for m in METRICS])
    )


def to_series(panel: DataFrame) -> DataFrame:
    """Long series: (entity_id, metric, period, value)."""
    return panel.unpivot(["entity_id", "period"], list(METRICS), "metric", "value")


def lag_features(series: DataFrame) -> DataFrame:
    """Training rows: lagged values, mean of the three prior values, month on a circle, trend index.

    Rows without every lag are dropped."""
    order = Window.partitionBy(*KEYS).orderBy("period")
    angle = 2 * F.pi() * F.month("period") / 12
    rolling = F.avg("value").over(order.rowsBetween(-ROLLING, -1))
    return series.select(
        *KEYS, "period", F.col("value").alias("target"),
        *[F.lag("value", k).over(order).alias(f"lag_{k}") for k in LAGS],
        F.when(F.row_number().over(order) > ROLLING, rolling).alias("rolling_mean"),
        F.sin(angle).alias("month_sin"), F.cos(angle).alias("month_cos"),
        (F.row_number().over(order) - 1).alias("trend_index"),
    ).dropna()


def time_split(series: DataFrame, validation_months: int) -> DataFrame:
    """Mark the last rows of every series as validation; order is kept, nothing is shuffled at random."""
    backwards = Window.partitionBy(*KEYS).orderBy(F.col("period").desc())
    return series.withColumn("is_validation", F.row_number().over(backwards) <= validation_months)


def to_arrays(series: DataFrame) -> DataFrame:
    """One row per series: ordered values and the last month."""
    ordered = F.array_sort(F.collect_list(F.struct("period", "value")))
    return series.groupBy(*KEYS).agg(ordered.alias("points")).select(
        *KEYS,
        F.transform("points", lambda p: p["value"]).alias("values"),
        F.element_at("points", -1)["period"].alias("last_period"),
    )


def split_arrays(arrays: DataFrame, validation_months: int) -> DataFrame:
    """Training prefix as `values`, held-out tail as `actuals`."""
    n_train = F.size("values") - validation_months
    return arrays.where(n_train > 0).select(
        *KEYS,
        F.slice("values", F.lit(1), n_train).alias("values"),
        F.slice("values", n_train + 1, F.lit(validation_months)).alias("actuals"),
        F.add_months("last_period", F.lit(-validation_months)).alias("last_period"),
    )


def expand_forecast(arrays: DataFrame, model: str, values: Column) -> DataFrame:
    """A model's forecast array as rows (keys, model, step, forecast)."""
    steps = arrays.select(*KEYS, F.posexplode(values).alias("position", "forecast"))
    return steps.select(
        *KEYS, F.lit(model).alias("model"), (F.col("position") + 1).cast("int").alias("step"), "forecast"
    )


def _steps(horizon: int) -> Column:
    return F.sequence(F.lit(1), F.lit(horizon))


def naive_values(horizon: int) -> Column:
    return F.transform(_steps(horizon), lambda _: F.element_at("values", -1))


def naive(arrays: DataFrame, horizon: int) -> DataFrame:
    """The last value, repeated."""
    return expand_forecast(arrays, "naive", naive_values(horizon))


def seasonal_naive(arrays: DataFrame, horizon: int, season: int = 12) -> DataFrame:
    """The last season, cycled; the last value where there is no full season."""
    start = F.size("values") - season
    cycled = F.transform(
        _steps(horizon), lambda s: F.element_at("values", (start + 1 + (s - 1) % season).cast("int"))
    )
    chosen = F.when(start >= 0, cycled).otherwise(naive_values(horizon))
    return expand_forecast(arrays, "seasonal_naive", chosen)


BASELINES: dict[str, Model] = {"naive": naive, "seasonal_naive": seasonal_naive}


def all_models() -> dict[str, Model]:
    """Every model, by name: those that compete unless a caller names others."""
    from tallystone.operators.boosting import gradient_boosting
    from tallystone.operators.smoothing import exponential_smoothing

    return {**BASELINES, "exponential_smoothing": exponential_smoothing, "gradient_boosting": gradient_boosting}


def forecast_all(arrays: DataFrame, horizon: int, models: dict[str, Model]) -> DataFrame:
    frames = [model(arrays, horizon) for model in models.values()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def holdout(arrays: DataFrame, models: dict[str, Model], settings: ForecastSettings) -> DataFrame:
    """Forecasts of the held-out months from the training prefix only, beside the actual values."""
    split = split_arrays(arrays, settings.validation_months)
    actuals = split.select(*KEYS, F.posexplode("actuals").alias("position", "actual")).select(
        *KEYS, (F.col("position") + 1).cast("int").alias("step"), "actual"
    )
    predicted = forecast_all(split.drop("actuals"), settings.validation_months, models)
    return predicted.join(actuals, [*KEYS, "step"])


def error_metrics(compared: DataFrame) -> DataFrame:
    """MAE, RMSE, MAPE and symmetric MAPE per series and model. Zero denominators are skipped."""
    error = F.abs(F.col("actual") - F.col("forecast"))
    size = F.abs("actual") + F.abs("forecast")
    return compared.groupBy(*KEYS, "model").agg(
        F.avg(error).alias("mae"),
        F.sqrt(F.avg(F.pow(F.col("actual") - F.col("forecast"), F.lit(2.0)))).alias("rmse"),
        (F.avg(F.when(F.col("actual") != 0, error / F.abs("actual"))) * 100).alias("mape"),
        (F.avg(F.when(size != 0, 2 * error / size)) * 100).alias("smape"),
    )


def model_rank(model: Column) -> Column:
    return F.array_position(F.lit(list(MODEL_RANK)), model)


def select_models(metrics: DataFrame) -> DataFrame:
    """Mark the model with the lowest RMSE per series; ties go to the simpler model."""
    order = Window.partitionBy(*KEYS).orderBy("rmse", model_rank(F.col("model")))
    return metrics.withColumn("selected", F.row_number().over(order) == 1)


def residual_deviation(compared: DataFrame) -> DataFrame:
    """Sample deviation of the holdout residuals per series and model; with a single one its size."""
    residual = F.col("actual") - F.col("forecast")
    return compared.groupBy(*KEYS, "model").agg(
        F.coalesce(F.stddev_samp(residual), F.avg(F.abs(residual))).alias("residual_std")
    )


def with_intervals(forecasts: DataFrame, deviation: DataFrame) -> DataFrame:
    """95 % interval that widens with the square root of the step."""
    width = Z_95 * F.col("residual_std") * F.sqrt(F.col("step").cast("double"))
    return (
        forecasts.join(deviation, [*KEYS, "model"])
        .withColumn("ci_lower", F.col("forecast") - width)
        .withColumn("ci_upper", F.col("forecast") + width)
        .drop("residual_std")
    )


def build_forecasts(
    series: DataFrame, models: dict[str, Model] | None = None, settings: ForecastSettings | None = None
) -> tuple[DataFrame, DataFrame]:
    """(forecasts, evaluation): every model scored on the holdout, the winner of each series refit on the whole of it."""
    settings, models = settings or ForecastSettings(), models or all_models()
    arrays = to_arrays(series)
    # The fitted holdout feeds the metrics and the deviations: written once, models are not fitted twice for it.
    compared = materialize(holdout(arrays, models, settings), "holdout")
    evaluation = select_models(error_metrics(compared))
    winners = materialize(evaluation.where("selected").select(*KEYS, "model"), "winners")

    def refit(name: str, model: Model) -> Model:
        won = winners.where(F.col("model") == name)
        return lambda series, horizon: model(series.join(won, KEYS, "left_semi"), horizon)

    future = forecast_all(arrays, settings.horizon, {name: refit(name, model) for name, model in models.items()})
    dated = with_intervals(future, residual_deviation(compared)).join(
        arrays.select(*KEYS, "last_period"), KEYS
    )
    forecasts = dated.select(
        *KEYS, F.add_months("last_period", F.col("step")).alias("period"), "step", "forecast", "model",
        "ci_lower", "ci_upper",
    )
    return forecasts, evaluation


def model_wins(evaluation: DataFrame) -> DataFrame:
    return evaluation.where("selected").groupBy("model").agg(F.count(F.lit(1)).alias("n_series"))
