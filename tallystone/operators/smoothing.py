"""Exponential smoothing with additive trend and, from two full seasons on, an additive season.

The weights of each series are found by a pattern search for the least squared one-step error, started from the best point of a grid:
see `fit_weights`."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.operators.forecasting import KEYS, expand_forecast, naive_values

SEASON = 12
MIN_SEASONAL = 24
STATE = "struct<level:double,trend:double,season:array<double>,sse:double>"
# Smoothing weights of level, trend and season that the search starts from.
GRID = ((0.1, 0.3, 0.5, 0.7, 0.9), (0.0, 0.1, 0.3, 0.6, 0.9), (0.0, 0.1, 0.3, 0.6, 0.9))
FIRST_STEP, LEAST_STEP, ROUNDS = 0.1, 0.002, 60


def _mean(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda a, x: a + x) / F.size(array)


def _start(seasonal: Column) -> Column:
    """State after the first season: the trend between the first two seasons' means, the level moved along it to
    the season's end, and the season's deviations from that line."""
    first, second = F.slice("values", 1, SEASON), F.slice("values", SEASON + 1, SEASON)
    trend, centre = (_mean(second) - _mean(first)) / SEASON, (SEASON - 1) / 2
    with_season = F.struct(
        (_mean(first) + trend * centre).alias("level"),
        trend.alias("trend"),
        F.transform(first, lambda v, i: v - _mean(first) - trend * (i - centre)).alias("season"),
        F.lit(0.0).alias("sse"),
    ).cast(STATE)
    plain = F.struct(
        F.element_at("values", 1).alias("level"),
        (F.element_at("values", 2) - F.element_at("values", 1)).alias("trend"),
        F.array_repeat(F.lit(0.0), SEASON).alias("season"),
        F.lit(0.0).alias("sse"),
    ).cast(STATE)
    return F.when(seasonal, with_season).otherwise(plain)


def _fold(state: Column, y: Column, p: Column) -> Column:
    season = F.element_at(state["season"], 1)
    base = state["level"] + state["trend"]
    level = p["alpha"] * (y - season) + (1 - p["alpha"]) * base
    trend = p["beta"] * (level - state["level"]) + (1 - p["beta"]) * state["trend"]
    current = p["gamma"] * (y - level) + (1 - p["gamma"]) * season
    return F.struct(
        level.alias("level"), trend.alias("trend"),
        F.concat(F.slice(state["season"], 2, SEASON - 1), F.array(current)).alias("season"),
        (state["sse"] + F.pow(y - base - season, F.lit(2.0))).alias("sse"),
    ).cast(STATE)


def _seasonal() -> Column:
    return F.size("values") >= MIN_SEASONAL


def _smoothed(weights: Column) -> Column:
    """The state after the whole series, smoothed with the given weights."""
    first = F.when(_seasonal(), F.lit(SEASON + 1)).otherwise(F.lit(2))
    rest = F.slice("values", first, F.greatest(F.size("values"), F.lit(1)))
    return F.aggregate(rest, _start(_seasonal()), lambda state, y: _fold(state, y, weights))


def _candidate(alpha: Column, beta: Column, gamma: Column, moved: int, step: Column) -> Column:
    """Weights with their error, in an order that puts the least error first and, if tied, staying before moving."""
    bounded = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    weights = F.struct(
        bounded(alpha).alias("alpha"), bounded(beta).alias("beta"), F.when(_seasonal(), bounded(gamma)).otherwise(F.lit(0.0)).alias("gamma")
    )
    return F.struct(
        _smoothed(weights)["sse"].alias("sse"), F.lit(moved).alias("moved"), weights.alias("weights"), step.alias("step")
    )


def fit_weights(arrays: DataFrame) -> DataFrame:
    """keys, values, weights, sse and rounds-end step of every series of two values or more.

    Each series starts from the best point of GRID. A round tries a step up and down in each weight; it moves to the best of the
    six if that lowers the squared error, else it halves the step. A series stops when its step is below LEAST_STEP, or after ROUNDS
    rounds. So the result is never worse than the grid. All of it is one expression over the row of a series: no shuffle, and no
    round is a job."""
    usable = arrays.where(F.size("values") >= 2).select(*KEYS, "values")
    grid = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("a", "b", "c"), point)]) for point in itertools.product(*GRID)])
    start = F.array_min(F.transform(grid, lambda g: _candidate(g["a"], g["b"], g["c"], 0, F.lit(FIRST_STEP))))
    moves = F.array(*[
        F.struct(*[F.lit(sign if i == axis else 0.0).alias(n) for i, n in enumerate(("a", "b", "c"))]) for axis in range(3) for sign in (-1.0, 1.0)
    ])

    def round_of(at: Column, _: Column) -> Column:
        here, step = at["weights"], at["step"]
        stay = F.struct(at["sse"].alias("sse"), F.lit(0).alias("moved"), here.alias("weights"), (step / 2).alias("step"))
        tried = F.transform(
            moves, lambda m: _candidate(here["alpha"] + m["a"] * step, here["beta"] + m["b"] * step, here["gamma"] + m["c"] * step, 1, step)
        )
        return F.when(step < LEAST_STEP, at).otherwise(F.array_min(F.concat(F.array(stay), tried)))

    begun = usable.withColumn("start", start)
    fitted = begun.withColumn("end", F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.col("start"), round_of))
    return fitted.select(*KEYS, "values", "end.weights", "end.sse", F.col("start.sse").alias("grid_sse"), "end.step")


def smoothed_states(weighted: DataFrame) -> DataFrame:
    """keys and state of series with weights: level, trend, season of the next twelve months, squared error."""
    return weighted.select(*KEYS, _smoothed(F.col("weights")).alias("state"))


def exponential_smoothing(arrays: DataFrame, horizon: int) -> DataFrame:
    """Forecast of every series; one without two values repeats its last value."""
    states = smoothed_states(fit_weights(arrays))
    state = F.col("state")
    future = F.transform(
        F.sequence(F.lit(1), F.lit(horizon)),
        lambda s: state["level"] + s * state["trend"]
        + F.element_at(state["season"], ((s - 1) % SEASON + 1).cast("int")),
    )
    short = expand_forecast(arrays.where(F.size("values") < 2), "exponential_smoothing", naive_values(horizon))
    return expand_forecast(states, "exponential_smoothing", future).unionByName(short)
