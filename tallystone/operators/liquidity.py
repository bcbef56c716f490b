"""Liquidity risk of consolidated cash paths, all scenarios in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.config import LiquiditySettings
from tallystone.functions.ranks import grouped_ranks, interpolated


def risk_score(probability: Column, settings: LiquiditySettings | None = None) -> Column:
    s = settings or LiquiditySettings()
    return (
        F.when(probability <= s.low_max, "LOW")
        .when(probability <= s.medium_max, "MEDIUM")
        .when(probability <= s.high_max, "HIGH")
        .otherwise("CRITICAL")
    )


def liquidity_metrics(paths: DataFrame, settings: LiquiditySettings | None = None) -> DataFrame:
    """Risk figures per scenario against a minimum cash requirement (strictly below is a breach)."""
    s = settings or LiquiditySettings()
    below = F.col("cash") < s.minimum_cash
    per_sim = paths.groupBy("scenario", "sim_id").agg(
        F.min("cash").alias("low"), F.max("cash").alias("high"), F.avg("cash").alias("mean_cash"),
        F.count_if(below).alias("months"),
    )
    breached = F.avg((F.col("months") > 0).cast("double"))
    result = per_sim.groupBy("scenario").agg(
        F.lit(s.minimum_cash).alias("minimum_cash_requirement"),
        breached.alias("probability_of_liquidity_breach"),
        F.avg("low").alias("expected_minimum_cash"),
        F.min("low").alias("worst_simulated_cash"),
        F.max("high").alias("best_simulated_cash"),
        F.avg("months").alias("avg_months_below_threshold"),
        F.max("months").alias("max_months_below_threshold"),
        (breached * 100).alias("pct_simulations_ever_breaching"),
        F.avg("mean_cash").alias("average_cash"),
    )
    return result.withColumn("risk_score", risk_score(F.col("probability_of_liquidity_breach"), s))


def liquidity_report(paths: DataFrame, settings: LiquiditySettings | None = None) -> DataFrame:
    """One row per scenario: its risk figures and, nested, its months. paths: consolidated."""
    months = breach_by_month(paths, settings)
    fields = F.struct("step", F.date_format("period", "yyyy-MM").alias("period"), "probability_of_breach", "median_cash", "p5_cash")
    nested = months.groupBy("scenario").agg(F.array_sort(F.collect_list(fields)).alias("by_month"))
    return liquidity_metrics(paths, settings).join(nested, "scenario")


def breach_by_month(paths: DataFrame, settings: LiquiditySettings | None = None) -> DataFrame:
    """Share of paths below the requirement, median and fifth percentile per month."""
    s = settings or LiquiditySettings()
    keys, shares = ["scenario", "step", "period"], {"median_cash": 0.5, "p5_cash": 0.05}
    breached = paths.groupBy(*keys).agg(F.avg((F.col("cash") < s.minimum_cash).cast("double")).alias("probability_of_breach"))
    ranks = grouped_ranks(paths, keys, "cash", list(shares.values()))
    return breached.join(ranks, keys).select(
        *keys, "probability_of_breach", *[interpolated(p, i).alias(name) for i, (name, p) in enumerate(shares.items())]
    )
