"""Accruals of recurring expenses: expected cost from prior periods against the recognised cost.

Input rows are monthly sums, so a window partition holds one series of months."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystone.config import Z_95

UNIT_CATEGORIES = ("Utilities", "Professional Services", "Logistics")
CORPORATE_CATEGORIES = ("Interest Expense",)
ROLLING_PERIODS = 3
MIN_HISTORY = 2
SERIES = ("expense_category", "entity_id", "business_unit")


def monthly_expense(enriched: DataFrame) -> DataFrame:
    """EUR debits per category, entity, unit and month, all recurring categories in one pass.

    Interest is one series per entity; for the others a posting without unit belongs to no series."""
    by_unit = F.col("coa_subcategory").isin(*UNIT_CATEGORIES)
    kept = enriched.where(
        (by_unit & F.col("business_unit").isNotNull()) | F.col("coa_subcategory").isin(*CORPORATE_CATEGORIES)
    ).where(F.col("entity_id").isNotNull() & F.col("period").isNotNull())
    unit = F.when(by_unit, F.col("business_unit"))
    cost = F.coalesce(F.sum("debit_eur"), F.lit(0)).cast("decimal(28,7)")
    return kept.groupBy(
        F.col("coa_subcategory").alias("expense_category"), "entity_id", unit.alias("business_unit"), "period"
    ).agg(cost.alias("recognized_cost"))


def accruals(monthly: DataFrame) -> DataFrame:
    """Expected cost, accrual and 95 % interval for every period with at least two prior ones.

    The expected cost is the mean of the up to three preceding rows of the series (rows, not calendar months);
    the mean of all prior rows and of prior rows in the same calendar month are reported beside it."""
    series = Window.partitionBy(*SERIES).orderBy("period")
    prior = series.rowsBetween(Window.unboundedPreceding, -1)
    trailing = series.rowsBetween(-ROLLING_PERIODS, -1)
    same_month = (
        Window.partitionBy(*SERIES, F.month("period")).orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    )
    cost = F.col("recognized_cost").cast("double")
    error = F.col("rolling_std") / F.sqrt(F.col("n_periods_in_estimate"))
    return (
        monthly.withColumn("cost", cost)
        .withColumn("historical_average", F.avg("cost").over(prior))
        .withColumn("seasonal_average", F.avg("cost").over(same_month))
        .withColumn("rolling_average", F.avg("cost").over(trailing))
        .withColumn("rolling_std", F.stddev_samp("cost").over(trailing))
        .withColumn("n_periods_in_estimate", F.count("cost").over(trailing))
        .withColumn("position", F.row_number().over(series))
        .where(F.col("position") > MIN_HISTORY)
        .withColumn("expected_cost", F.col("rolling_average"))
        .withColumn("estimated_accrual", F.col("expected_cost") - F.col("cost"))
        .withColumn("ci_lower", F.col("expected_cost") - Z_95 * error)
        .withColumn("ci_upper", F.col("expected_cost") + Z_95 * error)
        .select(
            "entity_id", "business_unit", "expense_category", "period", "historical_average", "seasonal_average",
            "rolling_average", "expected_cost", F.col("cost").alias("recognized_cost"), "estimated_accrual",
            "ci_lower", "ci_upper", "n_periods_in_estimate",
        )
    )


def accrual_summary(table: DataFrame) -> DataFrame:
    return table.groupBy("expense_category").agg(
        F.round(F.avg("estimated_accrual"), 2).alias("mean_accrual"),
        F.round(F.stddev_samp("estimated_accrual"), 2).alias("std_accrual"),
        F.count("estimated_accrual").alias("n_estimates"),
    )
