"""Reporting queries over the statement tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The balances that yearly reports add up, and the smoothed ratios.
BALANCE_STOCKS = (
    "cash", "accounts_receivable", "inventory", "other_current_assets", "total_assets", "accounts_payable", "debt",
    "other_liabilities", "income_tax_payable", "total_liabilities", "common_stock", "retained_earnings",
    "total_equity", "difference",
)
SMOOTHED_RATIOS = ("dso_3m_avg", "dpo_3m_avg", "dio_3m_avg", "ccc_3m_avg")


def _of_entities(df: DataFrame, entities: list[str] | None) -> DataFrame:
    return df if not entities else df.where(F.col("entity_id").isin(*entities))


def latest_kpis(statement: DataFrame, sheet: DataFrame) -> DataFrame:
    """Consolidated figures of the last month of the income statement."""
    flows = statement.groupBy("period").agg(
        *[F.sum(c).alias(c) for c in ("revenue", "ebitda", "net_income")]
    )
    stocks = sheet.groupBy("period").agg(
        F.sum("cash").alias("cash"),
        F.sum(F.col("accounts_receivable") + F.col("inventory") - F.col("accounts_payable")).alias(
            "net_working_capital"
        ),
    )
    months = flows.join(stocks, "period", "left")
    return months.agg(F.max_by(F.struct(*months.columns), "period").alias("last")).select("last.*")


def roll_up(
    df: DataFrame, columns: list[str], yearly: bool = False, entities: list[str] | None = None
) -> DataFrame:
    """Sum flow columns over entities by month or by year."""
    key = F.date_format("period", "yyyy").alias("year") if yearly else F.col("period")
    return _of_entities(df, entities).groupBy(key).agg(*[F.sum(c).alias(c) for c in columns])


def year_end_balances(sheet: DataFrame, entities: list[str] | None = None) -> DataFrame:
    """Balances at the last month of each year per entity, summed over entities."""
    year = F.date_format("period", "yyyy")
    last = (
        _of_entities(sheet, entities)
        .groupBy(year.alias("year"), "entity_id")
        .agg(F.max_by(F.struct(*BALANCE_STOCKS), "period").alias("s"))
        .select("year", "s.*")
    )
    return last.groupBy("year").agg(*[F.sum(c).alias(c) for c in BALANCE_STOCKS])


def ratio_series(wc: DataFrame, entities: list[str] | None = None) -> DataFrame:
    """The smoothed ratios as one long series per entity and metric."""
    return _of_entities(wc, entities).unpivot(
        ["entity_id", "period"], list(SMOOTHED_RATIOS), "metric", "value"
    )


def actual_and_forecast(series: DataFrame, forecasts: DataFrame) -> DataFrame:
    """History and forecast of every series on one axis."""
    none = F.lit(None).cast("double")
    history = series.select(
        "entity_id", "metric", "period", F.lit("actual").alias("kind"), F.col("value"),
        none.alias("ci_lower"), none.alias("ci_upper"),
    )
    future = forecasts.select(
        "entity_id", "metric", "period", F.lit("forecast").alias("kind"), F.col("forecast").alias("value"),
        "ci_lower", "ci_upper",
    )
    return history.unionByName(future)


def model_comparison(evaluation: DataFrame, entity: str, metric: str) -> DataFrame:
    """Models of one series, best holdout error first."""
    return (
        evaluation.where((F.col("entity_id") == entity) & (F.col("metric") == metric))
        .select("model", "mae", "rmse", "mape", "smape", "selected")
        .orderBy("rmse", "model")
    )


def plan_levers(plan: DataFrame) -> DataFrame:
    """Lever use by month, one row per lever."""
    levers = ["borrow_balance", "defer_balance", "accel", "capex_cut"]
    return plan.unpivot(["scenario", "step"], levers, "lever", "amount")
