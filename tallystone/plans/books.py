"""From raw tables to published books: layers, statements, ratios, accruals, forecasts and the three reports, as one run."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tallystone.config import SCENARIOS, ForecastSettings, LiquiditySettings, PlanSettings, QualitySettings, SimulationSettings
from tallystone.operators import accruals, cash_plan, forecasting, ledger, liquidity, paths, statements, working_capital
from tallystone.plans.quality import run_quality_engine
from tallystone.schema import TRANSACTIONS
from tallystone.sources import layers, publish


@dataclass(frozen=True)
class BookSettings:
    quality: QualitySettings = field(default_factory=QualitySettings)
    forecast: ForecastSettings = field(default_factory=ForecastSettings)
    simulation: SimulationSettings = field(default_factory=SimulationSettings)
    liquidity: LiquiditySettings = field(default_factory=LiquiditySettings)
    plan: PlanSettings = field(default_factory=PlanSettings)
    models: dict[str, forecasting.Model] | None = None  # all, unless told otherwise


def _stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Written once, then read by all that follows from it."""
    layers.write_table(df, f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def write_statements(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Statements, ratios and accruals of the validated layer of a run."""
    validated = layers.read_layer(spark, f"{folder}/layers", TRANSACTIONS)
    coa, fx = (layers.read_validated(spark, f"{folder}/validated", n) for n in ("chart_of_accounts", "fx_rates"))
    monthly = _stored(ledger.monthly_postings(validated), folder, "postings")
    postings = ledger.enrich(monthly, coa, fx)
    income = _stored(statements.income_statement(postings), folder, "income_statement")
    sheet = _stored(statements.balance_sheet(postings, income), folder, "balance_sheet")
    flow = _stored(statements.cash_flow(postings, sheet), folder, "cash_flow")
    ratios = _stored(working_capital.working_capital(income, sheet), folder, "working_capital")
    accrued = accruals.accruals(accruals.monthly_expense(postings))
    publish.replace_months(accrued, f"{folder}/accruals")
    return {"income_statement": income, "balance_sheet": sheet, "cash_flow": flow, "working_capital": ratios}


def write_outlook(spark: SparkSession, folder: str, tables: dict[str, DataFrame], settings: BookSettings) -> None:
    """Forecasts, cash paths and plans, with the liquidity and plan reports."""
    income, sheet, flow = (tables[n] for n in ("income_statement", "balance_sheet", "cash_flow"))
    series = _stored(forecasting.to_series(forecasting.forecast_panel(income, sheet, flow)), folder, "series")
    forecasts, evaluation = forecasting.build_forecasts(series, settings.models, settings.forecast)
    forecasts = _stored(forecasts, folder, "forecasts")
    _stored(evaluation, folder, "model_evaluation")
    history = paths.entity_history(income, tables["working_capital"], flow, sheet)
    calibration = _stored(
        paths.calibrate(forecasts, history, list(SCENARIOS), settings.simulation, settings.forecast), folder, "calibration"
    )
    simulated = _stored(paths.cash_paths(calibration, settings.simulation), folder, "cash_paths")
    total = _stored(paths.consolidate(simulated), folder, "consolidated_paths")
    _stored(paths.cash_fan(simulated), folder, "cash_fan")
    layers.write_report(liquidity.liquidity_report(total, settings.liquidity), f"{folder}/reports/liquidity")
    baseline = cash_plan.consolidated_baseline(cash_plan.entity_baseline(calibration, settings.simulation))
    floors = _stored(cash_plan.buffered_floor(baseline, total, settings.plan, settings.liquidity), folder, "cash_floors")
    rows = _stored(cash_plan.search_plan(floors, settings.plan), folder, "cash_plan")
    report = cash_plan.plan_report(floors, rows, total, settings.plan)
    layers.write_report(report, f"{folder}/reports/cash_plan")


def publish_books(
    tables: dict[str, DataFrame], root: str, run_id: str, run_timestamp: str, settings: BookSettings | None = None
) -> str:
    """Run everything into the folder of the run and publish it at the end. Returns the folder. After a failure nothing is
    published, and the same run may be started again."""
    settings = settings or BookSettings()
    spark = next(iter(tables.values())).sparkSession
    folder = publish.begin(spark, root, run_id)
    run_quality_engine(tables, folder, run_timestamp, settings.quality)
    write_outlook(spark, folder, write_statements(spark, folder), settings)
    publish.publish(spark, root, run_id)
    return folder
