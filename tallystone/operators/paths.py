"""Scenario cash paths: calibration from history and forecasts, simulated paths, consolidation and their fan.

Paths are a long table keyed by scenario, entity, simulation and step. Random numbers come from a digest of
(seed, entity, variable, simulation, step): they do not depend on partitioning, and every scenario sees the same
draws. The table is partitioned by simulation once; paths, consolidation and per-simulation risk all keep that
partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.config import SCENARIOS, ForecastSettings, SimulationSettings
from tallystone.functions.ranks import grouped_ranks, interpolated
from tallystone.operators.working_capital import days_in_month
from tallystone.session import materialize

PERCENTILES = (5, 10, 25, 50, 75, 90, 95)
CONSOLIDATED = "CONSOLIDATED"
SIMS_PER_CHUNK = 500
MIN_DEVIATION = 1e-6


def with_scenarios(df: DataFrame, scenarios: list[str]) -> DataFrame:
    """Every row once per scenario, with the scenario's shifts. An unknown scenario is an error."""
    unknown = [s for s in scenarios if s not in SCENARIOS]
    if unknown:
        raise ValueError(f"Unknown scenario {unknown}. Expected one of {list(SCENARIOS)}.")
    rows = F.array(
        *[
            F.struct(F.lit(s).alias("scenario"), *[F.lit(float(v)).alias(k) for k, v in SCENARIOS[s].items()])
            for s in scenarios
        ]
    )
    return df.withColumn("scenario_shift", F.explode(rows)).select("scenario_shift.*", *df.columns)


def entity_history(statement: DataFrame, wc: DataFrame, flow: DataFrame, sheet: DataFrame) -> DataFrame:
    """Per entity: mean and deviation of gross margin, DSO, DPO and investing cash flow; closing balances."""
    margin = 1 - F.try_divide(F.col("cogs").cast("double"), F.col("revenue").cast("double"))
    stats = lambda c, name: [F.avg(c).alias(f"{name}_mean"), F.stddev_samp(c).alias(f"{name}_std")]
    closing = F.max_by(F.struct("accounts_receivable", "accounts_payable", "cash", "debt"), "period")
    invested = F.col("investing_cf").cast("double")
    return (
        statement.groupBy("entity_id").agg(*stats(margin, "margin"))
        .join(wc.groupBy("entity_id").agg(*stats(F.col("dso"), "dso"), *stats(F.col("dpo"), "dpo")), "entity_id")
        .join(flow.groupBy("entity_id").agg(*stats(invested, "other_cf")), "entity_id")
        .join(sheet.groupBy("entity_id").agg(closing.alias("closing")), "entity_id")
        .select(
            "entity_id", "margin_mean", "margin_std", "dso_mean", "dso_std", "dpo_mean", "dpo_std",
            "other_cf_mean", "other_cf_std",
            F.col("closing.accounts_receivable").cast("double").alias("opening_ar"),
            F.col("closing.accounts_payable").cast("double").alias("opening_ap"),
            F.col("closing.cash").cast("double").alias("opening_cash"),
            F.col("closing.debt").cast("double").alias("debt"),
        )
    )


POINTS = ("revenue", "operating_expense")


def calibrate(
    forecasts: DataFrame, history: DataFrame, scenarios: list[str], simulation: SimulationSettings | None = None,
    forecast: ForecastSettings | None = None,
) -> DataFrame:
    """Simulation inputs per scenario, entity and step. Scenarios move the points, not the deviations.

    Every entity needs exactly one revenue and one expense forecast per step of the horizon."""
    simulation, forecast = simulation or SimulationSettings(), forecast or ForecastSettings()
    sigma = (F.col("ci_upper") - F.col("ci_lower")) / (2 * 1.96)

    def pick(metric: str, value: Column) -> Column:
        return F.max(F.when(F.col("metric") == metric, value))

    points = forecasts.where(F.col("metric").isin(*POINTS)).groupBy(
        "entity_id", "step", "period"
    ).agg(
        pick("revenue", F.col("forecast")).alias("revenue_point"),
        pick("revenue", sigma).alias("revenue_sigma"),
        pick("operating_expense", F.col("forecast")).alias("opex_point"),
        pick("operating_expense", sigma).alias("opex_sigma"),
        *[F.count_if((F.col("metric") == m) & F.col("forecast").isNotNull()).alias(f"n_{m}") for m in POINTS],
    )
    entity = Window.partitionBy("entity_id")
    complete = F.count(F.lit(1)).over(entity) == forecast.horizon
    for metric in POINTS:
        complete = complete & (F.min(f"n_{metric}").over(entity) == 1) & (F.max(f"n_{metric}").over(entity) == 1)
    checked = points.withColumn("complete", complete).withColumn(
        "step",
        F.when(F.col("complete"), F.col("step")).otherwise(
            F.raise_error(F.lit("an entity needs one revenue and one expense forecast per step")).cast("int")
        ),
    ).drop("complete", *[f"n_{m}" for m in POINTS])
    floor_std = lambda c: F.greatest(F.col(c), F.lit(MIN_DEVIATION))
    shifted = with_scenarios(checked.join(history, "entity_id"), scenarios)
    return shifted.select(
        "scenario", "entity_id", "step", "period",
        (F.col("revenue_point") * (1 + F.col("revenue_pct"))).alias("revenue_point"), "revenue_sigma",
        (F.col("opex_point") * (1 + F.col("opex_pct"))).alias("opex_point"), "opex_sigma",
        "margin_mean", floor_std("margin_std").alias("margin_std"),
        (F.col("dso_mean") + F.col("dso_days")).alias("dso_mean"), floor_std("dso_std").alias("dso_std"),
        F.greatest(F.lit(1.0), F.col("dpo_mean") + F.col("dpo_days")).alias("dpo_mean"),
        floor_std("dpo_std").alias("dpo_std"),
        "other_cf_mean", floor_std("other_cf_std").alias("other_cf_std"),
        (F.col("debt") * simulation.debt_annual_rate / 12).alias("monthly_interest"),
        "opening_ar", "opening_ap", "opening_cash", days_in_month(F.col("period")).alias("days"),
    )


def cost_share(margin: Column, simulation: SimulationSettings) -> Column:
    return margin if simulation.cost_ratio == "margin" else 1 - margin


def standard_normal(variable: str, seed: int) -> Column:
    """A reproducible normal draw for the row's entity, simulation and step."""
    key = F.concat_ws("|", F.lit(str(seed)), "entity_id", F.lit(variable), F.col("sim_id").cast("string"),
                      F.col("step").cast("string"))
    digest = F.md5(key)

    def uniform(start: int) -> Column:
        number = F.conv(F.substring(digest, start, 13), 16, 10).cast("double")
        return (number + 0.5) / float(2**52)

    return F.sqrt(-2 * F.ln(uniform(1))) * F.cos(2 * F.pi() * uniform(14))


VARIABLES = ("revenue", "opex", "margin", "dso", "dpo", "other_cf")


def draws(calibration: DataFrame, simulation: SimulationSettings) -> DataFrame:
    """Six normal draws per entity, simulation and step, partitioned by simulation."""
    cells = calibration.select("entity_id", "step").distinct()
    n = simulation.n_simulations
    last_chunk = (n - 1) // SIMS_PER_CHUNK
    chunked = cells.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(last_chunk)))).repartition("chunk")
    start = F.col("chunk") * SIMS_PER_CHUNK
    stop = F.least(start + SIMS_PER_CHUNK, F.lit(n)) - 1
    sims = chunked.withColumn("sim_id", F.explode(F.sequence(start, stop))).drop("chunk")
    drawn = sims.select(
        "entity_id", "step", "sim_id", *[standard_normal(v, simulation.seed).alias(f"z_{v}") for v in VARIABLES]
    )
    return drawn.repartition("sim_id")


def cash_paths(calibration: DataFrame, simulation: SimulationSettings | None = None) -> DataFrame:
    """Simulated cash per scenario, entity, simulation and step."""
    simulation = simulation or SimulationSettings()
    joined = draws(calibration, simulation).join(calibration, ["entity_id", "step"])
    shock = lambda name, mean, std: F.col(mean) + F.col(std) * F.col(f"z_{name}")
    zero, one = F.lit(0.0), F.lit(1.0)
    margin = F.least(F.greatest(shock("margin", "margin_mean", "margin_std"), F.lit(0.05)), F.lit(0.95))
    flows = (
        joined.withColumn("revenue", F.greatest(shock("revenue", "revenue_point", "revenue_sigma"), zero))
        .withColumn("opex", F.greatest(shock("opex", "opex_point", "opex_sigma"), zero))
        .withColumn("spend", F.col("revenue") * cost_share(margin, simulation) + F.col("opex"))
        .withColumn("ar", F.col("revenue") * F.greatest(shock("dso", "dso_mean", "dso_std"), one) / F.col("days"))
        .withColumn("ap", F.col("spend") * F.greatest(shock("dpo", "dpo_mean", "dpo_std"), one) / F.col("days"))
        .withColumn("other_cf", shock("other_cf", "other_cf_mean", "other_cf_std") - F.col("monthly_interest"))
    )
    return accumulate_cash(flows, ["scenario", "entity_id", "sim_id"]).select(
        "scenario", "entity_id", "sim_id", "step", "period", "revenue", "opex", "ar", "ap", "operating_cf", "cash"
    )


def accumulate_cash(flows: DataFrame, keys: list[str]) -> DataFrame:
    """Operating cash flow from the change in receivables and payables, and running cash, per path."""
    path = Window.partitionBy(*keys).orderBy("step")
    so_far = path.rowsBetween(Window.unboundedPreceding, 0)
    ar_before = F.coalesce(F.lag("ar").over(path), F.col("opening_ar"))
    ap_before = F.coalesce(F.lag("ap").over(path), F.col("opening_ap"))
    collections = ar_before + F.col("revenue") - F.col("ar")
    payments = ap_before + F.col("spend") - F.col("ap")
    return (
        flows.withColumn("operating_cf", collections - payments)
        .withColumn("net_cf", F.col("operating_cf") + F.col("other_cf"))
        .withColumn("cash", F.col("opening_cash") + F.sum("net_cf").over(so_far))
    )


def consolidate(paths: DataFrame) -> DataFrame:
    """Cash of all entities per scenario, simulation and step."""
    return paths.groupBy("scenario", "sim_id", "step", "period").agg(F.sum("cash").alias("cash"))


def cash_fan(paths: DataFrame) -> DataFrame:
    """Mean, median and percentiles per month, consolidated and per entity. All percentiles of all groups come from two passes
    over the paths; no task holds a group. paths is a written table."""
    keys = ["scenario", "entity_id", "step", "period"]
    total = materialize(consolidate(paths).withColumn("entity_id", F.lit(CONSOLIDATED)), "consolidated")
    everything = total.unionByName(paths.select(*keys, "sim_id", "cash")).select(*keys, "cash")
    means = everything.groupBy(*keys).agg(F.avg("cash").alias("mean"))
    ranks = grouped_ranks(everything, keys, "cash", [p / 100 for p in PERCENTILES])
    by_share = {f"p{p}": interpolated(p / 100, i) for i, p in enumerate(PERCENTILES)}
    return means.join(ranks, keys).select(
        *keys, "mean", by_share["p50"].alias("median"), *[c.alias(name) for name, c in by_share.items()]
    )
