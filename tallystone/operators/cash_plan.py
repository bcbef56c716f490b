"""Cash baseline, volatility-buffered floor and the cheapest lever plan.

Levers per month: a borrowing balance, a free deferred-payment balance, and one-time flows from earlier
collections and from capex cuts. A one-time flow costs the same in any month and helps every later month, so the
best schedule of a given total takes it as early as the monthly caps allow. Deferral is free, so it is used first
and borrowing covers the rest. The cost is then a convex piecewise-linear function of two totals (collections,
cuts); it has its minimum at a vertex, so evaluating all vertices finds the exact optimum of the linear program.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.config import LiquiditySettings, PlanSettings, SimulationSettings
from tallystone.operators.liquidity import liquidity_metrics
from tallystone.operators.paths import accumulate_cash, cost_share

EPSILON = 1e-6


def entity_baseline(calibration: DataFrame, simulation: SimulationSettings | None = None) -> DataFrame:
    """The simulated cash model with every draw at its mean: one path per scenario and entity."""
    simulation = simulation or SimulationSettings()
    spend = F.col("revenue_point") * cost_share(F.col("margin_mean"), simulation) + F.col("opex_point")
    flows = (
        calibration.withColumn("revenue", F.col("revenue_point"))
        .withColumn("spend", spend)
        .withColumn("ar", F.col("revenue") * F.col("dso_mean") / F.col("days"))
        .withColumn("ap", F.col("spend") * F.col("dpo_mean") / F.col("days"))
        .withColumn("other_cf", F.col("other_cf_mean") - F.col("monthly_interest"))
        .withColumn("planned_capex", F.greatest(-F.col("other_cf_mean"), F.lit(0.0)))
    )
    return accumulate_cash(flows, ["scenario", "entity_id"]).select(
        "scenario", "entity_id", "step", "period", "revenue", "spend", "planned_capex", "net_cf", "opening_cash",
        F.col("cash").alias("cash_baseline"),
    )


def consolidated_baseline(baseline: DataFrame) -> DataFrame:
    sums = ("revenue", "spend", "planned_capex", "net_cf", "opening_cash", "cash_baseline")
    return baseline.groupBy("scenario", "step", "period").agg(*[F.sum(c).alias(c) for c in sums])


def buffered_floor(
    baseline: DataFrame, paths: DataFrame, plan: PlanSettings | None = None, real: LiquiditySettings | None = None
) -> DataFrame:
    """Floor per month: policy plus z deviations of simulated cash; headroom of the real policy beside it."""
    plan, real = plan or PlanSettings(), real or LiquiditySettings()
    spread = paths.groupBy("scenario", "step").agg(F.stddev_samp("cash").alias("cash_std"))
    headroom = F.min("cash_baseline").over(Window.partitionBy("scenario")) - real.minimum_cash
    return (
        baseline.withColumn("real_policy_headroom", headroom)
        .join(spread, ["scenario", "step"])
        .withColumn("floor", plan.policy_minimum_cash + plan.safety_buffer_z * F.col("cash_std"))
    )


def _running(name: str) -> Column:
    """Running totals of an array of structs' field, as an array."""
    return F.transform(
        "months",
        lambda _, i: F.aggregate(F.slice("months", F.lit(1), i + 1), F.lit(0.0), lambda a, m: a + m[name]),
    )


def search_plan(floors: DataFrame, plan: PlanSettings | None = None) -> DataFrame:
    """Cheapest plan per scenario, one row per month; no rows for a scenario no plan can satisfy.

    `floors` has the consolidated baseline and the floor per scenario and step. A scenario is one row of short
    arrays; its candidate plans are generated and costed from that row."""
    plan = plan or PlanSettings()
    rate = plan.borrowing_rate_annual / 12
    month = F.struct(
        F.col("step"), F.col("period"), F.col("cash_baseline"),
        F.greatest(F.col("floor") - F.col("cash_baseline"), F.lit(0.0)).alias("shortfall"),
        (F.col("revenue") * plan.max_collections_acceleration_pct).alias("accel_cap"),
        (F.col("planned_capex") * plan.max_capex_reduction_pct).alias("cut_cap"),
    )
    scenario = (
        floors.groupBy("scenario")
        .agg(F.array_sort(F.collect_list(month)).alias("months"), F.avg("spend").alias("mean_spend"))
        .withColumn("defer_cap", F.col("mean_spend") * (plan.max_payment_delay_days / 30))
        .withColumn("accel_upto", _running("accel_cap"))
        .withColumn("cut_upto", _running("cut_cap"))
        # What deferral leaves over each month, and what must be covered beyond full borrowing.
        .withColumn("need", F.transform("months", lambda m: m["shortfall"] - F.col("defer_cap")))
        .withColumn("must", F.transform("need", lambda n: n - plan.max_borrowing))
        .withColumn("levels", F.concat("need", "must"))
    )
    zero = F.array(F.lit(0.0))
    minus = lambda caps: F.flatten(F.transform("levels", lambda n: F.transform(caps, lambda c: n - c)))
    within = lambda values, caps: F.array_distinct(
        F.filter(values, lambda v: (v >= 0) & (v <= F.element_at(caps, -1) + EPSILON))
    )
    scenario = scenario.withColumn(
        "accels",
        within(F.concat(zero, "accel_upto", "levels", minus(F.col("cut_upto"))), F.col("accel_upto")),
    ).withColumn(
        "cuts", within(F.concat(zero, "cut_upto", "levels", minus(F.col("accel_upto"))), F.col("cut_upto"))
    )
    pair = lambda a, c: F.struct(a.alias("accel_total"), c.alias("cut_total"))
    corners = F.concat(
        F.flatten(F.transform("accels", lambda a: F.transform("cuts", lambda c: pair(a, c)))),
        F.flatten(F.transform("accels", lambda a: F.transform("levels", lambda n: pair(a, n - a)))),
        F.flatten(F.transform("cuts", lambda c: F.transform("levels", lambda n: pair(n - c, c)))),
    )
    valid = F.filter(
        corners,
        lambda p: (p["accel_total"] >= 0) & (p["cut_total"] >= 0)
        & (p["accel_total"] <= F.element_at("accel_upto", -1) + EPSILON)
        & (p["cut_total"] <= F.element_at("cut_upto", -1) + EPSILON),
    )
    costed = scenario.withColumn("corners", F.array_distinct(valid)).withColumn("p", F.explode("corners")).drop("corners")
    covered = lambda i: F.least(F.col("p.accel_total"), F.get("accel_upto", i)) + F.least(
        F.col("p.cut_total"), F.get("cut_upto", i)
    )
    borrow = F.transform("need", lambda n, i: F.greatest(n - covered(i), F.lit(0.0)))
    costed = (
        costed.withColumn("borrow", borrow)
        .where(F.forall("borrow", lambda b: b <= plan.max_borrowing + EPSILON))
        .withColumn(
            "total_cost",
            F.aggregate("borrow", F.lit(0.0), lambda a, b: a + b) * rate
            + F.col("p.accel_total") * plan.factoring_discount_rate
            + F.col("p.cut_total") * plan.capex_delay_cost_rate,
        )
    )
    order = F.struct(F.round("total_cost", 4), F.col("p"))
    kept = ("months", "accel_upto", "cut_upto", "defer_cap", "p", "borrow", "total_cost")
    best = costed.groupBy("scenario").agg(F.min_by(F.struct(*kept), order).alias("b")).select("scenario", "b.*")
    return _plan_rows(best)


def _plan_rows(best: DataFrame) -> DataFrame:
    """The chosen plan by month."""
    month = best.select("*", F.posexplode("months").alias("i", "m"))
    taken = lambda total, upto: F.least(F.col(total), F.get(upto, F.col("i")))
    before = lambda total, upto: F.when(
        F.col("i") > 0, F.least(F.col(total), F.get(upto, F.col("i") - 1))
    ).otherwise(F.lit(0.0))
    one_time = taken("p.accel_total", "accel_upto") + taken("p.cut_total", "cut_upto")
    rows = month.select(
        "scenario", F.col("m.step").alias("step"), F.col("m.period").alias("period"), "total_cost",
        F.get("borrow", F.col("i")).alias("borrow_balance"),
        F.least(F.greatest(F.col("m.shortfall") - one_time, F.lit(0.0)), F.col("defer_cap")).alias("defer_balance"),
        (taken("p.accel_total", "accel_upto") - before("p.accel_total", "accel_upto")).alias("accel"),
        (taken("p.cut_total", "cut_upto") - before("p.cut_total", "cut_upto")).alias("capex_cut"),
        one_time.alias("one_time"), F.col("m.cash_baseline").alias("cash_baseline"),
    )
    adjustment = F.col("borrow_balance") + F.col("defer_balance") + F.col("one_time")
    return (
        rows.withColumn("net_adjustment", adjustment)
        .withColumn("cash_optimized", F.col("cash_baseline") + F.col("net_adjustment"))
        .drop("one_time")
    )


def plan_costs(plan_rows: DataFrame, plan: PlanSettings | None = None) -> DataFrame:
    """Cost per lever, peak balances and totals per scenario."""
    plan = plan or PlanSettings()
    return plan_rows.groupBy("scenario").agg(
        F.max("total_cost").alias("total_cost"),
        (F.sum("borrow_balance") * (plan.borrowing_rate_annual / 12)).alias("financing_cost"),
        (F.sum("accel") * plan.factoring_discount_rate).alias("acceleration_cost"),
        (F.sum("capex_cut") * plan.capex_delay_cost_rate).alias("capex_delay_cost"),
        F.max("borrow_balance").alias("max_borrow_balance"), F.max("defer_balance").alias("max_defer_balance"),
        F.sum("accel").alias("total_accelerated"), F.sum("capex_cut").alias("total_capex_cut"),
    )


def before_and_after(paths: DataFrame, plan_rows: DataFrame, settings: LiquiditySettings) -> DataFrame:
    """Risk of the same simulated paths without and with the plan's monthly adjustment."""
    adjusted = paths.join(
        plan_rows.select("scenario", "step", "net_adjustment"), ["scenario", "step"]
    ).withColumn("cash", F.col("cash") + F.col("net_adjustment"))
    with_plan = plan_rows.select("scenario").distinct()
    before = liquidity_metrics(paths.join(with_plan, "scenario", "left_semi"), settings)
    after = liquidity_metrics(adjusted, settings)
    return before.withColumn("state", F.lit("before")).unionByName(after.withColumn("state", F.lit("after")))


def plan_status(floors: DataFrame, plan_rows: DataFrame) -> DataFrame:
    """Each scenario with a status: optimal, or infeasible where no plan keeps all floors."""
    solved = plan_rows.groupBy("scenario").agg(F.max("total_cost").alias("total_cost"))
    status = F.when(F.col("total_cost").isNull(), "infeasible").otherwise("optimal")
    return floors.select("scenario").distinct().join(solved, "scenario", "left").withColumn("status", status)


def plan_report(floors: DataFrame, plan_rows: DataFrame, paths: DataFrame, plan: PlanSettings | None = None) -> DataFrame:
    """One row per scenario: status, costs, the headroom of the real policy, risk before and after the plan, and the months, nested. A
    scenario without a plan has its status and headroom only."""
    plan = plan or PlanSettings()
    risk = before_and_after(paths, plan_rows, LiquiditySettings(minimum_cash=plan.policy_minimum_cash))
    values = F.struct(*[c for c in risk.columns if c not in ("scenario", "state")])
    states = risk.groupBy("scenario").agg(*[F.max(F.when(F.col("state") == s, values)).alias(s) for s in ("before", "after")])
    month = F.struct(
        "step", F.date_format("period", "yyyy-MM").alias("period"),
        *[c for c in plan_rows.columns if c not in ("scenario", "step", "period", "total_cost")],
    )
    months = plan_rows.groupBy("scenario").agg(F.array_sort(F.collect_list(month)).alias("months"))
    headroom = floors.groupBy("scenario").agg(F.min("real_policy_headroom").alias("real_policy_headroom"), F.max("floor").alias("highest_floor"))
    out = plan_status(floors, plan_rows).drop("total_cost").join(headroom, "scenario")
    for part in (plan_costs(plan_rows, plan), states, months):
        out = out.join(part, "scenario", "left")
    return out
