from __future__ import annotations

import itertools
import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallystone.config import LiquiditySettings, PlanSettings, SimulationSettings
from tallystone.operators import accruals, boosting, cash_plan, forecasting, journal, ledger, liquidity, paths, smoothing, statements
from tallystone.operators.working_capital import working_capital, working_capital_trend

COA = [("1000", "Cash", "Asset", "Cash", "Debit"), ("1001", "Accounts Receivable", "Asset", "Accounts Receivable", "Debit"),
       ("3000", "Common Stock", "Equity", "Common Stock", "Credit"), ("4000", "Sales", "Revenue", "Product Revenue", "Credit"),
       ("6000", "Rent", "Operating Expense", "Rent", "Debit"), ("6900", "Dep", "Operating Expense", "Depreciation Expense", "Debit")]
COA_SCHEMA = "account_id string, account_name string, account_category string, account_subcategory string, normal_balance string"


@pytest.fixture(scope="module")
def coa(spark):
    return spark.createDataFrame(COA, COA_SCHEMA)


@pytest.fixture(scope="module")
def fx(spark):
    rows = [(date(2024, m, 1), c, r) for m in (1, 2, 3) for c, r in (("EUR", 1.0), ("USD", 0.9))]
    return spark.createDataFrame(rows, "rate_date date, currency string, rate_to_eur double").withColumn(
        "rate_to_eur", F.col("rate_to_eur").cast("decimal(10,5)"))


def event(doc, kind, day, debit, credit, amount, currency="EUR", entity="E"):
    return (doc, kind, day, entity, "BU", currency, None, Decimal(str(amount)), None, None, "ERP", debit, credit)


EVENT_SCHEMA = ("document_id string, document_type string, transaction_date date, entity_id string, business_unit string, currency string, "
                "counterparty_id string, amount decimal(18,4), payment_due_date date, payment_date date, source_system string, "
                "debit_account string, credit_account string")


@pytest.fixture(scope="module")
def enriched(spark, coa, fx):
    events = [
        event("OPEN_E", "Opening Balance", date(2024, 1, 1), "1000", "3000", 1000),
        event("D1", "Revenue Invoice", date(2024, 1, 10), "1001", "4000", 100, "USD"),
        event("D2", "Cash Receipt", date(2024, 2, 10), "1000", "1001", 100, "USD"),
        event("D3", "Payroll", date(2024, 2, 20), "6000", "1000", 40.005),
        event("D4", "Mystery", date(2024, 3, 2), "1000", "4000", 5),
        event("D5", "Revenue Invoice", date(2024, 3, 2), "1001", "4000", 0),
    ]
    legs = journal.post_journal(spark.createDataFrame(events, EVENT_SCHEMA), coa)
    assert legs.count() == 10
    return ledger.enriched_postings(legs, coa, fx)


def test_statements_reconcile(enriched):
    income = statements.income_statement(enriched, {"E": "0.3"})
    rows = {r.period.month: r for r in income.collect()}
    assert float(rows[1].revenue) == 90 and float(rows[1].taxes) == 27 and float(rows[1].net_income) == 63
    assert float(rows[2].operating_expense) == 40.01 and float(rows[2].taxes) == 0
    sheet = statements.balance_sheet(enriched, income)
    assert {r.status for r in sheet.collect()} == {"PASS"}
    flow = {r.period.month: r for r in statements.cash_flow(enriched, sheet).collect()}
    assert float(flow[2].beginning_cash) == 1000 and flow[2].status == "PASS"
    # an unknown document type stays out of the net change and shows as a difference
    assert flow[3].status == "FAIL" and float(flow[3].reconciliation_diff) == 5


def test_duplicate_rate_is_an_error(spark, fx):
    df = spark.createDataFrame([("EUR", date(2024, 1, 5), 1.0)], "currency string, transaction_date date, amount double")
    with pytest.raises(PySparkException):
        ledger.convert_to_eur(df, fx.unionByName(fx), {"amount": "eur"}).collect()


def test_conversion_uses_month_and_keeps_unrated(spark, fx):
    df = spark.createDataFrame([("USD", date(2024, 1, 20), 100), ("CHF", date(2024, 1, 5), 100)], "currency string, transaction_date date, amount int")
    got = {r.currency: r.eur for r in ledger.convert_to_eur(df, fx, {"amount": "eur"}).collect()}
    assert float(got["USD"]) == 90 and got["CHF"] is None


def test_buckets_and_signs(spark):
    pairs = [("Revenue", "x"), ("COGS", "x"), ("Operating Expense", "Rent"), ("Operating Expense", "Depreciation Expense"),
             ("Operating Expense", "Interest Expense"), ("Operating Expense", "Tax Expense"), ("Operating Expense", None), ("Asset", "Cash"), (None, None)]
    df = spark.createDataFrame(pairs, "c string, s string").select(ledger.pl_bucket(F.col("c"), F.col("s")).alias("b"))
    assert [r.b for r in df.collect()] == ["Revenue", "COGS", "Operating Expense", "Depreciation", "Interest", "Tax", "Operating Expense", None, None]
    df = spark.createDataFrame([(100, 0, "Debit"), (0, 100, "Credit"), (0, 7, None)], "d int, c int, n string")
    assert [r.v for r in df.select(ledger.signed_amount(F.col("d"), F.col("c"), F.col("n")).alias("v")).collect()] == [100, 100, 7]


def test_ratios(spark):
    income = spark.createDataFrame([("E", date(2024, 1, 1), 300.0, 150.0, 50.0), ("E", date(2024, 2, 1), 0.0, 150.0, 50.0)],
                                   "entity_id string, period date, revenue double, cogs double, operating_expense double")
    sheet = spark.createDataFrame([("E", date(2024, m, 1), 100.0, 50.0, 80.0) for m in (1, 2)],
                                  "entity_id string, period date, accounts_receivable double, inventory double, accounts_payable double")
    wc = working_capital(income, sheet)
    first, second = wc.orderBy("period").collect()
    assert first.dso == pytest.approx(100 / 300 * 31) and first.dpo == pytest.approx(80 / 200 * 31) and first.dio == pytest.approx(50 / 150 * 31)
    assert first.ccc == pytest.approx(first.dso + first.dio - first.dpo) and first.dso_3m_avg == first.dso
    assert second.dso is None and second.dpo_3m_avg == pytest.approx((first.dpo + second.dpo) / 2)
    assert working_capital_trend(wc).first().direction == "improved"


def test_accruals(spark):
    rows = [("Utilities", "E", "B", date(2024, m, 1), float(m * 100)) for m in range(1, 6)]
    rows += [("Utilities", "E", "short", date(2024, m, 1), 1.0) for m in (1, 2)]
    df = spark.createDataFrame(rows, "expense_category string, entity_id string, business_unit string, period date, recognized_cost double")
    out = accruals.accruals(df).orderBy("period").collect()
    assert [r.period.month for r in out] == [3, 4, 5]
    assert out[1].rolling_average == 200 and out[1].recognized_cost == 400 and out[1].seasonal_average is None
    assert out[1].ci_upper - out[1].ci_lower == pytest.approx(2 * 1.96 * 100 / 3**0.5)
    assert out[2].historical_average == 250 and out[2].n_periods_in_estimate == 3


def series_of(spark, values, entity="E", metric="revenue"):
    rows = [(entity, metric, date(2020 + i // 12, i % 12 + 1, 1), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "entity_id string, metric string, period date, value double")


def values_of(df):
    return [r.forecast for r in df.orderBy("step").collect()]


def test_baselines(spark):
    assert values_of(forecasting.naive(forecasting.to_arrays(series_of(spark, [10, 20, 30])), 4)) == [30.0] * 4
    year = forecasting.to_arrays(series_of(spark, range(1, 13)))
    assert values_of(forecasting.seasonal_naive(year, 14)) == [float(v) for v in [*range(1, 13), 1, 2]]
    assert values_of(forecasting.seasonal_naive(forecasting.to_arrays(series_of(spark, [1, 2])), 2)) == [2.0, 2.0]


def test_error_metrics(spark):
    rows = [("E", "m", "naive", y, f) for y, f in ((100.0, 110.0), (200.0, 190.0), (300.0, 320.0))]
    df = spark.createDataFrame(rows, "entity_id string, metric string, model string, actual double, forecast double")
    r = forecasting.error_metrics(df).first()
    assert r.mae == pytest.approx(40 / 3) and r.rmse == pytest.approx(200**0.5)
    zero = forecasting.error_metrics(df.withColumn("actual", F.lit(0.0)).withColumn("forecast", F.lit(0.0))).first()
    assert zero.mape is None and zero.smape is None


def test_lag_features(spark):
    rows = forecasting.lag_features(series_of(spark, range(14))).orderBy("period").collect()
    assert len(rows) == 2 and (rows[0].target, rows[0].lag_1, rows[0].lag_12, rows[0].rolling_mean, rows[0].trend_index) == (12, 11, 0, 10, 12)


def test_holdout_does_not_leak(spark):
    values = [100 + 10 * (i % 12) + i for i in range(36)]
    models = {**forecasting.BASELINES, "exponential_smoothing": smoothing.exponential_smoothing}
    def predicted(v):
        out = forecasting.holdout(forecasting.to_arrays(series_of(spark, v)), models, forecasting.ForecastSettings())
        return {(r.model, r.step): r.forecast for r in out.collect()}
    assert predicted(values) == predicted(values[:-6] + [1e9] * 6)


def test_smoothing_follows_trend_and_season(spark):
    values = [100 + 2 * i + 10 * (i % 12) for i in range(48)]
    got = values_of(smoothing.exponential_smoothing(forecasting.to_arrays(series_of(spark, values)), 12))
    assert got == pytest.approx([100 + 2 * i + 10 * (i % 12) for i in range(48, 60)], rel=0.05)
    line = values_of(smoothing.exponential_smoothing(forecasting.to_arrays(series_of(spark, [1, 2, 3, 4])), 2))
    assert line == pytest.approx([5, 6])
    assert values_of(smoothing.exponential_smoothing(forecasting.to_arrays(series_of(spark, [7])), 2)) == [7, 7]


def test_boosting_stays_in_range_and_falls_back(spark):
    values = [100 + 10 * (i % 12) for i in range(36)]
    both = series_of(spark, values).unionByName(series_of(spark, [5, 6, 7], entity="short"))
    out = boosting.gradient_boosting(forecasting.to_arrays(both), 3)
    assert values_of(out.where("entity_id = 'short'")) == [7.0] * 3
    assert all(90 <= v <= 220 for v in values_of(out.where("entity_id = 'E'")))


def test_forecasts_pick_the_better_model(spark):
    forecasts, evaluation = forecasting.build_forecasts(series_of(spark, [i % 12 for i in range(36)]))
    assert forecasting.model_wins(evaluation).first().model == "seasonal_naive"
    rows = forecasts.orderBy("step").collect()
    assert len(rows) == 12 and rows[0].period == date(2023, 1, 1) and rows[0].ci_lower == rows[0].forecast


def test_penny_plug_balances(spark):
    rows = [("D", 1, "debit", "33.333"), ("D", 2, "debit", "33.333"), ("D", 3, "debit", "-10.005"), ("D", 4, "credit", "56.661"), ("Z", 1, "debit", "0.001"), ("Z", 2, "credit", "0.001")]
    df = spark.createDataFrame(rows, "document_id string, leg_no int, side string, amount string").withColumn("amount", F.col("amount").cast("decimal(28,6)"))
    out = journal.penny_plug(df).collect()
    total = sum(r.amount if r.side == "debit" else -r.amount for r in out)
    assert total == 0 and {r.document_id for r in out} == {"D"} and all(r.amount > 0 for r in out)
    assert {r.leg_no: r.side for r in out}[3] == "credit"


def test_opening_documents_balance(spark):
    entities = spark.createDataFrame([("E", "EUR", 1_234_567), ("F", "USD", 7)], "entity_id string, functional_currency string, annual_revenue_scale_eur bigint")
    parts = journal.penny_plug(journal.opening_balances(entities, "2024-01-01")).collect()
    assert sum(r.entity_id == "E" for r in parts) == 13
    for entity in ("E", "F"):
        assert sum(r.amount if r.side == "debit" else -r.amount for r in parts if r.entity_id == entity) == 0


def test_invoice_status(spark):
    rows = [(date(2024, 1, 1), date(2024, 1, 5), True), (date(2024, 1, 1), date(2024, 9, 1), False), (date(2024, 6, 1), date(2024, 9, 1), True), (date(2024, 9, 1), date(2024, 9, 9), True)]
    df = spark.createDataFrame(rows, "due_date date, expected_payment date, ok boolean")
    out = journal.invoice_status(df, "2024-07-01", "ok").collect()
    assert [r.payment_status for r in out] == ["Paid", "Written Off", "Overdue", "Open"] and out[2].payment_date is None


def calibration(spark, scenarios=("base", "optimistic", "pessimistic")):
    forecasts = spark.createDataFrame(
        [(e, m, date(2025, s, 1), s, v, v - 10.0, v + 10.0) for e in ("E", "F") for m, v in (("revenue", 500.0), ("operating_expense", 100.0)) for s in range(1, 13)],
        "entity_id string, metric string, period date, step int, forecast double, ci_lower double, ci_upper double")
    history = spark.createDataFrame([(e, 0.4, 0.05, 30.0, 3.0, 40.0, 3.0, -20.0, 5.0, 480.0, 400.0, 1000.0, 120.0) for e in ("E", "F")],
                                    "entity_id string, margin_mean double, margin_std double, dso_mean double, dso_std double, dpo_mean double, dpo_std double, "
                                    "other_cf_mean double, other_cf_std double, opening_ar double, opening_ap double, opening_cash double, debt double")
    return paths.calibrate(forecasts, history, list(scenarios)), forecasts, history


def test_paths_are_reproducible_and_ordered(spark):
    cal, forecasts, history = calibration(spark)
    sim = SimulationSettings(n_simulations=600)
    p = paths.cash_paths(cal, sim)
    total = p.agg(F.sum("cash")).first()[0]
    assert paths.cash_paths(cal.repartition(7), sim).agg(F.sum("cash")).first()[0] == pytest.approx(total)
    assert p.count() == 3 * 2 * 600 * 12
    fan = {(r.scenario, r.entity_id): r for r in paths.cash_fan(p).where("step = 12").collect()}
    row = fan[("base", "CONSOLIDATED")]
    assert row.p5 < row.p10 < row.p25 < row["median"] < row.p75 < row.p90 < row.p95
    assert row["mean"] == pytest.approx(fan[("base", "E")]["mean"] + fan[("base", "F")]["mean"])
    assert fan[("optimistic", "CONSOLIDATED")]["mean"] > row["mean"] > fan[("pessimistic", "CONSOLIDATED")]["mean"]
    mean_path = {r.step: r.cash_baseline for r in cash_plan.consolidated_baseline(cash_plan.entity_baseline(cal)).where("scenario = 'base'").collect()}
    assert mean_path[12] == pytest.approx(row["mean"], rel=0.05)


def test_bad_scenario_and_missing_steps_fail(spark):
    _, forecasts, history = calibration(spark)
    with pytest.raises(ValueError):
        paths.calibrate(forecasts, history, ["nope"])
    with pytest.raises(PySparkException):
        paths.calibrate(forecasts.where("step < 12"), history, ["base"]).collect()


def test_liquidity_on_a_small_matrix(spark):
    matrix = [[150, 150, 150], [90, 120, 50], [150, 80, 120], [95, 5, 60]]
    rows = [("base", i, s + 1, date(2025, s + 1, 1), float(v)) for i, line in enumerate(matrix) for s, v in enumerate(line)]
    df = spark.createDataFrame(rows, "scenario string, sim_id int, step int, period date, cash double")
    s = LiquiditySettings(minimum_cash=100.0)
    r = liquidity.liquidity_metrics(df, s).first()
    assert (r.probability_of_liquidity_breach, r.worst_simulated_cash, r.max_months_below_threshold, r.risk_score) == (0.75, 5.0, 3, "CRITICAL")
    assert r.avg_months_below_threshold == 1.5
    assert [x.probability_of_breach for x in liquidity.breach_by_month(df, s).orderBy("step").collect()] == [0.5, 0.5, 0.5]
    probs = spark.createDataFrame([(p,) for p in (0.0, 0.05, 0.10, 0.35, 0.90)], "p double")
    assert [x.r for x in probs.select(liquidity.risk_score(F.col("p")).alias("r")).collect()] == ["LOW", "LOW", "MEDIUM", "HIGH", "CRITICAL"]


def floors_of(spark, shortfalls, revenue=100.0, capex=50.0, spend=20.0):
    rows = [("s", i + 1, date(2025, i + 1, 1), 1000.0, 1000.0 + v, revenue, capex, spend) for i, v in enumerate(shortfalls)]
    return spark.createDataFrame(rows, "scenario string, step int, period date, cash_baseline double, floor double, revenue double, planned_capex double, spend double")


def brute_plan(shortfalls, plan, revenue=100.0, capex=50.0, spend=20.0, step=2.5):
    """Cheapest schedule over a grid of monthly flows."""
    n, defer = len(shortfalls), plan.max_payment_delay_days / 30 * spend
    accel = [step * k for k in range(int(plan.max_collections_acceleration_pct * revenue / step) + 1)]
    cuts = [step * k for k in range(int(plan.max_capex_reduction_pct * capex / step) + 1)]
    best = None
    for a in itertools.product(accel, repeat=n):
        for c in itertools.product(cuts, repeat=n):
            cost, flow = 0.0, 0.0
            for t in range(n):
                flow += a[t] + c[t]
                borrow = max(max(shortfalls[t], 0) - defer - flow, 0)
                if borrow > plan.max_borrowing + 1e-9:
                    break
                cost += borrow * plan.borrowing_rate_annual / 12 + a[t] * plan.factoring_discount_rate + c[t] * plan.capex_delay_cost_rate
            else:
                best = cost if best is None else min(best, cost)
    return best


@pytest.mark.parametrize("shortfalls,limit", [([10, 15, 20], 40.0), ([30, 60, 80], 40.0), ([45, 20, 60], 20.0), ([70, 60, 90], 30.0)])
def test_plan_search_finds_the_optimum(spark, shortfalls, limit):
    plan = PlanSettings(max_borrowing=limit, max_collections_acceleration_pct=0.15, max_capex_reduction_pct=0.15, borrowing_rate_annual=0.20, capex_delay_cost_rate=0.03)
    rows = cash_plan.search_plan(floors_of(spark, shortfalls), plan).orderBy("step").collect()
    want = brute_plan(shortfalls, plan)
    if want is None:
        assert rows == []
        return
    assert rows[0].total_cost == pytest.approx(want, abs=1e-6)
    costs = cash_plan.plan_costs(cash_plan.search_plan(floors_of(spark, shortfalls), plan), plan).first()
    assert costs.financing_cost + costs.acceleration_cost + costs.capex_delay_cost == pytest.approx(want, abs=1e-6)
    for r, v in zip(rows, shortfalls):
        assert r.cash_optimized >= 1000 + v - 1e-6 and r.borrow_balance <= limit + 1e-6


def test_comfortable_and_impossible_plans(spark):
    assert cash_plan.search_plan(floors_of(spark, [-50, -60, -70])).first().total_cost == 0
    assert cash_plan.search_plan(floors_of(spark, [1e9, 1e9])).collect() == []


def test_plan_moves_the_same_paths(spark):
    plan = cash_plan.search_plan(floors_of(spark, [10, 15]))
    sims = spark.createDataFrame([("s", i, t, date(2025, t, 1), 995.0 + i) for i in range(10) for t in (1, 2)], "scenario string, sim_id int, step int, period date, cash double")
    out = {r.state: r for r in cash_plan.before_and_after(sims, plan, LiquiditySettings(minimum_cash=1000.0)).collect()}
    assert out["before"].probability_of_liquidity_breach == 0.5 and out["after"].probability_of_liquidity_breach == 0
    assert out["after"].average_cash == pytest.approx(out["before"].average_cash + 12.5)


def test_boosting_of_short_series_only(spark):
    out = boosting.gradient_boosting(forecasting.to_arrays(series_of(spark, [5, 6, 7])), 3)
    assert values_of(out) == [7.0] * 3


def test_all_models_compete_by_default(spark):
    _, evaluation = forecasting.build_forecasts(series_of(spark, [100 + i + 10 * (i % 12) for i in range(40)]))
    assert {r.model for r in evaluation.collect()} == set(forecasting.MODEL_RANK)


def test_repeated_account_is_an_error(spark, coa):
    postings = spark.createDataFrame([("1000",)], "account_id string")
    with pytest.raises(PySparkException, match="duplicate account id"):
        ledger.join_chart(postings, coa.unionByName(coa)).collect()


@pytest.mark.parametrize("change", ["missing", "repeated"])
def test_each_step_needs_both_forecasts(spark, change):
    rows = [("E", m, date(2024, s, 1), s, 100.0, 90.0, 110.0) for m in paths.POINTS for s in range(1, 13)]
    rows = [r for r in rows if r[1] == "revenue" or r[3] != 5] if change == "missing" else rows + [rows[-1]]
    forecasts = spark.createDataFrame(rows, "entity_id string, metric string, period date, step int, forecast double, ci_lower double, ci_upper double")
    history = spark.createDataFrame([("E", *[1.0] * 12)], "entity_id string, " + ", ".join(f"{c} double" for c in (
        "margin_mean margin_std dso_mean dso_std dpo_mean dpo_std other_cf_mean other_cf_std opening_ar opening_ap opening_cash debt").split()))
    with pytest.raises(PySparkException, match="one revenue and one expense"):
        paths.calibrate(forecasts, history, ["base"]).collect()


def test_forecast_queries_run_with_all_models():
    from harness.catalog import QUERIES

    for name in ("forecasts", "cash_paths", "consolidated_paths", "cash_fan", "liquidity_metrics", "plan_search"):
        assert f"{name}_all_models" in QUERIES


def smooth_error(values, alpha, beta, gamma):
    """Squared one-step error, in plain Python."""
    n = smoothing.SEASON
    if len(values) >= smoothing.MIN_SEASONAL:
        first, second = sum(values[:n]) / n, sum(values[n:2 * n]) / n
        trend = (second - first) / n
        level, season = first + trend * (n - 1) / 2, [v - first - trend * (i - (n - 1) / 2) for i, v in enumerate(values[:n])]
        rest = values[n:]
    else:
        level, trend, season, rest, gamma = values[0], values[1] - values[0], [0.0] * n, values[1:], 0.0
    total = 0.0
    for y in rest:
        s, base = season.pop(0), level + trend
        total += (y - base - s) ** 2
        new = alpha * (y - s) + (1 - alpha) * base
        trend = beta * (new - level) + (1 - beta) * trend
        season.append(gamma * (y - new) + (1 - gamma) * s)
        level = new
    return total


def test_weights_are_a_minimum_and_never_worse_than_the_grid(spark):
    rng = random.Random(12)
    rows = {}
    for k, n in enumerate((2, 3, 10, 23, 24, 30, 60)):
        rows[f"s{k}"] = [100 + 3 * i + 20 * (i % 12 in (3, 4)) + rng.gauss(0, 15) for i in range(n)]
    rows["flat"] = [5.0] * 40
    rows["walk"] = list(itertools.accumulate(rng.gauss(0, 5) for _ in range(48)))
    df = spark.createDataFrame([(k, "m", v, date(2024, 1, 1)) for k, v in rows.items()], "entity_id string, metric string, values array<double>, last_period date")
    for r in smoothing.fit_weights(df).collect():
        values, at = rows[r.entity_id], (r.weights.alpha, r.weights.beta, r.weights.gamma)
        assert r.sse == pytest.approx(smooth_error(values, *at), rel=1e-9, abs=1e-9)
        grid = min(smooth_error(values, *p) for p in itertools.product(*smoothing.GRID))
        assert r.grid_sse == pytest.approx(grid, rel=1e-9, abs=1e-9) and r.sse <= grid * (1 + 1e-12) + 1e-12
        if r.step < smoothing.LEAST_STEP:
            for axis in range(3):
                for d in (-2 * r.step, 2 * r.step):
                    near = [min(1.0, max(0.0, w + (d if i == axis else 0))) for i, w in enumerate(at)]
                    assert smooth_error(values, *near) >= r.sse * (1 - 1e-9) - 1e-9
