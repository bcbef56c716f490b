"""Queries over forecasts, scenario cash paths, liquidity risk and cash plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harness.books import EXTRA_DUCK_VIEWS as V
from harness.books import Books
from harness.present import plain
from harness.q_statements import three_statements
from harness.registry import query
from harness.sql_books import month, ratio
from tallystone.config import SCENARIOS, ForecastSettings, LiquiditySettings, PlanSettings, SimulationSettings
from tallystone.operators import boosting, cash_plan, forecasting, liquidity, paths, reports, smoothing
from tallystone.operators.working_capital import working_capital

SETTINGS = ForecastSettings()
SIMULATION = SimulationSettings()
ALL_SCENARIOS = list(SCENARIOS)
# Policies at the size of the derived books.
RISK_POLICY = LiquiditySettings(minimum_cash=650_000_000.0)
PLAN_POLICY = PlanSettings(policy_minimum_cash=450_000_000.0, max_borrowing=60_000_000.0)
PLAN_RISK = LiquiditySettings(minimum_cash=PLAN_POLICY.policy_minimum_cash)


def statement_tables(b: Books) -> tuple[DataFrame, DataFrame, DataFrame]:
    tables = []
    for i, name in enumerate(("income_statement", "balance_sheet", "cash_flow")):
        tables.append(b.once(f"stored_{name}", lambda books, i=i: three_statements(books)[i]))
    return tuple(tables)


def series(b: Books) -> DataFrame:
    return b.once("series", lambda books: forecasting.to_series(forecasting.forecast_panel(*statement_tables(books))))


V["panel"] = """
SELECT i.entity_id, i.period, CAST(revenue AS DOUBLE) AS revenue, CAST(operating_expense AS DOUBLE) AS operating_expense,
       CAST(accounts_receivable AS DOUBLE) AS accounts_receivable, CAST(accounts_payable AS DOUBLE) AS accounts_payable,
       CAST(operating_cf AS DOUBLE) AS operating_cf, CAST(cash AS DOUBLE) AS ending_cash
FROM [income_statement] i JOIN [balance_sheet] b ON b.entity_id = i.entity_id AND b.period = i.period
JOIN [cash_flow] c ON c.entity_id = i.entity_id AND c.period = i.period"""
V["series"] = " UNION ALL ".join(
    f"SELECT entity_id, '{m}' AS metric, period, {m} AS value FROM [panel]" for m in forecasting.METRICS
)
V["arrays"] = """
SELECT entity_id, metric, list(value ORDER BY period) AS vals, max(period) AS last_period FROM [series]
GROUP BY entity_id, metric"""
V["train"] = """
SELECT entity_id, metric, vals[1:len(vals) - 6] AS vals, vals[len(vals) - 5:] AS actuals FROM [arrays]"""


def _baselines(source: str, horizon: int) -> str:
    return f"""
SELECT entity_id, metric, 'naive' AS model, s AS step, vals[len(vals)] AS forecast
FROM [{source}], (SELECT CAST(unnest(range(1, {horizon + 1})) AS INTEGER) AS s)
UNION ALL
SELECT entity_id, metric, 'seasonal_naive', s,
       CASE WHEN len(vals) >= 12 THEN vals[len(vals) - 11 + (s - 1) % 12] ELSE vals[len(vals)] END
FROM [{source}], (SELECT CAST(unnest(range(1, {horizon + 1})) AS INTEGER) AS s)"""


V["future"] = _baselines("arrays", 12)
V["holdout_forecasts"] = _baselines("train", 6)
V["compared"] = """
SELECT f.*, t.actuals[f.step] AS actual FROM [holdout_forecasts] f JOIN [train] t USING (entity_id, metric)"""
V["evaluation"] = """
SELECT *, row_number() OVER (PARTITION BY entity_id, metric ORDER BY rmse, CASE model WHEN 'naive' THEN 1 ELSE 2 END) = 1 AS selected
FROM (SELECT entity_id, metric, model, avg(abs(actual - forecast)) AS mae, sqrt(avg((actual - forecast) ** 2)) AS rmse,
             100 * avg(abs(actual - forecast) / abs(actual)) FILTER (WHERE actual <> 0) AS mape,
             100 * avg(2 * abs(actual - forecast) / (abs(actual) + abs(forecast))) FILTER (WHERE abs(actual) + abs(forecast) <> 0) AS smape,
             stddev_samp(actual - forecast) AS residual_std
      FROM [compared] GROUP BY entity_id, metric, model)"""
V["forecasts"] = """
SELECT f.entity_id, f.metric, CAST(a.last_period + to_months(f.step) AS DATE) AS period, f.step, f.forecast, f.model,
       f.forecast - 1.96 * e.residual_std * sqrt(f.step) AS ci_lower,
       f.forecast + 1.96 * e.residual_std * sqrt(f.step) AS ci_upper
FROM [future] f JOIN [evaluation] e ON e.entity_id = f.entity_id AND e.metric = f.metric AND e.model = f.model AND e.selected
JOIN [arrays] a ON a.entity_id = f.entity_id AND a.metric = f.metric"""


@query("forecast_panel", f"SELECT entity_id, {month()}, {ratio(*forecasting.METRICS, digits=5)} FROM [panel]")
def forecast_panel(b: Books) -> DataFrame:
    return plain(forecasting.forecast_panel(*three_statements(b)), digits=5)


@query("forecast_series_long", f"SELECT entity_id, metric, {month()}, round(value, 5) AS value FROM [series]")
def forecast_series_long(b: Books) -> DataFrame:
    return plain(forecasting.to_series(forecasting.forecast_panel(*statement_tables(b))), digits=5)


@query(
    "lag_features",
    f"""SELECT entity_id, metric, {month()}, {ratio('target', 'lag_1', 'lag_2', 'lag_3', 'lag_12', digits=5)},
               round(rolling_mean, 5) AS rolling_mean, round(sin(2 * pi() * month(period) / 12), 5) AS month_sin,
               round(cos(2 * pi() * month(period) / 12), 5) AS month_cos, CAST(rn - 1 AS INTEGER) AS trend_index
        FROM (SELECT entity_id, metric, period, value AS target, lag(value, 1) OVER w AS lag_1, lag(value, 2) OVER w AS lag_2,
                     lag(value, 3) OVER w AS lag_3, lag(value, 12) OVER w AS lag_12,
                     avg(value) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_mean, row_number() OVER w AS rn
              FROM [series] WINDOW w AS (PARTITION BY entity_id, metric ORDER BY period)) WHERE lag_12 IS NOT NULL""",
)
def lag_features(b: Books) -> DataFrame:
    return plain(forecasting.lag_features(series(b)), digits=5)


@query(
    "time_split",
    f"""SELECT entity_id, metric, {month()}, row_number() OVER (PARTITION BY entity_id, metric ORDER BY period DESC) <= 6 AS is_validation
        FROM [series]""",
)
def time_split(b: Books) -> DataFrame:
    return plain(forecasting.time_split(series(b), SETTINGS.validation_months).drop("value"))


def _model_query(name: str) -> str:
    return f"SELECT entity_id, metric, model, step, round(forecast, 3) AS forecast FROM [future] WHERE model = '{name}'"


@query("forecast_naive", _model_query("naive"))
def forecast_naive(b: Books) -> DataFrame:
    return plain(forecasting.naive(forecasting.to_arrays(series(b)), SETTINGS.horizon), digits=3)


@query("forecast_seasonal_naive", _model_query("seasonal_naive"))
def forecast_seasonal_naive(b: Books) -> DataFrame:
    return plain(forecasting.seasonal_naive(forecasting.to_arrays(series(b)), SETTINGS.horizon), digits=3)


@query("forecast_holt_winters")
def forecast_holt_winters(b: Books) -> DataFrame:
    return plain(smoothing.exponential_smoothing(forecasting.to_arrays(series(b)), SETTINGS.horizon))


@query("forecast_gbt")
def forecast_gbt(b: Books) -> DataFrame:
    return plain(boosting.gradient_boosting(forecasting.to_arrays(series(b)), SETTINGS.horizon))


def competing(b: Books) -> dict[str, forecasting.Model]:
    """SQL expresses the baselines; `<query>_all_models` runs all."""
    return forecasting.all_models() if b.models == "all" else forecasting.BASELINES


def compared(b: Books) -> DataFrame:
    return forecasting.holdout(forecasting.to_arrays(series(b)), competing(b), SETTINGS)


_ERRORS = ("mae", "rmse", "mape", "smape")


@query("forecast_metrics", f"SELECT entity_id, metric, model, {ratio(*_ERRORS, digits=3, off_ties=True)} FROM [evaluation]", models=True)
def forecast_metrics(b: Books) -> DataFrame:
    return plain(forecasting.error_metrics(compared(b)), digits=3, off_ties=True)


@query(
    "forecast_evaluation",
    f"SELECT entity_id, metric, model, step, {ratio('forecast', 'actual', digits=3)} FROM [compared]",
    models=True,
)
def forecast_evaluation(b: Books) -> DataFrame:
    return plain(compared(b), digits=3)


@query("forecast_selection", "SELECT entity_id, metric, model FROM [evaluation] WHERE selected", models=True)
def forecast_selection(b: Books) -> DataFrame:
    chosen = forecasting.select_models(forecasting.error_metrics(compared(b)))
    return chosen.where("selected").select("entity_id", "metric", "model")


def forecasts(b: Books) -> DataFrame:
    return b.once("forecasts", lambda books: forecasting.build_forecasts(series(books), competing(books))[0])


def evaluation(b: Books) -> DataFrame:
    return forecasting.build_forecasts(series(b), competing(b))[1]


@query(
    "forecast_intervals",
    "SELECT entity_id, metric, model, round(residual_std, 3) AS residual_std FROM [evaluation]",
    models=True,
)
def forecast_intervals(b: Books) -> DataFrame:
    return plain(forecasting.residual_deviation(compared(b)), digits=3)


@query(
    "forecasts",
    f"SELECT entity_id, metric, {month()}, step, model, {ratio('forecast', 'ci_lower', 'ci_upper', digits=3)} FROM [forecasts]",
    models=True,
)
def forecasts_query(b: Books) -> DataFrame:
    return plain(forecasting.build_forecasts(series(b), competing(b))[0], digits=3)


@query("model_wins", "SELECT model, count(*) AS n_series FROM [evaluation] WHERE selected GROUP BY model", models=True)
def model_wins(b: Books) -> DataFrame:
    return forecasting.model_wins(evaluation(b))


@query(
    "actual_vs_forecast",
    f"""SELECT entity_id, metric, {month()}, 'actual' AS kind, round(value, 5) AS value, CAST(NULL AS DOUBLE) AS ci_lower,
               CAST(NULL AS DOUBLE) AS ci_upper FROM [series]
        UNION ALL SELECT entity_id, metric, {month()}, 'forecast', round(forecast, 5), round(ci_lower, 5), round(ci_upper, 5)
        FROM [forecasts]""",
    models=True,
)
def actual_vs_forecast(b: Books) -> DataFrame:
    return plain(reports.actual_and_forecast(series(b), forecasts(b)), digits=5)


@query(
    "model_comparison",
    f"""SELECT model, {ratio(*_ERRORS, digits=3, off_ties=True)}, selected FROM [evaluation]
        WHERE entity_id = 'ASIA' AND metric = 'revenue' ORDER BY rmse, model""",
    models=True,
)
def model_comparison(b: Books) -> DataFrame:
    return plain(reports.model_comparison(evaluation(b), "ASIA", "revenue"), digits=3, off_ties=True)


# Smoothing at given weights, and what the search makes of them.

WEIGHTS = (0.3, 0.1, 0.2)
V["smooth_start"] = """
SELECT entity_id, metric, vals, m1 + (m2 - m1) / 12 * 5.5 AS level, (m2 - m1) / 12 AS trend,
       list_transform(range(12), lambda i: vals[i + 1] - m1 - (m2 - m1) / 12 * (i - 5.5)) AS season
FROM (SELECT *, list_sum(vals[1:12]) / 12 AS m1, list_sum(vals[13:24]) / 12 AS m2 FROM [arrays])"""
V["smooth_walk"] = f"""
WITH RECURSIVE walk AS (
  SELECT entity_id, metric, vals, 12 AS i, level, trend, season, 0.0::DOUBLE AS sse FROM [smooth_start]
  UNION ALL
  SELECT entity_id, metric, vals, i + 1, new_level, {WEIGHTS[1]} * (new_level - level) + {1 - WEIGHTS[1]} * trend,
         list_append(season[2:12], {WEIGHTS[2]} * (vals[i + 1] - new_level) + {1 - WEIGHTS[2]} * season[1]),
         sse + (vals[i + 1] - level - trend - season[1]) ** 2
  FROM (SELECT *, {WEIGHTS[0]} * (vals[i + 1] - season[1]) + {1 - WEIGHTS[0]} * (level + trend) AS new_level FROM walk WHERE i < len(vals)))
SELECT * FROM walk WHERE i = len(vals)"""


@query(
    "smoothing_recursion",
    "SELECT entity_id, metric, round(level, 2) AS level, round(trend, 3) AS trend, round(season[1], 2) AS next_season, round(sqrt(sse), 1) AS error FROM [smooth_walk]",
)
def smoothing_recursion(b: Books) -> DataFrame:
    """Every series smoothed with given weights."""
    weights = F.struct(*[F.lit(w).alias(n) for n, w in zip(("alpha", "beta", "gamma"), WEIGHTS)])
    states = smoothing.smoothed_states(forecasting.to_arrays(series(b)).withColumn("weights", weights))
    return states.select(
        "entity_id", "metric", F.round("state.level", 2).alias("level"), F.round("state.trend", 3).alias("trend"),
        F.round(F.col("state.season")[0], 2).alias("next_season"), F.round(F.sqrt("state.sse"), 1).alias("error"),
    )


@query("smoothing_weights")
def smoothing_weights(b: Books) -> DataFrame:
    """The weights of each series, with their error and that of the best point of the grid."""
    found = smoothing.fit_weights(forecasting.to_arrays(series(b)))
    return plain(found.select("entity_id", "metric", "weights.*", "sse", "grid_sse"), digits=4)


# Scenario paths

_SHIFTS = ", ".join(
    f"('{s}', {v['revenue_pct']}::DOUBLE, {v['opex_pct']}::DOUBLE, {v['dso_days']}::DOUBLE, {v['dpo_days']}::DOUBLE)"
    for s, v in SCENARIOS.items()
)
V["scenario_shifts"] = f"SELECT * FROM (VALUES {_SHIFTS}) AS s(scenario, revenue_pct, opex_pct, dso_days, dpo_days)"
V["history"] = """
SELECT i.entity_id, margin_mean, margin_std, dso_mean, dso_std, dpo_mean, dpo_std, cf_mean, cf_std,
       CAST(b.accounts_receivable AS DOUBLE) AS opening_ar, CAST(b.accounts_payable AS DOUBLE) AS opening_ap,
       CAST(b.cash AS DOUBLE) AS opening_cash, CAST(b.debt AS DOUBLE) AS debt
FROM (SELECT entity_id, avg(1 - CAST(cogs AS DOUBLE) / nullif(CAST(revenue AS DOUBLE), 0)) AS margin_mean,
             stddev_samp(1 - CAST(cogs AS DOUBLE) / nullif(CAST(revenue AS DOUBLE), 0)) AS margin_std
      FROM [income_statement] GROUP BY 1) i
JOIN (SELECT entity_id, avg(dso) AS dso_mean, stddev_samp(dso) AS dso_std, avg(dpo) AS dpo_mean, stddev_samp(dpo) AS dpo_std
      FROM [working_capital] GROUP BY 1) w ON w.entity_id = i.entity_id
JOIN (SELECT entity_id, avg(CAST(investing_cf AS DOUBLE)) AS cf_mean, stddev_samp(CAST(investing_cf AS DOUBLE)) AS cf_std
      FROM [cash_flow] GROUP BY 1) c ON c.entity_id = i.entity_id
JOIN (SELECT * FROM [balance_sheet] QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY period DESC) = 1) b
  ON b.entity_id = i.entity_id"""
V["calibration"] = """
SELECT s.scenario, r.entity_id, r.step, r.period, r.forecast * (1 + revenue_pct) AS revenue_point,
       (r.ci_upper - r.ci_lower) / 3.92 AS revenue_sigma, o.forecast * (1 + opex_pct) AS opex_point,
       (o.ci_upper - o.ci_lower) / 3.92 AS opex_sigma, margin_mean, greatest(margin_std, 1e-6) AS margin_std,
       dso_mean + dso_days AS dso_mean, greatest(dso_std, 1e-6) AS dso_std, greatest(1.0, dpo_mean + dpo_days) AS dpo_mean,
       greatest(dpo_std, 1e-6) AS dpo_std, cf_mean AS other_cf_mean, greatest(cf_std, 1e-6) AS other_cf_std,
       debt * 0.065 / 12 AS monthly_interest, opening_ar, opening_ap, opening_cash, day(last_day(r.period)) AS days
FROM [forecasts] r JOIN [forecasts] o ON o.entity_id = r.entity_id AND o.step = r.step AND o.metric = 'operating_expense'
JOIN [history] h ON h.entity_id = r.entity_id, [scenario_shifts] s WHERE r.metric = 'revenue'"""
_CALIBRATED = (
    "revenue_point", "revenue_sigma", "opex_point", "opex_sigma", "margin_mean", "margin_std", "dso_mean", "dso_std",
    "dpo_mean", "dpo_std", "other_cf_mean", "other_cf_std", "monthly_interest", "opening_ar", "opening_ap", "opening_cash",
)


def calibrated(b: Books) -> DataFrame:
    def build(books: Books) -> DataFrame:
        income, sheet, flow = statement_tables(books)
        history = paths.entity_history(income, working_capital(income, sheet), flow, sheet)
        return paths.calibrate(forecasts(books), history, ALL_SCENARIOS, SIMULATION)

    return b.once("calibration", build)


def simulated(b: Books) -> DataFrame:
    return b.once("paths", lambda books: paths.cash_paths(calibrated(books), SIMULATION))


def consolidated(b: Books) -> DataFrame:
    return paths.consolidate(simulated(b))


def _uniform(variable: str, start: int) -> str:
    key = f"md5(concat_ws('|', '42', entity_id, '{variable}', sim_id::VARCHAR, step::VARCHAR))"
    return f"((('0x' || substr({key}, {start}, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)"


_Z = ", ".join(
    f"sqrt(-2 * ln({_uniform(v, 1)})) * cos(2 * pi() * {_uniform(v, 14)}) AS z_{v}" for v in paths.VARIABLES
)
V["draws"] = f"""
SELECT entity_id, step, sim_id, {_Z}
FROM (SELECT DISTINCT entity_id, step FROM [calibration]), (SELECT CAST(unnest(range(0, {SIMULATION.n_simulations})) AS INTEGER) AS sim_id)"""
V["path_flows"] = """
SELECT *, revenue * greatest(dso_mean + dso_std * z_dso, 1) / days AS ar, spend * greatest(dpo_mean + dpo_std * z_dpo, 1) / days AS ap,
       other_cf_mean + other_cf_std * z_other_cf - monthly_interest AS other_cf
FROM (SELECT *, revenue * (1 - least(greatest(margin_mean + margin_std * z_margin, 0.05), 0.95)) + opex AS spend
FROM (SELECT c.*, d.* EXCLUDE (entity_id, step), greatest(revenue_point + revenue_sigma * z_revenue, 0) AS revenue,
             greatest(opex_point + opex_sigma * z_opex, 0) AS opex
      FROM [calibration] c JOIN [draws] d ON d.entity_id = c.entity_id AND d.step = c.step))"""
V["paths"] = """
SELECT scenario, entity_id, sim_id, step, period, revenue, opex, ar, ap, operating_cf,
       opening_cash + sum(operating_cf + other_cf) OVER (PARTITION BY scenario, entity_id, sim_id ORDER BY step) AS cash
FROM (SELECT *, coalesce(lag(ar) OVER w, opening_ar) + revenue - ar - (coalesce(lag(ap) OVER w, opening_ap) + spend - ap) AS operating_cf
      FROM [path_flows] WINDOW w AS (PARTITION BY scenario, entity_id, sim_id ORDER BY step))"""
V["consolidated"] = "SELECT scenario, sim_id, step, period, sum(cash) AS cash FROM [paths] GROUP BY ALL"


@query("scenario_inputs", f"""SELECT scenario, entity_id, step, round(forecast * (1 + revenue_pct), 2) AS revenue_point
       FROM [forecasts], [scenario_shifts] WHERE metric = 'revenue'""", models=True)
def scenario_inputs(b: Books) -> DataFrame:
    shifted = paths.with_scenarios(forecasts(b).where(F.col("metric") == "revenue"), ALL_SCENARIOS)
    point = F.col("forecast") * (1 + F.col("revenue_pct"))
    return plain(shifted.select("scenario", "entity_id", "step", point.alias("revenue_point")), digits=2)


@query("cash_calibration", f"SELECT scenario, entity_id, step, {month()}, {ratio(*_CALIBRATED, digits=4)}, days FROM [calibration]", models=True)
def cash_calibration(b: Books) -> DataFrame:
    income, sheet, flow = statement_tables(b)
    history = paths.entity_history(income, working_capital(income, sheet), flow, sheet)
    return plain(paths.calibrate(forecasts(b), history, ALL_SCENARIOS, SIMULATION), digits=4)


@query("cash_paths", f"SELECT scenario, entity_id, sim_id, step, {month()}, {ratio('operating_cf', 'cash', digits=1)} FROM [paths]", models=True)
def cash_paths(b: Books) -> DataFrame:
    built = paths.cash_paths(calibrated(b), SIMULATION)
    return plain(built.select("scenario", "entity_id", "sim_id", "step", "period", "operating_cf", "cash"), digits=1)


@query("consolidated_paths", f"SELECT scenario, sim_id, step, {month()}, round(cash, 1) AS cash FROM [consolidated]", models=True)
def consolidated_paths(b: Books) -> DataFrame:
    return plain(consolidated(b), digits=1)


_FAN = ", ".join(f"round(quantile_cont(cash, {p / 100}), 1) AS p{p}" for p in paths.PERCENTILES)


@query(
    "cash_fan",
    f"""SELECT scenario, entity_id, step, {month()}, round(avg(cash), 1) AS mean, round(quantile_cont(cash, 0.5), 1) AS median, {_FAN}
        FROM (SELECT scenario, entity_id, step, period, cash FROM [paths]
              UNION ALL SELECT scenario, 'CONSOLIDATED', step, period, cash FROM [consolidated]) GROUP BY scenario, entity_id, step, period""",
    models=True,
)
def cash_fan(b: Books) -> DataFrame:
    return plain(paths.cash_fan(simulated(b)), digits=1)


def _metrics_sql(source: str, minimum: float, extra: str = "") -> str:
    return f"""
SELECT scenario, {extra}round({minimum}::DOUBLE, 1) AS minimum_cash_requirement, avg((m > 0)::INT) AS p,
       avg(low) AS expected_minimum_cash, min(low) AS worst_simulated_cash, max(high) AS best_simulated_cash,
       avg(m) AS avg_months_below_threshold, max(m) AS max_months_below_threshold, avg(mean_cash) AS average_cash
FROM (SELECT scenario, sim_id, min(cash) AS low, max(cash) AS high, avg(cash) AS mean_cash,
             count(*) FILTER (WHERE cash < {minimum}) AS m FROM {source} GROUP BY scenario, sim_id) GROUP BY scenario"""


_RISK = "CASE WHEN p <= 0.05 THEN 'LOW' WHEN p <= 0.2 THEN 'MEDIUM' WHEN p <= 0.5 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_score"
_RISK_COLUMNS = f"""minimum_cash_requirement, round(p, 6) AS probability_of_liquidity_breach,
 {ratio('expected_minimum_cash', 'worst_simulated_cash', 'best_simulated_cash', digits=1)},
 round(avg_months_below_threshold, 6) AS avg_months_below_threshold, max_months_below_threshold,
 round(p * 100, 6) AS pct_simulations_ever_breaching, round(average_cash, 1) AS average_cash, {_RISK}"""


def _present_risk(df: DataFrame) -> DataFrame:
    cents = ("expected_minimum_cash", "worst_simulated_cash", "best_simulated_cash", "average_cash")
    return plain(df.select(*[F.round(c, 1).alias(c) if c in cents else F.col(c) for c in df.columns]))


@query("liquidity_metrics", f"SELECT scenario, {_RISK_COLUMNS} FROM ({_metrics_sql('[consolidated]', RISK_POLICY.minimum_cash)})", models=True)
def liquidity_metrics(b: Books) -> DataFrame:
    return _present_risk(liquidity.liquidity_metrics(consolidated(b), RISK_POLICY))


@query(
    "breach_by_month",
    f"""SELECT scenario, step, {month()}, round(avg((cash < {RISK_POLICY.minimum_cash})::INT), 6) AS probability_of_breach,
               round(quantile_cont(cash, 0.5), 1) AS median_cash, round(quantile_cont(cash, 0.05), 1) AS p5_cash
        FROM [consolidated] GROUP BY scenario, step, period""",
    models=True,
)
def breach_by_month(b: Books) -> DataFrame:
    monthly = liquidity.breach_by_month(consolidated(b), RISK_POLICY)
    return plain(monthly.withColumns({c: F.round(c, 1) for c in ("median_cash", "p5_cash")}))


@query(
    "risk_score",
    f"""SELECT scenario, step, {_RISK} FROM (SELECT scenario, step, avg((cash < {RISK_POLICY.minimum_cash})::INT) AS p
        FROM [consolidated] GROUP BY scenario, step)""",
    models=True,
)
def risk_score(b: Books) -> DataFrame:
    monthly = liquidity.breach_by_month(consolidated(b), RISK_POLICY)
    return monthly.select("scenario", "step", liquidity.risk_score(F.col("probability_of_breach")).alias("risk_score"))


@query(
    "scenario_risk",
    f"""SELECT scenario, {_RISK}, round(p, 6) AS probability_of_liquidity_breach,
               {ratio('expected_minimum_cash', 'worst_simulated_cash', digits=1)}
        FROM ({_metrics_sql('[consolidated]', RISK_POLICY.minimum_cash)}) WHERE scenario <> 'stress'""",
    models=True,
)
def scenario_risk(b: Books) -> DataFrame:
    chosen = consolidated(b).where(F.col("scenario") != "stress")
    return _present_risk(liquidity.liquidity_metrics(chosen, RISK_POLICY)).select(
        "scenario", "risk_score", "probability_of_liquidity_breach", "expected_minimum_cash", "worst_simulated_cash"
    )


# Cash plans

V["entity_baseline"] = """
SELECT *, opening_cash + sum(net_cf) OVER (PARTITION BY scenario, entity_id ORDER BY step) AS cash_baseline
FROM (SELECT *, coalesce(lag(ar) OVER w, opening_ar) + revenue - ar - (coalesce(lag(ap) OVER w, opening_ap) + spend - ap)
              + other_cf_mean - monthly_interest AS net_cf
      FROM (SELECT *, revenue * dso_mean / days AS ar, spend * dpo_mean / days AS ap
            FROM (SELECT *, revenue_point AS revenue, revenue_point * (1 - margin_mean) + opex_point AS spend,
                         greatest(-other_cf_mean, 0) AS planned_capex FROM [calibration]))
      WINDOW w AS (PARTITION BY scenario, entity_id ORDER BY step))"""
_BASE = ("revenue", "spend", "planned_capex", "net_cf", "opening_cash", "cash_baseline")
V["baseline"] = (
    "SELECT scenario, step, period, " + ", ".join(f"sum({c}) AS {c}" for c in _BASE)
    + " FROM [entity_baseline] GROUP BY scenario, step, period"
)
V["floors"] = f"""
SELECT b.*, {PLAN_POLICY.policy_minimum_cash} + 3.0 * s.cash_std AS floor,
       min(cash_baseline) OVER (PARTITION BY b.scenario) - 2750000.0 AS real_policy_headroom, s.cash_std
FROM [baseline] b JOIN (SELECT scenario, step, stddev_samp(cash) AS cash_std FROM [consolidated] GROUP BY 1, 2) s
  ON s.scenario = b.scenario AND s.step = b.step"""


def baseline(b: Books) -> DataFrame:
    return cash_plan.consolidated_baseline(cash_plan.entity_baseline(calibrated(b), SIMULATION))


def floors(b: Books) -> DataFrame:
    return cash_plan.buffered_floor(baseline(b), consolidated(b), PLAN_POLICY)


def plan(b: Books) -> DataFrame:
    return b.once("plan", lambda books: cash_plan.search_plan(floors(books), PLAN_POLICY))


@query("cash_baseline", f"SELECT scenario, step, {month()}, {ratio(*_BASE, digits=2)} FROM [baseline]", models=True)
def cash_baseline(b: Books) -> DataFrame:
    return plain(baseline(b), digits=2)


@query("buffered_floor", f"SELECT scenario, step, {month()}, {ratio('cash_baseline', 'cash_std', 'floor', 'real_policy_headroom', digits=1)} FROM [floors]", models=True)
def buffered_floor(b: Books) -> DataFrame:
    kept = ("cash_baseline", "cash_std", "floor", "real_policy_headroom")
    return plain(floors(b).select("scenario", "step", "period", *kept), digits=1)


V["plan_feasible"] = f"""
SELECT scenario, CASE WHEN max(floor - cash_baseline - deferred - early - cut) <= {PLAN_POLICY.max_borrowing} THEN 'optimal' ELSE 'infeasible' END AS status
FROM (SELECT scenario, floor, cash_baseline,
             avg(spend) OVER (PARTITION BY scenario) * {PLAN_POLICY.max_payment_delay_days / 30} AS deferred,
             sum(revenue) OVER w * {PLAN_POLICY.max_collections_acceleration_pct} AS early,
             sum(planned_capex) OVER w * {PLAN_POLICY.max_capex_reduction_pct} AS cut
      FROM [floors] WINDOW w AS (PARTITION BY scenario ORDER BY step)) GROUP BY scenario"""


@query("plan_status", "SELECT scenario, status FROM [plan_feasible]", models=True)
def plan_status(b: Books) -> DataFrame:
    """Each scenario, with a plan or without: all levers at their limits keep the floors, or nothing does."""
    return cash_plan.plan_status(floors(b), plan(b)).select("scenario", "status")


# The plan in SQL: all corners of the two totals, costed one by one. Amounts as in the operator, from its settings.
V["plan_months"] = f"""
SELECT *, shortfall - defer_cap AS need, shortfall - defer_cap - {PLAN_POLICY.max_borrowing} AS must FROM (
  SELECT scenario, step, period, cash_baseline, greatest(floor - cash_baseline, 0.0) AS shortfall,
         sum(revenue * {PLAN_POLICY.max_collections_acceleration_pct}) OVER w AS accel_upto,
         sum(planned_capex * {PLAN_POLICY.max_capex_reduction_pct}) OVER w AS cut_upto,
         avg(spend) OVER (PARTITION BY scenario) * {PLAN_POLICY.max_payment_delay_days / 30} AS defer_cap
  FROM [floors] WINDOW w AS (PARTITION BY scenario ORDER BY step))"""
V["plan_levels"] = "SELECT scenario, need AS level FROM [plan_months] UNION SELECT scenario, must FROM [plan_months]"
V["plan_limits"] = "SELECT scenario, max(accel_upto) AS most_accel, max(cut_upto) AS most_cut FROM [plan_months] GROUP BY scenario"


def _totals(own: str, other: str, most: str) -> str:
    return f"""
SELECT DISTINCT scenario, v FROM (
  SELECT scenario, 0.0::DOUBLE AS v FROM [plan_limits] UNION ALL SELECT scenario, {own} FROM [plan_months]
  UNION ALL SELECT scenario, level FROM [plan_levels]
  UNION ALL SELECT l.scenario, l.level - m.{other} FROM [plan_levels] l JOIN [plan_months] m ON m.scenario = l.scenario)
JOIN [plan_limits] USING (scenario) WHERE v >= 0 AND v <= {most} + {cash_plan.EPSILON}"""


V["plan_accels"] = _totals("accel_upto", "cut_upto", "most_accel")
V["plan_cuts"] = _totals("cut_upto", "accel_upto", "most_cut")
V["plan_corners"] = f"""
SELECT DISTINCT scenario, a, c FROM (
  SELECT a.scenario, a.v AS a, c.v AS c FROM [plan_accels] a JOIN [plan_cuts] c ON c.scenario = a.scenario
  UNION ALL SELECT a.scenario, a.v, l.level - a.v FROM [plan_accels] a JOIN [plan_levels] l ON l.scenario = a.scenario
  UNION ALL SELECT c.scenario, l.level - c.v, c.v FROM [plan_cuts] c JOIN [plan_levels] l ON l.scenario = c.scenario)
JOIN [plan_limits] USING (scenario)
WHERE a >= 0 AND c >= 0 AND a <= most_accel + {cash_plan.EPSILON} AND c <= most_cut + {cash_plan.EPSILON}"""
V["plan_best"] = f"""
SELECT scenario, a, c, total_cost FROM (
  SELECT scenario, a, c, max(borrow) AS peak,
         sum(borrow) * {PLAN_POLICY.borrowing_rate_annual / 12} + a * {PLAN_POLICY.factoring_discount_rate} + c * {PLAN_POLICY.capex_delay_cost_rate} AS total_cost
  FROM (SELECT p.*, greatest(need - least(a, accel_upto) - least(c, cut_upto), 0.0) AS borrow
        FROM [plan_corners] p JOIN [plan_months] m ON m.scenario = p.scenario) GROUP BY scenario, a, c)
WHERE peak <= {PLAN_POLICY.max_borrowing} + {cash_plan.EPSILON}
QUALIFY row_number() OVER (PARTITION BY scenario ORDER BY round(total_cost, 4), a, c) = 1"""
V["plan_rows"] = """
SELECT *, borrow_balance + defer_balance + one_time AS net_adjustment, cash_baseline + borrow_balance + defer_balance + one_time AS cash_optimized
FROM (SELECT *, least(greatest(shortfall - one_time, 0.0), defer_cap) AS defer_balance
      FROM (SELECT m.scenario, step, period, total_cost, cash_baseline, shortfall, defer_cap,
                   greatest(need - least(a, accel_upto) - least(c, cut_upto), 0.0) AS borrow_balance,
                   least(a, accel_upto) + least(c, cut_upto) AS one_time,
                   least(a, accel_upto) - coalesce(lag(least(a, accel_upto)) OVER w, 0) AS accel,
                   least(c, cut_upto) - coalesce(lag(least(c, cut_upto)) OVER w, 0) AS capex_cut
            FROM [plan_months] m JOIN [plan_best] b ON b.scenario = m.scenario WINDOW w AS (PARTITION BY m.scenario ORDER BY step)))"""
_PLAN = ("total_cost", "borrow_balance", "defer_balance", "accel", "capex_cut", "cash_baseline", "net_adjustment", "cash_optimized")
_PLAN_COSTS = f"""
SELECT scenario, max(total_cost) AS total_cost, sum(borrow_balance) * {PLAN_POLICY.borrowing_rate_annual / 12} AS financing_cost,
       sum(accel) * {PLAN_POLICY.factoring_discount_rate} AS acceleration_cost, sum(capex_cut) * {PLAN_POLICY.capex_delay_cost_rate} AS capex_delay_cost,
       max(borrow_balance) AS max_borrow_balance, max(defer_balance) AS max_defer_balance, sum(accel) AS total_accelerated,
       sum(capex_cut) AS total_capex_cut FROM [plan_rows] GROUP BY scenario"""
_COSTS = ("total_cost", "financing_cost", "acceleration_cost", "capex_delay_cost", "max_borrow_balance", "max_defer_balance", "total_accelerated", "total_capex_cut")
V["planned_paths"] = """
SELECT c.scenario, c.sim_id, c.step, c.period, c.cash + p.net_adjustment AS cash FROM [consolidated] c
JOIN [plan_rows] p ON p.scenario = c.scenario AND p.step = c.step"""
V["unplanned_paths"] = "SELECT * FROM [consolidated] WHERE scenario IN (SELECT scenario FROM [plan_best])"


@query("plan_search", f"SELECT scenario, step, {month()}, {ratio(*_PLAN, digits=2)} FROM [plan_rows]", models=True)
def plan_search(b: Books) -> DataFrame:
    return plain(cash_plan.search_plan(floors(b), PLAN_POLICY), digits=2)


@query("plan_costs", f"SELECT scenario, {ratio(*_COSTS, digits=2)} FROM ({_PLAN_COSTS})", models=True)
def plan_costs(b: Books) -> DataFrame:
    return plain(cash_plan.plan_costs(plan(b), PLAN_POLICY), digits=2)


@query(
    "plan_before_after",
    " UNION ALL ".join(
        f"SELECT scenario, '{state}' AS state, {_RISK_COLUMNS} FROM ({_metrics_sql(f'[{source}]', PLAN_RISK.minimum_cash)})"
        for state, source in (("before", "unplanned_paths"), ("after", "planned_paths"))
    ),
    models=True,
)
def plan_before_after(b: Books) -> DataFrame:
    return _present_risk(cash_plan.before_and_after(consolidated(b), plan(b), PLAN_RISK))


@query(
    "plan_levers_long",
    """SELECT scenario, step, lever, round(amount, 2) AS amount
       FROM (UNPIVOT (SELECT scenario, step, borrow_balance, defer_balance, accel, capex_cut FROM [plan_rows])
             ON borrow_balance, defer_balance, accel, capex_cut INTO NAME lever VALUE amount)""",
    models=True,
)
def plan_levers_long(b: Books) -> DataFrame:
    return plain(reports.plan_levers(plan(b)), digits=2)
