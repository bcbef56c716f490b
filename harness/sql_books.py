"""Checking-database views of the statements, written independently of the Spark operators."""

from __future__ import annotations

from harness.books import EXTRA_DUCK_VIEWS as V

EUR = "DECIMAL(28,7)"

V["enriched"] = """
SELECT t.entity_id, t.business_unit, t.account_id, t.document_type, t.currency, t.period,
       t.document_id LIKE 'OPEN!_%' ESCAPE '!' AS opening_document,
       a.account_category AS coa_category, a.account_subcategory AS coa_subcategory,
       a.normal_balance AS coa_normal_balance, t.debit * f.rate_to_eur AS debit_eur,
       t.credit * f.rate_to_eur AS credit_eur,
       CASE WHEN a.normal_balance = 'Debit' THEN (t.debit - t.credit) * f.rate_to_eur
            ELSE (t.credit - t.debit) * f.rate_to_eur END AS contribution
FROM (SELECT *, CAST(date_trunc('month', transaction_date) AS DATE) AS period FROM [transactions]) t
LEFT JOIN [chart_of_accounts] a USING (account_id)
LEFT JOIN [fx_rates] f ON f.currency = t.currency AND f.rate_date = t.period"""


def _bucket_sum(condition: str) -> str:
    return f"CAST(coalesce(sum(CASE WHEN {condition} THEN contribution END), 0) AS {EUR})"


V["is_lines"] = f"""
SELECT entity_id, period, {_bucket_sum("coa_category = 'Revenue'")} AS revenue,
       {_bucket_sum("coa_category = 'COGS'")} AS cogs,
       {_bucket_sum("coa_category = 'Operating Expense' AND coa_subcategory NOT IN ('Depreciation Expense', 'Interest Expense', 'Tax Expense')")} AS operating_expense,
       {_bucket_sum("coa_subcategory = 'Depreciation Expense'")} AS depreciation,
       {_bucket_sum("coa_subcategory = 'Interest Expense'")} AS interest
FROM [enriched]
WHERE coa_category IN ('Revenue', 'COGS', 'Operating Expense')
  AND document_type IS DISTINCT FROM 'Opening Balance' AND entity_id IS NOT NULL AND period IS NOT NULL
GROUP BY entity_id, period"""

V["income_statement"] = f"""
SELECT entity_id, period, revenue, cogs, revenue - cogs AS gross_profit, operating_expense,
       revenue - cogs - operating_expense AS ebitda, depreciation,
       revenue - cogs - operating_expense - depreciation AS ebit, interest, pretax_income, taxes,
       pretax_income - taxes AS net_income
FROM (SELECT *, CAST(greatest(pretax_income, 0) * CAST(0.25 AS DECIMAL(5,4)) AS {EUR}) AS taxes
      FROM (SELECT *, CAST(revenue - cogs - operating_expense - depreciation - interest AS {EUR}) AS pretax_income
            FROM [is_lines]))"""

_GROUPS = {
    "cash": "Cash", "accounts_receivable": "Accounts Receivable", "inventory": "Inventory",
    "other_current_assets": "Other Current Assets", "fixed_assets_gross": "Fixed Assets",
    "accumulated_depreciation": "Accumulated Depreciation", "accounts_payable": "Accounts Payable",
    "debt": "Debt", "other_liabilities": "Other Liabilities", "common_stock": "Common Stock",
    "opening_equity_flow": "Retained Earnings",
}
_SUMS = ", ".join(f"{_bucket_sum(f'''coa_subcategory = '{s}' ''')} AS {n}" for n, s in _GROUPS.items())
V["bs_flows"] = f"""
SELECT entity_id, period, {_SUMS} FROM [enriched] WHERE coa_category IN ('Asset', 'Liability', 'Equity')
GROUP BY entity_id, period"""

_ZEROED = ", ".join(f"coalesce({n}, 0) AS {n}" for n in _GROUPS)
V["bs_grid"] = f"""
SELECT g.entity_id, g.period, {_ZEROED}
FROM (SELECT * FROM (SELECT DISTINCT entity_id FROM [bs_flows]), (SELECT DISTINCT period FROM [income_statement])) g
LEFT JOIN [bs_flows] f ON f.entity_id = g.entity_id AND f.period = g.period"""

_CUMULATED = ", ".join(f"CAST(sum({n}) OVER w AS {EUR}) AS {n}" for n in _GROUPS)
V["bs_running"] = f"""
SELECT entity_id, period, {_CUMULATED} FROM [bs_grid] WINDOW w AS (PARTITION BY entity_id ORDER BY period)"""

V["balance_sheet"] = f"""
SELECT *, CASE WHEN abs(difference) <= 0.01 THEN 'PASS' ELSE 'FAIL' END AS status,
       cash < 0 OR accounts_receivable < 0 OR inventory < 0 OR other_current_assets < 0 OR fixed_assets_gross < 0
           AS economically_implausible
FROM (SELECT *, total_assets - total_liabilities - total_equity AS difference
FROM (SELECT entity_id, period, cash, accounts_receivable, inventory, other_current_assets,
             cash + accounts_receivable + inventory + other_current_assets AS total_current_assets,
             fixed_assets_gross, accumulated_depreciation,
             fixed_assets_gross - accumulated_depreciation AS fixed_assets_net,
             cash + accounts_receivable + inventory + other_current_assets + fixed_assets_gross
                 - accumulated_depreciation AS total_assets,
             accounts_payable, debt, other_liabilities, income_tax_payable,
             accounts_payable + debt + other_liabilities + income_tax_payable AS total_liabilities, common_stock,
             retained_earnings, common_stock + retained_earnings AS total_equity
      FROM (SELECT b.*, CAST(coalesce(n.tax, 0) AS {EUR}) AS income_tax_payable,
                   CAST(first_value(opening_equity_flow) OVER (PARTITION BY b.entity_id ORDER BY b.period)
                        + coalesce(n.earned, 0) AS {EUR}) AS retained_earnings
            FROM [bs_running] b
            LEFT JOIN (SELECT entity_id, period, sum(net_income) OVER w AS earned, sum(taxes) OVER w AS tax
                       FROM [income_statement] WINDOW w AS (PARTITION BY entity_id ORDER BY period)) n
              ON n.entity_id = b.entity_id AND n.period = b.period)))"""

V["cash_sections"] = f"""
SELECT entity_id, period,
       CAST(coalesce(sum(flow) FILTER (WHERE document_type IN ('Cash Receipt', 'Vendor Payment', 'Payroll', 'Interest Payment')), 0) AS {EUR}) AS operating_cf,
       CAST(coalesce(sum(flow) FILTER (WHERE document_type = 'Capex'), 0) AS {EUR}) AS investing_cf,
       CAST(0 AS {EUR}) AS financing_cf,
       CAST(coalesce(sum(flow) FILTER (WHERE document_type NOT IN ('Cash Receipt', 'Vendor Payment', 'Payroll', 'Interest Payment', 'Capex')), 0) AS {EUR}) AS other_cf
FROM (SELECT *, debit_eur - credit_eur AS flow FROM [enriched] WHERE coa_subcategory = 'Cash'
      AND document_type <> 'Opening Balance') GROUP BY entity_id, period"""

V["opening_cash"] = """
SELECT entity_id, sum(debit_eur) AS opening_cash FROM [enriched] WHERE opening_document AND coa_subcategory = 'Cash'
GROUP BY entity_id"""

V["cash_flow"] = f"""
SELECT *, CASE WHEN reconciliation_diff <= 0.01 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT *, beginning_cash + net_change_in_cash AS ending_cash,
             abs(beginning_cash + net_change_in_cash - balance_sheet_cash) AS reconciliation_diff
FROM (SELECT s.entity_id, s.period, operating_cf, investing_cf, financing_cf,
             operating_cf + investing_cf + financing_cf AS net_change_in_cash,
             coalesce(last_value(b.cash IGNORE NULLS) OVER (PARTITION BY s.entity_id ORDER BY s.period
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), o.opening_cash, 0) AS beginning_cash,
             b.cash AS balance_sheet_cash
      FROM [cash_sections] s LEFT JOIN [balance_sheet] b ON b.entity_id = s.entity_id AND b.period = s.period
      LEFT JOIN [opening_cash] o ON o.entity_id = s.entity_id))"""

V["working_capital"] = """
SELECT *, avg(dso) OVER w AS dso_3m_avg, avg(dpo) OVER w AS dpo_3m_avg, avg(dio) OVER w AS dio_3m_avg,
       avg(ccc) OVER w AS ccc_3m_avg
FROM (SELECT *, dso + dio - dpo AS ccc
FROM (SELECT i.entity_id, i.period, i.revenue, i.cogs, i.operating_expense, b.accounts_receivable, b.inventory,
             b.accounts_payable,
             CAST(b.accounts_receivable AS DOUBLE) / nullif(CAST(i.revenue AS DOUBLE), 0) * day(last_day(i.period)) AS dso,
             CAST(b.accounts_payable AS DOUBLE) / nullif(CAST(i.cogs + i.operating_expense AS DOUBLE), 0)
                 * day(last_day(i.period)) AS dpo,
             CAST(b.inventory AS DOUBLE) / nullif(CAST(i.cogs AS DOUBLE), 0) * day(last_day(i.period)) AS dio
      FROM [income_statement] i JOIN [balance_sheet] b ON b.entity_id = i.entity_id AND b.period = i.period))
WINDOW w AS (PARTITION BY entity_id ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""

V["monthly_expense"] = f"""
SELECT coa_subcategory AS expense_category, entity_id,
       CASE WHEN coa_subcategory = 'Interest Expense' THEN NULL ELSE business_unit END AS business_unit, period,
       CAST(coalesce(sum(debit_eur), 0) AS {EUR}) AS recognized_cost
FROM [enriched]
WHERE coa_subcategory = 'Interest Expense'
   OR (coa_subcategory IN ('Utilities', 'Professional Services', 'Logistics') AND business_unit IS NOT NULL)
GROUP BY 1, 2, 3, 4"""

V["accruals"] = """
SELECT entity_id, business_unit, expense_category, period, historical_average, seasonal_average, rolling_average,
       rolling_average AS expected_cost, cost AS recognized_cost, rolling_average - cost AS estimated_accrual,
       rolling_average - 1.96 * sd / sqrt(n) AS ci_lower, rolling_average + 1.96 * sd / sqrt(n) AS ci_upper,
       n AS n_periods_in_estimate
FROM (SELECT *, avg(cost) OVER (s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS historical_average,
             avg(cost) OVER (PARTITION BY expense_category, entity_id, business_unit, month(period) ORDER BY period
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seasonal_average,
             avg(cost) OVER (s ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_average,
             stddev_samp(cost) OVER (s ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS sd,
             count(cost) OVER (s ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS n, row_number() OVER s AS rn
      FROM (SELECT *, CAST(recognized_cost AS DOUBLE) AS cost FROM [monthly_expense])
      WINDOW s AS (PARTITION BY expense_category, entity_id, business_unit ORDER BY period))
WHERE rn > 2"""


def money(*names: str, digits: int = 2) -> str:
    return ", ".join(f"CAST(round({n}, {digits}) AS DOUBLE) AS {n}" for n in names)


def ratio(*names: str, digits: int = 6, off_ties: bool = False) -> str:
    shift = " + 2.7e-8" if off_ties else ""
    return ", ".join(f"round({n}{shift}, {digits}) AS {n}" for n in names)


def month(name: str = "period") -> str:
    return f"strftime({name}, '%Y-%m') AS {name}"


def day(*names: str) -> str:
    return ", ".join(f"strftime({n}, '%Y-%m-%d') AS {n}" for n in names)
