"""Queries over the journal, the statements, working capital, accruals and the reporting roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harness.books import AS_OF, Books
from harness.present import plain
from harness.registry import query
from harness.sql_books import money, month, ratio
from tallystone.operators import accruals, journal, ledger, reports, statements, working_capital

IS_MONEY = statements.INCOME_COLUMNS[2:]
BS_MONEY = tuple(c for c in statements.BALANCE_COLUMNS[2:] if c not in ("status", "economically_implausible"))
CF_MONEY = tuple(c for c in statements.CASH_FLOW_COLUMNS[2:] if c != "status")


def enriched(b: Books) -> DataFrame:
    """The ledger is summed once to monthly postings; every statement reads that small written table."""
    postings = b.once("postings", lambda books: ledger.monthly_postings(books["transactions"]))
    return ledger.enrich(postings, b["chart_of_accounts"], b["fx_rates"])


def three_statements(b: Books) -> tuple[DataFrame, DataFrame, DataFrame]:
    postings = enriched(b)
    income = statements.income_statement(postings)
    sheet = statements.balance_sheet(postings, income)
    return income, sheet, statements.cash_flow(postings, sheet)


# Journal derivation

_EVENT_TOTALS = """SELECT document_type, account_name, count(*) AS n_legs, CAST(sum(debit) AS DOUBLE) AS debit,
CAST(sum(credit) AS DOUBLE) AS credit, count(DISTINCT document_id) AS n_documents
FROM [journal_legs] GROUP BY document_type, account_name"""


@query("post_journal", _EVENT_TOTALS)
def post_journal(b: Books) -> DataFrame:
    legs = journal.post_journal(b["posting_events"], b["chart_of_accounts"])
    return legs.groupBy("document_type", "account_name").agg(
        F.count(F.lit(1)).alias("n_legs"),
        F.sum("debit").cast("double").alias("debit"),
        F.sum("credit").cast("double").alias("credit"),
        F.count_distinct("document_id").alias("n_documents"),
    )


_PENNY = """
WITH lines AS (SELECT 'SO_' || CAST(l_orderkey AS VARCHAR) AS document_id, l_linenumber AS line_no,
                      CAST(l_extendedprice AS DECIMAL(18,2)) AS gross, CAST(l_discount AS DECIMAL(4,2)) AS rate,
                      CAST(l_tax AS DECIMAL(4,2)) AS tax FROM lineitem),
line_legs AS (SELECT document_id, line_no, sum(gross * (1 - rate) * (1 + tax)) AS net, sum(gross * rate) AS discount
              FROM lines GROUP BY document_id, line_no),
legs AS (SELECT document_id, line_no * 2 AS leg_no, 'debit' AS side, CAST(net AS DECIMAL(28,6)) AS amount FROM line_legs
         UNION ALL SELECT document_id, line_no * 2 + 1, 'credit', CAST(-discount AS DECIMAL(28,6)) FROM line_legs
         UNION ALL SELECT document_id, 1000, 'credit', CAST(sum(net + discount) AS DECIMAL(28,6)) FROM line_legs GROUP BY document_id),
rounded AS (SELECT document_id, leg_no,
                   CASE WHEN amount < 0 THEN CASE side WHEN 'debit' THEN 'credit' ELSE 'debit' END ELSE side END AS side,
                   CAST(round(abs(amount), 2) AS DECIMAL(18,2)) AS amount FROM legs),
plugged AS (SELECT document_id, leg_no, side,
                   CASE WHEN leg_no = max(leg_no) OVER d
                        THEN amount + CASE side WHEN 'credit' THEN 1 ELSE -1 END
                             * sum(CASE side WHEN 'debit' THEN amount ELSE -amount END) OVER d
                        ELSE amount END AS amount
            FROM rounded WINDOW d AS (PARTITION BY document_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT document_id, leg_no, side, CAST(amount AS DOUBLE) AS amount FROM plugged WHERE amount > 0"""


@query("penny_plug", _PENNY)
def penny_plug(b: Books) -> DataFrame:
    """One document per order: a net leg and a (negative) discount leg per line, the total as last leg."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    rate, tax = F.col("l_discount").cast("decimal(4,2)"), F.col("l_tax").cast("decimal(4,2)")
    lines = b["lineitem"].groupBy(
        F.concat(F.lit("SO_"), F.col("l_orderkey").cast("string")).alias("document_id"), F.col("l_linenumber").alias("line_no")
    ).agg(F.sum(price * (1 - rate) * (1 + tax)).alias("net"), F.sum(price * rate).alias("discount"))
    leg = lambda no, side, amount: F.struct(
        no.cast("int").alias("leg_no"), F.lit(side).alias("side"), amount.cast("decimal(28,6)").alias("amount")
    )
    per_line = lines.select(
        "document_id",
        F.explode(
            F.array(
                leg(F.col("line_no") * 2, "debit", F.col("net")),
                leg(F.col("line_no") * 2 + 1, "credit", -F.col("discount")),
            )
        ).alias("leg"),
    ).select("document_id", "leg.*")
    totals = lines.groupBy("document_id").agg(F.sum(F.col("net") + F.col("discount")).alias("total")).select(
        "document_id", leg(F.lit(1000), "credit", F.col("total")).alias("leg")
    ).select("document_id", "leg.*")
    return plain(journal.penny_plug(per_line.unionByName(totals)))


@query(
    "invoice_status",
    f"""SELECT 'AR' AS ledger, payment_status, count(*) AS n, CAST(sum(invoice_amount) AS DOUBLE) AS amount,
               count(payment_date) AS n_paid_dates FROM [receivables] GROUP BY payment_status
        UNION ALL SELECT 'AP', payment_status, count(*), CAST(sum(net_amount) AS DOUBLE), count(payment_date)
        FROM [payables] GROUP BY payment_status""",
)
def invoice_status(b: Books) -> DataFrame:
    def summary(df: DataFrame, name: str, amount: str) -> DataFrame:
        return df.groupBy(F.lit(name).alias("ledger"), "payment_status").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(amount).cast("double").alias("amount"),
            F.count("payment_date").alias("n_paid_dates"),
        )

    ar = journal.invoice_status(b["receivables_due"], AS_OF, "collectable")
    ap = journal.invoice_status(b["payables_due"], AS_OF, "payable_now", write_off=False)
    return summary(ar, "AR", "invoice_amount").unionByName(summary(ap, "AP", "net_amount"))


@query("invoice_tax", f"SELECT invoice_id, {money('net_amount', 'tax_amount', 'invoice_amount')} FROM [payables]")
def invoice_tax(b: Books) -> DataFrame:
    taxed = journal.invoice_tax(b["payables_due"])
    return plain(taxed.select("invoice_id", "net_amount", "tax_amount", "invoice_amount"))


@query(
    "depreciation_schedule",
    f"SELECT entity_id, {month()}, {money('capex', 'gross_assets', 'depreciation')} FROM [depreciation]",
)
def depreciation_schedule(b: Books) -> DataFrame:
    schedule = journal.depreciation_schedule(b["capex_plan"])
    return plain(schedule.select("entity_id", "period", "capex", "gross_assets", "depreciation"))


@query(
    "opening_equity",
    f"""SELECT entity_id, {money('total_assets', 'total_liabilities', 'common_stock', 'retained_earnings')}
        FROM (SELECT *, total_assets - total_liabilities - common_stock AS retained_earnings
        FROM (SELECT entity_id,
          sum(amount) FILTER (WHERE side = 'debit') - sum(amount) FILTER (WHERE account_name = 'Accumulated Depreciation') AS total_assets,
          sum(amount) FILTER (WHERE side = 'credit' AND account_name NOT IN ('Accumulated Depreciation', 'Common Stock')) AS total_liabilities,
          sum(amount) FILTER (WHERE account_name = 'Common Stock') AS common_stock
        FROM [opening_parts] GROUP BY entity_id))""",
)
def opening_equity(b: Books) -> DataFrame:
    return plain(journal.opening_equity(b["entities"]).drop("functional_currency"))


# Ledger enrichment


@query(
    "fx_convert",
    f"""SELECT t.currency, strftime(t.transaction_date, '%Y-%m') AS period, count(*) AS n_legs,
               count(f.rate_to_eur) AS n_rated,
               CAST(round(sum(t.debit * f.rate_to_eur), 2) AS DOUBLE) AS debit_eur,
               CAST(round(sum(t.credit * f.rate_to_eur), 2) AS DOUBLE) AS credit_eur
        FROM [transactions] t LEFT JOIN [fx_rates] f ON f.currency = t.currency
             AND f.rate_date = CAST(date_trunc('month', t.transaction_date) AS DATE) GROUP BY 1, 2""",
)
def fx_convert(b: Books) -> DataFrame:
    eur = ledger.convert_to_eur(b["transactions"], b["fx_rates"], {"debit": "debit_eur", "credit": "credit_eur"})
    return plain(
        eur.groupBy("currency", F.trunc("transaction_date", "MM").alias("period")).agg(
            F.count(F.lit(1)).alias("n_legs"),
            F.count("debit_eur").alias("n_rated"),
            F.sum("debit_eur").alias("debit_eur"),
            F.sum("credit_eur").alias("credit_eur"),
        )
    )


@query(
    "coa_join",
    """SELECT coa_category, coa_subcategory, coa_normal_balance, count(*) AS n_legs,
              count(*) FILTER (WHERE account_category IS DISTINCT FROM coa_category) AS n_drift
       FROM (SELECT t.account_category, a.account_category AS coa_category, a.account_subcategory AS coa_subcategory,
                    a.normal_balance AS coa_normal_balance
             FROM [raw_transactions] t LEFT JOIN [chart_of_accounts] a USING (account_id)) GROUP BY 1, 2, 3""",
)
def coa_join(b: Books) -> DataFrame:
    joined = ledger.join_chart(b["raw_transactions"], b["chart_of_accounts"])
    return joined.groupBy("coa_category", "coa_subcategory", "coa_normal_balance").agg(
        F.count(F.lit(1)).alias("n_legs"),
        F.count_if(~F.col("account_category").eqNullSafe(F.col("coa_category"))).alias("n_drift"),
    )


@query(
    "pl_bucket",
    """SELECT bucket, count(*) AS n_legs, CAST(sum(amount) AS DOUBLE) AS amount FROM (
       SELECT t.amount, CASE WHEN a.account_category IN ('Revenue', 'COGS') THEN a.account_category
              WHEN a.account_category = 'Operating Expense' THEN
                CASE a.account_subcategory WHEN 'Depreciation Expense' THEN 'Depreciation'
                     WHEN 'Interest Expense' THEN 'Interest' WHEN 'Tax Expense' THEN 'Tax'
                     ELSE 'Operating Expense' END END AS bucket
       FROM [transactions] t LEFT JOIN [chart_of_accounts] a USING (account_id)) GROUP BY bucket""",
)
def pl_bucket(b: Books) -> DataFrame:
    joined = ledger.join_chart(b["transactions"], b["chart_of_accounts"])
    bucket = ledger.pl_bucket(F.col("coa_category"), F.col("coa_subcategory")).alias("bucket")
    return joined.groupBy(bucket).agg(
        F.count(F.lit(1)).alias("n_legs"), F.sum("amount").cast("double").alias("amount")
    )


@query(
    "signed_amount",
    """SELECT a.account_id, CAST(sum(CASE WHEN a.normal_balance = 'Debit' THEN t.debit - t.credit
              ELSE t.credit - t.debit END) AS DOUBLE) AS contribution
       FROM [transactions] t JOIN [chart_of_accounts] a USING (account_id) GROUP BY a.account_id""",
)
def signed_amount(b: Books) -> DataFrame:
    joined = ledger.join_chart(b["transactions"], b["chart_of_accounts"])
    signed = ledger.signed_amount(F.col("debit"), F.col("credit"), F.col("coa_normal_balance"))
    return joined.groupBy("account_id").agg(F.sum(signed).cast("double").alias("contribution"))


# Statements


@query("income_statement", f"SELECT entity_id, {month()}, {money(*IS_MONEY)} FROM [income_statement]")
def income_statement(b: Books) -> DataFrame:
    return plain(statements.income_statement(enriched(b)))


@query(
    "net_income_by_entity",
    "SELECT entity_id, CAST(round(sum(net_income), 2) AS DOUBLE) AS net_income FROM [income_statement] GROUP BY 1",
)
def net_income_by_entity(b: Books) -> DataFrame:
    return plain(statements.net_income_by_entity(statements.income_statement(enriched(b))))


_FLOWS = tuple(statements.BALANCE_ACCOUNTS.values())


@query("dense_grid", f"SELECT entity_id, {month()}, {money(*_FLOWS)} FROM [bs_grid]")
def dense_grid(b: Books) -> DataFrame:
    postings = enriched(b)
    return plain(statements.dense_grid(statements.account_flows(postings), statements.income_statement(postings)))


@query("running_balance", f"SELECT entity_id, {month()}, {money(*_FLOWS)} FROM [bs_running]")
def running_balance(b: Books) -> DataFrame:
    postings = enriched(b)
    grid = statements.dense_grid(statements.account_flows(postings), statements.income_statement(postings))
    return plain(statements.running_balances(grid))


@query(
    "balance_sheet",
    f"SELECT entity_id, {month()}, {money(*BS_MONEY)}, status, economically_implausible FROM [balance_sheet]",
)
def balance_sheet(b: Books) -> DataFrame:
    return plain(three_statements(b)[1])


@query("opening_cash", f"SELECT entity_id, {money('opening_cash')} FROM [opening_cash]")
def opening_cash(b: Books) -> DataFrame:
    return plain(statements.opening_cash(enriched(b)))


@query(
    "cash_flow_sections",
    f"SELECT entity_id, {month()}, {money('operating_cf', 'investing_cf', 'financing_cf', 'other_cf')} FROM [cash_sections]",
)
def cash_flow_sections(b: Books) -> DataFrame:
    return plain(statements.cash_flow_sections(enriched(b)))


@query("cash_flow", f"SELECT entity_id, {month()}, {money(*CF_MONEY)}, status FROM [cash_flow]")
def cash_flow(b: Books) -> DataFrame:
    return plain(three_statements(b)[2])


@query(
    "reconciliation_summary",
    """SELECT 'balance_sheet' AS statement, count(*) AS n_months, count(*) FILTER (WHERE status = 'FAIL') AS n_fail,
              count(*) FILTER (WHERE economically_implausible) AS n_implausible,
              coalesce(string_agg(DISTINCT CASE WHEN economically_implausible OR status = 'FAIL' THEN entity_id END, ','
                         ORDER BY CASE WHEN economically_implausible OR status = 'FAIL' THEN entity_id END), '') AS entities_affected
       FROM [balance_sheet]
       UNION ALL SELECT 'cash_flow', count(*), count(*) FILTER (WHERE status = 'FAIL'), 0,
              coalesce(string_agg(DISTINCT CASE WHEN status = 'FAIL' THEN entity_id END, ','), '') FROM [cash_flow]""",
)
def reconciliation_summary(b: Books) -> DataFrame:
    _, sheet, flow = three_statements(b)
    return statements.reconciliation_summary(sheet, flow)


# Working capital and accruals

_WC_MONEY = ("revenue", "cogs", "operating_expense", "accounts_receivable", "inventory", "accounts_payable")
_WC_RATIOS = ("dso", "dpo", "dio", "ccc", "dso_3m_avg", "dpo_3m_avg", "dio_3m_avg", "ccc_3m_avg")


def ratios(b: Books) -> DataFrame:
    income, sheet, _ = three_statements(b)
    return working_capital.working_capital(income, sheet)


@query("working_capital", f"SELECT entity_id, {month()}, {money(*_WC_MONEY)}, {ratio(*_WC_RATIOS)} FROM [working_capital]")
def working_capital_query(b: Books) -> DataFrame:
    return plain(ratios(b))


@query(
    "wc_trend",
    """SELECT entity_id, round(first_dso, 6) AS first_dso, round(last_dso, 6) AS last_dso,
              round(first_ccc, 6) AS first_ccc, round(last_ccc, 6) AS last_ccc,
              round(last_dso - first_dso, 6) AS dso_change, round(last_ccc - first_ccc, 6) AS ccc_change,
              CASE WHEN last_dso - first_dso > 0 THEN 'deteriorated' ELSE 'improved' END AS direction
       FROM (SELECT entity_id, arg_min_null(dso_3m_avg, period) AS first_dso, arg_max_null(dso_3m_avg, period) AS last_dso,
                    arg_min_null(ccc_3m_avg, period) AS first_ccc, arg_max_null(ccc_3m_avg, period) AS last_ccc
             FROM [working_capital] GROUP BY entity_id)""",
)
def wc_trend(b: Books) -> DataFrame:
    return plain(working_capital.working_capital_trend(ratios(b)).drop("commentary"))


@query(
    "wc_worst_cycle",
    f"SELECT round(ccc_3m_avg, 6) AS ccc_3m_avg, entity_id, {month()} FROM [working_capital] ORDER BY ccc_3m_avg DESC NULLS LAST LIMIT 1",
)
def wc_worst_cycle(b: Books) -> DataFrame:
    return plain(working_capital.worst_conversion_cycle(ratios(b)))


@query(
    "monthly_expense",
    f"SELECT expense_category, entity_id, business_unit, {month()}, {money('recognized_cost')} FROM [monthly_expense]",
)
def monthly_expense(b: Books) -> DataFrame:
    return plain(accruals.monthly_expense(enriched(b)))


_ACCRUAL_NUMBERS = (
    "historical_average", "seasonal_average", "rolling_average", "expected_cost", "recognized_cost",
    "estimated_accrual", "ci_lower", "ci_upper",
)


@query(
    "accruals",
    f"""SELECT entity_id, business_unit, expense_category, {month()}, {ratio(*_ACCRUAL_NUMBERS, digits=4, off_ties=True)},
               n_periods_in_estimate FROM [accruals]""",
)
def accruals_query(b: Books) -> DataFrame:
    return plain(accruals.accruals(accruals.monthly_expense(enriched(b))), digits=4, off_ties=True)


@query(
    "accrual_summary",
    """SELECT expense_category, round(avg(estimated_accrual), 2) AS mean_accrual,
              round(stddev_samp(estimated_accrual), 2) AS std_accrual, count(*) AS n_estimates
       FROM [accruals] GROUP BY expense_category""",
)
def accrual_summary(b: Books) -> DataFrame:
    return accruals.accrual_summary(accruals.accruals(accruals.monthly_expense(enriched(b))))


# Reporting roll-ups


@query(
    "latest_kpis",
    f"""SELECT strftime(i.period, '%Y-%m') AS period, CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue,
               CAST(round(sum(ebitda), 2) AS DOUBLE) AS ebitda, CAST(round(sum(net_income), 2) AS DOUBLE) AS net_income,
               CAST(round(sum(cash), 2) AS DOUBLE) AS cash,
               CAST(round(sum(accounts_receivable + inventory - accounts_payable), 2) AS DOUBLE) AS net_working_capital
        FROM [income_statement] i JOIN [balance_sheet] b ON i.entity_id = b.entity_id AND i.period = b.period
        WHERE i.period = (SELECT max(period) FROM [income_statement]) GROUP BY i.period""",
)
def latest_kpis(b: Books) -> DataFrame:
    income, sheet, _ = three_statements(b)
    return plain(reports.latest_kpis(income, sheet))


@query(
    "monthly_consolidated",
    f"""SELECT {month()}, CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue,
               CAST(round(sum(net_income), 2) AS DOUBLE) AS net_income FROM [income_statement] GROUP BY period""",
)
def monthly_consolidated(b: Books) -> DataFrame:
    return plain(reports.roll_up(statements.income_statement(enriched(b)), ["revenue", "net_income"]))


_YEARLY = ", ".join(f"CAST(round(sum({c}), 2) AS DOUBLE) AS {c}" for c in IS_MONEY)
_YEARLY_CF_COLUMNS = ("operating_cf", "investing_cf", "financing_cf", "net_change_in_cash")
_YEARLY_CF = ", ".join(f"CAST(round(sum({c}), 2) AS DOUBLE) AS {c}" for c in _YEARLY_CF_COLUMNS)


@query(
    "yearly_flows",
    f"""SELECT strftime(period, '%Y') AS year, {_YEARLY} FROM [income_statement]
        WHERE entity_id IN ('ASIA', 'EUROPE') GROUP BY 1""",
)
def yearly_flows(b: Books) -> DataFrame:
    income = statements.income_statement(enriched(b))
    return plain(reports.roll_up(income, list(IS_MONEY), yearly=True, entities=["ASIA", "EUROPE"]))


@query("yearly_cash_flows", f"SELECT strftime(period, '%Y') AS year, {_YEARLY_CF} FROM [cash_flow] GROUP BY 1")
def yearly_cash_flows(b: Books) -> DataFrame:
    return plain(reports.roll_up(three_statements(b)[2], list(_YEARLY_CF_COLUMNS), yearly=True))


_STOCKS = reports.BALANCE_STOCKS


@query(
    "year_end_balances",
    f"""SELECT year, {", ".join(f"CAST(round(sum({c}), 2) AS DOUBLE) AS {c}" for c in _STOCKS)}
        FROM (SELECT *, strftime(period, '%Y') AS year,
                     row_number() OVER (PARTITION BY strftime(period, '%Y'), entity_id ORDER BY period DESC) AS rn
              FROM [balance_sheet]) WHERE rn = 1 GROUP BY year""",
)
def year_end_balances(b: Books) -> DataFrame:
    return plain(reports.year_end_balances(three_statements(b)[1]))


@query(
    "wc_trend_long",
    f"""SELECT entity_id, {month()}, metric, round(value, 6) AS value
        FROM (UNPIVOT (SELECT entity_id, period, dso_3m_avg, dpo_3m_avg, dio_3m_avg, ccc_3m_avg FROM [working_capital])
              ON dso_3m_avg, dpo_3m_avg, dio_3m_avg, ccc_3m_avg INTO NAME metric VALUE value)""",
)
def wc_trend_long(b: Books) -> DataFrame:
    return plain(reports.ratio_series(ratios(b)).where(F.col("value").isNotNull()))
