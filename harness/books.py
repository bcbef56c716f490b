"""Ledger, invoice and master tables derived from the given test tables.

The test data holds orders, order lines, customers and suppliers but no books of account. This module derives
them: every order is a sales invoice, every order line a vendor invoice, and both are posted as journal entries.
Raw copies carry defects at fixed arithmetic places. Each view has one SQL text for Spark and for the checking
database, or one per side where row generators differ; on the Spark side the journal views use the package's
own posting operators.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.operators import journal
from tallystone.session import materialize
from tallystone.schema import EXPECTED_COLUMNS
from tallystone.sources.raw import as_raw, with_row_uid

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
# Master tables are written once, so that Spark knows their size when they join. Fact tables are read as views of the given tables:
# a written copy of the ledger would be many times as large as what it is derived from, and most queries need few of its columns. Queries
# that run many rules read the invoices from a copy with their masters joined, which is about as large as the given table: else each rule's
# scan would join and shuffle the order lines again.
STORED = ("customers", "vendors", "entities")
FACT_TABLES = ("orders", "lineitem", "events")
INVOICES = ("receivables_due", "payables_due")
# A file of order lines may be a single task; its copy is read by as many as it has files.
ROWS_PER_FILE = 100_000
AS_OF = "2001-12-31"
OPENING_DATE = "1995-01-01"
UNITS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

# Accounts as (id, name, category, subcategory, normal balance).
CORPORATE_ACCOUNTS = (
    ("1000", "Cash", "Asset", "Cash", "Debit"),
    ("1001", "Accounts Receivable", "Asset", "Accounts Receivable", "Debit"),
    ("1002", "Inventory", "Asset", "Inventory", "Debit"),
    ("1003", "Other Current Assets", "Asset", "Other Current Assets", "Debit"),
    ("1004", "Fixed Assets - Equipment", "Asset", "Fixed Assets", "Debit"),
    ("1006", "Accumulated Depreciation", "Asset", "Accumulated Depreciation", "Credit"),
    ("2000", "Accounts Payable", "Liability", "Accounts Payable", "Credit"),
    ("2001", "Accrued Liabilities", "Liability", "Other Liabilities", "Credit"),
    ("2002", "Short-term Debt", "Liability", "Debt", "Credit"),
    ("2003", "Long-term Debt", "Liability", "Debt", "Credit"),
    ("2004", "Other Liabilities", "Liability", "Other Liabilities", "Credit"),
    ("3000", "Common Stock", "Equity", "Common Stock", "Credit"),
    ("3001", "Retained Earnings", "Equity", "Retained Earnings", "Credit"),
    ("6900", "Depreciation Expense", "Operating Expense", "Depreciation Expense", "Debit"),
    ("6901", "Interest Expense", "Operating Expense", "Interest Expense", "Debit"),
    ("6904", "Tax Expense", "Operating Expense", "Tax Expense", "Debit"),
    ("6907", "Bad Debt Expense", "Operating Expense", "Bad Debt Expense", "Debit"),
)
UNIT_ACCOUNTS = (
    (4000, "Product Revenue", "Revenue", "Credit"),
    (5000, "Cost of Goods Sold", "COGS", "Debit"),
    (6000, "Salaries", "Operating Expense", "Debit"),
    (6010, "Professional Services", "Operating Expense", "Debit"),
    (6020, "Utilities", "Operating Expense", "Debit"),
    (6030, "Logistics", "Operating Expense", "Debit"),
)


def _coa_rows() -> list[tuple]:
    rows = [(*a, None) for a in CORPORATE_ACCOUNTS]
    for start, name, category, normal in UNIT_ACCOUNTS:
        rows += [(str(start + i), f"{name} - {u}", category, name, normal, u) for i, u in enumerate(UNITS)]
    return rows


def _coa_values() -> str:
    quote = lambda v: "CAST(NULL AS STRING)" if v is None else f"'{v}'"
    return ", ".join("(" + ", ".join(quote(v) for v in row) + ")" for row in _coa_rows())


def _unit_account(start: int, unit: str) -> str:
    cases = " ".join(f"WHEN '{u}' THEN '{start + i}'" for i, u in enumerate(UNITS))
    return f"CASE {unit} {cases} END"


def _shift(date: str, days: str) -> str:
    return f"CAST({date} + CAST({days} AS INT) AS DATE)"


_CURRENCY = "CASE {k} % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' ELSE 'GBP' END"

VIEWS: dict[str, str] = {}

VIEWS["customers"] = f"""
SELECT c_custkey, 'CUST_' || CAST(c_custkey AS STRING) AS customer_id, c_name AS customer_name,
       r_name AS entity_id, {_CURRENCY.replace("{k}", "n_nationkey")} AS currency,
       c_mktsegment AS customer_segment,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 60 WHEN 'BUILDING' THEN 45 WHEN 'HOUSEHOLD' THEN 15
            ELSE 30 END AS payment_terms_days,
       CAST(c_acctbal AS DECIMAL(18,2)) AS account_balance
FROM [customer] JOIN [nation] ON c_nationkey = n_nationkey JOIN [region] ON n_regionkey = r_regionkey"""

VIEWS["vendors"] = f"""
SELECT s_suppkey, 'VEND_' || CAST(s_suppkey AS STRING) AS vendor_id, s_name AS vendor_name,
       r_name AS entity_id, {_CURRENCY.replace("{k}", "n_nationkey")} AS currency,
       CAST(15 + 15 * (s_suppkey % 4) AS INT) AS payment_terms_days
FROM [supplier] JOIN [nation] ON s_nationkey = n_nationkey JOIN [region] ON n_regionkey = r_regionkey"""

VIEWS["entities"] = f"""
SELECT r_name AS entity_id, r_name || ' Ltd' AS entity_name, r_name AS country,
       {_CURRENCY.replace("{k}", "r_regionkey")} AS functional_currency,
       CAST(CAST(scale AS DECIMAL(18,2)) * 90 AS DECIMAL(18,2)) AS annual_revenue_scale_eur
FROM [region] JOIN (SELECT entity_id AS scale_entity, sum(account_balance) AS scale FROM [customers]
                    GROUP BY entity_id) s ON r_name = scale_entity"""

VIEWS["chart_of_accounts"] = f"""
SELECT * FROM (VALUES {_coa_values()}) AS coa(account_id, account_name, account_category, account_subcategory,
                                              normal_balance, expected_business_unit)"""

VIEWS["receivables_due"] = f"""
SELECT o_orderkey AS k, 'ARINV_' || CAST(o_orderkey AS STRING) AS invoice_id, customer_id, entity_id, currency,
       customer_segment, customer_segment AS business_unit, CAST(o_orderdate AS DATE) AS invoice_date,
       {_shift("CAST(o_orderdate AS DATE)", "payment_terms_days")} AS due_date,
       {_shift("CAST(o_orderdate AS DATE)", "payment_terms_days + o_orderkey % 15 - 2")} AS expected_payment,
       NOT (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') AS collectable,
       CAST(o_totalprice AS DECIMAL(18,2)) AS invoice_amount
FROM [orders] JOIN [customers] ON o_custkey = c_custkey"""

VIEWS["receivables"] = f"""
SELECT k, invoice_id, customer_id, entity_id, invoice_date, due_date,
       CASE WHEN collectable AND expected_payment <= DATE '{AS_OF}' THEN expected_payment END AS payment_date,
       currency, invoice_amount,
       CASE WHEN collectable AND expected_payment <= DATE '{AS_OF}' THEN 'Paid'
            WHEN {_shift("due_date", "120")} <= DATE '{AS_OF}' THEN 'Written Off'
            WHEN due_date < DATE '{AS_OF}' THEN 'Overdue' ELSE 'Open' END AS payment_status,
       business_unit, customer_segment
FROM [receivables_due]"""

VIEWS["payables_due"] = f"""
SELECT l_orderkey * 7 + l_linenumber AS k,
       'APINV_' || CAST(l_orderkey AS STRING) || '_' || CAST(l_linenumber AS STRING) || '_'
           || CAST(l_partkey AS STRING) || '_' || CAST(l_suppkey AS STRING) AS invoice_id,
       vendor_id, entity_id, currency, CAST(l_shipdate AS DATE) AS invoice_date,
       {_shift("CAST(l_shipdate AS DATE)", "payment_terms_days")} AS due_date,
       {_shift("CAST(l_shipdate AS DATE)", "payment_terms_days + l_partkey % 14 - 4")} AS expected_payment,
       NOT (l_returnflag = 'R' AND l_tax > 0.075) AS payable_now,
       CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) * CAST(0.8 AS DECIMAL(2,1)), 2)
            AS DECIMAL(18,2)) AS net_amount,
       CAST(l_tax AS DECIMAL(4,2)) AS tax_rate,
       CASE p_size % 5 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'FURNITURE'
                       WHEN 3 THEN 'HOUSEHOLD' ELSE 'MACHINERY' END AS business_unit,
       CASE p_type WHEN 'ECONOMY' THEN 'Utilities' WHEN 'SMALL' THEN 'Logistics'
                   WHEN 'PROMO' THEN 'Professional Services' ELSE 'Raw Materials' END AS expense_category
FROM [lineitem] JOIN [vendors] ON l_suppkey = s_suppkey JOIN [part] ON l_partkey = p_partkey"""

VIEWS["payables"] = f"""
SELECT k, invoice_id, vendor_id, entity_id, invoice_date, due_date,
       CASE WHEN payable_now AND expected_payment <= DATE '{AS_OF}' THEN expected_payment END AS payment_date,
       currency, CAST(net_amount + round(net_amount * tax_rate, 2) AS DECIMAL(18,2)) AS invoice_amount,
       CAST(round(net_amount * tax_rate, 2) AS DECIMAL(18,2)) AS tax_amount, net_amount,
       CASE WHEN payable_now AND expected_payment <= DATE '{AS_OF}' THEN 'Paid'
            WHEN due_date < DATE '{AS_OF}' THEN 'Overdue' ELSE 'Open' END AS payment_status,
       business_unit, expense_category
FROM [payables_due]"""

_EVENT_COLUMNS = (
    "k", "document_id", "document_type", "transaction_date", "entity_id", "business_unit", "currency",
    "counterparty_id", "amount", "payment_due_date", "payment_date", "source_system", "debit_account",
    "credit_account",
)


def _union_events(source: str, kinds: list[dict[str, str]]) -> str:
    parts = []
    for kind in kinds:
        columns = ", ".join(f"{kind[c]} AS {c}" for c in _EVENT_COLUMNS)
        parts.append(f"SELECT {columns} FROM [{source}]" + (f" WHERE {kind['where']}" if kind.get("where") else ""))
    return " UNION ALL ".join(parts)


def _ar_event(prefix: str, kind: str, date: str, debit: str, credit: str, **other: str) -> dict[str, str]:
    return {
        "k": "k", "document_id": f"'{prefix}_' || CAST(k AS STRING)", "document_type": f"'{kind}'",
        "transaction_date": date, "entity_id": "entity_id", "business_unit": "business_unit",
        "currency": "currency", "counterparty_id": "customer_id", "amount": "invoice_amount",
        "payment_due_date": "due_date", "payment_date": "payment_date", "source_system": "'AR_SYSTEM'",
        "debit_account": debit, "credit_account": credit, **other,
    }


def _ap_event(prefix: str, kind: str, date: str, debit: str, credit: str, **other: str) -> dict[str, str]:
    return {
        "k": "k", "document_id": f"'{prefix}' || substr(invoice_id, 6)", "document_type": f"'{kind}'",
        "transaction_date": date, "entity_id": "entity_id", "business_unit": "business_unit",
        "currency": "currency", "counterparty_id": "vendor_id", "amount": "net_amount",
        "payment_due_date": "due_date", "payment_date": "payment_date", "source_system": "'AP_SYSTEM'",
        "debit_account": debit, "credit_account": credit, **other,
    }


_EXPENSE_ACCOUNT = (
    "CASE expense_category WHEN 'Raw Materials' THEN '1002' "
    f"WHEN 'Utilities' THEN {_unit_account(6020, 'business_unit')} "
    f"WHEN 'Logistics' THEN {_unit_account(6030, 'business_unit')} "
    f"ELSE {_unit_account(6010, 'business_unit')} END"
)

SALES_EVENTS = [
        _ar_event("ARINV", "Revenue Invoice", "invoice_date", "'1001'", _unit_account(4000, "business_unit")),
        _ar_event("ARCOL", "Cash Receipt", "payment_date", "'1000'", "'1001'", where="payment_status = 'Paid'"),
        _ar_event(
            "ARWO", "Bad Debt Writeoff", _shift("due_date", "120"), "'6907'", "'1001'",
            where="payment_status = 'Written Off'", payment_date="CAST(NULL AS DATE)",
        ),
        _ar_event(
            "PAYROLL", "Payroll", "invoice_date", _unit_account(6000, "business_unit"), "'1000'",
            amount="CAST(round(invoice_amount * 0.04, 2) AS DECIMAL(18,2))", counterparty_id="CAST(NULL AS STRING)",
            payment_due_date="CAST(NULL AS DATE)", payment_date="CAST(NULL AS DATE)",
            source_system="'PAYROLL_SYSTEM'",
        ),
]

PURCHASE_EVENTS = [
        _ap_event("APINV", "Vendor Invoice", "invoice_date", _EXPENSE_ACCOUNT, "'2000'"),
        _ap_event("APPAY", "Vendor Payment", "payment_date", "'2000'", "'1000'", where="payment_status = 'Paid'"),
        _ap_event(
            "COGSREC", "Inventory Consumption", _shift("invoice_date", "20"),
            _unit_account(5000, "business_unit"), "'1002'", where="expense_category = 'Raw Materials'",
            amount="CAST(round(net_amount * 0.9, 2) AS DECIMAL(18,2))", counterparty_id="CAST(NULL AS STRING)",
            payment_due_date="CAST(NULL AS DATE)", payment_date="CAST(NULL AS DATE)", source_system="'ERP'",
        ),
]


def _corporate_event(prefix: str, kind: str, day: int, debit: str, credit: str, amount: str, system: str,
                     where: str = "") -> dict[str, str]:
    return {
        "k": "CAST(month_no AS BIGINT)",
        "document_id": f"'{prefix}_' || entity_id || '_' || CAST(period AS STRING)",
        "document_type": f"'{kind}'", "transaction_date": _shift("period", str(day)), "entity_id": "entity_id",
        "business_unit": "'Corporate'", "currency": "functional_currency",
        "counterparty_id": "CAST(NULL AS STRING)", "amount": f"CAST({amount} AS DECIMAL(18,2))",
        "payment_due_date": "CAST(NULL AS DATE)", "payment_date": "CAST(NULL AS DATE)",
        "source_system": f"'{system}'", "debit_account": f"'{debit}'", "credit_account": f"'{credit}'",
        "where": where,
    }


VIEWS["capex_plan"] = """
SELECT entity_id, functional_currency, period, month_no, annual_revenue_scale_eur * 0.45 AS opening_gross,
       annual_revenue_scale_eur * 0.21 AS opening_debt,
       CASE WHEN month_no % 3 = 0
            THEN CAST(round(annual_revenue_scale_eur * (0.010 + 0.001 * (month_no % 12)), 2) AS DECIMAL(18,2))
            ELSE CAST(0 AS DECIMAL(18,2)) END AS capex
FROM [entity_months]"""

CORPORATE_EVENTS = [
        _corporate_event("CAPEX", "Capex", 10, "1004", "1000", "capex", "ERP", "capex > 0"),
        _corporate_event(
            "DEPR", "Depreciation", 27, "6900", "1006", "round(depreciation, 2)", "ERP"
        ),
        _corporate_event(
            "INT", "Interest Payment", 27, "6901", "1000",
            "round(opening_debt * 0.065 / 12, 2)", "BANKING_SYSTEM",
        ),
]

EVENT_SOURCES = (
    ("sales_events", "receivables", SALES_EVENTS),
    ("purchase_events", "payables", PURCHASE_EVENTS),
    ("corporate_events", "depreciation", CORPORATE_EVENTS),
)
VIEWS["posting_events"] = (
    "SELECT * FROM [sales_events] UNION ALL SELECT * FROM [purchase_events] "
    "UNION ALL SELECT * FROM [corporate_events]"
)

_LEG_COLUMNS = "k, leg, " + ", ".join(EXPECTED_COLUMNS["transactions"])
VIEWS["transactions"] = f"""
SELECT {_LEG_COLUMNS} FROM [journal_legs] UNION ALL SELECT {_LEG_COLUMNS} FROM [opening_legs]"""

# Row generators and posting rules, checking-database side. Spark uses SPARK_VIEWS below.
DUCK_VIEWS: dict[str, str] = {name: _union_events(source, kinds) for name, source, kinds in EVENT_SOURCES}

DUCK_VIEWS["entity_months"] = """
SELECT entity_id, functional_currency, annual_revenue_scale_eur, m AS month_no,
       CAST(DATE '1995-01-01' + to_months(CAST(m AS INTEGER)) AS DATE) AS period
FROM [entities], (SELECT unnest(range(0, 84)) AS m)"""

DUCK_VIEWS["fx_rates"] = """
SELECT rate_date, currency,
       CAST(CASE currency WHEN 'EUR' THEN 1 WHEN 'USD' THEN 0.92 + 0.001 * month(rate_date)
            ELSE 1.16 - 0.002 * month(rate_date) END AS DECIMAL(10,5)) AS rate_to_eur
FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2002-12-01', INTERVAL 1 MONTH)) AS DATE)
             AS rate_date),
     (SELECT unnest(['EUR', 'USD', 'GBP']) AS currency)"""

DUCK_VIEWS["depreciation"] = """
SELECT *, opening_gross + sum(capex) OVER (PARTITION BY entity_id ORDER BY period) AS gross_assets,
       (opening_gross + sum(capex) OVER (PARTITION BY entity_id ORDER BY period)) * 0.015 AS depreciation
FROM [capex_plan]"""

DUCK_VIEWS["opening_parts"] = """
SELECT entity_id, functional_currency, account_name, leg_no, side, annual_revenue_scale_eur * share AS amount
FROM [entities], (VALUES ('Cash', 1, 'debit', 0.11), ('Accounts Receivable', 2, 'debit', 0.15),
  ('Inventory', 3, 'debit', 0.07), ('Other Current Assets', 4, 'debit', 0.03),
  ('Fixed Assets - Equipment', 5, 'debit', 0.45), ('Accumulated Depreciation', 6, 'credit', 0.09),
  ('Accounts Payable', 7, 'credit', 0.10), ('Accrued Liabilities', 8, 'credit', 0.03),
  ('Short-term Debt', 9, 'credit', 0.05), ('Long-term Debt', 10, 'credit', 0.16),
  ('Other Liabilities', 11, 'credit', 0.02), ('Common Stock', 12, 'credit', 0.25)) AS s(account_name, leg_no, side, share)"""

DUCK_VIEWS["opening_rounded"] = """
SELECT entity_id, functional_currency, account_name, leg_no, side, CAST(round(amount, 2) AS DECIMAL(18,2)) AS amount
FROM [opening_parts]
UNION ALL
SELECT entity_id, functional_currency, 'Retained Earnings', 13,
       CASE WHEN plug < 0 THEN 'debit' ELSE 'credit' END, CAST(abs(plug) AS DECIMAL(18,2))
FROM (SELECT entity_id, functional_currency,
             sum(CASE WHEN side = 'debit' THEN round(amount, 2) ELSE -round(amount, 2) END) AS plug
      FROM [opening_parts] GROUP BY entity_id, functional_currency)"""

DUCK_VIEWS["opening_legs"] = f"""
SELECT CAST(0 AS BIGINT) AS k, CAST(leg_no AS INTEGER) AS leg,
       'TXN_OPEN_' || entity_id || '_' || leg_no AS transaction_id, DATE '{OPENING_DATE}' AS transaction_date,
       entity_id, 'Corporate' AS business_unit, account_id, account_name, account_category,
       'Opening Balance' AS document_type, 'OPEN_' || entity_id AS document_id, NULL AS counterparty_id,
       functional_currency AS currency, amount, CASE WHEN side = 'debit' THEN amount ELSE 0.00 END AS debit,
       CASE WHEN side = 'credit' THEN amount ELSE 0.00 END AS credit, CAST(NULL AS DATE) AS payment_due_date,
       CAST(NULL AS DATE) AS payment_date, 'ERP' AS source_system
FROM [opening_rounded] JOIN [chart_of_accounts] USING (account_name) WHERE amount > 0"""

DUCK_VIEWS["journal_legs"] = """
SELECT k, leg, 'TXN_' || document_id || '_' || leg AS transaction_id, transaction_date, entity_id, business_unit,
       a.account_id, a.account_name, a.account_category, document_type, document_id, counterparty_id, currency,
       amount, CASE WHEN leg = 1 THEN amount ELSE 0.00 END AS debit,
       CASE WHEN leg = 2 THEN amount ELSE 0.00 END AS credit, payment_due_date, payment_date, source_system
FROM (SELECT *, 1 AS leg, debit_account AS leg_account FROM [posting_events]
      UNION ALL SELECT *, 2, credit_account FROM [posting_events]) e
JOIN [chart_of_accounts] a ON e.leg_account = a.account_id WHERE amount > 0"""

AR_VARIANTS = (("X", 89), ("N", 83), ("D", 179))
AP_VARIANTS = (("X", 889), ("N", 883), ("D", 1789))
TXN_VARIANTS = (("X", 877),)


def _duck_variants(source: str, variants: tuple) -> str:
    parts = [f"SELECT *, '0' AS v FROM [{source}]"]
    parts += [f"SELECT *, '{v}' AS v FROM [{source}] WHERE k % {n} = 0" for v, n in variants]
    return " UNION ALL ".join(parts)


DUCK_VIEWS["receivable_variants"] = _duck_variants("receivables", AR_VARIANTS)
DUCK_VIEWS["payable_variants"] = _duck_variants("payables", AP_VARIANTS)
DUCK_VIEWS["transaction_variants"] = _duck_variants("transactions", TXN_VARIANTS)

_INVOICE_AMOUNT = """CASE WHEN k % 109 = 0 THEN '  ' WHEN k % 113 = 0 THEN '-' || CAST(invoice_amount AS STRING)
            WHEN k % 211 = 0 THEN CAST(CAST(invoice_amount * 400 AS DECIMAL(18,2)) AS STRING)
            WHEN v = 'N' THEN CAST(CAST(round(invoice_amount * 1.002, 2) AS DECIMAL(18,2)) AS STRING)
            WHEN v = 'D' THEN CAST(CAST(invoice_amount + 100 AS DECIMAL(18,2)) AS STRING)
            ELSE CAST(invoice_amount AS STRING) END AS invoice_amount"""
_INVOICE_COMMON = f"""CASE WHEN k % 151 = 0 THEN 'ATLANTIS' ELSE entity_id END AS entity_id,
       CASE WHEN k % 127 = 0 THEN '2024-02-30' ELSE CAST(invoice_date AS STRING) END AS invoice_date,
       CASE WHEN k % 131 = 0 THEN CAST({_shift("invoice_date", "-5")} AS STRING) ELSE CAST(due_date AS STRING) END
           AS due_date,
       CASE WHEN k % 137 = 0 AND payment_date IS NOT NULL THEN CAST({_shift("invoice_date", "-3")} AS STRING)
            WHEN k % 139 = 0 THEN 'NULL' ELSE CAST(payment_date AS STRING) END AS payment_date,
       CASE WHEN k % 97 = 0 THEN 'N/A' WHEN k % 103 = 0 THEN 'XYZ' ELSE currency END AS currency"""
_INVOICE_ID = "CASE WHEN k % 157 = 0 THEN '' WHEN v = 'N' THEN invoice_id || 'B' ELSE invoice_id END AS invoice_id"
_UNIT = "CASE WHEN k % 149 = 0 THEN 'nan' ELSE business_unit END AS business_unit"

VIEWS["raw_receivables_text"] = f"""
SELECT {_INVOICE_ID}, CASE WHEN k % 101 = 0 THEN 'CUST_UNKNOWN' ELSE customer_id END AS customer_id,
       {_INVOICE_COMMON}, {_INVOICE_AMOUNT}, payment_status, {_UNIT}, customer_segment
FROM [receivable_variants]"""

VIEWS["raw_payables_text"] = f"""
SELECT {_INVOICE_ID}, CASE WHEN k % 101 = 0 THEN 'VEND_UNKNOWN' ELSE vendor_id END AS vendor_id,
       {_INVOICE_COMMON}, {_INVOICE_AMOUNT},
       CASE WHEN k % 163 = 0 THEN CAST(CAST(tax_amount + 1 AS DECIMAL(18,2)) AS STRING)
            ELSE CAST(tax_amount AS STRING) END AS tax_amount,
       CAST(net_amount AS STRING) AS net_amount, payment_status, {_UNIT}, expense_category
FROM [payable_variants]"""

VIEWS["raw_transactions_text"] = f"""
SELECT CASE WHEN k % 997 = 1 AND leg = 1 THEN '' ELSE transaction_id END AS transaction_id,
       CASE WHEN k % 919 = 1 AND leg = 2 THEN '2024-02-30' ELSE CAST(transaction_date AS STRING) END
           AS transaction_date,
       CASE WHEN k % 991 = 1 AND leg = 2 THEN 'ATLANTIS' ELSE entity_id END AS entity_id,
       CASE WHEN k % 53 = 1 THEN 'NA' ELSE business_unit END AS business_unit,
       CASE WHEN k % 983 = 1 THEN '9999' WHEN k % 977 = 1 AND leg = 1 THEN 'null' ELSE account_id END AS account_id,
       account_name,
       CASE WHEN k % 971 = 1 AND leg = 1 THEN 'Operating Expense' ELSE account_category END AS account_category,
       document_type, document_id, CASE WHEN k % 47 = 1 THEN '' ELSE counterparty_id END AS counterparty_id,
       CASE WHEN k % 967 = 1 AND leg = 1 THEN 'XYZ' WHEN k % 953 = 1 THEN 'N/A' ELSE currency END AS currency,
       CASE WHEN k % 941 = 1 AND leg = 1 THEN '' WHEN k % 937 = 1 THEN '-' || CAST(amount AS STRING)
            WHEN k % 887 = 1 THEN CAST(CAST(amount * 1000 AS DECIMAL(18,2)) AS STRING)
            ELSE CAST(amount AS STRING) END AS amount,
       CASE WHEN k % 929 = 1 AND leg = 1 THEN CAST(CAST(debit + 5 AS DECIMAL(18,2)) AS STRING)
            ELSE CAST(debit AS STRING) END AS debit,
       CAST(credit AS STRING) AS credit, CAST(payment_due_date AS STRING) AS payment_due_date,
       CASE WHEN k % 911 = 1 AND leg = 1 AND payment_date IS NOT NULL
            THEN CAST({_shift("transaction_date", "-3")} AS STRING)
            WHEN k % 907 = 1 THEN '' ELSE CAST(payment_date AS STRING) END AS payment_date,
       source_system
FROM [transaction_variants]"""

_NA_LIST = ", ".join(
    f"'{t}'"
    for t in (
        "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
        "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
    )
)


def _duck_raw(dataset: str, source: str) -> str:
    columns = EXPECTED_COLUMNS[dataset]
    cleaned = ", ".join(f"CASE WHEN {c} NOT IN ({_NA_LIST}) THEN {c} END AS {c}" for c in columns)
    joined = ", ".join(f"coalesce({c}, '<NA>')" for c in columns)
    digest = f"md5(concat_ws(chr(31), {joined}))"
    tag = f"left(md5(coalesce(document_id, {digest})), 24) || " if "document_id" in columns else ""
    return (
        f"SELECT '{dataset.upper()}_' || {tag}{digest} AS row_uid, * "
        f"FROM (SELECT {cleaned} FROM [{source}])"
    )


RAW_SOURCES = {
    "transactions": "raw_transactions_text",
    "accounts_receivable": "raw_receivables_text",
    "accounts_payable": "raw_payables_text",
}
for _name, _source in RAW_SOURCES.items():
    DUCK_VIEWS[f"raw_{_name}"] = _duck_raw(_name, _source)


def _references(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\[([a-z_]+)\]", sql)))


def duck_sql(query: str) -> str:
    """A checking query with the views it names put in front; names stand in square brackets."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in BASE_TABLES or name in ordered:
            return
        for dep in _references(_duck_text(name)):
            visit(dep)
        ordered.append(name)

    for name in _references(query):
        visit(name)
    strip = lambda text: re.sub(r"\[([a-z_]+)\]", r"\1", text)
    # A leading underscore-free alias per view; base tables keep their names.
    # A view that is read more than once is worked out once.
    texts = [query, *map(_duck_text, ordered)]
    uses = {n: sum(text.count(f"[{n}]") for text in texts) for n in ordered}
    views = ",\n".join(f"{n} AS {'MATERIALIZED ' if uses[n] > 1 else ''}({strip(_duck_text(n))})" for n in ordered)
    return (f"WITH {views}\n" if views else "") + strip(query)


EXTRA_DUCK_VIEWS: dict[str, str] = {}
# Tables that differ with the models that compete.
OF_MODELS = ("forecast_parts", "forecasts", "calibration", "paths", "plan")


def _duck_text(name: str) -> str:
    for source in (EXTRA_DUCK_VIEWS, DUCK_VIEWS, VIEWS):
        if name in source:
            return source[name]
    raise KeyError(name)


class Books:
    """The derived tables of one data folder as lazy DataFrames."""

    _known: dict[tuple[str, str], Books] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Books:
        """One instance per application and folder, so that views are analysed once."""
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._known:
            cls._known[key] = cls(spark, sf_dir)
        return cls._known[key]

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._frames, self.models = spark, sf_dir, {}, "baselines"
        # The JVM never compiles a method of more than 8,000 bytes, and the raw texts make larger ones; Spark then splits them.
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")

    def with_all_models(self) -> Books:
        """The same books, in which every forecast model competes; tables that do not depend on it are shared."""
        other = Books(self.spark, self.sf_dir)
        other._frames, other.models = self._frames, "all"
        return other

    def with_written_invoices(self) -> Books:
        """The same books, for queries that scan them many times: invoices are written once, and all that is derived from them reads the copy.
        Steps of several queries are shared."""
        if "written_invoices" not in self._frames:
            other = Books(self.spark, self.sf_dir)
            other._frames = {n: self[n] for n in STORED} | {n: materialize(self[n], n, ROWS_PER_FILE) for n in INVOICES}
            other._frames["written_invoices"] = other
            self._frames["written_invoices"] = other
        return self._frames["written_invoices"]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            df = self._build(name)
            self._frames[name] = materialize(df, name) if name in STORED else df
        return self._frames[name]

    def _build(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in SPARK_VIEWS:
            return SPARK_VIEWS[name](self)
        sql = VIEWS[name]
        deps = {d: self[d] for d in _references(sql)}
        return self.spark.sql(re.sub(r"\[([a-z_]+)\]", r"{\1}", sql), **deps)

    def once(self, name: str, build: Callable[[Books], DataFrame]) -> DataFrame:
        """An intermediate table that several queries start from, written the first time it is asked for."""
        if name in OF_MODELS:
            name = f"{name}_{self.models}"
        if name not in self._frames:
            self._frames[name] = materialize(build(self), name)
        return self._frames[name]

    def raw_tables(self) -> dict[str, DataFrame]:
        """The eight raw tables: strings with lineage keys."""
        tables = {n: self[f"raw_{n}"] for n in RAW_SOURCES}
        for n in ("entities", "chart_of_accounts", "vendors", "customers", "fx_rates"):
            df = self[n]
            tables[n] = df.select([c for c in df.columns if c not in ("c_custkey", "s_suppkey", "account_balance")])
        return tables


def _entity_months(b: Books) -> DataFrame:
    months = F.explode(F.sequence(F.lit(0), F.lit(83)))
    return (
        b["entities"]
        .select("entity_id", "functional_currency", "annual_revenue_scale_eur", months.alias("month_no"))
        .withColumn("period", F.expr("add_months(DATE '1995-01-01', month_no)"))
    )


def _fx_rates(b: Books) -> DataFrame:
    return b.spark.sql(
        """SELECT rate_date, currency,
                  CAST(CASE currency WHEN 'EUR' THEN 1 WHEN 'USD' THEN 0.92 + 0.001 * month(rate_date)
                       ELSE 1.16 - 0.002 * month(rate_date) END AS DECIMAL(10,5)) AS rate_to_eur
           FROM (SELECT explode(sequence(DATE '1995-01-01', DATE '2002-12-01', INTERVAL 1 MONTH)) AS rate_date)
           LATERAL VIEW explode(array('EUR', 'USD', 'GBP')) c AS currency"""
    )


def _variants(source: str, variants: tuple) -> Callable[[Books], DataFrame]:
    """A record and its variants. An array without a function over its elements is exploded by compiled code."""
    def build(b: Books) -> DataFrame:
        extra = [F.when(F.col("k") % n == 0, F.lit(v)) for v, n in variants]
        return b[source].withColumn("v", F.explode(F.array(F.lit("0"), *extra))).where("v IS NOT NULL")

    return build


def _raw(dataset: str) -> Callable[[Books], DataFrame]:
    return lambda b: with_row_uid(as_raw(b[RAW_SOURCES[dataset]]), dataset)


def _with_leg_number(legs: DataFrame) -> DataFrame:
    return legs.withColumn("leg", F.regexp_extract("transaction_id", "_([0-9]+)$", 1).cast("int"))


def _events(source: str, kinds: list[dict[str, str]]) -> Callable[[Books], DataFrame]:
    """All event kinds of one source in a single scan: the numbers of the kinds that apply, exploded. Each column is told by the
    number afterwards, so columns that a query does not read are not made."""

    def build(b: Books) -> DataFrame:
        numbers = [f"CASE WHEN {kind.get('where') or 'true'} THEN {i} END" for i, kind in enumerate(kinds)]
        rows = b[source].selectExpr("*", f"explode(array({', '.join(numbers)})) AS kind_no").where("kind_no IS NOT NULL")
        return rows.selectExpr(*[f"{_by_kind([kind[c] for kind in kinds])} AS {c}" for c in _EVENT_COLUMNS])

    return build


def _by_kind(values: list[str]) -> str:
    if len(set(values)) == 1:
        return values[0]
    cases = " ".join(f"WHEN {i} THEN {value}" for i, value in enumerate(values[:-1]))
    return f"CASE kind_no {cases} ELSE {values[-1]} END"


def _opening_legs(b: Books) -> DataFrame:
    parts = journal.opening_balances(b["entities"], OPENING_DATE)
    legs = journal.post_multi_leg(parts, b["chart_of_accounts"])
    return _with_leg_number(legs).withColumn("k", F.lit(0).cast("bigint"))


def _journal_legs(b: Books) -> DataFrame:
    return journal.post_journal(b["posting_events"], b["chart_of_accounts"], keep=["k", "leg_no"]).withColumnRenamed("leg_no", "leg")


SPARK_VIEWS: dict[str, Callable[[Books], DataFrame]] = {
    "entity_months": _entity_months,
    "fx_rates": _fx_rates,
    "depreciation": lambda b: journal.depreciation_schedule(b["capex_plan"]),
    "opening_legs": _opening_legs,
    "journal_legs": _journal_legs,
    "receivable_variants": _variants("receivables", AR_VARIANTS),
    "payable_variants": _variants("payables", AP_VARIANTS),
    "transaction_variants": _variants("transactions", TXN_VARIANTS),
    "raw_transactions": _raw("transactions"),
    "raw_accounts_receivable": _raw("accounts_receivable"),
    "raw_accounts_payable": _raw("accounts_payable"),
}
SPARK_VIEWS.update({name: _events(source, kinds) for name, source, kinds in EVENT_SOURCES})
