"""Queries over the raw tables: every quality rule, the cascade, the split, the ledger and the score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harness.books import EXTRA_DUCK_VIEWS as V
from harness.books import Books
from harness.present import plain
from harness.registry import query
from tallystone.config import QualitySettings
from tallystone.functions.parsing import to_date, to_money
from tallystone.operators import completeness, consistency, issues, ledger, reconciliation, scoring, statements
from tallystone.operators import uniqueness, validity
from tallystone.plans import quality
from tallystone.schema import EXPECTED_COLUMNS, PAYABLES, RECEIVABLES, ROW_LEVEL_DATASETS, TRANSACTIONS
from tallystone.session import step_path
from tallystone.sources import layers
from tallystone.sources.raw import (
    absent_columns, csv_headers, null_counts, number_copies, physical_rows, scan_csv, union_all,
)

SETTINGS = QualitySettings()
RUN_AT = "2024-01-01T00:00:00+00:00"
RAW = {name: f"raw_{name}" for name in ROW_LEVEL_DATASETS}

# Rules in SQL. Each view yields row_uid, dataset, validation_rule, severity, reason, field.

_BLANK = "({c} IS NULL OR trim({c}) = '')"
_DATE = "CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)"
_NUM = "TRY_CAST({c} AS DECIMAL(28,6))"


def _quote(text: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if text is None else "'" + text.replace("'", "''") + "'"


def _rule(dataset: str, rule: str, severity: str, reason: str, where: str, field: str | None = None,
          reason_sql: str | None = None, source: str | None = None) -> str:
    return (
        f"SELECT row_uid, '{dataset}' AS dataset, '{rule}' AS validation_rule, '{severity}' AS severity, "
        f"{reason_sql or _quote(reason)} AS reason, {_quote(field)} AS field FROM {source or f'[{RAW[dataset]}]'} r "
        f"WHERE {where}"
    )


def _missing(dataset: str, fields: dict[str, str]) -> list[str]:
    return [
        _rule(dataset, f"missing_{f}", s, f"{f} is empty", _BLANK.format(c=f), f)
        for f, s in fields.items()
    ]


_NO_PAYMENT = _BLANK.format(c="payment_date")
TXN_COMPLETE = _missing(
    TRANSACTIONS,
    {
        "transaction_id": "CRITICAL", "entity_id": "CRITICAL", "account_id": "CRITICAL", "amount": "CRITICAL",
        "currency": "HIGH", "business_unit": "INFO", "account_name": "INFO", "counterparty_id": "INFO",
    },
)
TXN_PAYMENT = [
    _rule(TRANSACTIONS, "missing_payment_date_unpaid", "LOW",
          "no payment date on an invoice line; the item is still open",
          f"{_NO_PAYMENT} AND document_type IN ('Revenue Invoice', 'Vendor Invoice')", "payment_date"),
    _rule(TRANSACTIONS, "missing_payment_date_inconsistent", "HIGH", "",
          f"{_NO_PAYMENT} AND document_type IN ('Cash Receipt', 'Vendor Payment')", "payment_date",
          "'payment booked as ' || document_type || ' without a payment date'"),
]


def _invoice_complete(dataset: str, party: str, category: str) -> list[str]:
    return _missing(
        dataset,
        {
            "invoice_id": "CRITICAL", "entity_id": "CRITICAL", party: "CRITICAL", "invoice_amount": "CRITICAL",
            "currency": "HIGH", "business_unit": "INFO", category: "INFO",
        },
    ) + [
        _rule(dataset, "missing_payment_date_unpaid", "LOW",
              "no payment date, and the status is not Paid",
              f"{_NO_PAYMENT} AND payment_status IS DISTINCT FROM 'Paid'", "payment_date"),
        _rule(dataset, "missing_payment_date_inconsistent", "HIGH", "status Paid without a payment date",
              f"{_NO_PAYMENT} AND payment_status = 'Paid'", "payment_date"),
    ]


def _currency(dataset: str) -> str:
    return _rule(dataset, "invalid_currency", "HIGH", "currency outside EUR, GBP, USD",
                 "currency NOT IN ('EUR', 'USD', 'GBP')", "currency")


def _negative(dataset: str, amount: str) -> str:
    return _rule(dataset, "negative_amount_not_allowed", "MEDIUM",
                 f"{amount} below zero",
                 f"{_NUM.format(c=amount)} < 0", amount)


def _bad_date(dataset: str, column: str) -> str:
    return _rule(dataset, "invalid_date", "HIGH", f"{column} holds no calendar date",
                 f"NOT {_BLANK.format(c=column)} AND {_DATE.format(c=column)} IS NULL", column)


def _order(dataset: str, early: str, late: str, rule: str) -> str:
    return _rule(dataset, rule, "HIGH", f"{late} before {early}",
                 f"{_DATE.format(c=late)} < {_DATE.format(c=early)}", late)


MISMATCH = _rule(PAYABLES, "amount_mismatch", "MEDIUM", "invoice_amount does not equal net_amount + tax_amount",
                 f"abs({_NUM.format(c='invoice_amount')} - ({_NUM.format(c='net_amount')} + {_NUM.format(c='tax_amount')})) > 0.01",
                 "invoice_amount")
ROW_VALIDITY = {
    TRANSACTIONS: [
        _currency(TRANSACTIONS), _negative(TRANSACTIONS, "amount"),
        *[_bad_date(TRANSACTIONS, c) for c in ("transaction_date", "payment_due_date", "payment_date")],
        _order(TRANSACTIONS, "transaction_date", "payment_date", "payment_before_invoice"),
    ],
    **{
        d: [
            _currency(d), _negative(d, "invoice_amount"),
            *[_bad_date(d, c) for c in ("invoice_date", "due_date", "payment_date")],
            _order(d, "invoice_date", "due_date", "invalid_due_date"),
            _order(d, "invoice_date", "payment_date", "payment_before_invoice"),
            *([MISMATCH] if d == PAYABLES else []),
        ]
        for d in (RECEIVABLES, PAYABLES)
    },
}
COMPLETE = {
    TRANSACTIONS: TXN_COMPLETE + TXN_PAYMENT,
    RECEIVABLES: _invoice_complete(RECEIVABLES, "customer_id", "customer_segment"),
    PAYABLES: _invoice_complete(PAYABLES, "vendor_id", "expense_category"),
}
V["row_local_issues"] = " UNION ALL ".join(r for d in ROW_LEVEL_DATASETS for r in COMPLETE[d] + ROW_VALIDITY[d])


def _repeated(dataset: str, rule: str, keys: list[str], reason: str) -> str:
    key = ", ".join(keys)
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return _rule(dataset, rule, "HIGH", reason, "n_same > 1",
                 source=f"(SELECT row_uid, count(*) OVER (PARTITION BY {key}) AS n_same FROM [{RAW[dataset]}] WHERE {present})")


def _exact(dataset: str) -> str:
    return _repeated(dataset, "duplicate_exact", ["row_uid"], "more than one record has exactly this content")


def _invoice(dataset: str) -> str:
    return _repeated(dataset, "duplicate_invoice", ["invoice_id"], "invoice_id repeated by another record")


def _business(dataset: str, party: str) -> str:
    keys = [party, "invoice_date", "invoice_amount"]
    return _repeated(dataset, "duplicate_business_key", keys,
                     f"{' + '.join(keys)} repeated by another record")


def _near(dataset: str, party: str) -> str:
    rows = (
        f"SELECT row_uid, invoice_id, {party} AS party, {_DATE.format(c='invoice_date')} AS day, "
        f"{_NUM.format(c='invoice_amount')} AS value, row_number() OVER () AS n FROM [{RAW[dataset]}] WHERE {party} IS NOT NULL"
    )
    matched = (
        f"SELECT DISTINCT a.n, a.row_uid FROM ({rows}) a JOIN ({rows}) b ON a.party = b.party AND a.day = b.day "
        "AND a.n <> b.n AND (a.invoice_id <> b.invoice_id OR a.invoice_id IS NULL OR b.invoice_id IS NULL) "
        "AND abs(b.value - a.value) <= a.value * 0.005"
    )
    return _rule(dataset, "duplicate_near", "MEDIUM",
                 f"another invoice of this {party} has the same invoice_date and invoice_amount within 0.5%",
                 "true", source=f"({matched})")


UNIQUE = {
    TRANSACTIONS: [_exact(TRANSACTIONS)],
    RECEIVABLES: [_exact(RECEIVABLES), _invoice(RECEIVABLES), _business(RECEIVABLES, "customer_id"), _near(RECEIVABLES, "customer_id")],
    PAYABLES: [_exact(PAYABLES), _invoice(PAYABLES), _business(PAYABLES, "vendor_id"), _near(PAYABLES, "vendor_id")],
}
V["uniqueness_issues"] = " UNION ALL ".join(r for d in ROW_LEVEL_DATASETS for r in UNIQUE[d])


def _outlier(dataset: str, amount: str, group: str) -> str:
    values = f"SELECT row_uid, {group} AS grp, {_NUM.format(c=amount)} AS value FROM [{RAW[dataset]}] WHERE {group} IS NOT NULL"
    scored = (
        f"SELECT row_uid, 0.6745 * CAST(value - med AS DOUBLE) / nullif(CAST(mad AS DOUBLE), 0) AS z, n FROM ("
        f"SELECT *, median(abs(value - med)) OVER (PARTITION BY grp) AS mad FROM ("
        f"SELECT *, CAST(median(value) OVER (PARTITION BY grp) AS DECIMAL(28,7)) AS med, count(value) OVER (PARTITION BY grp) AS n FROM ({values})))"
    )
    return _rule(dataset, "statistical_outlier", "MEDIUM",
                 f"{amount} more than 8 robust deviations from the median of its category",
                 "n >= 20 AND abs(z) > 8", amount, source=f"({scored})")


OUTLIER = {
    TRANSACTIONS: _outlier(TRANSACTIONS, "amount", "account_name"),
    RECEIVABLES: _outlier(RECEIVABLES, "invoice_amount", "business_unit"),
    PAYABLES: _outlier(PAYABLES, "invoice_amount", "expense_category"),
}
V["outlier_issues"] = " UNION ALL ".join(OUTLIER.values())


def _foreign(dataset: str, column: str, master: str, severity: str = "HIGH") -> str:
    return _rule(dataset, f"invalid_{column}", severity, f"no master record with this {column}",
                 f"{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM [{master}] m WHERE m.{column} = r.{column})", column)


FOREIGN = [
    _foreign(TRANSACTIONS, "account_id", "chart_of_accounts"), _foreign(TRANSACTIONS, "entity_id", "entities"),
    _foreign(RECEIVABLES, "entity_id", "entities"), _foreign(RECEIVABLES, "customer_id", "customers"),
    _foreign(PAYABLES, "entity_id", "entities"), _foreign(PAYABLES, "vendor_id", "vendors"),
]
DRIFT = _rule(TRANSACTIONS, "inconsistent_classification", "HIGH",
              "account_category differs from the chart of accounts",
              "EXISTS (SELECT 1 FROM [chart_of_accounts] m WHERE m.account_id = r.account_id AND m.account_category <> r.account_category)",
              "account_category")
V["consistency_issues"] = " UNION ALL ".join([*FOREIGN, DRIFT])

V["unbalanced"] = f"""
SELECT document_id FROM (SELECT document_id, abs(sum(coalesce({_NUM.format(c='debit')}, 0) - coalesce({_NUM.format(c='credit')}, 0))) AS gap
FROM [raw_transactions] WHERE document_id IS NOT NULL GROUP BY document_id) WHERE gap > 0.01"""
BALANCE = _rule(TRANSACTIONS, "journal_entry_unbalanced", "CRITICAL", "",
                "document_id IN (SELECT document_id FROM [unbalanced])", None,
                "'debits and credits of document ' || document_id || ' differ'")


def _tie(dataset: str, amount: str, kind: str, account: str, side: str) -> str:
    def total(source: str, date: str, value: str, where: str) -> str:
        return (
            f"SELECT entity_id, date_trunc('month', {_DATE.format(c=date)}) AS period, coalesce(sum({_NUM.format(c=value)}), 0) AS total "
            f"FROM [{source}] WHERE {where} AND entity_id IS NOT NULL AND {_DATE.format(c=date)} IS NOT NULL GROUP BY 1, 2"
        )

    sub = total(RAW[dataset], "invoice_date", amount, "true")
    gl = total("raw_transactions", "transaction_date", side, f"document_type = '{kind}' AND account_name = '{account}'")
    return (
        f"SELECT coalesce(s.entity_id, g.entity_id) AS entity_id, coalesce(s.period, g.period) AS period, '{dataset}' AS dataset, "
        f"CAST(coalesce(s.total, 0) AS DECIMAL(28,6)) AS subledger, CAST(coalesce(g.total, 0) AS DECIMAL(28,6)) AS gl, "
        f"'{amount}' AS field, '{account}' AS account "
        f"FROM ({sub}) s FULL JOIN ({gl}) g ON s.entity_id = g.entity_id AND s.period = g.period"
    )


V["tie_out"] = (
    _tie(RECEIVABLES, "invoice_amount", "Revenue Invoice", "Accounts Receivable", "debit") + " UNION ALL "
    + _tie(PAYABLES, "net_amount", "Vendor Invoice", "Accounts Payable", "credit")
)
_TWO = "CAST(CAST({c} AS DECIMAL(28,2)) AS VARCHAR)"
V["tie_out_issues"] = f"""
SELECT CAST(NULL AS VARCHAR) AS row_uid, dataset, 'subledger_tie_out_failure' AS validation_rule, 'HIGH' AS severity,
       dataset || ' of ' || entity_id || ' in ' || strftime(period, '%Y-%m') || ': sub-ledger ' || {_TWO.format(c='subledger')}
       || ', ' || account || ' postings ' || {_TWO.format(c='gl')} || ', off by ' || {_TWO.format(c='abs(subledger - gl)')} AS reason, field
FROM [tie_out] WHERE abs(subledger - gl) > 0.01"""
V["reconciliation_issues"] = f"{BALANCE} UNION ALL SELECT * FROM [tie_out_issues]"

_DIMENSION = """CASE WHEN validation_rule LIKE 'missing\\_%' ESCAPE '\\' THEN 'completeness'
 WHEN validation_rule LIKE 'duplicate\\_%' ESCAPE '\\' THEN 'uniqueness'
 WHEN validation_rule IN ('invalid_currency', 'negative_amount_not_allowed', 'invalid_date', 'payment_before_invoice',
      'amount_mismatch', 'statistical_outlier', 'invalid_due_date') THEN 'validity'
 WHEN validation_rule IN ('invalid_account_id', 'invalid_entity_id', 'invalid_customer_id', 'invalid_vendor_id',
      'inconsistent_classification') THEN 'consistency'
 WHEN validation_rule IN ('journal_entry_unbalanced', 'subledger_tie_out_failure', 'document_quarantine_cascade')
      THEN 'reconciliation' END"""
V["all_issues"] = f"""
SELECT *, {_DIMENSION} AS dimension FROM (SELECT * FROM [row_local_issues] UNION ALL SELECT * FROM [uniqueness_issues]
UNION ALL SELECT * FROM [outlier_issues] UNION ALL SELECT * FROM [consistency_issues]
UNION ALL SELECT * FROM [reconciliation_issues])"""
V["flagged_first"] = """
SELECT DISTINCT row_uid FROM [all_issues] WHERE row_uid IS NOT NULL AND severity IN ('CRITICAL', 'HIGH')"""
V["cascade"] = f"""
SELECT DISTINCT t.row_uid, 'transactions' AS dataset, 'document_quarantine_cascade' AS validation_rule,
       'CRITICAL' AS severity, {_quote(scoring.CASCADE_REASON)} AS reason, CAST(NULL AS VARCHAR) AS field,
       'reconciliation' AS dimension
FROM [raw_transactions] t
WHERE document_id IN (SELECT document_id FROM [raw_transactions] WHERE row_uid IN (SELECT row_uid FROM [flagged_first]))
  AND row_uid NOT IN (SELECT row_uid FROM [flagged_first])"""
V["final_issues"] = "SELECT * FROM [all_issues] UNION ALL SELECT * FROM [cascade]"
V["flagged"] = """
SELECT DISTINCT row_uid FROM [final_issues] WHERE row_uid IS NOT NULL AND severity IN ('CRITICAL', 'HIGH')"""
V["layer_counts"] = " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, count(*) AS n_raw, count(*) FILTER (WHERE f.row_uid IS NULL) AS n_validated, "
    f"count(f.row_uid) AS n_quarantined FROM [{RAW[d]}] r LEFT JOIN [flagged] f ON f.row_uid = r.row_uid"
    for d in ROW_LEVEL_DATASETS
)


# Scans


@query(
    "raw_scan",
    " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, name AS column_name, n_rows, n_missing FROM (UNPIVOT (SELECT count(*) AS n_rows, "
        + ", ".join(f"count(*) - count({c}) AS {c}" for c in completeness.EXPECTED_COLUMNS[d])
        + f" FROM [{RAW[d]}]) ON {', '.join(completeness.EXPECTED_COLUMNS[d])} INTO NAME name VALUE n_missing)"
        for d in ROW_LEVEL_DATASETS
    ),
)
def raw_scan(b: Books) -> DataFrame:
    return union_all([null_counts(b[RAW[d]], d) for d in ROW_LEVEL_DATASETS])


@query("row_lineage", """SELECT dataset, count(*) AS n_rows, count(*) AS n_uids FROM (
       SELECT 'transactions' AS dataset FROM [raw_transactions] UNION ALL
       SELECT 'accounts_receivable' FROM [raw_accounts_receivable] UNION ALL
       SELECT 'accounts_payable' FROM [raw_accounts_payable]) GROUP BY dataset""")
def row_lineage(b: Books) -> DataFrame:
    """Physical records and distinct lineage keys per table: the same number."""
    uids = union_all([number_copies(b[RAW[d]]).select(F.lit(d).alias("dataset"), "row_uid") for d in ROW_LEVEL_DATASETS])
    return uids.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_uid").alias("n_uids")
    )


@query(
    "strict_parse",
    f"""SELECT strftime(date_trunc('month', {_DATE.format(c='invoice_date')}), '%Y-%m') AS period, count(*) AS n_rows,
               count({_NUM.format(c='invoice_amount')}) AS n_amounts, count({_DATE.format(c='due_date')}) AS n_due,
               CAST(sum({_NUM.format(c='invoice_amount')}) AS DOUBLE) AS amount
        FROM [raw_accounts_receivable] GROUP BY 1""",
)
def strict_parse(b: Books) -> DataFrame:
    parsed = b["raw_accounts_receivable"].select(
        F.date_format(to_date(F.col("invoice_date")), "yyyy-MM").alias("period"),
        to_money(F.col("invoice_amount")).alias("amount"), to_date(F.col("due_date")).alias("due"),
    )
    return parsed.groupBy("period").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("amount").alias("n_amounts"), F.count("due").alias("n_due"),
        F.sum("amount").cast("double").alias("amount"),
    )


# The raw tables as CSV files. Half of the records, by a digest of their first column, are in files whose columns stand in reverse
# order; in the payables the last expected column is left out of these.

_LACKS = {PAYABLES: EXPECTED_COLUMNS[PAYABLES][-1]}


def csv_scans(b: Books) -> dict[str, DataFrame]:
    """The eight raw tables, written as CSV and read back by the CSV scan."""
    def written(name: str) -> str:
        df = b.raw_tables()[name]
        columns = [c for c in EXPECTED_COLUMNS[name] if c in df.columns]
        path = step_path(b.spark, f"csv_{name}")
        other = F.substring(F.md5(F.coalesce(F.col(columns[0]).cast("string"), F.lit(""))), -1, 1) < "8"
        text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        options = dict(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="gzip")
        text.where(~other).write.options(**options).csv(f"{path}/one")
        rest = [c for c in reversed(columns) if c != _LACKS.get(name)]
        text.where(other).select(*rest).write.options(**options).csv(f"{path}/two")
        return f"{path}/*/*.csv.gz"

    if "csv_paths" not in b._frames:
        b._frames["csv_paths"] = {n: written(n) for n in EXPECTED_COLUMNS}
        b._frames["csv_scans"] = {n: scan_csv(b.spark, path, n, places=False) for n, path in b._frames["csv_paths"].items()}
    return b._frames["csv_scans"]


_TABLE = {**RAW, **{n: n for n in EXPECTED_COLUMNS if n not in RAW}}


def _in_second(name: str) -> str:
    return f"right(md5(coalesce({EXPECTED_COLUMNS[name][0]}::VARCHAR, '')), 1) < '8'"


def _missing_count(name: str, column: str) -> str:
    lacking = f" OR {_in_second(name)}" if column == _LACKS.get(name) else ""
    return f"count(*) FILTER (WHERE {column} IS NULL{lacking}) AS {column}"


@query(
    "raw_scan_csv",
    " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, name AS column_name, n_rows, n_missing FROM (UNPIVOT (SELECT count(*) AS n_rows, "
        + ", ".join(_missing_count(d, c) for c in columns) + f" FROM [{_TABLE[d]}]) ON {', '.join(columns)} INTO NAME name VALUE n_missing)"
        for d, columns in EXPECTED_COLUMNS.items()
    ),
)
def raw_scan_csv(b: Books) -> DataFrame:
    """Rows and missing values of each expected column of the eight tables, through the CSV scan of files with two headers."""
    return union_all([null_counts(scan, d) for d, scan in csv_scans(b).items()])


@query("csv_lineage", " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, count(*) AS n_rows, count(*) AS n_ids, count(*) AS n_places FROM [{_TABLE[d]}]" for d in EXPECTED_COLUMNS
))
def csv_lineage(b: Books) -> DataFrame:
    """Physical records, their distinct keys, and the places that the files have: the same number."""
    parts = []
    csv_scans(b)
    for d, path in b._frames["csv_paths"].items():
        files = scan_csv(b.spark, path, d).groupBy("source_file").agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("row_index").alias("ids"), (F.max("row_index") + 1).alias("places")
        )
        parts.append(files.agg(
            F.lit(d).alias("dataset"), F.sum("n").alias("n_rows"), F.sum("ids").alias("n_ids"), F.sum("places").alias("n_places")
        ))
    return union_all(parts)


@query("physical_lineage", "SELECT o_orderkey, row_number() OVER () - 1 AS row_index FROM orders")
def physical_lineage(b: Books) -> DataFrame:
    """The number of each order in its file, from the hidden columns of the scan."""
    return physical_rows(b["orders"]).select("o_orderkey", "row_index")


@query(
    "schema_check",
    " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, 'schema_missing_column' AS validation_rule, 'CRITICAL' AS severity, '{c}' AS field, count(*) AS n_rows "
        f"FROM [{_TABLE[d]}] WHERE {_in_second(d)}" for d, c in _LACKS.items()
    ),
)
def schema_check(b: Books) -> DataFrame:
    """Expected columns that files lack, of all eight tables, with the number of records in these files."""
    parts = []
    for d, scan in csv_scans(b).items():
        absent = absent_columns(csv_headers(b.spark, b._frames["csv_paths"][d]), d)
        sizes = scan.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))
        rows = completeness.schema_issues_of_files(absent, d).select("dataset", "validation_rule", "severity", "field", "reason")
        met = absent.join(sizes, "source_file").groupBy("field").agg(F.sum("n_rows").alias("n_rows"))
        parts.append(rows.drop("reason").distinct().join(met, "field"))
    return union_all(parts).select("dataset", "validation_rule", "severity", "field", "n_rows")


_PARSED = {
    TRANSACTIONS: ("transaction_date", ("transaction_date", "payment_due_date", "payment_date"), ("amount", "debit", "credit")),
    RECEIVABLES: ("invoice_date", ("invoice_date", "due_date", "payment_date"), ("invoice_amount",)),
    PAYABLES: ("invoice_date", ("invoice_date", "due_date", "payment_date"), ("invoice_amount", "tax_amount", "net_amount")),
}


@query(
    "strict_parse_all",
    " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, strftime(date_trunc('month', {_DATE.format(c=by)}), '%Y-%m') AS period, count(*) AS n_rows, "
        f"{' + '.join(f'count({_DATE.format(c=c)})' for c in dates)} AS n_dates, {' + '.join(f'count({_NUM.format(c=c)})' for c in amounts)} AS n_amounts, "
        f"CAST({' + '.join(f'coalesce(CAST(sum({_NUM.format(c=c)}) AS DECIMAL(28,6)), 0)' for c in amounts)} AS DECIMAL(28,2))::VARCHAR AS amount FROM [{RAW[d]}] GROUP BY 2"
        for d, (by, dates, amounts) in _PARSED.items()
    ),
)
def strict_parse_all(b: Books) -> DataFrame:
    """All dates and amounts of the three row-level tables, by month."""
    parts = []
    for d, (by, dates, amounts) in _PARSED.items():
        parsed = b[RAW[d]].select(
            F.date_format(to_date(F.col(by)), "yyyy-MM").alias("period"), *[to_date(F.col(c)).alias(c) for c in {by: 0, **dict.fromkeys(dates)}],
            *[to_money(F.col(c)).alias(c) for c in amounts],
        )
        total = sum((F.coalesce(F.sum(c), F.expr("0BD")).cast("decimal(38,6)") for c in amounts[1:]), F.coalesce(F.sum(amounts[0]), F.expr("0BD")).cast("decimal(38,6)"))
        parts.append(parsed.groupBy("period").agg(
            F.lit(d).alias("dataset"), F.count(F.lit(1)).alias("n_rows"), sum((F.count(c) for c in dates[1:]), F.count(dates[0])).alias("n_dates"),
            sum((F.count(c) for c in amounts[1:]), F.count(amounts[0])).alias("n_amounts"), total.cast("decimal(28,2)").cast("string").alias("amount"),
        ))
    return union_all(parts).select("dataset", "period", "n_rows", "n_dates", "n_amounts", "amount")


# Rules

_ISSUE = "row_uid, dataset, validation_rule, severity, reason, field"


def _sql(*parts: str) -> str:
    return f"SELECT {_ISSUE} FROM ({' UNION ALL '.join(parts)})"


def _rules(b: Books, dataset: str, rules: list[issues.RowRule]) -> DataFrame:
    return issues.evaluate_row_rules(b[RAW[dataset]], dataset, rules)


@query("issues_row_local", f"SELECT {_ISSUE} FROM [row_local_issues]")
def issues_row_local(b: Books) -> DataFrame:
    return quality.row_local_issues(b.raw_tables())


@query("rule_counts", "SELECT dataset, validation_rule, severity, field, count(*) AS n_issues FROM [row_local_issues] GROUP BY ALL")
def rule_counts(b: Books) -> DataFrame:
    return quality.row_local_counts(b.raw_tables())


@query(
    "missing_fields",
    "SELECT dataset, validation_rule, severity, count(*) AS n FROM ("
    + " UNION ALL ".join(r for d in ROW_LEVEL_DATASETS for r in COMPLETE[d])
    + ") WHERE field <> 'payment_date' GROUP BY ALL",
)
def missing_fields(b: Books) -> DataFrame:
    frames = [
        _rules(b, d, [r for r in completeness.completeness_rules(b[RAW[d]], d, SETTINGS) if r.field != "payment_date"])
        for d in ROW_LEVEL_DATASETS
    ]
    return union_all(frames).groupBy("dataset", "validation_rule", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("completeness_txn", _sql(*COMPLETE[TRANSACTIONS]))
def completeness_txn(b: Books) -> DataFrame:
    df = b[RAW[TRANSACTIONS]]
    return _rules(b, TRANSACTIONS, completeness.completeness_rules(df, TRANSACTIONS, SETTINGS))


@query("payment_date_context_txn", _sql(*TXN_PAYMENT))
def payment_date_context_txn(b: Books) -> DataFrame:
    return _rules(b, TRANSACTIONS, completeness.ledger_payment_date_rules(SETTINGS))


@query("completeness_ar", _sql(*COMPLETE[RECEIVABLES]))
def completeness_ar(b: Books) -> DataFrame:
    return _rules(b, RECEIVABLES, completeness.completeness_rules(b[RAW[RECEIVABLES]], RECEIVABLES, SETTINGS))


@query("completeness_ap", _sql(*COMPLETE[PAYABLES]))
def completeness_ap(b: Books) -> DataFrame:
    return _rules(b, PAYABLES, completeness.completeness_rules(b[RAW[PAYABLES]], PAYABLES, SETTINGS))


@query("dup_exact", _sql(*[_exact(d) for d in ROW_LEVEL_DATASETS]))
def dup_exact(b: Books) -> DataFrame:
    return union_all([uniqueness.exact_duplicates(b[RAW[d]], d, "HIGH") for d in ROW_LEVEL_DATASETS])


_INVOICES = (RECEIVABLES, PAYABLES)


@query("dup_business_key", _sql(*[_business(d, uniqueness.PARTY[d]) for d in _INVOICES]))
def dup_business_key(b: Books) -> DataFrame:
    keys = lambda d: [uniqueness.PARTY[d], "invoice_date", "invoice_amount"]
    return union_all([uniqueness.business_key_duplicates(b[RAW[d]], d, keys(d), "HIGH") for d in _INVOICES])


@query("dup_invoice", _sql(*[_invoice(d) for d in _INVOICES]))
def dup_invoice(b: Books) -> DataFrame:
    return union_all([uniqueness.duplicate_invoice_ids(b[RAW[d]], d, "HIGH") for d in _INVOICES])


@query("dup_near", _sql(*[_near(d, uniqueness.PARTY[d]) for d in _INVOICES]))
def dup_near(b: Books) -> DataFrame:
    return union_all(
        [
            uniqueness.near_duplicates(b[RAW[d]], d, uniqueness.PARTY[d], "invoice_amount", "invoice_date", "MEDIUM")
            for d in _INVOICES
        ]
    )


@query("uniqueness_issues", f"SELECT {_ISSUE} FROM [uniqueness_issues]")
def uniqueness_issues(b: Books) -> DataFrame:
    return quality.duplicate_issues(b.with_written_invoices().raw_tables())


@query("amount_mismatch", _sql(MISMATCH))
def amount_mismatch(b: Books) -> DataFrame:
    return _rules(b, PAYABLES, [validity.gross_rule("0.01", "MEDIUM")])


@query("date_order", _sql(*[r for d in ROW_LEVEL_DATASETS for r in ROW_VALIDITY[d] if "_date before " in r]))
def date_order(b: Books) -> DataFrame:
    wanted = ("payment_before_invoice", "invalid_due_date")
    return union_all(
        [
            _rules(b, d, [r for r in validity.validity_row_rules(b[RAW[d]], d, SETTINGS) if r.name in wanted])
            for d in ROW_LEVEL_DATASETS
        ]
    )


@query("invalid_currency", _sql(*[_currency(d) for d in ROW_LEVEL_DATASETS]))
def invalid_currency(b: Books) -> DataFrame:
    return union_all([_rules(b, d, [validity.currency_rule("HIGH")]) for d in ROW_LEVEL_DATASETS])


@query("negative_amount", _sql(*[_negative(d, validity.AMOUNT[d]) for d in ROW_LEVEL_DATASETS]))
def negative_amount(b: Books) -> DataFrame:
    return union_all(
        [_rules(b, d, [validity.negative_amount_rule(validity.AMOUNT[d], "MEDIUM")]) for d in ROW_LEVEL_DATASETS]
    )


@query("invalid_date", _sql(*[_bad_date(d, c) for d in ROW_LEVEL_DATASETS for c in validity.DATE_COLUMNS[d]]))
def invalid_date(b: Books) -> DataFrame:
    return union_all(
        [
            _rules(b, d, validity.invalid_date_rules(b[RAW[d]], validity.DATE_COLUMNS[d], "HIGH"))
            for d in ROW_LEVEL_DATASETS
        ]
    )


@query("outlier_mad", f"SELECT {_ISSUE} FROM [outlier_issues]")
def outlier_mad(b: Books) -> DataFrame:
    return quality.outlier_issues(b.raw_tables())


@query(
    "validity_issues",
    _sql(*[r for d in ROW_LEVEL_DATASETS for r in ROW_VALIDITY[d]], "SELECT * FROM [outlier_issues]"),
)
def validity_issues(b: Books) -> DataFrame:
    rows = [_rules(b, d, validity.validity_row_rules(b[RAW[d]], d, SETTINGS)) for d in ROW_LEVEL_DATASETS]
    return union_all([*rows, quality.outlier_issues(b.raw_tables())])


@query("fk_violation", _sql(*FOREIGN))
def fk_violation(b: Books) -> DataFrame:
    return consistency.consistency_issues(b.raw_tables(), SETTINGS).where(F.col("validation_rule").startswith("invalid_"))


@query("category_drift", _sql(DRIFT))
def category_drift(b: Books) -> DataFrame:
    return consistency.consistency_issues(b.raw_tables(), SETTINGS).where("validation_rule = 'inconsistent_classification'")


@query("consistency_issues", f"SELECT {_ISSUE} FROM [consistency_issues]")
def consistency_issues(b: Books) -> DataFrame:
    return consistency.consistency_issues(b.raw_tables(), SETTINGS)


@query("journal_unbalanced", _sql(BALANCE))
def journal_unbalanced(b: Books) -> DataFrame:
    return reconciliation.journal_balance_issues(b[RAW[TRANSACTIONS]], "0.01", "CRITICAL")


@query(
    "subledger_tieout",
    """SELECT dataset, entity_id, strftime(period, '%Y-%m') AS period, CAST(round(subledger, 2) AS DOUBLE) AS subledger,
              CAST(round(gl, 2) AS DOUBLE) AS gl, CAST(round(abs(subledger - gl), 2) AS DOUBLE) AS difference FROM [tie_out]""",
)
def subledger_tieout(b: Books) -> DataFrame:
    t = b[RAW[TRANSACTIONS]]
    ar = reconciliation.tie_out(b[RAW[RECEIVABLES]], t, "invoice_amount", "Revenue Invoice", "Accounts Receivable", "debit")
    ap = reconciliation.tie_out(b[RAW[PAYABLES]], t, "net_amount", "Vendor Invoice", "Accounts Payable", "credit")
    both = ar.withColumn("dataset", F.lit(RECEIVABLES)).unionByName(ap.withColumn("dataset", F.lit(PAYABLES)))
    return plain(both)


@query("reconciliation_issues", f"SELECT {_ISSUE} FROM [reconciliation_issues]")
def reconciliation_issues(b: Books) -> DataFrame:
    return reconciliation.reconciliation_issues(b.raw_tables(), SETTINGS)


# The engine


def checked(b: Books) -> DataFrame:
    """The issue table, written once: the cascade, the split, the ledger and the score all start from it."""
    return b.once("checks", lambda books: quality.run_all_checks(books.with_written_invoices().raw_tables()))


def final_issues(b: Books) -> DataFrame:
    """Checks plus cascade, written once as well."""
    return b.once("final_issues", lambda books: scoring.with_cascade(_near_flagged(books), checked(books)))


def _near_flagged(b: Books) -> DataFrame:
    """The legs that the cascade looks at."""
    return scoring.flagged_documents(_tagged(b)[TRANSACTIONS], checked(b))


def _tagged(b: Books) -> dict[str, DataFrame]:
    tables = b.with_written_invoices().raw_tables()
    return {**tables, TRANSACTIONS: layers.with_document_tag(tables[TRANSACTIONS])}


@query("all_issues", f"SELECT {_ISSUE}, dimension FROM [all_issues]")
def all_issues(b: Books) -> DataFrame:
    return quality.run_all_checks(b.with_written_invoices().raw_tables())


@query(
    "rule_dimension",
    "SELECT validation_rule, dimension, severity, count(*) AS n_issues FROM [all_issues] GROUP BY ALL",
)
def rule_dimension(b: Books) -> DataFrame:
    return quality.rule_catalog(checked(b))


@query("document_cascade", f"SELECT {_ISSUE}, dimension FROM [cascade]")
def document_cascade(b: Books) -> DataFrame:
    return scoring.cascade_issues(_near_flagged(b), checked(b))


@query(
    "validated_split",
    " UNION ALL ".join(
        f"SELECT '{d}' AS dataset, r.row_uid, CASE WHEN f.row_uid IS NULL THEN 'validated' ELSE 'quarantined' END AS layer "
        f"FROM [{RAW[d]}] r LEFT JOIN [flagged] f ON f.row_uid = r.row_uid"
        for d in ROW_LEVEL_DATASETS
    ),
)
def validated_split(b: Books) -> DataFrame:
    return scoring.split_layers(b.with_written_invoices().raw_tables(), final_issues(b))


@query("layers_written", "SELECT * FROM [layer_counts]")
def layers_written(b: Books) -> DataFrame:
    """The layers written in one pass per table and read back; an error unless the rows are as many as the pass observed."""
    root = step_path(b.spark, "layers")
    counts = layers.write_layers(b.with_written_invoices().raw_tables(), scoring.flagged_by_dataset(final_issues(b)), root)
    back = union_all([
        b.spark.read.parquet(f"{root}/{d}").select(F.lit(d).alias("dataset"), "layer") for d in ROW_LEVEL_DATASETS
    ])
    read = back.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_raw"), F.count_if(F.col("layer") == "validated").alias("n_validated"),
        F.count_if(F.col("layer") == "quarantined").alias("n_quarantined"),
    )
    observed = [f"{d} {c['n_raw']} {c['n_validated']} {c['n_quarantined']}" for d, c in counts.items()]
    same = F.concat_ws(" ", "dataset", "n_raw", "n_validated", "n_quarantined").isin(*observed)
    wrong = F.raise_error(F.lit("the rows read back are not those observed")).cast("long")
    return read.withColumn("n_raw", F.when(same, F.col("n_raw")).otherwise(wrong))


V["quarantine_ledger"] = f"""
SELECT dataset, row_uid AS record_id, validation_rule, severity, reason, '{RUN_AT}' AS timestamp FROM [final_issues]
WHERE row_uid IS NOT NULL AND severity IN ('CRITICAL', 'HIGH')"""


@query("quarantine_ledger", "SELECT * FROM [quarantine_ledger]")
def quarantine_ledger(b: Books) -> DataFrame:
    return scoring.quarantine_ledger(final_issues(b), RUN_AT)


_PENALTY = """least(coalesce(sum(CASE severity WHEN 'CRITICAL' THEN 1.0 WHEN 'HIGH' THEN 0.6 WHEN 'MEDIUM' THEN 0.3
 WHEN 'LOW' THEN 0.1 WHEN 'INFO' THEN 0.02 ELSE 0.3 END) FILTER (WHERE dimension = '{d}'), 0)::DOUBLE / any_value(n), 1)"""
_DIMENSIONS = ("completeness", "uniqueness", "validity", "consistency", "reconciliation")
V["quality_score"] = (
    "SELECT *, round("
    + " + ".join(f"0.2 * {d}_score" for d in _DIMENSIONS)
    + ", 2) AS overall_score FROM (SELECT "
    + ", ".join(f"round(100 * (1 - {_PENALTY.format(d=d)}), 2) AS {d}_score" for d in _DIMENSIONS)
    + ", any_value(n) AS total_rows FROM [final_issues], (SELECT CAST(sum(n_raw) AS BIGINT) AS n FROM [layer_counts]))"
)


@query("quality_score", "SELECT * FROM [quality_score]")
def quality_score(b: Books) -> DataFrame:
    return scoring.quality_score(final_issues(b), b.with_written_invoices().raw_tables())


@query(
    "issue_counts",
    """SELECT 'severity' AS grouping, severity AS name, count(*) AS n_issues FROM [final_issues] GROUP BY severity
       UNION ALL SELECT 'rule', validation_rule, count(*) FROM [final_issues] GROUP BY validation_rule""",
)
def issue_counts(b: Books) -> DataFrame:
    return scoring.issue_counts(final_issues(b))


@query("layer_counts", "SELECT * FROM [layer_counts]")
def layer_counts(b: Books) -> DataFrame:
    return scoring.layer_counts(_tagged(b), final_issues(b))


@query(
    "quality_report",
    """SELECT (SELECT overall_score FROM [quality_score]) AS overall_score,
              (SELECT string_agg(dataset || '=' || n_raw || '/' || n_validated || '/' || n_quarantined, ';' ORDER BY dataset) FROM [layer_counts]) AS layers,
              (SELECT string_agg(severity || '=' || n, ';' ORDER BY severity) FROM (SELECT severity, count(*) AS n FROM [final_issues] GROUP BY severity)) AS by_severity,
              (SELECT string_agg(validation_rule || '=' || n, ';' ORDER BY validation_rule) FROM (SELECT validation_rule, count(*) AS n FROM [final_issues] GROUP BY validation_rule)) AS by_rule""",
)
def quality_report(b: Books) -> DataFrame:
    """The nested report row, its maps printed as text for comparison."""
    report = scoring.quality_report(final_issues(b), _tagged(b), RUN_AT)
    text = lambda c: F.expr(f"array_join(transform(array_sort(map_keys({c})), k -> concat(k, '=', {c}[k])), ';')")
    layers_text = F.expr(
        "array_join(transform(array_sort(map_keys(row_counts_raw)), k -> concat(k, '=', row_counts_raw[k], '/', "
        "row_counts_validated[k], '/', row_counts_quarantined[k])), ';')"
    )
    return report.select(
        "overall_score", layers_text.alias("layers"), text("issue_counts_by_severity").alias("by_severity"),
        text("issue_counts_by_rule").alias("by_rule"),
    )


_DETAIL_COLUMNS = "record_id, validation_rule, severity, reason, timestamp, entity_id, account_id, document_id, transaction_date, amount, source_system"
V["quarantine_detail"] = f"""
SELECT {_DETAIL_COLUMNS} FROM (SELECT * FROM [quarantine_ledger] WHERE dataset = 'transactions') l
LEFT JOIN (SELECT DISTINCT * FROM [raw_transactions]) r ON r.row_uid = l.record_id"""


def detail(b: Books) -> DataFrame:
    entries = scoring.quarantine_ledger(final_issues(b), RUN_AT).where(F.col("dataset") == TRANSACTIONS).drop("dataset")
    return scoring.quarantine_detail(entries, b.with_written_invoices()[RAW[TRANSACTIONS]])


@query("quarantine_detail", "SELECT * FROM [quarantine_detail]")
def quarantine_detail(b: Books) -> DataFrame:
    return detail(b).select(*_DETAIL_COLUMNS.split(", "))


_BROWSE = "record_id, validation_rule, severity, reason, entity_id, source_system, account_id, transaction_date, timestamp"


@query(
    "quarantine_browse",
    f"""SELECT {_BROWSE} FROM [quarantine_detail] WHERE severity = 'HIGH' AND entity_id IN ('ASIA', 'EUROPE')
        ORDER BY {", ".join(c + " NULLS FIRST" for c in _BROWSE.split(", "))} LIMIT 500""",
)
def quarantine_browse(b: Books) -> DataFrame:
    return scoring.browse_quarantine(detail(b), severities=["HIGH"], entities=["ASIA", "EUROPE"])


# Both over all three row-level tables. The two queries above are kept with their SQL.

_FIELDS = list(dict.fromkeys(c for d in ROW_LEVEL_DATASETS for c in completeness.EXPECTED_COLUMNS[d]))
V["quarantine_detail_all"] = " UNION ALL BY NAME ".join(
    f"SELECT l.*, {', '.join('r.' + c for c in completeness.EXPECTED_COLUMNS[d])} FROM [quarantine_ledger] l "
    f"LEFT JOIN (SELECT DISTINCT * FROM [{RAW[d]}]) r ON r.row_uid = l.record_id WHERE l.dataset = '{d}'"
    for d in ROW_LEVEL_DATASETS
)


def detail_all(b: Books) -> DataFrame:
    return scoring.quarantine_detail_of_tables(scoring.quarantine_ledger(final_issues(b), RUN_AT), b.with_written_invoices().raw_tables())


@query("quarantine_detail_all", "SELECT * FROM [quarantine_detail_all]")
def quarantine_detail_all(b: Books) -> DataFrame:
    return detail_all(b).select("dataset", "record_id", "validation_rule", "severity", "reason", "timestamp", *_FIELDS)


_BROWSE_ALL = ", ".join(scoring.BROWSE_COLUMNS)


@query(
    "quarantine_browse_all",
    f"""SELECT {_BROWSE_ALL} FROM [quarantine_detail_all] WHERE severity = 'HIGH' AND entity_id IN ('ASIA', 'EUROPE')
        ORDER BY {", ".join(c + " NULLS FIRST" for c in scoring.BROWSE_COLUMNS)} LIMIT 500""",
)
def quarantine_browse_all(b: Books) -> DataFrame:
    ledger = scoring.quarantine_ledger(final_issues(b), RUN_AT)
    return scoring.browse_ledger(ledger, b.with_written_invoices().raw_tables(), severities=["HIGH"], entities=["ASIA", "EUROPE"])


@query("top_rules", "SELECT validation_rule, count(*) AS n_issues FROM [final_issues] GROUP BY 1 ORDER BY 2 DESC, 1")
def top_rules(b: Books) -> DataFrame:
    return scoring.top_rules(final_issues(b))


@query(
    "validated_net_income",
    """SELECT entity_id, CAST(round(sum((CASE WHEN a.normal_balance = 'Debit' THEN debit - credit ELSE credit - debit END)
              * rate_to_eur * CASE WHEN a.account_category = 'Revenue' THEN 1 ELSE -1 END), 2) AS DOUBLE) AS pretax_income
       FROM (SELECT entity_id, account_id, currency, CAST(date_trunc('month', try_strptime(transaction_date, '%Y-%m-%d')) AS DATE) AS m,
                    TRY_CAST(debit AS DECIMAL(18,2)) AS debit, TRY_CAST(credit AS DECIMAL(18,2)) AS credit
             FROM [raw_transactions] WHERE row_uid NOT IN (SELECT row_uid FROM [flagged])
               AND document_type IS DISTINCT FROM 'Opening Balance') t
       JOIN [chart_of_accounts] a USING (account_id) LEFT JOIN [fx_rates] f ON f.currency = t.currency AND f.rate_date = t.m
       WHERE a.account_category IN ('Revenue', 'COGS', 'Operating Expense') GROUP BY entity_id""",
)
def validated_net_income(b: Books) -> DataFrame:
    """End to end: raw journal, checks, cascade, split, typed layer, income statement."""
    kept = scoring.validated_rows(_tagged(b)[TRANSACTIONS], final_issues(b))
    postings = ledger.enriched_postings(layers.typed(kept, TRANSACTIONS), b["chart_of_accounts"], b["fx_rates"])
    income = statements.income_statement(postings)
    return plain(income.groupBy("entity_id").agg(F.sum("pretax_income").alias("pretax_income")))
