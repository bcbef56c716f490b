"""Table layouts: raw (all strings), expected columns, and typed validated targets."""

from __future__ import annotations

from pyspark.sql import types as T

TRANSACTIONS = "transactions"
RECEIVABLES = "accounts_receivable"
PAYABLES = "accounts_payable"
ROW_LEVEL_DATASETS = (TRANSACTIONS, RECEIVABLES, PAYABLES)

# The columns a raw table must carry.
EXPECTED_COLUMNS = {
    TRANSACTIONS: (
        "transaction_id", "transaction_date", "entity_id", "business_unit", "account_id", "account_name",
        "account_category", "document_type", "document_id", "counterparty_id", "currency", "amount", "debit",
        "credit", "payment_due_date", "payment_date", "source_system",
    ),
    RECEIVABLES: (
        "invoice_id", "customer_id", "entity_id", "invoice_date", "due_date", "payment_date", "currency",
        "invoice_amount", "payment_status", "business_unit", "customer_segment",
    ),
    PAYABLES: (
        "invoice_id", "vendor_id", "entity_id", "invoice_date", "due_date", "payment_date", "currency",
        "invoice_amount", "tax_amount", "net_amount", "payment_status", "business_unit", "expense_category",
    ),
    "entities": ("entity_id", "entity_name", "country", "functional_currency"),
    "chart_of_accounts": ("account_id", "account_name", "account_category", "normal_balance"),
    "vendors": ("vendor_id", "vendor_name", "entity_id", "currency", "payment_terms_days"),
    "customers": ("customer_id", "customer_name", "entity_id", "currency", "customer_segment"),
    "fx_rates": ("rate_date", "currency", "rate_to_eur"),
}

# Columns present in the files beyond the expected minimum.
EXTRA_COLUMNS = {
    "entities": ("annual_revenue_scale_eur",),
    "chart_of_accounts": ("account_subcategory", "expected_business_unit"),
    "vendors": ("default_expense_category",),
    "customers": ("payment_terms_days",),
}

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(10, 5)

_DATES = {
    "transaction_date", "payment_due_date", "payment_date", "invoice_date", "due_date", "rate_date",
}
_MONEY = {"amount", "debit", "credit", "invoice_amount", "tax_amount", "net_amount"}
_INTS = {"payment_terms_days"}


def raw_columns(dataset: str) -> tuple[str, ...]:
    if dataset not in EXPECTED_COLUMNS:
        raise ValueError(f"Unknown dataset '{dataset}'. Expected one of {sorted(EXPECTED_COLUMNS)}.")
    return EXPECTED_COLUMNS[dataset] + EXTRA_COLUMNS.get(dataset, ())


def typed_field(name: str) -> T.DataType:
    if name in _DATES:
        return T.DateType()
    if name in _MONEY:
        return MONEY
    if name in _INTS:
        return T.IntegerType()
    if name == "rate_to_eur":
        return RATE
    if name == "annual_revenue_scale_eur":
        return T.LongType()
    return T.StringType()


def typed_schema(dataset: str) -> T.StructType:
    return T.StructType([T.StructField(c, typed_field(c)) for c in raw_columns(dataset)])


ISSUE_SCHEMA = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in ("row_uid", "dataset", "validation_rule", "severity", "reason", "field", "dimension")
    ]
)
