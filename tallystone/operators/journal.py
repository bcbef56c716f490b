"""Posting business events as balanced journal legs, and the schedules that feed them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.functions.parsing import is_true
from tallystone.schema import EXPECTED_COLUMNS, MONEY, TRANSACTIONS

WRITE_OFF_DAYS = 120
DEPRECIATION_MONTHLY_RATE = "0.015BD"

# Opening balances as a share of an entity's annual revenue scale, with their side.
OPENING_SHARES = (
    ("Cash", "debit", "0.11"),
    ("Accounts Receivable", "debit", "0.15"),
    ("Inventory", "debit", "0.07"),
    ("Other Current Assets", "debit", "0.03"),
    ("Fixed Assets - Equipment", "debit", "0.45"),
    ("Accumulated Depreciation", "credit", "0.09"),
    ("Accounts Payable", "credit", "0.10"),
    ("Accrued Liabilities", "credit", "0.03"),
    ("Short-term Debt", "credit", "0.05"),
    ("Long-term Debt", "credit", "0.16"),
    ("Other Liabilities", "credit", "0.02"),
)
COMMON_STOCK_SHARE = "0.25"


def _round_money(col: Column) -> Column:
    return F.round(col, 2).cast(MONEY)


def post_journal(events: DataFrame, coa: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Every event with a positive amount becomes a debit leg and a credit leg of one document.

    Events carry debit_account and credit_account ids; names and categories come from the chart of accounts. keep: further columns of
    the events to keep; `leg_no` among them keeps the number of the leg."""
    keep = keep or []
    zero = F.lit(0).cast(MONEY)
    amount = _round_money(F.col("amount"))

    first = F.col("leg_no") == 1
    posted = (
        events.where(F.col("amount") > 0)
        .withColumn("amount", amount)
        # Only the number of the leg is exploded, so columns that nobody reads are not made.
        .withColumn("leg_no", F.explode(F.array(F.lit(1), F.lit(2))))
        .select(
            *[c for c in keep if c != "leg_no"], "document_id", "document_type", "transaction_date", "entity_id", "business_unit", "currency",
            "counterparty_id", "payment_due_date", "payment_date", "source_system", "amount", "leg_no",
            F.when(first, F.col("debit_account")).otherwise(F.col("credit_account")).alias("account_id"),
            F.when(first, F.col("amount")).otherwise(zero).alias("debit"),
            F.when(first, zero).otherwise(F.col("amount")).alias("credit"),
        )
    )
    return _name_accounts(posted, coa, keep)


def _name_accounts(legs: DataFrame, coa: DataFrame, keep: list[str]) -> DataFrame:
    names = coa.select("account_id", "account_name", "account_category")
    txn_id = F.concat(F.lit("TXN_"), "document_id", F.lit("_"), F.col("leg_no").cast("string"))
    return legs.join(names, "account_id").select(
        *keep, *[txn_id.alias(c) if c == "transaction_id" else F.col(c) for c in EXPECTED_COLUMNS[TRANSACTIONS]]
    )


def penny_plug(legs: DataFrame) -> DataFrame:
    """Round each leg of (document_id, leg_no, side, amount) to cents so that every document still balances.

    A negative amount moves to the other side. What rounding leaves over goes to the document's last leg. The
    per-document residual is one partial aggregation; it meets its single last leg by (document, leg), so a
    document with very many legs does not end up in one task. Legs of 0 or less are dropped."""
    flipped = F.when(F.col("side") == "debit", "credit").otherwise("debit")
    rounded = legs.withColumn("side", F.when(F.col("amount") < 0, flipped).otherwise(F.col("side"))).withColumn(
        "amount", _round_money(F.abs(F.col("amount")))
    )
    signed = F.when(F.col("side") == "debit", F.col("amount")).otherwise(-F.col("amount"))
    residuals = rounded.groupBy("document_id").agg(
        F.sum(signed).alias("residual"), F.max("leg_no").alias("leg_no")
    )
    balanced = rounded.join(residuals, ["document_id", "leg_no"], "left")
    plug = F.coalesce(F.col("residual"), F.lit(0).cast(MONEY))
    adjusted = F.when(F.col("side") == "credit", F.col("amount") + plug).otherwise(F.col("amount") - plug)
    return (
        balanced.withColumn("amount", adjusted.cast(MONEY)).drop("residual").where(F.col("amount") > 0)
    )


def post_multi_leg(legs: DataFrame, coa: DataFrame) -> DataFrame:
    """Post documents of any number of legs (account_name, side, amount) with exact balance."""
    zero = F.lit(0).cast(MONEY)
    posted = (
        penny_plug(legs)
        .withColumn("debit", F.when(F.col("side") == "debit", F.col("amount")).otherwise(zero))
        .withColumn("credit", F.when(F.col("side") == "credit", F.col("amount")).otherwise(zero))
    )
    ids = coa.select("account_name", "account_id")
    return _name_accounts(posted.join(ids, "account_name").drop("account_name"), coa, [])


def opening_equity(entities: DataFrame) -> DataFrame:
    """Opening assets, liabilities and stock per entity, with retained earnings as what balances them."""
    scale = F.col("annual_revenue_scale_eur").cast("decimal(18,2)")

    def total(names: set[str], negative: set[str] = frozenset()) -> Column:
        parts = [
            scale * F.expr(f"{'-' if name in negative else ''}{share}BD")
            for name, _, share in OPENING_SHARES
            if name in names
        ]
        return sum(parts[1:], parts[0])

    contra = {"Accumulated Depreciation"}
    assets = {name for name, side, _ in OPENING_SHARES if side == "debit"} | contra
    liabilities = {name for name, side, _ in OPENING_SHARES if side == "credit"} - contra
    balanced = entities.select(
        "entity_id", "functional_currency",
        total(assets, contra).alias("total_assets"), total(liabilities).alias("total_liabilities"),
        (scale * F.expr(f"{COMMON_STOCK_SHARE}BD")).alias("common_stock"),
    )
    return balanced.withColumn(
        "retained_earnings", F.col("total_assets") - F.col("total_liabilities") - F.col("common_stock")
    )


def opening_balances(entities: DataFrame, opening_date: str) -> DataFrame:
    """The opening document of every entity as unrounded legs, retained earnings last."""
    scale = F.col("annual_revenue_scale_eur").cast("decimal(18,2)")
    shares = (*OPENING_SHARES, ("Common Stock", "credit", COMMON_STOCK_SHARE))
    equity = opening_equity(entities).select("entity_id", "retained_earnings")

    def part(number: int, name: str, side: str, amount: Column) -> Column:
        return F.struct(
            F.lit(number).alias("leg_no"), F.lit(name).alias("account_name"), F.lit(side).alias("side"),
            amount.cast("decimal(28,6)").alias("amount"),
        )

    parts = [part(i, name, side, scale * F.expr(f"{share}BD")) for i, (name, side, share) in enumerate(shares, 1)]
    parts.append(part(len(shares) + 1, "Retained Earnings", "credit", F.col("retained_earnings")))
    none = F.lit(None)
    return (
        entities.join(equity, "entity_id")
        .select("entity_id", F.col("functional_currency").alias("currency"), F.explode(F.array(*parts)).alias("p"))
        .select(
            "entity_id", "currency", "p.*",
            F.concat(F.lit("OPEN_"), "entity_id").alias("document_id"),
            F.lit("Opening Balance").alias("document_type"),
            F.lit(opening_date).cast("date").alias("transaction_date"),
            F.lit("Corporate").alias("business_unit"),
            none.cast("string").alias("counterparty_id"),
            none.cast("date").alias("payment_due_date"),
            none.cast("date").alias("payment_date"),
            F.lit("ERP").alias("source_system"),
        )
    )


def invoice_status(invoices: DataFrame, as_of: str, paid_flag: str, write_off: bool = True) -> DataFrame:
    """Payment date and status of an invoice as of a day, from due_date and expected_payment.

    Paid when payable and its payment falls on or before the day; else written off 120 days past due
    (receivables only), overdue past due, open otherwise."""
    day = F.lit(as_of).cast("date")
    paid = is_true(F.col(paid_flag) & (F.col("expected_payment") <= day))
    status = F.when(paid, "Paid")
    if write_off:
        status = status.when(F.date_add("due_date", WRITE_OFF_DAYS) <= day, "Written Off")
    status = status.when(F.col("due_date") < day, "Overdue").otherwise("Open")
    return invoices.withColumn("payment_date", F.when(paid, F.col("expected_payment"))).withColumn(
        "payment_status", status
    )


def invoice_tax(invoices: DataFrame) -> DataFrame:
    """Tax and gross of a net invoice: tax is rounded to cents, gross is net plus tax."""
    tax = _round_money(F.col("net_amount") * F.col("tax_rate"))
    return invoices.withColumn("tax_amount", tax).withColumn(
        "invoice_amount", (F.col("net_amount") + F.col("tax_amount")).cast(MONEY)
    )


def depreciation_schedule(plan: DataFrame) -> DataFrame:
    """Monthly depreciation of running gross fixed assets: opening gross plus capex so far, this month's included."""
    so_far = Window.partitionBy("entity_id").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    gross = F.col("opening_gross") + F.sum("capex").over(so_far)
    return plan.withColumn("gross_assets", gross).withColumn(
        "depreciation", F.col("gross_assets") * F.expr(DEPRECIATION_MONTHLY_RATE)
    )
