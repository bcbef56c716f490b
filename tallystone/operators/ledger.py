"""From journal legs to signed amounts in the reporting currency.

Statements need sums per account and month only, and the exchange rate depends on currency and month only. So
the ledger is first summed to a small monthly posting table (map-side combine, one narrow shuffle); the chart of
accounts and the rates join that table, not the legs. One posting table feeds every statement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.functions.parsing import month_of

OPENING_DOCUMENT = "Opening Balance"
OPENING_PREFIX = "OPEN_"


def join_chart(df: DataFrame, coa: DataFrame) -> DataFrame:
    """Add the authoritative category, subcategory and normal balance; unknown accounts stay with nulls. A repeated account
    id is an error, not a silent fan-out."""
    def single(column: str) -> Column:
        return F.when(F.count(F.lit(1)) == 1, F.max(column)).otherwise(
            F.raise_error(F.lit("duplicate account id in the chart of accounts")).cast("string")
        )

    lookup = coa.where(F.col("account_id").isNotNull()).groupBy("account_id").agg(
        single("account_category").alias("coa_category"),
        single("account_subcategory").alias("coa_subcategory"),
        single("normal_balance").alias("coa_normal_balance"),
    )
    return df.join(lookup, "account_id", "left")


def month_rates(fx_rates: DataFrame) -> DataFrame:
    """One rate per currency and month. A repeated key is an error, not a silent fan-out."""
    rate = F.when(F.count(F.lit(1)) == 1, F.max("rate_to_eur")).otherwise(
        F.raise_error(F.lit("duplicate exchange rate for a currency and month")).cast("decimal(10,5)")
    )
    return fx_rates.groupBy(
        F.col("currency"), month_of(F.col("rate_date").cast("date")).alias("period")
    ).agg(rate.alias("rate_to_eur"))


def join_rates(df: DataFrame, fx_rates: DataFrame, date: str = "transaction_date") -> DataFrame:
    """Add `rate_to_eur` of the record's currency in the month of its date; null where there is none."""
    rates = month_rates(fx_rates)
    keyed = df.withColumn("rate_period", month_of(F.col(date)))
    return keyed.join(
        rates.withColumnRenamed("period", "rate_period"), ["currency", "rate_period"], "left"
    ).drop("rate_period")


def convert_to_eur(df: DataFrame, fx_rates: DataFrame, columns: dict[str, str], date: str = "transaction_date") -> DataFrame:
    """Add EUR columns ({source: target}) at the month's rate; a missing rate gives null, which sums skip."""
    rated = join_rates(df, fx_rates, date)
    for source, target in columns.items():
        rated = rated.withColumn(target, F.col(source) * F.col("rate_to_eur"))
    return rated.drop("rate_to_eur")


def pl_bucket(category: Column, subcategory: Column) -> Column:
    """Income-statement line of an account, null for balance-sheet accounts."""
    operating = category == "Operating Expense"
    return (
        F.when(category == "Revenue", "Revenue")
        .when(category == "COGS", "COGS")
        .when(operating & (subcategory == "Depreciation Expense"), "Depreciation")
        .when(operating & (subcategory == "Interest Expense"), "Interest")
        .when(operating & (subcategory == "Tax Expense"), "Tax")
        .when(operating, "Operating Expense")
    )


def signed_amount(debit: Column, credit: Column, normal_balance: Column) -> Column:
    """Contribution to the account's balance, positive in its natural direction (no balance: credit side)."""
    return F.when(normal_balance == "Debit", debit - credit).otherwise(credit - debit)


def monthly_postings(transactions: DataFrame) -> DataFrame:
    """Debit and credit sums per entity, unit, account, document type, currency and month."""
    return (
        transactions.select(
            "entity_id", "business_unit", "account_id", "document_type", "currency",
            month_of(F.col("transaction_date")).alias("period"),
            F.coalesce(F.col("document_id").startswith(OPENING_PREFIX), F.lit(False)).alias("opening_document"),
            "debit", "credit",
        )
        .groupBy(
            "entity_id", "business_unit", "account_id", "document_type", "currency", "period", "opening_document"
        )
        .agg(F.sum("debit").alias("debit"), F.sum("credit").alias("credit"))
    )


def enrich(postings: DataFrame, coa: DataFrame, fx_rates: DataFrame) -> DataFrame:
    """Monthly postings with account attributes and EUR amounts, ready for the statements."""
    eur = convert_to_eur(
        join_chart(postings, coa), fx_rates, {"debit": "debit_eur", "credit": "credit_eur"}, "period"
    )
    return eur.withColumn(
        "contribution", signed_amount(F.col("debit_eur"), F.col("credit_eur"), F.col("coa_normal_balance"))
    )


def enriched_postings(transactions: DataFrame, coa: DataFrame, fx_rates: DataFrame) -> DataFrame:
    return enrich(monthly_postings(transactions), coa, fx_rates)
