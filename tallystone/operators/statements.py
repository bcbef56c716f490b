"""Income statement, balance sheet and cash flow per entity and month, from enriched monthly postings.

Everything here works on rows per entity and month: windows are partitioned by entity and hold one row per
month. Money stays decimal to the last step, so sums do not depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.functions.parsing import is_true
from tallystone.operators.ledger import OPENING_DOCUMENT, pl_bucket

# Default corporate tax rate.
DEFAULT_TAX_RATE = "0.25"
EUR = "decimal(28,7)"

# Statement sections by document type.
OPERATING_DOCUMENTS = ("Cash Receipt", "Vendor Payment", "Payroll", "Interest Payment")
INVESTING_DOCUMENTS = ("Capex",)
FINANCING_DOCUMENTS: tuple[str, ...] = ()

# The balance sheet line of each account subcategory, and the layouts of the statements.
BALANCE_ACCOUNTS = {
    "Cash": "cash",
    "Accounts Receivable": "accounts_receivable",
    "Inventory": "inventory",
    "Other Current Assets": "other_current_assets",
    "Fixed Assets": "fixed_assets_gross",
    "Accumulated Depreciation": "accumulated_depreciation",
    "Accounts Payable": "accounts_payable",
    "Debt": "debt",
    "Other Liabilities": "other_liabilities",
    "Common Stock": "common_stock",
    "Retained Earnings": "opening_equity_flow",
}
NON_NEGATIVE = ("cash", "accounts_receivable", "inventory", "other_current_assets", "fixed_assets_gross")

INCOME_COLUMNS = (
    "entity_id", "period", "revenue", "cogs", "gross_profit", "operating_expense", "ebitda", "depreciation",
    "ebit", "interest", "pretax_income", "taxes", "net_income",
)
BALANCE_COLUMNS = (
    "entity_id", "period", "cash", "accounts_receivable", "inventory", "other_current_assets",
    "total_current_assets", "fixed_assets_gross", "accumulated_depreciation", "fixed_assets_net", "total_assets",
    "accounts_payable", "debt", "other_liabilities", "income_tax_payable", "total_liabilities", "common_stock",
    "retained_earnings", "total_equity", "difference", "status", "economically_implausible",
)
CASH_FLOW_COLUMNS = (
    "entity_id", "period", "operating_cf", "investing_cf", "financing_cf", "net_change_in_cash",
    "beginning_cash", "ending_cash", "balance_sheet_cash", "reconciliation_diff", "status",
)


def _sum_where(condition: Column, value: str) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(value))).cast(EUR), F.lit(0).cast(EUR))


def _not_opening() -> Column:
    """A missing document type is not an opening document."""
    return ~is_true(F.col("document_type") == OPENING_DOCUMENT)


def tax_rate(rates: dict[str, str] | None) -> Column:
    """Tax rate per entity as decimal, the default for entities without one."""
    default = F.expr(f"CAST({DEFAULT_TAX_RATE} AS DECIMAL(5,4))")
    result = None
    for entity, rate in (rates or {}).items():
        literal = F.expr(f"CAST({rate} AS DECIMAL(5,4))")
        match = F.col("entity_id") == entity
        result = F.when(match, literal) if result is None else result.when(match, literal)
    return default if result is None else result.otherwise(default)


def income_statement(enriched: DataFrame, tax_rates: dict[str, str] | None = None) -> DataFrame:
    """Monthly income statement. Taxes are estimated on positive pre-tax income; journaled tax is left out."""
    bucket = pl_bucket(F.col("coa_category"), F.col("coa_subcategory"))
    pl = (
        enriched.where(_not_opening())
        .withColumn("bucket", bucket)
        .where(F.col("bucket").isNotNull() & F.col("entity_id").isNotNull() & F.col("period").isNotNull())
    )
    lines = {
        "revenue": "Revenue", "cogs": "COGS", "operating_expense": "Operating Expense",
        "depreciation": "Depreciation", "interest": "Interest",
    }
    monthly = pl.groupBy("entity_id", "period").agg(
        *[_sum_where(F.col("bucket") == b, "contribution").alias(name) for name, b in lines.items()]
    )
    zero = F.lit(0).cast(EUR)
    return (
        monthly.withColumn("gross_profit", (F.col("revenue") - F.col("cogs")).cast(EUR))
        .withColumn("ebitda", (F.col("gross_profit") - F.col("operating_expense")).cast(EUR))
        .withColumn("ebit", (F.col("ebitda") - F.col("depreciation")).cast(EUR))
        .withColumn("pretax_income", (F.col("ebit") - F.col("interest")).cast(EUR))
        .withColumn("taxes", (F.greatest(F.col("pretax_income"), zero) * tax_rate(tax_rates)).cast(EUR))
        .withColumn("net_income", (F.col("pretax_income") - F.col("taxes")).cast(EUR))
        .select(*INCOME_COLUMNS)
    )


def net_income_by_entity(statement: DataFrame) -> DataFrame:
    return statement.groupBy("entity_id").agg(F.sum("net_income").alias("net_income"))


def account_flows(enriched: DataFrame) -> DataFrame:
    """Monthly flow per balance-sheet account group, opening documents included."""
    kept = enriched.where(
        F.col("coa_category").isin("Asset", "Liability", "Equity")
        & F.col("entity_id").isNotNull()
        & F.col("period").isNotNull()
    )
    return kept.groupBy("entity_id", "period").agg(
        *[
            _sum_where(F.col("coa_subcategory") == sub, "contribution").alias(name)
            for sub, name in BALANCE_ACCOUNTS.items()
        ]
    )


def dense_grid(flows: DataFrame, statement: DataFrame) -> DataFrame:
    """Flows on every (entity, income-statement month); absent cells are 0, other months are dropped.

    The month list is one short array, attached to each entity as a scalar subquery and exploded."""
    months = statement.agg(F.array_sort(F.collect_set("period"))).scalar()
    grid = flows.select("entity_id").distinct().select("entity_id", F.explode(months).alias("period"))
    values = [c for c in flows.columns if c not in ("entity_id", "period")]
    return grid.join(flows, ["entity_id", "period"], "left").select(
        "entity_id", "period", *[F.coalesce(F.col(c), F.lit(0).cast(EUR)).alias(c) for c in values]
    )


def _so_far() -> Window:
    return Window.partitionBy("entity_id").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)


def running_balances(grid: DataFrame) -> DataFrame:
    """Cumulative balance per entity and account."""
    values = [c for c in grid.columns if c not in ("entity_id", "period")]
    return grid.select(
        "entity_id", "period", *[F.sum(c).over(_so_far()).cast(EUR).alias(c) for c in values]
    )


def balance_sheet(enriched: DataFrame, statement: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Monthly balance sheet. Retained earnings are the opening balance plus cumulative net income; estimated
    tax that is not paid is a liability."""
    balances = running_balances(dense_grid(account_flows(enriched), statement))
    earned = statement.select(
        "entity_id", "period",
        F.sum("net_income").over(_so_far()).alias("cumulative_net_income"),
        F.sum("taxes").over(_so_far()).alias("income_tax_payable"),
    )
    zero = F.lit(0).cast(EUR)
    opening = F.first("opening_equity_flow").over(_so_far())
    joined = (
        balances.join(earned, ["entity_id", "period"], "left")
        .withColumn("cumulative_net_income", F.coalesce(F.col("cumulative_net_income"), zero))
        .withColumn("income_tax_payable", F.coalesce(F.col("income_tax_payable"), zero).cast(EUR))
        .withColumn("retained_earnings", (opening + F.col("cumulative_net_income")).cast(EUR))
    )

    def total(*names: str) -> Column:
        return sum((F.col(n) for n in names[1:]), F.col(names[0])).cast(EUR)

    implausible = F.lit(False)
    for name in NON_NEGATIVE:
        implausible = implausible | (F.col(name) < 0)
    return (
        joined.withColumn(
            "total_current_assets", total("cash", "accounts_receivable", "inventory", "other_current_assets")
        )
        .withColumn("fixed_assets_net", (F.col("fixed_assets_gross") - F.col("accumulated_depreciation")).cast(EUR))
        .withColumn("total_assets", total("total_current_assets", "fixed_assets_net"))
        .withColumn(
            "total_liabilities", total("accounts_payable", "debt", "other_liabilities", "income_tax_payable")
        )
        .withColumn("total_equity", total("common_stock", "retained_earnings"))
        .withColumn(
            "difference",
            (F.col("total_assets") - (F.col("total_liabilities") + F.col("total_equity"))).cast(EUR),
        )
        .withColumn("status", F.when(F.abs("difference") <= F.expr(f"{tolerance}BD"), "PASS").otherwise("FAIL"))
        .withColumn("economically_implausible", implausible)
        .select(*BALANCE_COLUMNS)
    )


def opening_cash(enriched: DataFrame) -> DataFrame:
    """Cash debits of the opening documents per entity."""
    kept = enriched.where(F.col("opening_document") & (F.col("coa_subcategory") == "Cash"))
    return kept.groupBy("entity_id").agg(F.sum("debit_eur").cast(EUR).alias("opening_cash"))


def cash_section(document_type: Column) -> Column:
    section = F.when(document_type.isin(*OPERATING_DOCUMENTS), "operating_cf").when(
        document_type.isin(*INVESTING_DOCUMENTS), "investing_cf"
    )
    if FINANCING_DOCUMENTS:
        section = section.when(document_type.isin(*FINANCING_DOCUMENTS), "financing_cf")
    return section.otherwise("other_cf")


def cash_flow_sections(enriched: DataFrame) -> DataFrame:
    """Monthly cash movement per section; `other_cf` holds unknown document types."""
    kept = enriched.where(
        (F.col("coa_subcategory") == "Cash")
        & _not_opening()
        & F.col("entity_id").isNotNull()
        & F.col("period").isNotNull()
    ).select(
        "entity_id", "period", cash_section(F.col("document_type")).alias("section"),
        (F.col("debit_eur") - F.col("credit_eur")).alias("flow"),
    )
    names = ("operating_cf", "investing_cf", "financing_cf", "other_cf")
    return kept.groupBy("entity_id", "period").agg(
        *[_sum_where(F.col("section") == n, "flow").alias(n) for n in names]
    )


def cash_flow(enriched: DataFrame, sheet: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Direct cash-flow statement reconciled to the balance sheet's cash.

    The beginning cash is the last known balance-sheet cash of an earlier cash-flow month, else the opening
    cash. `other_cf` stays out of the net change, so an unknown document type shows as a difference."""
    flows = cash_flow_sections(enriched)
    cash = sheet.select("entity_id", "period", F.col("cash").alias("balance_sheet_cash"))
    earlier = (
        Window.partitionBy("entity_id").orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    )
    zero = F.lit(0).cast(EUR)
    known = F.last("balance_sheet_cash", ignorenulls=True).over(earlier)
    return (
        flows.join(cash, ["entity_id", "period"], "left")
        .join(opening_cash(enriched), "entity_id", "left")
        .withColumn(
            "net_change_in_cash",
            (F.col("operating_cf") + F.col("investing_cf") + F.col("financing_cf")).cast(EUR),
        )
        .withColumn("beginning_cash", F.coalesce(known, F.col("opening_cash"), zero))
        .withColumn("ending_cash", (F.col("beginning_cash") + F.col("net_change_in_cash")).cast(EUR))
        .withColumn("reconciliation_diff", F.abs(F.col("ending_cash") - F.col("balance_sheet_cash")).cast(EUR))
        .withColumn(
            "status",
            F.when(F.col("reconciliation_diff") <= F.expr(f"{tolerance}BD"), "PASS").otherwise("FAIL"),
        )
        .select(*CASH_FLOW_COLUMNS)
    )


def reconciliation_summary(sheet: DataFrame, flow: DataFrame) -> DataFrame:
    """Months that fail or look implausible per statement, with the entities affected."""

    def summarise(df: DataFrame, name: str, implausible: Column) -> DataFrame:
        return df.agg(
            F.lit(name).alias("statement"),
            F.count(F.lit(1)).alias("n_months"),
            F.count_if(F.col("status") == "FAIL").alias("n_fail"),
            F.count_if(implausible).alias("n_implausible"),
            F.array_join(
                F.array_sort(F.collect_set(F.when(implausible | (F.col("status") == "FAIL"), F.col("entity_id")))),
                ",",
            ).alias("entities_affected"),
        )

    return summarise(sheet, "balance_sheet", F.col("economically_implausible")).unionByName(
        summarise(flow, "cash_flow", F.lit(False))
    )
