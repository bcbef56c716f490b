"""Referential integrity against master data and drift of denormalised attributes.

Master tables join by key without a broadcast hint: Spark broadcasts them when their size is under its
threshold and shuffles them when they have outgrown it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.config import QualitySettings
from tallystone.operators.issues import RowRule, evaluate_row_rules, union_issues
from tallystone.schema import PAYABLES, RECEIVABLES, TRANSACTIONS
from tallystone.session import materialize

DRIFT_REASON = "account_category differs from the chart of accounts"


def references(
    df: DataFrame, dataset: str, masters: dict[str, tuple[DataFrame, str]], drift_severity: str
) -> DataFrame:
    """All references of a table in one scan. masters: key column -> (written table of known keys, severity). Against the
    chart of accounts, the category of the record is compared as well.

    A record whose keys are all known, with the category of its account, is left out before its lineage key is made, which costs
    far more than the look at the masters."""
    used = {c: m for c, m in masters.items() if c in df.columns}
    drift = "account_id" in used and "account_category" in df.columns
    # Names of their own: a subquery would take a name that its table has from there.
    probe = df.select("*", *[F.col(c).alias(f"of_{c}") for c in [*used, *(["account_category"] if drift else [])]])
    failing = [
        F.col(c).isNotNull() & ~known.where(F.col(c) == F.col(f"of_{c}").outer()).exists() for c, (known, _) in used.items()
    ]
    if drift:
        pairs = used["account_id"][0].select("account_id", F.explode("true_categories").alias("true_category"))
        of_account = F.col("account_id") == F.col("of_account_id").outer()
        failing.append(pairs.where(of_account & (F.col("true_category") != F.col("of_account_category").outer())).exists())
    if failing:
        df = probe.where(reduce(lambda a, b: a | b, failing)).select(*df.columns)
    joined = df.select("row_uid", *used, *(["account_category"] if drift else []))
    rules = []
    for column, (known, severity) in used.items():
        joined = joined.join(known, column, "left")
        unknown = F.col(column).isNotNull() & F.col(f"known_{column}").isNull()
        rules.append(RowRule(f"invalid_{column}", severity, f"no master record with this {column}", unknown, column))
    if drift:
        differs = F.exists("true_categories", lambda c: c != F.col("account_category"))
        rules.append(RowRule("inconsistent_classification", drift_severity, DRIFT_REASON, differs, "account_category"))
    return evaluate_row_rules(joined, dataset, rules)


def _known_keys(master: DataFrame, column: str) -> DataFrame:
    """Written, so that Spark knows the size and broadcasts the keys if they are few; otherwise a skewed key can be split."""
    keys = master.select(column).dropna().distinct().withColumn(f"known_{column}", F.lit(True))
    return materialize(keys, f"known_{column}")


def known_accounts(coa: DataFrame) -> DataFrame:
    """Known accounts with their categories, written."""
    accounts = coa.where(F.col("account_id").isNotNull()).groupBy("account_id").agg(
        F.lit(True).alias("known_account_id"), F.collect_set("account_category").alias("true_categories")
    )
    return materialize(accounts, "known_account_id")


def consistency_issues(tables: dict[str, DataFrame], settings: QualitySettings) -> DataFrame:
    """One scan per fact table: all its masters are joined and all its rules evaluated together."""
    s = settings.severities
    accounts = known_accounts(tables["chart_of_accounts"])
    entities = (_known_keys(tables["entities"], "entity_id"), s["invalid_entity"])
    frames = []
    for dataset, masters in (
        (TRANSACTIONS, {"account_id": (accounts, s["invalid_account"]), "entity_id": entities}),
        (RECEIVABLES, {"entity_id": entities, "customer_id": (_known_keys(tables["customers"], "customer_id"), s["invalid_account"])}),
        (PAYABLES, {"entity_id": entities, "vendor_id": (_known_keys(tables["vendors"], "vendor_id"), s["invalid_account"])}),
    ):
        frames.append(references(tables[dataset], dataset, masters, s["inconsistent_classification"]))
    return union_issues(frames)
