"""The quality engine: every rule over the raw tables, the cascade, the split and the layers on disk."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.config import QualitySettings
from tallystone.operators import completeness, consistency, reconciliation, scoring, uniqueness, validity
from tallystone.operators.issues import RowRule, evaluate_row_rules, rule_counts, union_issues, with_dimension
from tallystone.schema import ROW_LEVEL_DATASETS
from tallystone.sources import layers
from tallystone.sources.raw import union_all


def buckets(spark: SparkSession) -> int:
    """Buckets of a ledger stored by document: as many as shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def row_local_issues(tables: dict[str, DataFrame], settings: QualitySettings | None = None) -> DataFrame:
    """All completeness and validity rules that need only the record: one scan per table."""
    settings = settings or QualitySettings()
    return union_all([evaluate_row_rules(tables[n], n, row_rules(tables[n], n, settings)) for n in ROW_LEVEL_DATASETS])


def row_rules(df: DataFrame, name: str, settings: QualitySettings) -> list[RowRule]:
    return completeness.completeness_rules(df, name, settings) + validity.validity_row_rules(df, name, settings)


def row_local_counts(tables: dict[str, DataFrame], settings: QualitySettings | None = None) -> DataFrame:
    """Issues of the rules that need only the record, counted by table, rule and field without making them."""
    settings = settings or QualitySettings()
    return union_all([rule_counts(tables[n], n, row_rules(tables[n], n, settings)) for n in ROW_LEVEL_DATASETS])


def outlier_issues(tables: dict[str, DataFrame], settings: QualitySettings | None = None) -> DataFrame:
    values = [
        validity.outlier_values(tables[n], n, validity.AMOUNT[n], validity.OUTLIER_GROUP[n])
        for n in ROW_LEVEL_DATASETS
    ]
    return validity.outliers(union_all(values), settings or QualitySettings())


def duplicate_issues(tables: dict[str, DataFrame], settings: QualitySettings | None = None) -> DataFrame:
    settings = settings or QualitySettings()
    return union_all([uniqueness.uniqueness_issues(tables[n], n, settings) for n in ROW_LEVEL_DATASETS])


def run_all_checks(tables: dict[str, DataFrame], settings: QualitySettings | None = None) -> DataFrame:
    """The long issue table: every rule, with its quality dimension."""
    settings = settings or QualitySettings()
    return with_dimension(
        union_issues(
            [completeness.schema_issues(tables[n], n) for n in ROW_LEVEL_DATASETS]
            + [
                row_local_issues(tables, settings),
                duplicate_issues(tables, settings),
                outlier_issues(tables, settings),
                consistency.consistency_issues(tables, settings),
                reconciliation.reconciliation_issues(tables, settings),
            ]
        )
    )


def run_quality_engine(
    tables: dict[str, DataFrame], root: str, run_timestamp: str, settings: QualitySettings | None = None
) -> DataFrame:
    """Run the checks once and write every layer under `root` (a folder all executors share).

    The ledger is stored by document first, the issue table is written before it is used four times over: later reads survive a lost executor and do
    not repeat the rules. Returns the report row."""
    spark = next(iter(tables.values())).sparkSession
    ledger = layers.store_by_document(tables["transactions"], f"{root}/ledger/{uuid.uuid4().hex}", buckets(spark))
    tables = {**tables, "transactions": ledger}
    layers.write_table(run_all_checks(tables, settings), f"{root}/issues/checks")
    checks = spark.read.parquet(f"{root}/issues/checks")
    layers.write_table(scoring.cascade_issues(ledger, checks), f"{root}/issues/cascade")
    issues = checks.unionByName(spark.read.schema(checks.schema).parquet(f"{root}/issues/cascade"))

    layers.write_validated({n: df for n, df in tables.items() if n not in ROW_LEVEL_DATASETS}, f"{root}/validated")
    counts = layers.write_layers(tables, scoring.flagged_by_dataset(issues), f"{root}/layers")
    layers.write_quarantine(scoring.quarantine_ledger(issues, run_timestamp), f"{root}/quarantine")
    report = scoring.quality_report(issues, tables, run_timestamp, counts)
    layers.write_report(report, f"{root}/reports/quality")
    return report


def rule_catalog(issues: DataFrame) -> DataFrame:
    """Rules seen in an issue table with their dimension and severities."""
    return (
        with_dimension(issues.select("validation_rule", "severity"))
        .groupBy("validation_rule", "dimension", "severity")
        .agg(F.count(F.lit(1)).alias("n_issues"))
    )
