"""Quarantine cascade, validated split, ledger, quality score and the counts reported with it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.config import (
    DIMENSION_WEIGHTS, QUARANTINE_SEVERITIES, SEVERITY_WEIGHTS, UNKNOWN_SEVERITY_WEIGHT,
)
from tallystone.operators.issues import digest_marks, is_marked
from tallystone.schema import ROW_LEVEL_DATASETS, TRANSACTIONS
from tallystone.session import materialize
from tallystone.sources.layers import DOCUMENT_TAG, layered
from tallystone.sources.raw import document_tag, union_all

CASCADE_REASON = (
    "a leg of the same document is quarantined; the document leaves as a whole, so that what stays still balances"
)
BROWSE_COLUMNS = (
    "record_id", "validation_rule", "severity", "reason", "entity_id", "source_system", "account_id",
    "transaction_date", "invoice_date", "timestamp",
)
BROWSE_LIMIT = 500


def quarantined_uids(issues: DataFrame) -> DataFrame:
    """Distinct records with at least one CRITICAL or HIGH issue."""
    return (
        issues.where(F.col("row_uid").isNotNull() & F.col("severity").isin(*QUARANTINE_SEVERITIES))
        .select("row_uid")
        .distinct()
    )


def cascade_issues(transactions: DataFrame, issues: DataFrame) -> DataFrame:
    """One synthetic CRITICAL issue for every leg that shares a document with a quarantined leg.

    A single pass: the new issues do not cascade further. Copies of one record yield one issue. Of a ledger stored by
    document only the flagged keys move: they name their documents' tags, and both joins go bucket by bucket."""
    flagged = quarantined_uids(issues.where(F.col("dataset") == TRANSACTIONS))
    if DOCUMENT_TAG in transactions.columns:
        return _cascade_rows(_siblings_by_tag(transactions, flagged))
    legs = transactions.select("row_uid", "document_id").where(F.col("document_id").isNotNull())
    documents = legs.join(flagged, "row_uid", "left_semi").select("document_id").distinct()
    siblings = (
        legs.join(documents, "document_id", "left_semi")
        .select("row_uid")
        .distinct()
        .join(flagged, "row_uid", "left_anti")
    )
    return _cascade_rows(siblings)


def _siblings_by_tag(transactions: DataFrame, flagged: DataFrame) -> DataFrame:
    tagged = flagged.select(document_tag(F.col("row_uid")).alias(DOCUMENT_TAG), "row_uid")
    legs = transactions.where(F.col("document_id").isNotNull()).select(DOCUMENT_TAG, "row_uid")
    near = legs.join(tagged.select(DOCUMENT_TAG).distinct(), DOCUMENT_TAG, "left_semi")
    return near.dropDuplicates([DOCUMENT_TAG, "row_uid"]).join(tagged, [DOCUMENT_TAG, "row_uid"], "left_anti").select("row_uid")


def _cascade_rows(siblings: DataFrame) -> DataFrame:
    return siblings.select(
        "row_uid",
        F.lit(TRANSACTIONS).alias("dataset"),
        F.lit("document_quarantine_cascade").alias("validation_rule"),
        F.lit("CRITICAL").alias("severity"),
        F.lit(CASCADE_REASON).alias("reason"),
        F.lit(None).cast("string").alias("field"),
        F.lit("reconciliation").alias("dimension"),
    )


def _flagged_tags(issues: DataFrame) -> DataFrame:
    """Marks of the tags of documents with a quarantined leg."""
    flagged = quarantined_uids(issues.where(F.col("dataset") == TRANSACTIONS))
    return digest_marks(flagged.select(F.xxhash64(document_tag(F.col("row_uid"))).alias("digest")), "flagged_documents")


def flagged_documents(transactions: DataFrame, issues: DataFrame) -> DataFrame:
    """The legs of documents with a quarantined leg, and few others, of a tagged ledger that is not stored by document. Only these legs
    get their lineage keys."""
    return transactions.where(is_marked([DOCUMENT_TAG], _flagged_tags(issues)))


def with_cascade(transactions: DataFrame, issues: DataFrame) -> DataFrame:
    return issues.unionByName(cascade_issues(transactions, issues))


def validated_rows(df: DataFrame, issues: DataFrame) -> DataFrame:
    """Records without a CRITICAL or HIGH issue. Of a tagged ledger, the legs of documents without a quarantined leg are told by the tag."""
    if DOCUMENT_TAG in df.columns:
        near = is_marked([DOCUMENT_TAG], _flagged_tags(issues))
        of_ledger = quarantined_uids(issues.where(F.col("dataset") == TRANSACTIONS))
        return df.where(~near).unionByName(df.where(near).join(of_ledger, "row_uid", "left_anti"))
    return df.join(quarantined_uids(issues), "row_uid", "left_anti")


def quarantined_rows(df: DataFrame, issues: DataFrame) -> DataFrame:
    return df.join(quarantined_uids(issues), "row_uid", "left_semi")


def flagged_by_dataset(issues: DataFrame) -> dict[str, DataFrame]:
    """The quarantined lineage keys of each row-level table."""
    return {n: quarantined_uids(issues.where(F.col("dataset") == n)) for n in ROW_LEVEL_DATASETS}


def split_layers(tables: dict[str, DataFrame], issues: DataFrame) -> DataFrame:
    """dataset, row_uid and layer of every record: one join per table, of two narrow columns."""
    flagged = flagged_by_dataset(issues)
    parts = []
    for n in ROW_LEVEL_DATASETS:
        keys = [c for c in ("row_uid", DOCUMENT_TAG) if c in tables[n].columns]
        parts.append(layered(tables[n].select(*keys), flagged[n]).select(F.lit(n).alias("dataset"), "row_uid", "layer"))
    return union_all(parts)


def quarantine_ledger(issues: DataFrame, run_timestamp: str) -> DataFrame:
    """One row per quarantined record and quarantining reason, stamped with the given run time."""
    kept = issues.where(F.col("row_uid").isNotNull() & F.col("severity").isin(*QUARANTINE_SEVERITIES))
    return kept.select(
        "dataset", F.col("row_uid").alias("record_id"), "validation_rule", "severity", "reason",
        F.lit(run_timestamp).alias("timestamp"),
    )


def severity_weight(severity: Column) -> Column:
    """Weight of an issue; a severity outside the list weighs as much as MEDIUM."""
    weight = None
    for name, value in SEVERITY_WEIGHTS.items():
        literal = F.expr(f"CAST({value} AS DECIMAL(4,2))")
        weight = F.when(severity == name, literal) if weight is None else weight.when(severity == name, literal)
    return weight.otherwise(F.expr(f"CAST({UNKNOWN_SEVERITY_WEIGHT} AS DECIMAL(4,2))"))


def quality_score(issues: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Overall score and one score per dimension, 0 to 100, in a single row.

    Every dimension is charged against the number of rows of all row-level tables."""
    charged = issues.withColumn("weight", severity_weight(F.col("severity")))
    penalties = charged.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("dimension") == d, F.col("weight"))).cast("double"), F.lit(0.0)).alias(d)
            for d in DIMENSION_WEIGHTS
        ]
    )
    # Both sides are one-row aggregates, so the counts come in as a scalar subquery.
    counts = union_all([tables[n].select(F.lit(1).alias("one")) for n in ROW_LEVEL_DATASETS])
    total = counts.agg(F.count("one")).scalar()
    scored = penalties.withColumn("total_rows", total).select(
        "total_rows",
        *[
            F.when(
                F.col("total_rows") > 0,
                F.round(100 * (1 - F.least(F.col(d) / F.col("total_rows"), F.lit(1.0))), 2),
            )
            .otherwise(F.lit(100.0))
            .alias(d)
            for d in DIMENSION_WEIGHTS
        ],
    )
    overall = sum((F.col(d) * w for d, w in DIMENSION_WEIGHTS.items()), F.lit(0.0))
    return scored.select(
        F.round(overall, 2).alias("overall_score"), *[F.col(d).alias(f"{d}_score") for d in DIMENSION_WEIGHTS],
        "total_rows",
    )


def issue_counts(issues: DataFrame) -> DataFrame:
    """Issues by severity and by rule in one pass: (grouping, name, n_issues)."""
    return (
        issues.groupingSets([[F.col("severity")], [F.col("validation_rule")]], "severity", "validation_rule")
        .agg(F.count(F.lit(1)).alias("n_issues"), F.grouping("severity").alias("is_rule"))
        .select(
            F.when(F.col("is_rule") == 1, "rule").otherwise("severity").alias("grouping"),
            F.when(F.col("is_rule") == 1, F.col("validation_rule")).otherwise(F.col("severity")).alias("name"),
            "n_issues",
        )
    )


def layer_counts(tables: dict[str, DataFrame], issues: DataFrame) -> DataFrame:
    """Rows per row-level table: raw, validated, quarantined. All rows are counted without their lineage keys; those of a tagged ledger are
    made only of documents with a quarantined leg."""
    raw, quarantined = [], []
    for n in ROW_LEVEL_DATASETS:
        raw.append(tables[n].select(F.lit(n).alias("dataset"), F.lit(0).alias("flagged")))
        near = flagged_documents(tables[n], issues) if DOCUMENT_TAG in tables[n].columns else tables[n]
        quarantined.append(near.select(F.lit(n).alias("dataset"), "row_uid"))
    flagged = union_all(quarantined).join(quarantined_uids(issues), "row_uid", "left_semi").select("dataset", F.lit(1).alias("flagged"))
    counts = union_all([*raw, flagged]).groupBy("dataset").agg(
        F.count_if(F.col("flagged") == 0).alias("n_raw"), F.count_if(F.col("flagged") == 1).alias("n_quarantined")
    )
    return counts.select("dataset", "n_raw", (F.col("n_raw") - F.col("n_quarantined")).alias("n_validated"), "n_quarantined")


def top_rules(issues: DataFrame) -> DataFrame:
    """Rules by number of issues, most frequent first."""
    counts = issues.groupBy("validation_rule").agg(F.count(F.lit(1)).alias("n_issues"))
    return counts.orderBy(F.desc("n_issues"), "validation_rule")


def quality_report(
    issues: DataFrame, tables: dict[str, DataFrame], generated_at: str, counts: dict[str, dict[str, int]] | None = None,
) -> DataFrame:
    """The run's report as one row of nested maps, ready for a JSON sink. counts: rows per layer, where the pass that wrote the
    layers has observed them already."""
    by = issue_counts(issues)

    def as_map(kind: str) -> Column:
        return (
            by.where(F.col("grouping") == kind)
            .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "n_issues")))))
            .scalar()
        )

    layers = None if counts else layer_counts(tables, issues)

    def layer_map(column: str) -> Column:
        if counts:
            return F.create_map(*[F.lit(x) for n in sorted(counts) for x in (n, counts[n][column])])
        entries = F.array_sort(F.collect_list(F.struct("dataset", column)))
        return layers.agg(F.map_from_entries(entries)).scalar()

    score = quality_score(issues, tables)
    return score.select(
        F.lit(generated_at).alias("generated_at"),
        layer_map("n_raw").alias("row_counts_raw"),
        layer_map("n_validated").alias("row_counts_validated"),
        layer_map("n_quarantined").alias("row_counts_quarantined"),
        as_map("severity").alias("issue_counts_by_severity"),
        as_map("rule").alias("issue_counts_by_rule"),
        "overall_score",
        F.create_map(
            *[part for d in DIMENSION_WEIGHTS for part in (F.lit(d), F.col(f"{d}_score"))]
        ).alias("dimension_scores"),
    )


def quarantine_detail(ledger: DataFrame, raw: DataFrame) -> DataFrame:
    """Ledger rows of one table with the raw record's own fields beside them.

    Only the raw records that the ledger names are shuffled, and copies, which share their key, reduced to one."""
    raw = raw.drop(DOCUMENT_TAG)
    named = ledger.select(F.col("record_id").alias("row_uid")).distinct()
    one_per_key = raw.join(named, "row_uid", "left_semi").dropDuplicates(["row_uid"])
    return ledger.join(one_per_key, F.col("record_id") == F.col("row_uid"), "left").drop("row_uid")


def quarantine_detail_of_tables(ledger: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Ledger rows of all row-level tables, each with its own table's fields; the fields of other tables are null."""
    parts = [quarantine_detail(ledger.where(F.col("dataset") == n), tables[n]) for n in ROW_LEVEL_DATASETS]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def browse_quarantine(
    detail: DataFrame, severities: list[str] | None = None, entities: list[str] | None = None,
    sources: list[str] | None = None, rules: list[str] | None = None, limit: int = BROWSE_LIMIT,
) -> DataFrame:
    """The quarantine browser: optional IN filters, the display columns the table has, the first rows."""
    filters = {
        "severity": severities, "entity_id": entities, "source_system": sources, "validation_rule": rules,
    }
    for column, wanted in filters.items():
        if wanted and column in detail.columns:
            detail = detail.where(F.col(column).isin(*wanted))
    shown = detail.select(*[c for c in BROWSE_COLUMNS if c in detail.columns])
    return shown.orderBy(*shown.columns).limit(limit)


def browse_ledger(
    ledger: DataFrame, tables: dict[str, DataFrame], severities: list[str] | None = None, entities: list[str] | None = None,
    sources: list[str] | None = None, rules: list[str] | None = None, limit: int = BROWSE_LIMIT,
) -> DataFrame:
    """The quarantine browser over the ledger of all row-level tables: the first rows that `browse_quarantine` would show of their
    detail, without making the detail.

    The ledger's own filters come first, its keys meet two columns of the records for the other filters, and the first `limit` rows
    are found on the ledger's columns: the shown columns of a record follow from its key. Only these rows fetch the rest."""
    for column, wanted in (("severity", severities), ("validation_rule", rules)):
        if wanted:
            ledger = ledger.where(F.col(column).isin(*wanted))
    matched = []
    for n in ROW_LEVEL_DATASETS:
        own = ledger.where(F.col("dataset") == n)
        filters = {c: w for c, w in (("entity_id", entities), ("source_system", sources)) if w}
        if filters:
            # A table without the column of a filter has no record that passes it.
            tests = [F.col(c).isin(*w) if c in tables[n].columns else F.lit(False) for c, w in filters.items()]
            keys = tables[n].where(reduce(lambda a, b: a & b, tests)).select(F.col("row_uid").alias("record_id")).distinct()
            own = own.join(keys, "record_id", "left_semi")
        matched.append(own)
    order = ("record_id", "validation_rule", "severity", "reason", "timestamp")
    first = materialize(union_all(matched).orderBy(*order).limit(limit), "browsed")
    shown = {n: tables[n].select("row_uid", *[c for c in BROWSE_COLUMNS if c in tables[n].columns]) for n in ROW_LEVEL_DATASETS}
    detail = quarantine_detail_of_tables(first, shown)
    detail = detail.select(*[c for c in BROWSE_COLUMNS if c in detail.columns])
    return detail.orderBy(*detail.columns)
