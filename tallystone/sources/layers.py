"""Validated and quarantine layers, statement outputs and JSON reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallystone.functions.parsing import to_date, to_money
from tallystone.schema import ROW_LEVEL_DATASETS, typed_field, typed_schema
from tallystone.sources.raw import document_tag, tag_of_leg

DOCUMENT_TAG = "document_tag"


def typed(df: DataFrame, dataset: str) -> DataFrame:
    """Cast a validated string table to its typed layout; values that do not parse become null."""
    return typed_columns(df, dataset, [])


def typed_columns(df: DataFrame, dataset: str, more: list) -> DataFrame:
    columns = []
    for f in typed_schema(dataset).fields:
        if f.name not in df.columns:
            continue
        col = F.col(f.name)
        kind = f.dataType.typeName()
        if kind == "date":
            col = to_date(col)
        elif kind == "decimal":
            col = to_money(col).cast(f.dataType)
        elif kind != "string":
            col = col.cast("string").try_cast(f.dataType)
        columns.append(col.alias(f.name))
    return df.select(*columns, *more)


def read_validated(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """Typed scan of a validated table: explicit schema, no inference."""
    return spark.read.schema(typed_schema(dataset)).parquet(f"{root}/{dataset}")


def with_document_tag(ledger: DataFrame) -> DataFrame:
    """The ledger with the tag of each leg's document, which its lineage key has too."""
    return ledger.withColumn(DOCUMENT_TAG, tag_of_leg())


def store_by_document(ledger: DataFrame, path: str, buckets: int) -> DataFrame:
    """Store a ledger bucketed by the tag of its documents, the only time that it is shuffled for them: balances per document, legs of a
    document and the cascade then read it bucket by bucket. Returns the stored table, with its column `document_tag`.

    The tag comes from the lineage key, so legs without document are spread over all buckets. A document is read by one task,
    as a stream of its legs."""
    name = f"ledger_{uuid.uuid4().hex}"
    # Dealt as the buckets are, so each bucket is one file.
    dealt = with_document_tag(ledger).repartition(buckets, DOCUMENT_TAG)
    dealt.write.bucketBy(buckets, DOCUMENT_TAG).sortBy(DOCUMENT_TAG).option("path", path).saveAsTable(name)
    return ledger.sparkSession.table(name)


def write_layers(tables: dict[str, DataFrame], flagged: dict[str, DataFrame], root: str) -> dict[str, dict[str, int]]:
    """Write the row-level tables, split into `layer=validated` and `layer=quarantined`, in one pass over each: typed columns, and
    for quarantined records the raw record as JSON beside them. Returns the counts that the same pass observed.

    flagged: the lineage keys of the quarantined records of each table, each once."""
    counts = {}
    for name in ROW_LEVEL_DATASETS:
        df = tables[name]
        seen = Observation(f"layers_{name}_{uuid.uuid4().hex}")
        split = layered(df, flagged[name])
        raw_record = F.when(F.col("layer") == "quarantined", F.to_json(F.struct(*[c for c in df.columns if c != DOCUMENT_TAG])))
        out = typed_columns(split, name, ["row_uid", raw_record.alias("raw_record"), "layer"]).observe(
            seen, F.count(F.lit(1)).alias("n_raw"), F.count_if(F.col("layer") == "validated").alias("n_validated"),
            F.count_if(F.col("layer") == "quarantined").alias("n_quarantined"),
        )
        out.write.mode("overwrite").partitionBy("layer").parquet(f"{root}/{name}")
        counts[name] = dict(seen.get)
    return counts


def layered(df: DataFrame, flagged: DataFrame) -> DataFrame:
    """The records with their layer. flagged: row_uid, each once. A ledger stored by document meets the keys by document too."""
    marks = flagged.select("row_uid", F.lit(True).alias("is_flagged"))
    keys = ["row_uid"]
    if DOCUMENT_TAG in df.columns:
        marks = marks.withColumn(DOCUMENT_TAG, document_tag(F.col("row_uid")))
        keys = [DOCUMENT_TAG, "row_uid"]
    layer = F.when(F.col("is_flagged").isNull(), "validated").otherwise("quarantined")
    return df.join(marks, keys, "left").withColumn("layer", layer).select(*df.columns, "layer")


def read_layer(spark: SparkSession, root: str, dataset: str, layer: str = "validated") -> DataFrame:
    """One layer of a table written by `write_layers`."""
    return spark.read.parquet(f"{root}/{dataset}").where(F.col("layer") == layer).drop("layer")


def write_validated(tables: dict[str, DataFrame], root: str) -> None:
    for name, df in tables.items():
        typed(df, name).write.mode("overwrite").parquet(f"{root}/{name}")


def write_quarantine(ledger: DataFrame, path: str) -> None:
    """One quarantine ledger, partitioned by dataset."""
    ledger.write.mode("overwrite").partitionBy("dataset").parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a result table; CSV output prints dates as yyyy-MM-dd."""
    if fmt == "csv":
        format_dates(df).write.mode("overwrite").option("header", True).csv(path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def format_dates(df: DataFrame) -> DataFrame:
    """Dates as yyyy-MM-dd text."""
    return df.select(
        *[
            F.date_format(f.name, "yyyy-MM-dd").alias(f.name) if f.dataType.typeName() == "date" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


__all__ = [
    "DOCUMENT_TAG", "format_dates", "layered", "read_layer", "read_validated", "store_by_document", "typed", "typed_columns", "typed_field",
    "with_document_tag", "write_layers", "write_quarantine", "write_report", "write_table", "write_validated",
]
