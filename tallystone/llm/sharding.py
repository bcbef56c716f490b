"""Shards by extendible hashing: a directory indexed by hash-prefix bits, in which only oversized buckets split.

A row's 60 hash bits are 40 bits of its key's hash, then 20 bits of its row number's. Rows of one key so share
their first bits, and a key whose rows together exceed the limit is still split, by the bits that follow.

Bytes are summed by prefix once, at a depth a little beyond the expected one, with partial aggregation; coarser sums are sums of
these. A prefix is a shard if it fits the limit and its parent does not. Prefixes that are too large even at that depth
are summed again, six bits deeper, over their own rows only, until none is left. The directory never leaves Spark.

Defined cases: a null text has 0 bytes; a null key hashes as the empty key; repeated rows stay rows of their own; a single
row over the limit cannot be split and ends alone among rows that share its 60 bits, marked by `oversized`; an empty table
gives an empty result; further columns are carried along by `write_shards`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.llm.common import packed, whole_text
from tallystone.session import materialize

LIMIT = 16 << 20
KEY_BITS, BITS = 40, 60
SCHEMA = "depth int, prefix long, bytes long"


def _hash_bits(key: Column, row: Column) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    head = F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")
    tail = F.conv(F.substring(F.md5(row.cast("string")), 1, (BITS - KEY_BITS) // 4), 16, 10).cast("long")
    return F.shiftleft(head, BITS - KEY_BITS) + tail


def _shift(column: Column, by: Column) -> Column:
    return F.call_function("shiftright", column, by.cast("int"))


def _sums(rows: DataFrame, start: int, depth: int) -> DataFrame:
    """Bytes by prefix at all depths from start to depth."""
    fine = rows.groupBy(F.shiftright("bits", BITS - depth).alias("prefix")).agg(F.sum("n_bytes").alias("bytes"))
    up = fine.select("bytes", "prefix", F.explode(F.sequence(F.lit(start), F.lit(depth))).alias("depth"))
    up = up.withColumn("prefix", _shift(F.col("prefix"), F.lit(depth) - F.col("depth")))
    return up.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"))


def directory(rows: DataFrame, limit: int = LIMIT, step: int = 6) -> DataFrame:
    """depth, prefix and bytes of each shard. rows: bits, n_bytes."""
    spark = rows.sparkSession
    total = rows.agg(F.sum("n_bytes")).first()[0]
    start, depth = 0, min(BITS, max(1, math.ceil(math.log2(max(1, (total or 0) / limit))) + 3))
    shards, open_rows = spark.createDataFrame([], SCHEMA), rows
    while True:
        sums = materialize(_sums(open_rows, start, depth), "sums")
        parents = sums.where(F.col("bytes") > limit).select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")
        )
        fits = sums.where((F.col("bytes") <= limit) | (F.col("depth") == BITS))
        inner = fits.withColumn("parent", F.shiftright("prefix", 1)).join(parents, ["depth", "parent"], "left_semi")
        found = inner.unionByName(fits.where(F.col("depth") == 0).withColumn("parent", F.lit(None).cast("long")))
        shards = shards.unionByName(found.select("depth", "prefix", "bytes"))
        large = sums.where((F.col("bytes") > limit) & (F.col("depth") == depth)).select("prefix")
        if depth == BITS or large.isEmpty():
            return shards
        open_rows = materialize(
            open_rows.withColumn("prefix", F.shiftright("bits", BITS - depth)).join(large, "prefix", "left_semi")
            .select("bits", "n_bytes"), "open",
        )
        start, depth = depth, min(BITS, depth + step)


def assign_shards(rows: DataFrame, limit: int = LIMIT, step: int = 6) -> DataFrame:
    """rows: bits, n_bytes and more. Adds shard (the prefix as bits), depth, shard_bytes and oversized."""
    shards = materialize(directory(rows.select("bits", "n_bytes"), limit, step), "directory")
    depths = [r[0] for r in shards.select("depth").distinct().collect()]  # at most 61
    # A directory of the largest depth has an entry for each prefix; here a row finds its entry by trying its own
    # prefixes at the depths in use.
    tries = F.array(*[
        F.struct(F.lit(d).alias("depth"), F.shiftright("bits", BITS - d).alias("prefix")) for d in sorted(depths)
    ]) if depths else F.array().cast("array<struct<depth:int,prefix:bigint>>")
    tried = rows.select("*", F.explode(tries).alias("at")).select("*", "at.*").drop("at")
    out = tried.join(shards.withColumnRenamed("bytes", "shard_bytes"), ["depth", "prefix"])
    name = F.when(F.col("depth") == 0, F.lit("")).otherwise(
        F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0"))
    )
    return out.withColumn("shard", name).withColumn("oversized", F.col("shard_bytes") > limit).drop("prefix", "bits")


def shard_documents(docs: DataFrame, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, shard, depth, shard_bytes, oversized."""
    rows = materialize(
        docs.select(
            F.col(key).alias("doc_id"), _hash_bits(F.col(key), F.monotonically_increasing_id()).alias("bits"),
            F.octet_length(whole_text(text)).cast("long").alias("n_bytes"),
        ), "rows",
    )
    return assign_shards(rows, limit).select("doc_id", "n_bytes", "shard", "depth", "shard_bytes", "oversized")


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> None:
    """Write the documents with all their columns, a folder `shard=shard_<bits>` for each shard (`shard_=` if a column has
    that name). A shard is one task's work, and bounded by the limit."""
    folder = "shard"
    while folder in docs.columns:
        folder += "_"
    rows = packed(docs).select(
        "rec", _hash_bits(F.col(f"rec.{key}"), F.monotonically_increasing_id()).alias("bits"),
        F.octet_length(F.coalesce(F.col(f"rec.{text}").cast("string"), F.lit(""))).cast("long").alias("n_bytes"),
    )
    rows = materialize(rows, "rows")  # row numbers stay as they are when tasks run again
    out = assign_shards(rows, limit).select("rec.*", F.concat(F.lit("shard_"), F.col("shard")).alias(folder))
    out.repartition(folder).write.partitionBy(folder).parquet(path)
