"""Exact duplicates with a heavy-hitter split.

A pass over the texts writes a narrow table of digests. A Misra-Gries summary of it (Spark's `approx_top_k`, a frequent-items
sketch that decrements its counters in batches) names the digests that may hold more than one row in `counters`; the summaries
of single tasks are merged in two steps. The named digests are counted exactly. Those that are frequent indeed, at most
`counters` of them, are broadcast with the row that stays, and answer their rows without a shuffle. All other digests are
rarer than one row in `counters`, so an ordinary shuffle by digest meets no hot key.

Defined cases: a null text counts as the empty text; a null doc_id is smaller than any other; of rows that agree in text and
doc_id one stays; an empty table gives an empty result; further columns are carried along by `drop_duplicates_of_text` and may
have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystone.llm.common import packed, whole_text
from tallystone.session import materialize

COUNTERS = 1024


def _digests(docs: DataFrame, text: str, key: str) -> DataFrame:
    table = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(key).alias("key"),
        F.unhex(F.sha2(whole_text(text), 256)).alias("digest"),
    )
    return materialize(table, "digests")


def frequent_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Digest, keep (key and rid of the row that stays) and group_size of each digest that holds at least one row in
    `counters`, and more than one row. At most `counters` rows, whatever the input."""
    tracked = 8 * counters  # the sketch misses no item above 3.5 / tracked of the rows
    part = digests.groupBy(F.pmod(F.spark_partition_id(), F.lit(256)).alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(xxhash64(digest), {tracked}) AS sketch")
    )
    # Grouped by a constant: a task without rows then adds no summary, and an empty one cannot be merged.
    named = part.withColumn("all", F.lit(True)).groupBy("all").agg(F.expr(f"approx_top_k_combine(sketch, {tracked}) AS sketch")).select(
        F.explode(F.expr(f"approx_top_k_estimate(sketch, {4 * counters})")).alias("found")
    )
    named = named.select(F.col("found.item").alias("short"))
    total = digests.agg(F.count(F.lit(1)).alias("total"))
    counted = (
        digests.join(F.broadcast(named), F.xxhash64("digest") == F.col("short"))
        .groupBy("digest").agg(F.max(F.struct("key", "rid")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    )
    return (
        counted.crossJoin(F.broadcast(total))  # one row
        .where((F.col("group_size") > 1) & (F.col("group_size") * counters >= F.col("total")))
        .select("digest", "keep", "group_size")
    )


def duplicate_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = _digests(docs, text, key)
    winners = materialize(frequent_digests(digests, counters), "frequent")
    split = digests.join(F.broadcast(winners), "digest", "left")
    hot = split.where(F.col("keep").isNotNull())
    group = Window.partitionBy("digest")
    rest = (
        split.where(F.col("keep").isNull())
        .withColumn("keep", F.max(F.struct("key", "rid")).over(group))
        .withColumn("group_size", F.count(F.lit(1)).over(group))
    )
    return hot.unionByName(rest).select(
        F.col("key").alias("doc_id"), F.col("keep.key").alias("keep_id"), "group_size",
        (F.col("keep.rid") == F.col("rid")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_duplicates_of_text(docs: DataFrame, text: str = "text", key: str = "doc_id", counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, with all their columns. Rows of a frequent text other than the one that stays go before the
    shuffle."""
    digests = _digests(docs, text, key)
    winners = materialize(frequent_digests(digests, counters), "frequent")
    rows = packed(docs).select(
        "rec", F.col(f"rec.{key}").alias("key"), F.unhex(F.sha2(F.coalesce(F.col(f"rec.{text}").cast("string"), F.lit("")), 256)).alias("digest")
    )
    left = rows.join(F.broadcast(winners.select("digest", "keep")), "digest", "left").where(
        F.col("keep").isNull() | F.col("key").eqNullSafe(F.col("keep.key"))
    )
    first = F.row_number().over(Window.partitionBy("digest").orderBy(F.col("key").desc_nulls_last()))
    return left.withColumn("nth", first).where("nth = 1").select("rec.*")
