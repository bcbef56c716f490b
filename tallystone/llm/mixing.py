"""Mixing sources to target weights.

Sizes are summed per source by partial aggregation, so a hot source is no hot task; every later step works on the table of
sources or on narrow rows. Sources in code-point order (null last) get the weights in turn. A target is the source's share
of all words by weight, but at most `most` times the source's size; what is cut off goes to the other sources by weight,
until none is above its bound. With the sources sorted by bound over weight the first ones are capped, so running
sums give the common level in one step. Each document is emitted floor(rate) times, and once more if a number that its key and
the seed hash to lies under the fraction of the rate.

The ordered running sums are over the table of sources, which has a row per source and no more.

Defined cases: a null text has size 0; a null source is a source of its own; a document without doc_id hashes as the empty
key; repeated rows take the same decision; a source without words has target 0 and rate 0, and its documents, which
have no words, are not emitted; an empty table gives an empty result; further columns are carried along by `mixed`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystone.llm.common import packed, whole_text
from tallystone.session import materialize

#: A word is a run of anything but space and the controls from tab to carriage return; weights repeat.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3


def word_count(text: str = "text") -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """From rows of source and size: source, source_size, target, rate; one row per source."""
    every = Window.partitionBy()
    named = every.orderBy(F.col("source").asc_nulls_last())
    rising = every.orderBy(F.col("bound") / F.col("weight"), "nth")
    table = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("nth", F.row_number().over(named) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("nth") % len(weights) + 1))
        .withColumn("bound", F.col("source_size") * float(most))
        .withColumn("place", F.row_number().over(rising))
        # The level if exactly the sources before this one are at their bound: the first that stays under it is right.
        .withColumn("capped", F.sum("bound").over(rising.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("open", F.sum("weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("own_level", (F.sum("source_size").over(every) - F.coalesce("capped", F.lit(0.0))) / F.col("open"))
        .withColumn("under", F.when(F.col("bound") / F.col("weight") >= F.col("own_level"), F.struct("place", "own_level")))
        .withColumn("level", F.min("under").over(every)["own_level"])
        .withColumn("target", F.least("bound", F.col("weight") * F.col("level")))
    )
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most))))
    return table.select("source", "source_size", "target", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def copies(rate: str, key: str, seed: str) -> Column:
    """How often to emit a document: the whole part of the rate, and once more with the fraction as probability."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    whole = F.floor(F.col(rate))
    return whole + (draw < F.col(rate) - whole).cast("long")


def mix_plan(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, seed: str = "mix", key: str = "doc_id",
    text: str = "text", source: str = "source",
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies."""
    rows = materialize(
        docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size")), "sizes"
    )
    targets = materialize(source_targets(rows, weights, most), "targets").withColumnRenamed("source", "of")
    return (
        rows.join(targets, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("copies", copies("rate", "doc_id", seed))
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
    )


def mixed(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, seed: str = "mix", key: str = "doc_id",
    text: str = "text", source: str = "source",
) -> DataFrame:
    """The documents of the mix with all their columns, each as often as it is taken."""
    sizes = docs.select(F.col(source).alias("source"), word_count(text).alias("size"))
    targets = materialize(source_targets(sizes, weights, most), "targets").withColumnRenamed("source", "of")
    rows = packed(docs).select("rec", F.col(f"rec.{key}").alias("key"), F.col(f"rec.{source}").alias("own"))
    return (
        rows.join(targets, F.col("own").eqNullSafe(F.col("of")))
        .withColumn("times", copies("rate", "key", seed))
        .where("times > 0")
        .select("rec", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("nth"))
        .select("rec.*")
    )
