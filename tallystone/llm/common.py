"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.session import materialize

#: Fixed value: A-Z and a-z, for case folding that leaves all other letters alone.
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def packed(df: DataFrame, name: str = "rec") -> DataFrame:
    """All columns in one struct, so that no helper column can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: Keys with at least one of so many rows are frequent; there are at most as many of them.
FREQUENT = 1024


def join_split(rows: DataFrame, table: DataFrame, keys: Sequence[str], count: str, frequent: int = FREQUENT) -> DataFrame:
    """Inner join of written rows with a written table of one row per key, in which `count` is how many of the rows have the key.

    Keys that hold one row in `frequent` or more meet a broadcast of these few, so they are not shuffled; the others, none of
    which is large, meet by an ordinary join. Keys are not null."""
    total = table.agg(F.sum(count)).scalar()
    marked = table.withColumn("is_frequent", F.col(count) * frequent >= total)
    few = materialize(marked.where("is_frequent").drop("is_frequent"), "frequent_keys")  # `frequent` rows at most
    rest = table.join(F.broadcast(few.select(*keys)), list(keys), "left_anti")
    hot = rows.join(F.broadcast(few), list(keys))
    return hot.unionByName(rows.join(F.broadcast(few.select(*keys)), list(keys), "left_anti").join(rest, list(keys)))


def literal_longs(values: Sequence[int]) -> Column:
    """An array literal of longs. Made of one string, which stays small in the plan."""
    return F.transform(F.split(F.lit(" ".join(map(str, values))), " "), lambda x: x.cast("long"))
