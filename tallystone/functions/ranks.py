"""Exact values at given ranks, for groups of any size, without shuffling the values.

A mergeable quantile sketch (KLL) of each group brackets every wanted rank. One pass then counts what lies outside the
brackets and lists the distinct values inside, a hundredth of the group or so, in ranges of equal width; the counts of the
ranges lead to the one range that holds a rank, and only its values are ranked one by one. The brackets are a guess that the
counts confirm: groups with a rank outside its bracket are searched again in wider ones, at last from least to greatest value.

The values are read twice and meet a small written table of brackets, which Spark broadcasts if its size allows; what is
shuffled are sketches and counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystone.session import materialize

SKETCH_SIZE = 1024
#: The sketch misses a rank by 0.4 % of the group at most, with 99 % confidence.
MARGIN = 0.006
RANGES = 4096


def _same(left: str, right: str, keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


def _brackets(values: DataFrame, keys: list[str], value: str, shares: Sequence[float], margin: float) -> DataFrame:
    """Low and high ends of the brackets of each group, and all of them sorted, the edges."""
    sketch = values.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(SKETCH_SIZE)).alias("sketch"))
    low = F.array(*[F.lit(max(0.0, s - margin)) for s in shares])
    high = F.array(*[F.lit(min(1.0, s + margin)) for s in shares])
    at = sketch.select(
        *keys, F.kll_sketch_get_quantile_double("sketch", low).alias("low"), F.kll_sketch_get_quantile_double("sketch", high).alias("high")
    )
    return at.select(*keys, "low", "high", F.array_sort(F.concat("low", "high")).alias("edges"))


def _counted(values: DataFrame, brackets: DataFrame, keys: list[str], value: str, count: int) -> DataFrame:
    """Counts by slot (between two edges), range and value. Outside the brackets value is null and the range -1; these come first in
    their slot, since of such a slot only the upper edge may lie in a bracket. count: brackets of a group. Plain comparisons, one for
    each edge, are compiled, which functions over arrays are not."""
    table = values.select(*keys, F.col(value).alias("value")).alias("v").join(
        brackets.alias("b"), _same("v", "b", keys)
    ).select(*[F.col(f"v.{k}").alias(k) for k in keys], "value", F.col("value").cast("double").alias("x"), "low", "high", "edges")
    slot = reduce(lambda a, b: a + b, [(F.col("edges")[i] < F.col("x")).cast("int") for i in range(2 * count)])
    inside = reduce(lambda a, b: a | b, [(F.col("low")[i] <= F.col("x")) & (F.col("x") <= F.col("high")[i]) for i in range(count)])
    table = table.select(*keys, "value", "x", "edges", slot.alias("slot"), inside.alias("inside"))
    low = F.get("edges", F.greatest(F.col("slot") - 1, F.lit(0)))
    width = F.get("edges", "slot") - low
    part = F.when(width > 0, F.least(F.lit(RANGES - 1), F.floor((F.col("x") - low) / width * RANGES))).otherwise(F.lit(0))
    return table.groupBy(
        *keys, "slot", F.when(F.col("inside"), part).otherwise(F.lit(-1)).cast("int").alias("part"), F.when(F.col("inside"), F.col("value")).alias("value")
    ).agg(F.count(F.lit(1)).alias("times"))


def _picked(counts: DataFrame, keys: list[str], shares: Sequence[float]) -> DataFrame:
    """keys, n, wanted (2 i for the lower and 2 i + 1 for the upper rank of share i), value, missed."""
    ranges = counts.groupBy(*keys, "slot", "part").agg(F.sum("times").alias("times"))
    order = Window.partitionBy(*keys).orderBy("slot", "part")
    # At most RANGES and one for each slot of a group.
    ranges = ranges.withColumn("before", F.sum("times").over(order) - F.col("times")).withColumn(
        "n", F.sum("times").over(Window.partitionBy(*keys))
    )
    place = [F.lit(float(s)) * (F.col("n") - 1) for s in shares]
    ranks = F.array(*[f(p) for p in place for f in (F.floor, F.ceil)])
    found = ranges.withColumn(
        "wanted", F.filter(
            F.transform(ranks, lambda r, i: F.struct(i.alias("wanted"), (r - F.col("before")).alias("rest"))),
            lambda w: (w["rest"] >= 0) & (w["rest"] < F.col("times")),
        )
    ).where(F.size("wanted") > 0).select(*keys, "n", "slot", "part", "wanted")
    few = counts.alias("c").join(found.alias("f"), _same("c", "f", [*keys, "slot", "part"])).select(
        *[F.col(f"c.{k}").alias(k) for k in [*keys, "slot", "part", "value", "times"]], "n", "wanted"
    )
    along = Window.partitionBy(*keys, "slot", "part").orderBy("value")
    few = few.withColumn("last", F.sum("times").over(along) - 1).withColumn(
        "wanted", F.filter("wanted", lambda w: (w["rest"] <= F.col("last")) & (w["rest"] > F.col("last") - F.col("times")))
    )
    return few.select(*keys, "n", (F.col("part") < 0).alias("missed"), "value", F.explode("wanted.wanted").alias("wanted"))


def grouped_ranks(values: DataFrame, keys: list[str], value: str, shares: Sequence[float]) -> DataFrame:
    """keys, n and, of each share s, the values at the two ranks around s (n - 1): low<i>, high<i>. Null values do not count.

    values is best a written table, as it is read twice."""
    rest = values.where(F.col(value).isNotNull())
    margin, done = MARGIN, []
    while True:
        brackets = materialize(_brackets(rest, keys, value, shares, margin), "brackets")
        counts = materialize(_counted(rest, brackets, keys, value, len(shares)), "rank_counts")
        picked = materialize(_picked(counts, keys, shares), "ranks")
        missed = picked.groupBy(*keys).agg(F.max("missed").alias("missed")).where("missed").drop("missed")
        if margin >= 1 or missed.isEmpty():
            done.append(picked)
            break
        margin = max(0.05, 12 * margin)
        found = picked.groupBy(*keys).agg(F.max("missed").alias("missed")).where("NOT missed").drop("missed")
        done.append(picked.alias("p").join(found.alias("m"), _same("p", "m", keys), "left_semi"))
        rest = rest.alias("r").join(missed.alias("m"), _same("r", "m", keys), "left_semi")
    table = done[0]
    for other in done[1:]:
        table = table.unionByName(other)
    names = [f"{side}{i}" for i in range(len(shares)) for side in ("low", "high")]
    return table.groupBy(*keys, "n").agg(*[F.max(F.when(F.col("wanted") == j, F.col("value"))).alias(name) for j, name in enumerate(names)])


def interpolated(share: float, i: int) -> Column:
    """The percentile of share number i of `grouped_ranks`, between the two values by the place of the share."""
    place = F.lit(float(share)) * (F.col("n") - 1)
    low, high = F.col(f"low{i}").cast("double"), F.col(f"high{i}").cast("double")
    part = place - F.floor(place)
    return F.when(part == 0, low).otherwise((1 - part) * low + part * high)


def grouped_median(values: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, median, n. An even count averages the two middle values; a decimal's median has one more digit."""
    middle = grouped_ranks(values, keys, value, [0.5])
    return middle.select(*keys, ((F.col("low0") + F.col("high0")) * F.expr("0.5BD")).alias("median"), "n")
