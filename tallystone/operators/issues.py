"""From a predicate to issue rows.

Row-local rules of a table are evaluated together: one scan, one projection, one bit mask. Group rules produce
the keys that fail and meet the table again through a semi join, so no rule collects a group."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.config import DIMENSION_PREFIXES
from tallystone.functions.parsing import is_true
from tallystone.session import materialize
from tallystone.sources.raw import union_all

ISSUE_COLUMNS = ("row_uid", "dataset", "validation_rule", "severity", "reason", "field")


@dataclass(frozen=True)
class RowRule:
    """A rule that needs only the record itself."""

    name: str
    severity: str
    reason: str | Column
    predicate: Column
    field: str | None = None


def evaluate_row_rules(df: DataFrame, dataset: str, rules: list[RowRule]) -> DataFrame:
    """One issue row per (record, rule) whose predicate is true; a null predicate counts as false.

    Records that fail no rule are left out before their lineage key is made, which costs far more than the rules. A plain
    projection, which is compiled and shares repeated parsing between rules, sets one bit per rule that the record fails; the numbers
    of the bits are exploded and named."""
    own_reasons = {i: r.reason for i, r in enumerate(rules) if isinstance(r.reason, Column)}
    failing = df.where(reduce(lambda a, b: a | b, [is_true(r.predicate) for r in rules]))
    marks = failing.select("row_uid", rule_mask(rules).alias("mask"), *[c.cast("string").alias(f"reason{i}") for i, c in own_reasons.items()])
    numbers = F.filter(F.sequence(F.lit(0), F.lit(len(rules) - 1)), lambda i: F.getbit("mask", i) == 1)
    found = marks.select("*", F.explode(numbers).alias("rule"))

    def named(values: list[str | None]) -> Column:
        return F.get(F.array(*[F.lit(v).cast("string") for v in values]), "rule")

    reason = named([None if i in own_reasons else r.reason for i, r in enumerate(rules)])
    for i in own_reasons:
        reason = F.when(F.col("rule") == i, F.col(f"reason{i}")).otherwise(reason)
    return found.select(
        "row_uid", F.lit(dataset).alias("dataset"), named([r.name for r in rules]).alias("validation_rule"),
        named([r.severity for r in rules]).alias("severity"), reason.alias("reason"), named([r.field for r in rules]).alias("field"),
    )


def rule_mask(rules: list[RowRule]) -> Column:
    """One number per record, in which bit i is set if rule i fails it."""
    if not 0 < len(rules) < 64:
        raise ValueError("1 to 63 rules of a table")
    bits = [F.when(is_true(r.predicate), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, r in enumerate(rules)]
    return reduce(lambda a, b: a + b, bits)


def rule_counts(df: DataFrame, dataset: str, rules: list[RowRule]) -> DataFrame:
    """Issues per rule from the bits alone, in one aggregate: dataset, validation_rule, severity, field, n_issues."""
    marks = df.select(rule_mask(rules).alias("mask"))
    sums = marks.agg(*[F.coalesce(F.sum(F.getbit("mask", F.lit(i)).cast("long")), F.lit(0)).alias(f"n{i}") for i in range(len(rules))])
    rows = [
        F.struct(
            F.lit(r.name).alias("validation_rule"), F.lit(r.severity).alias("severity"), F.lit(r.field).cast("string").alias("field"),
            F.col(f"n{i}").alias("n_issues"),
        )
        for i, r in enumerate(rules)
    ]
    return sums.select(F.lit(dataset).alias("dataset"), F.inline(F.array(*rows))).where("n_issues > 0")


def issue_rows(
    failing: DataFrame, dataset: str, rule: str, severity: str, reason: str | Column, field: str | None = None
) -> DataFrame:
    """Issue rows for records already known to fail (`failing` carries row_uid)."""
    reason_col = reason if isinstance(reason, Column) else F.lit(reason)
    return failing.select(
        F.col("row_uid").cast("string").alias("row_uid"),
        F.lit(dataset).alias("dataset"),
        F.lit(rule).alias("validation_rule"),
        F.lit(severity).alias("severity"),
        reason_col.cast("string").alias("reason"),
        F.lit(field).cast("string").alias("field"),
    )


def _half(digest: Column) -> Column:
    return F.shiftright(digest, 32).cast("int")


def digest_marks(suspects: DataFrame, name: str) -> DataFrame:
    """The upper halves of 64-bit digests (column digest), written, so that Spark knows their size and broadcasts them if they are few."""
    # A name of its own: a subquery would take a name that its table has from there.
    return materialize(suspects.select(_half(F.col("digest")).alias("half_of_digest")).distinct(), name)


def is_marked(keys: list[str], marks: DataFrame) -> Column:
    """Whether the digest of the keys is among the marks: true for all rows that are meant and few others. A filter by it comes before the
    lineage key is made, which costs far more."""
    own = F.col("half_of_digest") == _half(F.xxhash64(*[F.col(k).outer() for k in keys]))
    return marks.where(own).exists()


def among(rows: DataFrame, keys: list[str], suspects: DataFrame, name: str) -> DataFrame:
    """The rows whose 64-bit digest of the keys is among the suspects (column digest), and few others. An exact test is to follow; the
    rows are written, as it reads them more than once."""
    return materialize(rows.where(is_marked(keys, digest_marks(suspects, name))), f"{name}_rows")


def union_issues(frames: list[DataFrame]) -> DataFrame:
    return union_all([f.select(*ISSUE_COLUMNS) for f in frames])


def rule_dimension(rule: Column) -> Column:
    """Quality dimension of a rule name: the first dimension with a matching prefix, else null."""
    result = None
    for dimension, prefixes in DIMENSION_PREFIXES:
        matches = F.lit(False)
        for prefix in prefixes:
            matches = matches | rule.startswith(prefix)
        result = F.when(matches, dimension) if result is None else result.when(matches, dimension)
    return result


def with_dimension(issues: DataFrame) -> DataFrame:
    return issues.withColumn("dimension", rule_dimension(F.col("validation_rule")))
