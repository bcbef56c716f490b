"""A Merkle manifest of a table, by a rollup of nested structs.

Leaves are ranked in their group. The last three octal digits of a rank place a leaf in a block of 512, the digits before them
name the block. Within a block the digits are grouped away one after the other; each step nests the nodes it groups in a
struct of their parent, whose hash is made of theirs. Blocks then take the part of leaves, until each group is one node. On
the way back, blocks meet the path of their own root by a grouping of both, and explode to their nodes with paths made of the
hashes beside them: no join. So no row holds more than a block, and a level of the way down or up moves each block once.

The roots of the groups, in the order of the groups, are the leaves of a last tree of the same kind.

`manifest` gives each row its leaf, the root of its group, the common root, and its path: of each level the hashes to the left
and to the right of its node, joined. `folded` makes the root out of a leaf and a path.

Ranks need no single task: rows are dealt by range, and a count of rows for each range and group tells the first rank in it.

Defined cases: a null value is written `-`; a null group is a group of its own, before all others; null keys come first; rows with equal
keys are ordered by their leaf, and equal leaves are interchangeable; a group of one row has its leaf as root, and so has a
table of one group; an empty table gives an empty result; further columns are not read unless carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystone.session import materialize

#: Fixed value: nodes that make one node of the next level.
RUN = 8
LEVELS = 3
BLOCK = RUN ** LEVELS
PATH = "array<struct<before: string, after: string>>"


def written(value: Column) -> Column:
    """A value as the leaf has it: `-` if null, else its UTF-8 byte count, a colon and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[written(v) for v in values]), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path give."""
    return F.aggregate(path, leaf, lambda node, at: F.sha2(F.concat(at["before"], node, at["after"]), 256))


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """rank of each row in its group `grp`, from 0, and the group's size n. rows is a written table."""
    # Equal rows are told apart by their place in the input, so that many of them fall into several ranges.
    by = ["grp", *order, "place"]
    dealt = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("place")
    numbered = dealt.withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id())
    numbered = materialize(numbered, "ranges")
    # One row per range and group: a group has at most as many as there are ranges.
    counts = numbered.groupBy("grp", "part").agg(F.min("nth").alias("head"), F.count(F.lit(1)).alias("size"))
    along = Window.partitionBy("grp").orderBy("part")
    offsets = counts.select(
        "grp", "part", (F.sum("size").over(along) - F.col("size") - F.col("head")).alias("shift"),
        F.sum("size").over(Window.partitionBy("grp")).alias("n"),
    )
    return numbered.join(offsets, ["grp", "part"]).withColumn("rank", F.col("nth") + F.col("shift")).drop("part", "nth", "shift")


def _rolled(nodes: DataFrame) -> DataFrame:
    """Blocks (grp, n, block, hash, kids) of nodes (grp, n, rank, hash, rec). n counts the nodes of the group; where it has one
    node only, that is its root already and is hashed no more."""
    digits = [F.pmod(F.floor(F.col("rank") / RUN ** k), F.lit(RUN)).cast("int").alias(f"d{k}") for k in range(LEVELS)]
    table = nodes.select("grp", "n", F.floor(F.col("rank") / BLOCK).alias("block"), *digits, "hash", F.struct("rec").alias("kids"))
    table = table.repartition("grp", "block")
    for k in range(LEVELS):
        keys = ["grp", "n", "block", *[f"d{j}" for j in range(k + 1, LEVELS)]]
        kids = F.sort_array(F.collect_list(F.struct(F.col(f"d{k}").alias("digit"), "hash", "kids")))
        table = table.groupBy(*keys).agg(kids.alias("kids"))
        hashes = F.transform("kids", lambda kid: kid["hash"])
        made = F.sha2(F.array_join(hashes, ""), 256)
        table = table.withColumn("hash", F.when(F.col("n") > RUN ** k, made).otherwise(hashes[0]))
    return table


def _unrolled(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """The nodes of blocks (grp, rank, rec, hash) with their paths. above: grp, rank (of the block), path, subroot, root."""
    both = blocks.select("grp", "n", "block", "kids", *[F.lit(None).cast(t).alias(c) for c, t in (("path", PATH), ("subroot", "string"), ("root", "string"))])
    kids_type = blocks.schema["kids"].dataType
    paths = above.select(
        "grp", F.lit(None).cast("long").alias("n"), F.col("rank").alias("block"), F.lit(None).cast(kids_type).alias("kids"), "path", "subroot", "root"
    )
    met = both.unionByName(paths).repartition("grp", "block").groupBy("grp", "block").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "path", "subroot", "root")]
    )
    table = met.withColumn("rank", F.col("block"))
    for k in reversed(range(LEVELS)):
        hashes = F.transform("kids", lambda kid: kid["hash"])
        table = table.select("grp", "n", "rank", "path", "subroot", "root", hashes.alias("hashes"), F.explode("kids").alias("kid"))
        place = F.col("kid.digit")
        beside = F.struct(
            F.array_join(F.slice("hashes", F.lit(1), place), "").alias("before"),
            F.array_join(F.slice("hashes", place + 2, F.lit(RUN)), "").alias("after"),
        )
        longer = F.when(F.col("n") > RUN ** k, F.concat(F.array(beside), F.col("path"))).otherwise(F.col("path"))
        table = table.select(
            "grp", "n", (F.col("rank") * RUN + place).alias("rank"), longer.alias("path"), "subroot", "root",
            F.col("kid.kids").alias("kids"), F.col("kid.hash").alias("hash"),
        )
    return table.select("grp", "rank", "path", "subroot", "root", "hash", F.col("kids.rec").alias("rec"))


def _climbed(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each round, and the root of each group (grp, hash)."""
    most = nodes.agg(F.max("n").alias("most")).first()["most"] or 0
    rounds = []
    while True:
        rounds.append(materialize(_rolled(nodes), "blocks"))
        most = -(-most // BLOCK)
        done = rounds[-1].select("grp", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("rank"), "hash", F.lit(None).cast("int").alias("rec"))
        if most <= 1:
            return rounds, done.select("grp", "hash")
        nodes = done


def _descended(rounds: list[DataFrame], top: DataFrame) -> DataFrame:
    for blocks in reversed(rounds):
        top = _unrolled(blocks, top)
    return top


def manifest_of(leaves: DataFrame, group: str, order: list[str], leaf: str, carry: list[str]) -> DataFrame:
    """leaves: any table with a group, columns of order, a leaf (text) and columns to carry. Gives the carried columns, leaf,
    subroot, root and path."""
    grp = F.when(F.col(group).isNull(), F.lit("-")).otherwise(F.concat(F.lit(":"), F.col(group).cast("string")))
    rows = leaves.select(
        grp.alias("grp"), F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]).alias("at"),
        F.col(leaf).alias("hash"), F.struct(*carry).alias("rec"),
    )
    rows = materialize(rows, "leaves")
    rounds, roots = _climbed(materialize(_ranked(rows, ["at", "hash"]).select("grp", "n", "rank", "hash", "rec"), "ranked"))
    roots = materialize(roots.select(F.lit("").alias("grp"), F.col("grp").alias("rec"), "hash"), "subroots")
    upper, last = _climbed(materialize(_ranked(roots, ["rec"]), "ranked"))
    top = last.select("grp", F.lit(0).cast("long").alias("rank"), F.array().cast(PATH).alias("path"), F.col("hash").alias("subroot"), F.col("hash").alias("root"))
    subroots = _descended(upper, top).select(
        F.col("rec").alias("grp"), F.lit(0).cast("long").alias("rank"), "path", F.col("hash").alias("subroot"), "root"
    )
    out = _descended(rounds, materialize(subroots, "paths"))
    return out.select("rec.*", F.col("hash").alias("leaf"), "subroot", "root", "path")


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", key: str = "doc_id", changed: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, path, and changed_leaf, the leaf of the document with the columns in
    `changed` in place of its own. The texts are read once; all that is ranked and grouped is hashes."""
    own = [F.col(c) for c in columns]
    other = [(changed or {}).get(c, F.col(c)) for c in columns]
    leaves = docs.select(
        F.col(key).alias("doc_id"), F.col(group).alias("grp"), leaf_of(own).alias("leaf"),
        (leaf_of(other) if changed else F.lit(None).cast("string")).alias("changed_leaf"),
    )
    return manifest_of(leaves, "grp", ["doc_id"], "leaf", ["doc_id", "changed_leaf"])
