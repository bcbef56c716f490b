"""Homomorphic multiset fingerprints of documents.

A text is the multiset of its paragraphs (lines). Each paragraph is hashed to wide vectors, and a text's fingerprint is the sum
of its paragraphs' vectors modulo a power of two: the order of paragraphs does not matter, and inserting or deleting a
paragraph adds or subtracts its vector. There are two vectors:

- 16 lanes modulo 2^32, cut from the paragraph's SHA-512: the fingerprints of different multisets differ.
- 128 lanes modulo 2^32: the sum of vectors drawn from the hashes of the paragraph's shingles of three words (one
  shingle if it has fewer), each +1 or -1 in one block of 32 lanes and 0 in the others. The cosine of two such sums estimates that of the shingle counts, with a deviation of about
  0.09 at most: the likeness, cut to 0 to 1. Equal fingerprints have likeness 1. A lane holds up to 2^31 shingles, more than a
  text can have, so the likeness of two fingerprints is that of the sums they were made of.

The fingerprint is both vectors in hexadecimal. `combine` adds and subtracts fingerprints.

`edited_fingerprints` finds each document's next one in descending order of the key: keys are dealt into ranges, each range
gets a copy of the first row of the next range, and a window in each range does the rest. Texts are shuffled once. The
edited text's fingerprint is made incrementally: only the paragraphs from the first changed one on are taken out and put in.

Defined cases: a null text is the empty text, which has one empty paragraph; null keys come last, rows with equal keys are ordered by
their text; a table of one row is its own successor; repeated rows follow each other; an empty table gives an empty
result; further columns are not read. The key is a whole number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystone.llm.common import shuffle_partitions, whole_text

EXACT, NEAR, WORDS = 16, 128, 3
BLOCKS = 4  # a shingle goes to one of four blocks of 32 lanes
PAIR = 0x100000001  # one bit in each half of a long: two lanes are counted at once
SUMS = [f"s{k}" for k in range(NEAR // BLOCKS // 2)]


def paragraph_digests(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda p: F.sha2(p, 512))


def exact_lanes(digests: str) -> Column:
    """16 sums modulo 2^32 over a column of paragraph digests."""
    def lane(i: int) -> Column:
        return F.aggregate(
            digests, F.lit(0).cast("long"),
            lambda total, d: (total + F.conv(F.substring(d, 8 * i + 1, 8), 16, 10).cast("long")) % (1 << 32),
        )

    return F.array(*[lane(i) for i in range(EXACT)])


def _count_shingles(parts: DataFrame, keys: list[str]) -> DataFrame:
    """For each key and block: how many shingles of the texts `part` have bit k and bit k + 32 of their hash set, two counts in
    a long, and n, their number."""
    paragraphs = parts.select(*keys, F.explode(F.split("part", "\n")).alias("paragraph"))
    words = paragraphs.select(*keys, F.split("paragraph", " ").alias("words"))
    first = F.slice("words", F.lit(1), F.greatest(F.lit(1), F.size("words") - WORDS + 1))
    hashes = F.transform(first, lambda w, i: F.xxhash64(w, *[F.get("words", i + k) for k in range(1, WORDS)]))
    exploded = words.select(*keys, F.explode(hashes).alias("h")).withColumn("block", F.shiftright("h", 16).bitwiseAND(F.lit(BLOCKS - 1).cast("long")))
    sums = [F.sum(F.shiftright("h", k).bitwiseAND(F.lit(PAIR))).alias(name) for k, name in enumerate(SUMS)]
    return exploded.groupBy(*keys, "block").agg(*sums, F.count(F.lit(1)).alias("n"))


def _block_lanes(prefix: str = "") -> Column:
    """Lanes of a block as whole numbers: shingles with the bit set minus shingles without."""
    n = F.col(f"{prefix}n")
    low = [2 * F.col(f"{prefix}{s}").bitwiseAND(F.lit(0xFFFFFFFF)) - n for s in SUMS]
    return F.array(*low, *[2 * F.shiftright(f"{prefix}{s}", 32) - n for s in SUMS])


def _all_lanes(lanes: str) -> Column:
    """An aggregate: the lanes of all blocks, absent blocks as zeros."""
    by_block = F.map_from_entries(F.collect_list(F.struct("block", lanes)))
    none = F.array_repeat(F.lit(0).cast("long"), NEAR // BLOCKS)
    return F.flatten(F.array(*[F.coalesce(F.try_element_at(by_block, F.lit(b).cast("long")), none) for b in range(BLOCKS)]))


def _hexed(exact: Column, near: Column) -> Column:
    a = F.transform(exact, lambda x: F.lpad(F.hex(x), 8, "0"))
    b = F.transform(near, lambda x: F.lpad(F.hex(F.pmod(x, F.lit(1 << 32))), 8, "0"))
    return F.lower(F.concat(F.array_join(a, ""), F.array_join(b, "")))


def _numbers(fingerprint: Column, start: int, count: int, digits: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)),
        lambda i: F.conv(F.substring(fingerprint, start + 1 + i * digits, F.lit(digits)), 16, 10).cast("long"),
    )


def combine(left: Column, right: Column, sign: int = 1) -> Column:
    """The fingerprint of the union of two multisets (sign 1), or of the left one without the right one (sign -1)."""
    parts = []
    for start, count, digits in ((0, EXACT, 8), (8 * EXACT, NEAR, 8)):
        a, b = _numbers(left, start, count, digits), _numbers(right, start, count, digits)
        mod = F.lit(16 ** digits)
        both = F.zip_with(a, b, lambda x, y: F.lpad(F.hex(F.pmod(x + sign * y, mod)), digits, "0"))
        parts.append(F.array_join(both, ""))
    return F.lower(F.concat(*parts))


def _cosine(a: Column, b: Column) -> Column:
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: (p * q).cast("double")), F.lit(0.0), lambda s, v: s + v)

    norm = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(norm == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), dot(a, b) / norm)))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1."""
    def signed(f: Column) -> Column:
        return F.transform(_numbers(f, 8 * EXACT, NEAR, 8), lambda x: F.when(x >= 1 << 31, x - (1 << 32)).otherwise(x))

    return F.when(a == b, F.lit(1.0)).otherwise(_cosine(signed(a), signed(b)))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fingerprint, one row per distinct key and text."""
    rows = docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("part"))
    rows = rows.select("doc_id", F.sha2("part", 256).alias("digest"), "part").dropDuplicates(["doc_id", "digest"])
    counts = _count_shingles(rows, ["doc_id", "digest"]).withColumn("lanes", _block_lanes())
    near = counts.groupBy(F.col("doc_id").alias("near_id"), F.col("digest").alias("near_digest")).agg(_all_lanes("lanes").alias("near"))
    exact = rows.select("doc_id", "digest", paragraph_digests(F.col("part")).alias("digests"))
    exact = exact.select("doc_id", "digest", exact_lanes("digests").alias("exact"))
    same = F.col("doc_id").eqNullSafe(F.col("near_id")) & (F.col("digest") == F.col("near_digest"))
    return exact.join(near, same).select("doc_id", _hexed(F.col("exact"), F.col("near")).alias("fingerprint"))


def _ranges(docs: DataFrame, key: str, count: int) -> tuple[Column, DataFrame]:
    """The range number of a key, and the first key of each range with the range that it follows."""
    spark = docs.sparkSession
    shares = [i / count for i in range(1, count)]
    found = docs.select(F.percentile_approx(key, F.array(*map(F.lit, shares)), F.lit(10 * count)).alias("b")).first() if shares else None
    bounds = sorted(set(found["b"] or [])) if found else []
    width = max(1, math.isqrt(len(bounds)))
    blocks = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    number: Column = F.lit(0)
    if blocks:
        # Two short looks, at the blocks' first bounds and into one block, instead of one at all bounds.
        firsts = F.array(*[F.lit(b[0]).cast("long") for b in blocks])
        all_blocks = F.array(*[F.array(*[F.lit(x).cast("long") for x in b]) for b in blocks])
        block = F.size(F.filter(firsts, lambda b: b < F.col(key)))
        inside = F.size(F.filter(F.get(all_blocks, F.greatest(block - 1, F.lit(0))), lambda b: b < F.col(key)))
        number = F.greatest(block - 1, F.lit(0)) * width + inside
    number = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(number)
    # One row per range, and there are a few ranges per shuffle partition.
    heads = docs.groupBy(number.alias("range")).agg(F.max(key).alias("head")).orderBy(F.desc("range")).collect()
    follows = [(heads[(i + 1) % len(heads)]["head"], heads[i]["range"]) for i in range(len(heads))]
    return number, spark.createDataFrame(follows, "head long, target int")


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The
    edited text has the last third of its code points replaced by the first as many of the next document."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    number, follows = _ranges(rows.select("doc_id"), "doc_id", 4 * shuffle_partitions(docs.sparkSession))
    # A row per range: small enough to broadcast.
    copied = rows.join(F.broadcast(follows), F.col("doc_id").eqNullSafe(F.col("head")), "left")
    home = F.struct(number.cast("int").alias("range"), F.lit(False).alias("ghost"))
    guest = F.struct(F.col("target").alias("range"), F.lit(True).alias("ghost"))
    dealt = copied.select(
        "doc_id", "text", F.explode(F.when(F.col("head").isNull() & F.col("target").isNull(), F.array(home)).otherwise(F.array(home, guest))).alias("at")
    ).select("doc_id", "text", "at.*")
    order = Window.partitionBy("range").orderBy("ghost", F.col("doc_id").desc_nulls_last(), "text")
    placed = dealt.withColumn("place", F.row_number().over(order)).withColumn("next", F.lead("text").over(order))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), n - third)
    placed = placed.withColumn("n_chars", n).withColumn("kept", kept).withColumn(
        "edited", F.concat("kept", F.substring(F.coalesce("next", F.lit("")), F.lit(1), third))
    )
    # From the paragraph on in which the kept part ends: what goes and what comes.
    same = F.length("kept") - F.length(F.substring_index("kept", "\n", -1)) + 1
    old, new = F.substring("text", same, n), F.substring("edited", same, n)

    parts = placed.select("range", "place", "ghost", F.explode(F.when(F.col("ghost"), F.array(
        F.struct(F.lit(0).alias("role"), F.col("text").alias("part"))
    )).otherwise(F.array(
        F.struct(F.lit(0).alias("role"), F.col("text").alias("part")),
        F.struct(F.lit(1).alias("role"), old.alias("part")), F.struct(F.lit(2).alias("role"), new.alias("part")),
    ))).alias("at")).select("range", "place", "at.*")
    counts = _count_shingles(parts, ["range", "place", "role"])
    names = [*SUMS, "n"]
    own = [F.sum(F.when(F.col("role") == 0, F.col(c)).otherwise(0)).alias(f"a{c}") for c in names]
    changed = [F.sum(F.when(F.col("role") == 1, -F.col(c)).otherwise(F.col(c))).alias(f"b{c}") for c in names]
    blocks = counts.groupBy("range", "place", "block").agg(*own, *changed)
    blocks = blocks.select("range", "place", "block", _block_lanes("a").alias("a"), _block_lanes("b").alias("b"))
    lanes = blocks.groupBy("range", "place").agg(_all_lanes("a").alias("near"), _all_lanes("b").alias("edited_near"))
    exact = placed.select(
        "range", "place", "ghost", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        paragraph_digests(F.col("text")).alias("digests"), paragraph_digests(F.col("edited")).alias("edited_digests"),
    )
    exact = exact.select(
        "range", "place", "ghost", "doc_id", "n_chars", "edited_sha256", exact_lanes("digests").alias("exact"),
        exact_lanes("edited_digests").alias("edited_exact"),
    )
    both = exact.join(lanes, ["range", "place"])
    along = Window.partitionBy("range").orderBy("place")
    both = both.withColumn("next_near", F.lead("near").over(along)).withColumn("next_exact", F.lead("exact").over(along))
    alike = F.when((F.col("exact") == F.col("edited_exact")) & (F.col("near") == F.col("edited_near")), F.lit(1.0))
    alike_next = F.when((F.col("exact") == F.col("next_exact")) & (F.col("near") == F.col("next_near")), F.lit(1.0))
    return both.where(~F.col("ghost")).select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        _hexed(F.col("exact"), F.col("near")).alias("fingerprint"),
        _hexed(F.col("edited_exact"), F.col("edited_near")).alias("edited_fingerprint"),
        alike.otherwise(_cosine(F.col("near"), F.col("edited_near"))).alias("near_edited"),
        alike_next.otherwise(_cosine(F.col("near"), F.col("next_near"))).alias("near_next"),
    )
