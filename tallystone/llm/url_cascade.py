"""Host and path rules over urls by a cascade of Bloom filters, without joining the urls to the list.

A rule is a key `host + path`. A url has a candidate key for each of its host's suffixes (at label borders) and each path
length that occurs in the list; it meets a rule if one of its candidate keys is listed. The candidate keys of all urls are
the key universe. Level 1 encodes the listed keys; level 2 the keys of the universe that level 1 takes wrongly; level 3 the
listed keys that level 2 takes wrongly; and so on until a level takes nothing wrongly. A key is listed if the first level
that lacks it is an even one: exact for every key of the universe. A second cascade tells block keys from allow
keys among the listed ones.

Sizes: level 1 has the false-positive rate r / (1.41 s) for r listed keys in a universe of s, all further levels 1/2. About
0.7 r keys are left after level 1 and half as many after each further pair, so the filters take r log2(s / r) bits
and a few more per key: bounded by the list and the logarithm of the universe, never by the number of urls. Only filters
reach the driver, as literals of the plan. `max_bits` bounds a filter; a longer list raises an error.

Bits are built by Spark's bitmap aggregates and probed in the projection of the urls.

Defined cases: a null url, or one without `://`, has an empty host and path and meets no rule; a url that meets no rule gets
the default verdict, since its keys are proven absent; repeated rows are judged alike; an empty list or table works; a key
listed twice must have one verdict (block wins).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.llm.common import ASCII_LOWER, ASCII_UPPER
from tallystone.session import materialize

BUCKET = 32768  # bits of one bitmap of Spark's


def host_of(url: str) -> Column:
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, ASCII_UPPER, ASCII_LOWER)


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def candidate_keys(host: str, path: str, lengths: Sequence[int]) -> Column:
    """Keys of all rules that could fit, the longest first; of equal length the one with the longer host first."""
    labels = F.split(F.col(host), r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    heads = F.transform(F.array(*[F.lit(n) for n in lengths]), lambda n: F.substring(F.col(path), F.lit(1), n))
    heads = F.array_distinct(heads)
    keys = F.flatten(F.transform(suffixes, lambda h: F.transform(heads, lambda p: F.struct(
        (-F.length(h) - F.length(p)).alias("n"), (-F.length(h)).alias("m"), F.concat(h, p).alias("key")))))
    return F.transform(F.array_sort(keys), lambda x: x["key"])


@dataclass(frozen=True)
class Level:
    """A Bloom filter: `words` longs of 64 bits, `probes` probes, seeded by its number."""

    words: tuple[int, ...]
    probes: int
    number: int

    def bits(self) -> int:
        return 64 * len(self.words)

    def has(self, key: Column, words: Column) -> Column:
        out = F.lit(True)
        for i in range(self.probes):
            at = _probe(key, self.number, i, self.bits())
            word = F.element_at(words, (F.shiftright(at, 6) + 1).cast("int"))
            out = out & (_bit(word, at) == 1)
        return out


def _probe(key: Column, number: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(number), F.lit(i)), F.lit(bits))


def _bit(word: Column, at: Column) -> Column:
    return F.call_function("getbit", word, F.pmod(at, F.lit(64)).cast("int"))


def _build(keys: DataFrame, count: int, rate: float, number: int, max_bits: int) -> Level:
    """The filter of a table of keys, with its false-positive rate."""
    bits = max(64, math.ceil(-count * math.log(rate) / math.log(2) ** 2))
    bits = 64 * math.ceil(bits / 64)
    if bits > max_bits:
        raise ValueError(f"a filter of {bits} bits is over max_bits = {max_bits}")
    probes = max(1, round(-math.log2(rate)))
    at = F.explode(F.array(*[_probe(F.col("key"), number, i, bits) for i in range(probes)]))
    maps = (
        keys.select(at.alias("at"))
        .groupBy((F.col("at") / F.lit(BUCKET)).cast("long").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.col("at") % BUCKET).alias("map"))
    )
    whole = bytearray(BUCKET // 8 * math.ceil(bits / BUCKET))
    for row in maps.toLocalIterator():  # bounded by max_bits
        whole[row["bucket"] * (BUCKET // 8):(row["bucket"] + 1) * (BUCKET // 8)] = bytes(row["map"])
    words = tuple(int.from_bytes(whole[i:i + 8], "little", signed=True) for i in range(0, bits // 8, 8))
    return Level(words, probes, number)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def has(self, key: Column, words: Sequence[Column]) -> Column:
        out = F.lit(False)
        for n in reversed(range(len(self.levels))):
            out = self.levels[n].has(key, words[n]) & ~out
        return out

    def literals(self) -> list[Column]:
        return [F.from_json(F.lit("[" + ",".join(map(str, x.words)) + "]"), "array<bigint>") for x in self.levels]


def build_cascade(listed: DataFrame, universe: DataFrame, max_bits: int = 1 << 28, max_levels: int = 60) -> Cascade:
    """listed: distinct keys. universe: keys, repeats allowed; listed keys in it are left out."""
    spark = listed.sparkSession
    left = materialize(listed.select("key"), "listed")
    n_left = left.count()
    if not n_left:
        return Cascade(())
    s = universe.agg(F.approx_count_distinct("key")).first()[0]
    levels: list[Level] = []
    rate = min(0.5, n_left / (math.sqrt(2) * max(s, 1)))
    inside, outside = left, universe.select("key")
    while True:
        number = len(levels) + 1
        if number > max_levels:
            raise RuntimeError(f"the cascade did not end in {max_levels} levels")
        level = _build(inside, n_left, rate, number, max_bits)
        levels.append(level)
        words = Cascade((level,)).literals()[0]
        wrong = outside.where(level.has(F.col("key"), words)).distinct()
        if number == 1:
            wrong = wrong.join(left, "key", "left_anti")
        wrong = materialize(wrong, "wrong")
        n_left = wrong.count()
        if not n_left:
            return Cascade(tuple(levels))
        inside, outside, rate = wrong, inside, 0.5


def judge_urls(
    pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id", url: str = "url",
    max_bits: int = 1 << 28,
) -> DataFrame:
    """rules: host, path, verdict (allow or block). One row per page: page_id, host, path, rule, verdict."""
    listed = materialize(
        rules.groupBy(F.concat(F.translate("host", ASCII_UPPER, ASCII_LOWER), "path").alias("key"))
        .agg(F.max((F.col("verdict") == "block").cast("int")).alias("block")), "rules",
    )
    # Distinct path lengths of the list: bounded by the longest path of a rule.
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect() if r[0] is not None)
    rows = pages.select(F.col(key).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    if not lengths:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    rows = rows.withColumn("keys", candidate_keys("host", "path", lengths))
    universe = rows.select(F.explode("keys").alias("key"))
    is_listed = build_cascade(listed.select("key"), universe, max_bits)
    is_block = build_cascade(listed.where("block = 1").select("key"), listed.where("block = 0").select("key"), max_bits)
    a, b = is_listed.literals(), is_block.literals()
    rule = F.get(F.filter("keys", lambda k: is_listed.has(k, a)), F.lit(0))
    verdict = F.when(is_block.has(F.col("rule"), b), "block").otherwise("allow")
    return (
        rows.withColumn("rule", rule)
        .select("page_id", "host", "path", "rule", F.when(F.col("rule").isNull(), default).otherwise(verdict).alias("verdict"))
    )
