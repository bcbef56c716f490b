"""The registered queries of this folder, thin over their operators, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.llm import (
    exact_dedup, fingerprints, language_id, manifest, mixing, near_dedup, passage_dedup, segmentation, sharding, suffix_dedup, toxicity,
    url_cascade, whitening,
)
from tallystone.llm.common import ASCII_LOWER, ASCII_UPPER, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op2_exact_dedup", """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(read(spark, sf_dir, "documents"))


@query("op3_language_id")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language_id.learn_languages(docs.where(~language_id.held_out()))
    return language_id.identify_languages(docs, model)


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.learn_toxicity(docs, read(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model)


@query("op5_sharding", f"""
WITH rows AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 10))::BIGINT AS bits FROM documents),
sums AS (
  SELECT d::INT AS depth, bits >> (40 - d) AS prefix, sum(n_bytes)::BIGINT AS bytes
  FROM rows, range(0, 41) t(d) GROUP BY ALL),
shards AS (
  SELECT s.* FROM sums s LEFT JOIN sums p ON p.depth = s.depth - 1 AND p.prefix = s.prefix >> 1
  WHERE s.bytes <= {sharding.LIMIT} AND (s.depth = 0 OR p.bytes > {sharding.LIMIT}))
SELECT r.doc_id, r.n_bytes, CASE WHEN s.depth = 0 THEN '' ELSE right(bin(r.bits + (1::BIGINT << 40)), 40)[1:s.depth] END AS shard,
       s.depth, s.bytes AS shard_bytes, false AS oversized
FROM rows r JOIN shards s ON s.prefix = r.bits >> (40 - s.depth)
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"))


#: The rules of the query.
RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


@query("op6_url_filters", r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
met AS (
  SELECT page_id, host, path, arg_max(h || p, length(h) + length(p)) FILTER (h IS NOT NULL) AS rule,
         arg_max(v, length(h) + length(p)) FILTER (h IS NOT NULL) AS v
  FROM (SELECT *, row_number() OVER () AS n FROM parts) x
  LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n, page_id, host, path)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM met
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_cascade.judge_urls(read(spark, sf_dir, "pages"), rules)


@query("op7_mixing", r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS nth
  FROM docs GROUP BY source),
weighted AS (
  SELECT *, (CASE nth % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END)::DOUBLE AS weight, source_size * 3.0::DOUBLE AS bound
  FROM sources),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(bound) OVER (ORDER BY bound / weight, nth ROWS BETWEEN UNBOUNDED
    PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))::DOUBLE / sum(weight) OVER (ORDER BY bound / weight, nth ROWS BETWEEN CURRENT ROW
    AND UNBOUNDED FOLLOWING) AS own_level FROM weighted),
targets AS (
  SELECT source, source_size, least(bound, weight * (SELECT own_level FROM levels WHERE bound / weight >= own_level
    ORDER BY bound / weight, nth LIMIT 1)) AS target FROM weighted),
rates AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS draw
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies
FROM (SELECT *, floor(rate)::BIGINT + (draw < rate - floor(rate))::BIGINT AS copies FROM rates)
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(read(spark, sf_dir, "documents"))


@query("op8_segmentation")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.sha2(F.coalesce("text", F.lit("")), 256)
    rows = segmentation.sample_segmentations(read(spark, sf_dir, "documents"), carry={"text_sha256": whole}, checked=True)
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256)
    return rows.withColumns({"n_pieces": F.size("ids").cast("long"), "ids_sha256": digest}).drop("ids")


@query("op9_near_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicate_classes(read(spark, sf_dir, "documents")).drop("digest")


@query("op10_fingerprints")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read(spark, sf_dir, "documents"))


@query("op11_passage_dedup", r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(doc_id, 9223372036854775807) AS ord,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (SELECT row, ord, words, unnest(range(1, len(words) + 1)) AS i FROM docs),
windows AS (
  SELECT row, ord, i, words[i] AS word, CASE WHEN i + 49 <= len(words) THEN md5(array_to_string(words[i:i + 49], ' ')) END AS w FROM places),
starts AS (SELECT *, w IS NOT NULL AND min(ord) OVER (PARTITION BY w) < ord AS later FROM windows),
marked AS (
  SELECT row, i, word, bool_or(later) OVER (PARTITION BY row ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM starts),
kept AS (
  SELECT row, count(*) FILTER (gone)::BIGINT AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept
  FROM marked GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row)
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passage_dedup.remove_passages(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: CRC-32 of a text of ASCII characters in SQL, bit by bit.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({}, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""


@query("op12_manifest", f"""
WITH RECURSIVE parts AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(':' || lang, '-') AS grp, text, concat(
      coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head
  FROM documents),
leaves AS (
  SELECT row, doc_id, grp, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(text) || ':' || translate(text, '{ASCII_UPPER}', '{ASCII_LOWER}'), '-')) AS folded_leaf
  FROM parts),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS nth, count(*) OVER (PARTITION BY grp) AS n FROM leaves),
tree AS (
  SELECT grp, 0 AS level, nth, n, leaf AS hash FROM ranked
  UNION ALL
  SELECT grp, level + 1, nth // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY nth)) FROM tree WHERE n > 1 GROUP BY grp, level, nth // 8, n),
subroots AS (SELECT grp, hash AS subroot, row_number() OVER (ORDER BY grp) - 1 AS nth, count(*) OVER () AS n FROM tree WHERE n = 1),
upper_tree AS (
  SELECT 0 AS level, nth, n, subroot AS hash FROM subroots
  UNION ALL
  SELECT level + 1, nth // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY nth)) FROM upper_tree WHERE n > 1 GROUP BY level, nth // 8, n),
beside AS (
  SELECT grp, level, nth, coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM tree WHERE n > 1 WINDOW run AS (PARTITION BY grp, level, nth // 8 ORDER BY nth)),
beside_up AS (
  SELECT level, nth, coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(hash, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM upper_tree WHERE n > 1 WINDOW run AS (PARTITION BY level, nth // 8 ORDER BY nth)),
walk AS (
  SELECT row, grp, 0 AS level, nth, '' AS proof,
         CASE WHEN {CRC32.format("doc_id::VARCHAR")} % 3 = 0 THEN folded_leaf ELSE leaf END AS node FROM ranked
  UNION ALL
  SELECT w.row, w.grp, w.level + 1, w.nth // 8, w.proof || b.before || b.after, sha256(b.before || w.node || b.after)
  FROM walk w JOIN beside b ON b.grp = w.grp AND b.level = w.level AND b.nth = w.nth),
walked AS (SELECT row, grp, arg_max(proof, level) AS proof, arg_max(node, level) AS node FROM walk GROUP BY row, grp),
walk_up AS (
  SELECT row, 0 AS level, nth, proof, node FROM walked JOIN subroots USING (grp)
  UNION ALL
  SELECT w.row, w.level + 1, w.nth // 8, w.proof || b.before || b.after, sha256(b.before || w.node || b.after)
  FROM walk_up w JOIN beside_up b ON b.level = w.level AND b.nth = w.nth),
done AS (SELECT row, arg_max(proof, level) AS proof, arg_max(node, level) AS folded_root FROM walk_up GROUP BY row)
SELECT r.doc_id, r.leaf, s.subroot, u.hash AS root, sha256(d.proof) AS proof_sha256, d.folded_root, d.folded_root = u.hash AS verified
FROM ranked r JOIN done d USING (row) JOIN subroots s ON s.grp = r.grp JOIN (SELECT hash FROM upper_tree WHERE n = 1) u ON true
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    lowered = F.translate("text", ASCII_UPPER, ASCII_LOWER)
    tampered = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0
    out = manifest.manifest(docs, changed={"text": F.when(tampered, lowered).otherwise(F.col("text"))})
    proof = F.array_join(F.transform("path", lambda at: F.concat(at["before"], at["after"])), "")
    out = out.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), manifest.folded(F.col("changed_leaf"), F.col("path")).alias("folded_root")
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))
