"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A node is a distinct text, so exact copies are one node. A shingle is five lower-cased words; its weight is its count in the
text times the mean weight of its words, 1 + ln((1 + N) / (1 + df)) / ln(1 + N): the inverse document frequency, scaled to run
from 1 to 2 in a corpus of any size. Frequencies are counted over all documents, in 2^18 hashed slots of words, which
bounds the table that tasks read.

For each of 36 samples a shingle of weight w draws r, c ~ Gamma(2, 1) and b ~ U(0, 1), and t = floor(ln w / r + b),
ln a = ln c - r (t - b) - r; the least `a` of the text is its sample. Two texts agree in a sample with the probability of
their weighted Jaccard similarity. The draws come from tables indexed by 16 hash bits, with a further hash-drawn
shift of ln a that tells shingles with the same table entry apart. Twelve bands of three samples name candidates: a pair of
similarity 0.8 meets in some band with probability 0.9998.

Links. In each bucket (texts with an equal band) every text is compared with one leader, another one in each
band; what is linked by then is one component. Then, in the buckets that still hold several components, each text outside the largest is
compared with the texts of other components of the bucket, if their samples agree well enough to allow the threshold; of these
each text tries its best ones, eight times as many in each round, until no untested pair of different components is left. So no pairs are listed inside a
component. Every link is verified by the exact weighted Jaccard similarity. What may be lost, at a similarity of just 0.8: a
pair without a common band (1.8 in 10,000), one whose 1,024 further samples agree four standard deviations too rarely (1 in 20,000), and one
whose 36 samples of the bands or first 128 further ones agree five too rarely (4 in a million).

Defined cases: a null text is empty; a text without words is similar to none but its exact copies; a text of one to four words is one shingle; repeated rows
are copies; of a class the smallest doc_id stays (null last), and one row of it; an empty table gives an empty
result; further columns are carried along by `drop_near_duplicates`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystone.llm.arrays import WordHasher, shingle_hashes, text_chunks
from tallystone.llm.common import packed, whole_text
from tallystone.llm.components import components
from tallystone.session import materialize

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 12, 3
SKETCHES = ((128, 5), (1024, 4))  # samples, and the standard deviations that a pair may fall short by
SLOT_BITS = 18
WEIGHT_BITS, WEIGHT_STEP = 26, 64  # a packed feature: 38 hash bits, then the weight in 64ths


def _digest(text: str = "text") -> Column:
    return F.unhex(F.md5(whole_text(text)))


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, hasher = np.zeros(1 << SLOT_BITS, dtype=np.int64), WordHasher()
    for batch in batches:
        for _, offsets, raw in text_chunks(batch.column("text"), lower=True):
            words, firsts = hasher(offsets, raw)
            rows = np.repeat(np.arange(len(firsts) - 1, dtype=np.int64), np.diff(firsts))
            seen = np.unique((rows << SLOT_BITS) | (words >> np.uint64(64 - SLOT_BITS)).astype(np.int64))
            counts += np.bincount(seen & ((1 << SLOT_BITS) - 1), minlength=1 << SLOT_BITS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["slot", "n"])


def slot_weights(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The inverse document frequency of each slot of words, over all documents. 2^18 numbers at most reach the driver."""
    rows = docs.select(F.col(text).cast("string").alias("text"))
    counted = rows.mapInArrow(_slot_counts, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    total = docs.count()
    weights = np.full(1 << SLOT_BITS, 2.0)
    weights[counted["slot"].to_numpy()] = 2.0 - np.log1p(counted["n"].to_numpy()) / math.log1p(max(total, 1))
    return weights.astype(np.float32)


def _features(words: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text, sorted, and their weights."""
    hashes = shingle_hashes(words, WORDS)
    if not len(hashes):
        return hashes, np.zeros(0, np.float32)
    idf = weights[(words >> np.uint64(64 - SLOT_BITS)).astype(np.int64)].astype(np.float64)
    sums = np.concatenate([[0.0], np.cumsum(idf)])
    width = min(WORDS, len(words))
    means = (sums[width:] - sums[:-width]) / width
    order = np.argsort(hashes, kind="stable")
    hashes, means = hashes[order], means[order]
    first = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    at = np.flatnonzero(first)
    times = np.diff(np.append(at, len(hashes)))
    # Steps of 1/64: running sums in texts of different length differ in their last bits.
    return hashes[at], (np.maximum(1, np.rint(means[at] * WEIGHT_STEP)) * times / WEIGHT_STEP).astype(np.float32)


class _Sampler:
    def __init__(self, samples: int) -> None:
        draw = np.random.default_rng(20240601)
        size = 1 << 16
        self.factors = draw.integers(0, 1 << 63, samples, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        r = draw.gamma(2.0, 1.0, size)
        self.r, self.inverse = r.astype(np.float32), (1.0 / r).astype(np.float32)
        self.c = (np.log(draw.gamma(2.0, 1.0, size)) - r).astype(np.float32)
        self.b = draw.random(size).astype(np.float32)

    def __call__(self, hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Samples of each text (rows) from the features of several; starts: each text's first feature."""
        logs, n = np.log(weights).astype(np.float32), len(hashes)
        out = np.empty((len(starts), len(self.factors)), dtype=np.float32)
        # Every step writes to these few arrays, which stay in the processor's cache.
        product, at = np.empty(n, np.uint64), np.empty(n, np.intp)
        a, table, low = np.empty(n, np.float32), np.empty(n, np.float32), np.empty(n, np.float32)
        for k, factor in enumerate(self.factors):
            np.multiply(hashes, factor, out=product)
            np.right_shift(product, np.uint64(48), out=at.view(np.uint64))
            # t = floor(ln w / r + b); ln a = c - r (t - b), where c holds the last - r
            np.multiply(logs, self.inverse.take(at, out=a, mode="clip"), out=a)
            a += self.b.take(at, out=table, mode="clip")
            np.floor(a, out=a)
            a -= table
            a *= self.r.take(at, out=table, mode="clip")
            np.subtract(self.c.take(at, out=table, mode="clip"), a, out=a)
            np.right_shift(product, np.uint64(24), out=product)
            np.bitwise_and(product, np.uint64(0xFFFFFF), out=product)
            np.copyto(low, product.view(np.int64), casting="unsafe")
            low *= np.float32(1e-3 / (1 << 24))
            a += low
            out[:, k] = np.minimum.reduceat(a, starts)
        return out


def _signer(weights: np.ndarray):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sampler = WordHasher(), _Sampler(BANDS * ROWS)
        for batch in batches:
            digests, ids, samples = batch.column("digest"), [], []
            hashes: list[np.ndarray] = []
            values: list[np.ndarray] = []
            held = 0

            def flush() -> None:
                nonlocal held
                if hashes:
                    starts = np.cumsum([0] + [len(h) for h in hashes[:-1]])
                    samples.append(sampler(np.concatenate(hashes), np.concatenate(values), starts))
                    hashes.clear()
                    values.clear()
                    held = 0

            for first, offsets, raw in text_chunks(batch.column("text"), lower=True):
                words, firsts = hasher(offsets, raw)
                for i in range(len(firsts) - 1):
                    if firsts[i] == firsts[i + 1]:
                        continue
                    h, w = _features(words[firsts[i]:firsts[i + 1]], weights)
                    hashes.append(h)
                    values.append(w)
                    ids.append(first + i)
                    held += len(h)
                    if held >= 1 << 15:
                        flush()
            flush()
            if not ids:
                continue
            flat = np.ascontiguousarray(np.concatenate(samples)).view(np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, flat.size + 1, flat.shape[1], dtype=np.int32)), pa.array(flat.ravel())
            )
            yield pa.RecordBatch.from_arrays([digests.take(pa.array(ids)), lists], names=["node", "samples"])

    return sign


def _featurer(weights: np.ndarray):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for first, offsets, raw in text_chunks(batch.column("text"), lower=True):
                words, firsts = hasher(offsets, raw)
                out = []
                for i in range(len(firsts) - 1):
                    h, w = _features(words[firsts[i]:firsts[i + 1]], weights)
                    steps = np.minimum(np.rint(w * WEIGHT_STEP), (1 << WEIGHT_BITS) - 1).astype(np.uint64)
                    out.append(((h >> np.uint64(WEIGHT_BITS) << np.uint64(WEIGHT_BITS)) | steps).tobytes())
                nodes = batch.column("digest").slice(first, len(out))
                yield pa.RecordBatch.from_arrays([nodes, pa.array(out, pa.binary())], names=["node", "features"])

    return pack


def _sketcher(size: int):
    """More samples of texts, from their packed features: four hash bits of each, sixteen samples in a long."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, places = _Sampler(size), np.uint64(4) * np.arange(16, dtype=np.uint64)
        for batch in batches:
            nodes, out = [], []
            texts: list[np.ndarray] = []
            held = 0

            def flush() -> None:
                nonlocal held
                if texts:
                    x = np.concatenate(texts)
                    weights = (x & np.uint64((1 << WEIGHT_BITS) - 1)).astype(np.float32) / WEIGHT_STEP
                    starts = np.cumsum([0] + [len(t) for t in texts[:-1]])
                    samples = sampler(x >> np.uint64(WEIGHT_BITS) << np.uint64(WEIGHT_BITS), weights, starts).view(np.uint32)
                    bits = ((samples * np.uint32(2654435769)) >> np.uint32(28)).astype(np.uint64)
                    out.append(np.bitwise_or.reduce(bits.reshape(len(texts), -1, 16) << places, axis=2).view(np.int64))
                    texts.clear()
                    held = 0

            for i, packed_row in enumerate(batch.column("features").to_pylist()):
                x = np.frombuffer(packed_row, np.uint64)
                if len(x):
                    nodes.append(i)
                    texts.append(x)
                    held += len(x)
                if held >= 1 << 15:
                    flush()
            flush()
            flat = np.concatenate(out).ravel() if out else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, size // 16, dtype=np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(nodes, pa.int64())), lists], names=["node", "sketch"])

    return sketch


def _sketch_agreement(a: str, b: str, size: int) -> Column:
    """In how many samples two sketches agree; unequal samples agree by chance in one of sixteen."""

    def unequal(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        z = z.bitwiseOR(F.shiftright(z, 1))
        return F.bit_count(z.bitwiseOR(F.shiftright(z, 2)).bitwiseAND(F.lit(0x1111111111111111)))

    return F.lit(size) - F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, n: s + n)


def _least_agreement(samples: int, chance: float, deviations: float) -> int:
    """The agreements below which a pair that agrees in a sample with this probability stays so many standard deviations too rarely."""
    return math.floor(samples * chance - deviations * math.sqrt(samples * chance * (1 - chance)))


def weighted_jaccard(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    mask = np.uint64((1 << WEIGHT_BITS) - 1)
    wx, wy = (x & mask).astype(np.float64), (y & mask).astype(np.float64)
    _, i, j = np.intersect1d(x >> np.uint64(WEIGHT_BITS), y >> np.uint64(WEIGHT_BITS), assume_unique=True, return_indices=True)
    both = np.minimum(wx[i], wy[j]).sum()
    union = wx.sum() + wy.sum() - both
    return float(both / union) if union else 0.0


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
        alike = pa.array([weighted_jaccard(x, y) for x, y in zip(left, right)], pa.float64())
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), alike], names=["a", "b", "similarity"])


def _verified(pairs: DataFrame, features: DataFrame, threshold: float) -> DataFrame:
    """pairs: a, b. Those that reach the threshold, with their similarity."""
    left = features.select(F.col("node").alias("a"), F.col("features").alias("left"))
    right = features.select(F.col("node").alias("b"), F.col("features").alias("right"))
    full = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return full.mapInArrow(_compare, "a binary, b binary, similarity double").where(F.col("similarity") >= threshold)


def _ordered(pairs: DataFrame, *more: str) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), *more)


def _labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs with the labels of both nodes; a node without links is its own label."""
    of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    out = pairs.join(of_a, "a", "left").join(of_b, "b", "left")
    return out.withColumn("la", F.coalesce("la", "a")).withColumn("lb", F.coalesce("lb", "b"))


def _merged(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Labels after further links: only the labels they join are worked on."""
    joined = materialize(components(_labelled(found, labels).select(F.col("la").alias("a"), F.col("lb").alias("b"))), "joined")
    own = labels.unionByName(joined.select("node", F.col("node").alias("label"))).dropDuplicates(["node"])
    moved = joined.select(F.col("node").alias("label"), F.col("label").alias("new"))
    return materialize(own.join(moved, "label", "left").select("node", F.coalesce("new", "label").alias("label")), "labels")


def _relabelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _links(signed: DataFrame, feature_table, threshold: float) -> DataFrame:
    """Verified links (a, b, similarity) whose components are those of all candidate pairs."""
    keys = F.array(*[
        F.xxhash64(F.lit(i), *[F.get("samples", F.lit(ROWS * i + j)) for j in range(ROWS)]) for i in range(BANDS)
    ])
    # Ranks hashed with the bucket: another leader in each band.
    keyed = signed.select("node", keys.alias("keys"))
    rows = keyed.select("node", F.explode("keys").alias("bucket")).withColumn("rank", F.xxhash64("node", "bucket"))
    buckets = rows.groupBy("bucket").agg(F.min("rank").alias("least"), F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = materialize(rows.join(buckets.drop("members"), "bucket"), "buckets")
    leaders = shared.where("rank = least").select("bucket", F.col("node").alias("b"))
    pairs = _ordered(shared.where("rank != least").select("bucket", F.col("node").alias("a")).join(leaders, "bucket")).distinct()
    pairs = materialize(pairs, "pairs")
    features = feature_table(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    links = materialize(_verified(pairs, features, threshold), "verified")

    # Buckets of several components: who else could be linked?
    labels = materialize(components(links), "labels")
    placed = _relabelled(shared.select("node", "bucket"), labels)
    sizes = placed.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("bucket").agg(F.max(F.struct("n", "label"))["label"].alias("largest"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    placed = materialize(placed.join(mixed, "bucket"), "mixed")
    features = feature_table(placed.select("node").distinct())

    # First the best linked text of each bucket, which stands in the middle of its group.
    degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    ranked = placed.join(degree, "node", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    middle = ranked.groupBy("bucket").agg(F.max(F.struct("degree", "node", "label")).alias("m"))
    near = ranked.join(middle, "bucket").where(F.col("label") != F.col("m.label"))
    batch = _ordered(near.select(F.col("node").alias("a"), F.col("m.node").alias("b"))).distinct().join(pairs, ["a", "b"], "left_anti")
    batch = materialize(batch, "middle")
    tested = pairs.unionByName(batch)
    found = materialize(_verified(batch, features, threshold), "verified")
    links, labels = links.unionByName(found), _merged(labels, found)

    # Then all pairs whose samples leave the threshold likely. The samples of the bands, which all texts have, tell which texts need a
    # short sketch, as they have a likely partner, and short sketches which need a long one.
    placed = _relabelled(placed.drop("label", "largest"), labels)
    largest = placed.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(
        F.max(F.struct("n", "label"))["label"].alias("largest"), F.count(F.lit(1)).alias("labels")
    ).where("labels > 1").drop("labels")
    placed = materialize(placed.join(largest, "bucket").join(signed.select("node", "samples", keys.alias("keys")), "node"), "placed")

    def sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        names = [c for c in rows.columns if c != "largest"]
        return rows.where("label != largest").select(*[F.col(c).alias(f"a_{c}") for c in names]), rows.select(
            *[F.col(c).alias(f"b_{c}") for c in names], "largest"
        )

    # A pair is looked at in the first of its buckets only.
    first = F.get("a_keys", (F.array_position(F.zip_with("a_keys", "b_keys", lambda x, y: x == y), True) - 1).cast("int"))
    agree = F.size(F.filter(F.zip_with("a_samples", "b_samples", lambda x, y: x == y), lambda x: x))
    met = (
        (F.col("a_bucket") == F.col("b_bucket")) & (F.col("a_label") != F.col("b_label"))
        & ((F.col("b_label") == F.col("largest")) | (F.col("a_node") < F.col("b_node"))) & (F.col("a_bucket") == first)
        & (agree >= _least_agreement(BANDS * ROWS, threshold, 5))
    )
    likely, rows = met, placed
    for size, deviations in SKETCHES:
        a, b = sides(rows)
        needed = a.join(b, likely, "left_semi").select(F.col("a_node").alias("node")).union(b.join(a, likely, "left_semi").select("b_node"))
        needed = materialize(needed.distinct(), "needed")
        sketches = features.join(needed, "node", "left_semi").mapInArrow(_sketcher(size), "node binary, sketch array<bigint>")
        rows = materialize(placed.join(sketches, "node"), "sketches")
        agree = _sketch_agreement("a_sketch", "b_sketch", size)
        likely = met & (agree >= _least_agreement(size, threshold + (1 - threshold) / 16, deviations))
    a, b = sides(rows)
    open_pairs = a.join(b, likely).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"), agree.alias("agree"))
    open_pairs = _ordered(open_pairs, "agree").distinct().join(tested, ["a", "b"], "left_anti")
    open_pairs = materialize(open_pairs, "open")
    each = 4
    while not open_pairs.isEmpty():
        best = Window.partitionBy("a").orderBy(F.desc("agree"), "b")
        batch = open_pairs.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= each).select("a", "b")
        batch = materialize(batch, "batch")
        found = materialize(_verified(batch, features, threshold), "verified")
        links, labels = links.unionByName(found), _merged(labels, found)
        rest = _labelled(open_pairs.join(batch, ["a", "b"], "left_anti"), labels)
        open_pairs = materialize(rest.where(F.col("la") != F.col("lb")).select("a", "b", "agree"), "open")
        each *= 8
    return links


def near_duplicate_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per document: doc_id, class_id, n_links (of its text, to other texts, as far as they were needed), kept, digest."""
    weights = slot_weights(docs, text)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), _digest(text).alias("digest"))
    listed = materialize(rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "digest"), "listed")
    signed = rows.select("digest", "text").mapInArrow(_signer(weights), "node binary, samples array<int>")
    signed = materialize(signed.dropDuplicates(["node"]), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
    owners = listed.groupBy("digest").agg(first.alias("owner"))

    def feature_table(nodes: DataFrame) -> DataFrame:
        wanted = nodes.join(owners, nodes["node"] == owners["digest"]).select("node", F.col("owner.doc_id").alias("own"))
        texts = rows.join(wanted, (F.col("digest") == F.col("node")) & F.col("doc_id").eqNullSafe(F.col("own")))
        packed_rows = texts.select("digest", "text").mapInArrow(_featurer(weights), "node binary, features binary")
        return materialize(packed_rows.dropDuplicates(["node"]), "features")

    links = materialize(_links(signed, feature_table, threshold), "links")
    labels = components(links)
    degrees = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    nodes = (
        owners.join(labels, F.col("digest") == labels["node"], "left").select("digest", "owner", F.coalesce("label", "digest").alias("label"))
    )
    classes = nodes.groupBy("label").agg(F.min("owner").alias("head"))
    nodes = materialize(nodes.select("digest", "label").join(classes, "label").join(degrees, F.col("digest") == F.col("node"), "left")
                        .select("digest", "head", F.coalesce("n_links", F.lit(0)).alias("n_links")), "nodes")
    return listed.join(nodes, "digest").select(
        "doc_id", F.col("head.doc_id").alias("class_id"), "n_links", (F.col("rid") == F.col("head.rid")).alias("kept"), "digest"
    )


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that stay, one of each class, with all their columns."""
    kept = near_duplicate_classes(docs, key, text, threshold).where("kept").select(F.col("doc_id").alias("own"), F.col("digest").alias("of"))
    rows = packed(docs).select("rec", F.col(f"rec.{key}").alias("key"), F.unhex(F.md5(F.coalesce(F.col(f"rec.{text}").cast("string"), F.lit("")))).alias("digest"))
    stay = rows.join(kept, (F.col("digest") == F.col("of")) & F.col("key").eqNullSafe(F.col("own")))
    nth = F.row_number().over(Window.partitionBy("digest").orderBy("key"))
    return stay.withColumn("nth", nth).where("nth = 1").select("rec.*")
