"""Toxicity by the nearest labelled examples.

Learning, from a bounded sample of labelled rows (`examples` of them, those whose keys hash lowest, and of these no more than hold
`example_bytes` of text): the terms of a text are its lower-cased words and their first four, five and six letters, as 48-bit
hashes. All terms count, in examples and in texts: a vector is the unit vector of (1 + ln tf) idf times the term's emphasis.
Document frequencies are counted over all documents; those of terms of no example, which only count in the length of a text, in SLOTS
slots by hash. The emphasis is 1, or, for terms that speak for the label (chi square, significant at one in a thousand, and four times
as frequent in toxic examples), the root of chi square over that quantile: it weighs terms and leaves none out. Without it, the
neighbours of a text are those that share its common words, and most toxic texts are missed (README has figures).

Search: exact cosines, over an inverted index in blocks of 64 examples. The COMMON most frequent terms have their lists as columns of
a table, with the maximum of each block; the postings of all other terms are summed first. What the common terms can add in a
block is bounded by the sum of query weights times maxima, and by the lengths of both parts. The two best blocks of a query give a
first k-th best cosine; of the others only those are opened whose bound reaches it. Candidates are scored again in double
precision, so the k neighbours are exact, ties going to the first example. Texts are searched many at a time, block by block.

Scores: neighbours vote with 1 / (distance + 0.05); votes are mapped to probabilities by an isotonic fit of the examples' own
leave-one-out votes. A text that shares no term with an example has no neighbour; its score is that of a vote of nothing, averaged with
the labels of the examples without neighbour. The evidence is the nearest examples with their labels and cosines.

The driver holds one number per term of the examples, and the examples' terms packed as tasks made them; it neither unpacks them nor
builds the index. Tasks get both by broadcast, which `examples` and `example_bytes` bound, and build the index once per worker.

Defined cases: null and empty texts have no terms; without any labelled row every score is 0; a row without doc_id counts as the empty
key in the split; labels without value are not read, and of several labels of a key the largest holds; the first example counts
however long it is; repeated rows get equal scores; an empty table gives an empty result; further columns are carried along by
`drop_toxic`.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystone.llm.arrays import mix, powers, text_chunks
from tallystone.llm.common import packed, whole_text
from tallystone.llm.language_id import _folded, held_out
from tallystone.session import materialize

EXAMPLES, EXAMPLE_BYTES, NEIGHBOURS, BLOCK, COMMON = 20_000, 1 << 28, 15, 64, 2048
SLOTS = 1 << 20  # of the document frequencies of terms that no example has
SIGNIFICANT, LEAST_ROWS = 10.83, 5  # fixed value: the 0.999 quantile of chi square with one degree of freedom
LEAST_LIFT = 4  # how much more often a term must occur in toxic examples
THRESHOLD = 0.7
PREFIXES = (4, 5, 6)
CHUNK, MANY = 1 << 19, 128  # bytes of text whose terms are found at once, queries searched at once
WORD = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x8CB92BA72F3D8DD7)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PREFIX = np.uint64(0x5851F42D4C957F2D)


def word_counts(text: str | None) -> Counter:
    return Counter(WORD.findall(text.lower())) if text else Counter()


def terms_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


@functools.lru_cache(maxsize=4)
def _power_table(bits: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(_BASE, 1 << bits), powers(_INVERSE, 1 << bits)


def chunk_terms(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a run of at most 65,536 texts: text, term and how often it occurs, by text, then term."""
    codes = _folded()[np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), dtype=np.uint32)]
    lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    borders = np.minimum(lead[offsets], len(codes))
    codes = np.insert(codes, borders, 0)  # a border before and after each text
    borders = borders + np.arange(len(borders))
    power, inverse = _power_table(max(12, int(len(codes)).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[: len(codes)])])
        inside = codes > 0
        begin = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        own = (np.searchsorted(borders, begin, side="right") - 1).astype(np.uint64) << np.uint64(48)

        def keys(at: np.ndarray, first: np.ndarray, last: np.ndarray, salt: np.uint64) -> np.ndarray:
            return at | (mix((sums[last] - sums[first]) * inverse[first] + salt) >> np.uint64(16))

        words, first, times = np.unique(keys(own, begin, end, np.uint64(0)), return_index=True, return_counts=True)
        begin, length, own = begin[first], (end - begin)[first], own[first]
        parts, counts = [words], [times]
        for n in PREFIXES:
            long = length >= n
            parts.append(keys(own[long], begin[long], begin[long] + n, _PREFIX))
            counts.append(times[long])
    key, times = np.concatenate(parts), np.concatenate(counts)
    order = np.argsort(key)
    key, times = key[order], times[order]
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    times = np.add.reduceat(times, heads) if len(key) else times
    key = key[heads]
    return (key >> np.uint64(48)).astype(np.int64), (key & np.uint64((1 << 48) - 1)).astype(np.int64), times


def term_id(term: str) -> int:
    """The hash of a word, or of first letters written with a star."""
    raw = np.frombuffer(term.rstrip("*").encode(), np.uint8)
    ids = chunk_terms(np.array([0, len(raw)]), raw)[1]
    with np.errstate(over="ignore"):
        codes = _folded()[np.frombuffer(term.rstrip("*").encode("utf-32-le"), np.uint32)].astype(np.uint64) + np.uint64(1)
        salt = _PREFIX if term.endswith("*") else np.uint64(0)
        found = int(mix(np.array([(codes * powers(_BASE, len(codes))).sum() + salt], np.uint64))[0] >> np.uint64(16))
    assert found in ids.tolist()
    return found


@dataclass(frozen=True)
class Vocabulary:
    """The sorted terms of the examples."""

    terms: np.ndarray

    def numbers(self, terms: np.ndarray) -> np.ndarray:
        """Numbers of terms; those of no example come after the vocabulary, by slot."""
        if not len(self.terms):
            return terms % SLOTS
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, len(self.terms) + terms % SLOTS)

    def number(self, term: str) -> int:
        return int(self.numbers(np.array([term_id(term)]))[0])


def _label_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch.column("label").to_numpy()
        for row, offsets, raw in text_chunks(batch.column("text"), CHUNK):
            text, term, _ = chunk_terms(offsets, raw)
            term, at = np.unique(term, return_inverse=True)
            toxic = np.bincount(at, weights=labels[row + text], minlength=len(term)).astype(np.int64)
            both = np.bincount(at, minlength=len(term))
            yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(both - toxic), pa.array(toxic)], names=["term", "n0", "n1"])


def _frequency(shared: Any):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        totals = np.zeros(len(vocabulary.terms) + SLOTS, np.int64)
        for batch in batches:
            for _, offsets, raw in text_chunks(batch.column("text"), CHUNK):
                text, term, _ = chunk_terms(offsets, raw)
                numbers = vocabulary.numbers(term)
                # Two terms of a text in one slot count once.
                slots = numbers >= len(vocabulary.terms)
                several = np.unique((text[slots] << 32) | numbers[slots]) & ((1 << 32) - 1)
                totals += np.bincount(np.concatenate([numbers[~slots], several]), minlength=len(totals))
        used = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals[used])], names=["term", "n"])

    return count


class BlockMaxIndex:
    """Examples as unit vectors (pairs of term numbers and weights, iterated twice), searched exactly by cosine."""

    def __init__(self, vectors: Iterable[tuple[np.ndarray, np.ndarray]], terms: int, block: int = BLOCK, common: int = COMMON) -> None:
        rows_of = np.zeros(terms, np.int64)
        self.size = 0
        for term, _ in vectors:
            rows_of[term] += 1
            self.size += 1
        most = np.sort(np.argsort(-rows_of, kind="stable")[:common])
        self.block, self.terms, self.blocks = block, terms, -(-self.size // block)
        self.common = np.full(terms, -1, np.int32)
        self.common[most] = np.arange(len(most))
        self.table = np.zeros((self.blocks * block, len(most)), np.float32)
        # Postings of the other terms, by term, then example.
        rows_of[most] = 0
        self.begin = np.concatenate([[0], np.cumsum(rows_of)])
        self.row, self.weight = np.zeros(self.begin[-1], np.int32), np.zeros(self.begin[-1], np.float32)
        free = self.begin[:-1].copy()
        for i, (term, weight) in enumerate(vectors):
            place = self.common[term]
            other = place < 0
            self.table[i, place[~other]] = weight[~other]
            at = free[term[other]]
            self.row[at], self.weight[at] = i, weight[other]
            free[term[other]] += 1
        part = np.sqrt(np.einsum("ij,ij->i", self.table, self.table, dtype=np.float64)) * (1 + 1e-6)
        shape = (self.blocks, block)
        self.peak = self.table.reshape(*shape, -1).max(axis=1) if self.size else self.table
        self.reach = part.reshape(shape).max(axis=1) if self.size else part

    def search(self, term: np.ndarray, weight: np.ndarray, k: int, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the k nearest examples with a positive cosine, best first. `but`: an example to leave out."""
        return self.search_many([(term, weight)], k, [but])[0]

    def search_many(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, but: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        if not self.size:
            return [(np.zeros(0, np.int64), np.zeros(0))] * len(queries)
        if len(queries) > MANY:
            parts = range(0, len(queries), MANY)
            return [x for i in parts for x in self.search_many(queries[i:i + MANY], k, but[i:i + MANY] if but is not None else None)]
        n, width = len(queries), self.blocks * self.block
        known, dense = np.zeros((n, width)), np.zeros((n, self.table.shape[1]))
        for q, (term, weight) in enumerate(queries):
            place = self.common[term]
            other = place < 0
            dense[q, place[~other]] = weight[~other]
            rare, own = term[other], weight[other]
            begin, end = self.begin[rare], self.begin[rare + 1]
            many = end - begin
            at = np.arange(many.sum()) + np.repeat(begin - np.cumsum(many) + many, many)
            known[q] = np.bincount(self.row[at], weights=self.weight[at] * np.repeat(own, many), minlength=width)
            if but is not None and but[q] >= 0:
                known[q, but[q]] = -np.inf
        light = dense.astype(np.float32)
        more = np.minimum(light @ self.peak.T * (1 + 1e-5), np.outer(np.sqrt(np.einsum("ij,ij->i", dense, dense)), self.reach)) + 1e-6
        bounds = known.reshape(n, self.blocks, self.block).max(axis=2) + more
        near = np.full((n, width), -1.0, np.float32)

        def fill(wanted: np.ndarray) -> None:
            for b in np.flatnonzero(wanted.any(axis=0)).tolist():
                of, part = np.flatnonzero(wanted[:, b]), slice(b * self.block, (b + 1) * self.block)
                near[of, part] = known[of, part] + light[of] @ self.table[part].T

        opened = np.zeros((n, self.blocks), bool)
        first = min(self.blocks, max(2, -(-k // self.block) + 1))
        np.put_along_axis(opened, np.argpartition(-bounds, first - 1, axis=1)[:, :first], True, axis=1)
        fill(opened)
        seen = near.reshape(n, self.blocks, self.block)[opened].reshape(n, -1)
        least = np.partition(seen, -k, axis=1)[:, -k] if seen.shape[1] >= k else np.full(n, -1.0)
        fill(~opened & (bounds > 0) & (bounds >= least[:, None] - 1e-5))
        out = []
        for q in range(n):
            at = np.flatnonzero(near[q, : self.size] >= max(-1e-5, least[q] - 1e-5))
            if len(at) > k:
                cosines = near[q, at]
                at = at[cosines >= np.partition(cosines, -k)[-k] - 1e-5]
            # Rounded, so that equal examples tie.
            scores = np.round(known[q, at] + self.table[at] @ dense[q], 12)
            at, scores = at[scores > 0], scores[scores > 0]
            best = np.lexsort((at, -scores))[:k]
            out.append((at[best], scores[best]))
        return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit of y over x by pooling neighbours: points of a step-wise linear map. Each pool counts half a row of the
    overall rate, so that no pool is certain."""
    order = np.argsort(x, kind="stable")
    rate = y.mean()
    pools: list[list[float]] = []  # sum, count, sum of x
    for v, t in zip(x[order].tolist(), y[order].tolist()):
        pools.append([t, 1.0, v])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    table = np.array(pools)
    values = (table[:, 0] + 0.5 * rate) / (table[:, 1] + 0.5)
    return table[:, 2] / table[:, 1], np.maximum.accumulate(values)


@dataclass(frozen=True)
class Scales:
    """By term number: idf (then of the slots of further terms) and emphasis."""

    idf: np.ndarray
    emphasis: np.ndarray

    def vectors(self, offsets: np.ndarray, raw: np.ndarray, vocabulary: Vocabulary) -> list[tuple[np.ndarray, np.ndarray]]:
        """The unit vectors of a run of texts, without the places of terms that no example has."""
        text, term, times = chunk_terms(offsets, raw)
        numbers = vocabulary.numbers(term)
        weight = (1.0 + np.log(times)) * self.idf[numbers]
        own = numbers < len(self.emphasis)
        weight[own] *= self.emphasis[numbers[own]]
        count = len(offsets) - 1
        size = np.sqrt(np.bincount(text, weights=weight * weight, minlength=count))
        text, numbers, weight = text[own], numbers[own], weight[own]
        weight /= size[text]
        ends = np.searchsorted(text, np.arange(count + 1))
        return [(numbers[a:b], weight[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist())]


@dataclass(frozen=True)
class ToxicityModel:
    vocabulary: Vocabulary
    scales: Scales
    labels: np.ndarray
    keys: list
    calibration: tuple[np.ndarray, np.ndarray]
    base: float  # the score of a text that shares no term with an example
    sent: tuple = field(default=(), repr=False, compare=False)  # broadcasts of the vocabulary and of the examples

    @property
    def idf(self) -> np.ndarray:
        return self.scales.idf

    @property
    def emphasis(self) -> np.ndarray:
        return self.scales.emphasis


class PackedExamples:
    """The examples' vectors as tasks packed them; becomes an index where a broadcast of it is read."""

    def __init__(self, scales: Scales, table: pa.Table) -> None:
        self.scales, self.table = scales, table

    def __reduce__(self) -> tuple:
        return _examined, (self.scales, self.table)

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for numbers, times in zip(self.table["numbers"], self.table["times"]):
            number = np.cumsum(_unpack(numbers.as_buffer()), dtype=np.int64)
            weight = (1.0 + np.log(_unpack(times.as_buffer()))) * self.scales.idf[number] * self.scales.emphasis[number]
            yield number, (weight / np.sqrt(weight @ weight) if len(weight) else weight).astype(np.float32)


def _examined(scales: Scales, table: pa.Table) -> tuple[Scales, BlockMaxIndex, np.ndarray, list]:
    index = BlockMaxIndex(PackedExamples(scales, table), max(1, len(scales.emphasis)))
    return scales, index, table["label"].to_numpy().astype(np.float64), table["doc_id"].to_pylist()


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers below 2^32, by byte position, which compresses better."""
    return zlib.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack(sent: Any) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(sent), np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def _to_packed(shared: Any, scales: Any, common: np.ndarray):
    """Numbers (as steps) and times of each example's terms, and its two heaviest common terms."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, own_scales = shared.value, scales.value
        is_common = np.zeros(len(vocabulary.terms), bool)
        is_common[common] = True
        for batch in batches:
            for row, offsets, raw in text_chunks(batch.column("text"), CHUNK):
                count = len(offsets) - 1
                text, term, times = chunk_terms(offsets, raw)
                number = vocabulary.numbers(term)
                ends = np.searchsorted(text, np.arange(count + 1)).tolist()
                numbers, many, lead = [], [], []
                for a, b in zip(ends, ends[1:]):
                    own = number[a:b]
                    numbers.append(_pack(np.diff(own, prepend=0)))
                    many.append(_pack(times[a:b]))
                    often = is_common[own]
                    weight = (1.0 + np.log(times[a:b][often])) * own_scales.idf[own[often]] * own_scales.emphasis[own[often]]
                    lead.append(own[often][np.argsort(-weight, kind="stable")[:2]].tolist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(row, count), batch.column("label").slice(row, count), pa.array(lead, pa.list_(pa.int64())),
                     pa.array(numbers, pa.binary()), pa.array(many, pa.binary())], names=["doc_id", "label", "lead", "numbers", "times"],
                )

    return pack


def _vote(labels: np.ndarray, cosines: np.ndarray) -> float:
    strength = 1.0 / (np.maximum(0.0, 1.0 - cosines) + 0.05)
    return float(labels @ strength / strength.sum())


def sample_examples(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, examples: int, example_bytes: int
) -> DataFrame:
    """doc_id, label and text of the examples, written."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    known = known.groupBy(F.col(key).alias("own")).agg(F.max((F.col(label) > 0).cast("int")).alias("label"))
    present = docs.select(F.col(key).alias("at")).distinct()
    chosen = known.join(present, F.col("own") == F.col("at"), "left_semi").orderBy(F.xxhash64("own"), "own").limit(examples)
    chosen = materialize(chosen, "chosen")
    rows = docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("own")  # `examples` rows at most
    )
    # A key with several rows gives one example, its first text.
    sample = materialize(rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "examples")
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")  # over `examples` numbers at most
    sizes = sample.select("doc_id", F.octet_length("text").cast("long").alias("size"))
    fitting = sizes.withColumn("before", F.sum("size").over(order) - F.col("size")).where((F.col("before") == 0) | (F.col("before") + F.col("size") <= example_bytes))
    return sample.join(F.broadcast(materialize(fitting.select("doc_id"), "fitting")), "doc_id", "left_semi")


def learn_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    examples: int = EXAMPLES, example_bytes: int = EXAMPLE_BYTES,
) -> ToxicityModel:
    """From labelled rows that are not held out."""
    context = docs.sparkSession.sparkContext
    sample = sample_examples(docs, labels, key, text, label, examples, example_bytes)
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    counted = sample.select("text", "label").mapInArrow(_label_counts, "term long, n0 long, n1 long")
    counted = counted.groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    terms, of0, of1 = (counted[c].to_numpy() for c in ("term", "n0", "n1"))
    del counted
    order = np.argsort(terms)
    vocabulary, of0, of1 = Vocabulary(terms[order]), of0[order], of1[order]
    common = np.argsort(-(of0 + of1), kind="stable")[:COMMON]
    shared = context.broadcast(vocabulary)

    texts = docs.select(F.col(text).cast("string").alias("text"))
    frequency = texts.mapInArrow(_frequency(shared), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    times = np.zeros(len(vocabulary.terms) + SLOTS)
    times[frequency["term"].to_numpy()] = frequency["n"].to_numpy()
    del frequency
    scales = Scales(np.log((1.0 + docs.count()) / (1.0 + times)) + 1.0, _emphasis(of1.astype(float), of0.astype(float), n1, n0))
    del times, of0, of1

    kind = docs.schema[key].dataType.simpleString()
    packed_rows = sample.select("doc_id", "label", "text").mapInArrow(
        _to_packed(shared, context.broadcast(scales), common), f"doc_id {kind}, label int, lead array<long>, numbers binary, times binary"
    )
    # Examples with the same heaviest common terms stand together, so that block maxima are of use. A row per example.
    table = packed_rows.orderBy("lead", "label", F.col("doc_id").cast("string")).drop("lead").toArrow()
    labels_of, keys = table["label"].to_numpy().astype(np.float64), table["doc_id"].to_pylist()
    examined = context.broadcast(PackedExamples(scales, table))
    del table
    votes = sample.select("doc_id", "text").mapInArrow(_own_votes(shared, examined), "nth long, vote double").toArrow()
    voted = np.full(len(keys), np.nan)
    voted[votes["nth"].to_numpy()] = votes["vote"].to_numpy()
    rate = n1 / (n0 + n1) if n0 + n1 else 0.0
    alone = np.isnan(voted)
    fit = isotonic(voted[~alone], labels_of[~alone]) if (~alone).any() else (np.array([0.0]), np.array([rate]))
    base = (labels_of[alone].sum() + float(np.interp(0.0, *fit))) / (int(alone.sum()) + 1)
    return ToxicityModel(vocabulary, scales, labels_of, keys, fit, float(base), (shared, examined))


def _emphasis(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """By term: 1, or more for terms that speak for the label. a, b: toxic and other examples that have it."""
    miss = (n1 - a) * b - (n0 - b) * a
    chi = (n0 + n1) * miss * miss / (float(max(1, n0)) * float(max(1, n1)) * (a + b) * np.maximum(1.0, n0 + n1 - a - b))
    telling = (a + b >= LEAST_ROWS) & (a * n0 > LEAST_LIFT * b * n1)
    return np.where(telling, np.sqrt(np.maximum(1.0, chi / SIGNIFICANT)), 1.0)


def _own_votes(shared: Any, examined: Any):
    """The votes of the other examples on each example that has neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, (scales, index, labels, keys) = shared.value, examined.value
        number = {k: i for i, k in enumerate(keys)}
        for batch in batches:
            of = [number[k] for k in batch.column("doc_id").to_pylist()]
            nth, votes = [], []
            for row, offsets, raw in text_chunks(batch.column("text"), CHUNK):
                queries = scales.vectors(offsets, raw, vocabulary)
                own = of[row:row + len(queries)]
                for i, (found, cosines) in zip(own, index.search_many(queries, NEIGHBOURS, own)):
                    if len(found):
                        nth.append(i)
                        votes.append(_vote(labels[found], cosines))
            yield pa.RecordBatch.from_arrays([pa.array(nth, pa.int64()), pa.array(votes, pa.float64())], names=["nth", "vote"])

    return run


def _scorer(model: ToxicityModel, kind: pa.DataType, evidence: int):
    (shared, examined), calibration, base = model.sent, model.calibration, model.base
    evidence_type = pa.list_(pa.struct([("doc_id", kind), ("label", pa.int32()), ("cosine", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, (scales, index, labels, keys) = shared.value, examined.value
        for batch in batches:
            for row, offsets, raw in text_chunks(batch.column("text"), CHUNK):
                scores, proof = [], []
                for found, cosines in index.search_many(scales.vectors(offsets, raw, vocabulary), NEIGHBOURS):
                    score = float(np.interp(_vote(labels[found], cosines), *calibration)) if len(found) else base
                    scores.append(min(1.0, max(0.0, score)))
                    near = list(zip(found.tolist(), cosines.tolist()))[:evidence]
                    proof.append([{"doc_id": keys[i], "label": int(labels[i]), "cosine": c} for i, c in near])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rec").slice(row, len(scores)), pa.array(scores, pa.float64()), pa.array(proof, evidence_type)],
                    names=["rec", "score", "evidence"],
                )

    return run


def _scored(rows: DataFrame, model: ToxicityModel, key_type: str, evidence: int) -> DataFrame:
    """rows: rec and text. Adds score and evidence, without the text."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    kind = to_arrow_type(_parse_datatype_string(key_type))
    record = rows.schema["rec"].dataType.simpleString()
    schema = f"rec {record}, score double, evidence array<struct<doc_id: {key_type}, label: int, cosine: double>>"
    return rows.select("rec", "text").mapInArrow(_scorer(model, kind, evidence), schema)


def predicted(score: str = "score", threshold: float = THRESHOLD) -> Column:
    return (F.col(score) >= threshold).cast("int")


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text", evidence: int = 3
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, evidence (the nearest examples)."""
    rows = docs.select(
        F.struct(F.col(key).alias("doc_id"), held_out(key).alias("held_out")).alias("rec"), F.col(text).cast("string").alias("text")
    )
    scored = _scored(rows, model, docs.schema[key].dataType.simpleString(), evidence)
    return scored.select("rec.*", "score", predicted().alias("predicted"), "evidence")


def drop_toxic(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    rows = packed(docs).select("rec", F.col(f"rec.{text}").cast("string").alias("text"))
    scored = _scored(rows, model, docs.schema[key].dataType.simpleString(), 0)
    return scored.where(F.col("score") < THRESHOLD).select("rec.*")
