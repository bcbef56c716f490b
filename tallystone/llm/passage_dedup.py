"""Removal of passages of `length` words that an earlier document holds, by level-wise doubling of repeated windows.

Windows are compared at a quarter, a half and the whole of `length` (13, 26 and 50 words). Only windows that repeat at one
level, in documents with different keys, are extended to twice that length (to `length` at last); the search ends where none
is left.

1. First length. Every window of `length` words is stood for by one of its 13-word windows, the leftmost with the least hash: equal
   windows by equal ones, at equal distance. Windows that follow each other mostly share it, so a text gives one row, a run,
   for some 20 words. Runs whose 13 words are in one document only are dropped.
2. Runs that are equal as a whole (from their first start to the end of their last window) are settled together: of their documents
   the smallest keeps its words, all others lose them. One run stands for them in what follows, and only where the same 13
   words stand in several different runs.
3. Doubled length. A run is extended to the 26 words that its windows have in common, to the right of its first 13 words or around them.
   Runs that share no such window with another document are dropped.
4. Whole length. Each window of the runs that are left is compared; where it is in a smaller document too, its words go.

Identifiers are 64-bit hashes, always compared together with the hash of the first 13 words.

All groups are pre-aggregated, so much copied texts and passages that many documents share meet as few rows; their own rows learn
the outcome from a broadcast of at most 1,024 frequent keys, all others by a join. Texts are joined twice by narrow keys: for the words of the runs to extend, and to cut them.

Defined cases: a null text has no words; texts shorter than `length` words keep all; a null key counts as greater than any other;
rows with equal keys are not earlier than each other, so repeated rows stay; repeats within one document stay; an empty
table gives an empty result; further columns are not read. The key is a whole number.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.llm.arrays import WordHasher, mix, powers, text_chunks
from tallystone.llm.common import join_split
from tallystone.session import materialize

LENGTH = 50
SEGMENT = 1 << 20
_LAST = (1 << 63) - 1
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def levels(length: int) -> list[int]:
    """The lengths of the levels, from a quarter of `length` by doubling."""
    out = [-(-length // 4)]
    while out[-1] < length:
        out.append(min(length, 2 * out[-1]))
    return out


def doubled_windows(words: np.ndarray, length: int) -> np.ndarray:
    """Identifiers of all windows of a length, each made of two of half the length (overlapping, if it is no power of two)."""
    known = 1
    while known < length and len(words) > 0:
        offset = min(known, length - known)
        with np.errstate(over="ignore"):
            words = mix(words[:-offset] * np.uint64(0x9FB21C651E98DF25) + words[offset:]) if offset < len(words) else words[:0]
        known += offset
    return words


class _Sums:
    """Identifiers of stretches of any length of a sequence, by differences of prefix sums."""

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        self._inverse = _powers_to(n)[1]
        with np.errstate(over="ignore"):
            self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers_to(n)[0][:n])])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self._sums[end] - self._sums[start]) * self._inverse[start] + (end - start).astype(np.uint64))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _power_table(max(16, int(n).bit_length()))


@functools.lru_cache(maxsize=4)
def _power_table(bits: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(_BASE, 1 << bits), powers(_INVERSE, 1 << bits)


def runs_of(words: np.ndarray, firsts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of a sequence of texts whose words begin at `firsts` (one more than texts): text, first and last start, place of the
    first-level window, all counted within the text, its identifier and that of the whole run."""
    gram = levels(length)[0]
    span = length - gram + 1
    empty = tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    if len(words) < length:
        return empty
    owner = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    found = []
    for begin in range(0, len(words) - length + 1, SEGMENT):
        part = words[begin:begin + SEGMENT + length - 1]
        ids = doubled_windows(part, gram)
        count = len(part) - length + 1
        starts = np.arange(begin, begin + count)
        inside = owner[starts] == owner[starts + length - 1]
        keys = (mix(ids) & ~np.uint64((1 << 22) - 1)) | np.arange(len(ids), dtype=np.uint64)
        size = -(-len(keys) // span) * span
        padded = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[:len(keys)] = keys
        blocks = padded.reshape(-1, span)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:count], ahead[span - 1:span - 1 + count])
        at = (least & np.uint64((1 << 22) - 1)).astype(np.int64)
        starts, at = starts[inside], at[inside]
        if not len(starts):
            continue
        turn = np.flatnonzero((np.diff(at) != 0) | (np.diff(starts) != 1) | (np.diff(owner[starts]) != 0)) + 1
        head = np.concatenate([[0], turn])
        tail = np.concatenate([turn, [len(starts)]]) - 1
        found.append((starts[head], starts[tail], at[head] + begin, ids[at[head]]))
    if not found:
        return empty
    first, last, anchor, grams = (np.concatenate(c) for c in zip(*found))
    with np.errstate(over="ignore"):
        whole = mix(_Sums(words)(first, last + length) + mix((anchor - first).astype(np.uint64)))
    text = owner[first]
    base = firsts[text]
    return text, first - base, last - base, anchor - base, grams, whole


def _scan(length: int):
    names = ["ord", "rid", "first", "last", "anchor", "gram", "whole"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for row, offsets, raw in text_chunks(batch.column("text")):
                text, first, last, anchor, gram, whole = runs_of(*hasher(offsets, raw), length)
                if len(text):
                    numbers = [pa.array(c.astype(np.int32)) for c in (first, last, anchor)]
                    keys = [batch.column(c).take(pa.array(text + row)) for c in ("ord", "rid")]
                    yield pa.RecordBatch.from_arrays([*keys, *numbers, pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64))], names=names)

    return scan


def _cut_words(length: int):
    """The hashes of the words of each run that a text is asked for."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            runs = batch.column("runs")
            for row, offsets, raw in text_chunks(batch.column("text"), 1 << 20):
                words, firsts = hasher(offsets, raw)
                part = runs.slice(row, len(offsets) - 1)
                asked = part.flatten()
                owner = np.repeat(np.arange(len(part)), np.diff(part.offsets.to_numpy()))
                first, last, anchor = (asked.field(c).to_numpy().astype(np.int64) for c in ("first", "last", "anchor"))
                data = words.tobytes()
                begin, end = (firsts[owner] + first) * 8, (firsts[owner] + last + length) * 8
                cuts = pa.array([data[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [asked.field("gram"), asked.field("whole"), batch.column("ord").take(pa.array(row + owner)),
                     pa.array((anchor - last).astype(np.int32)), pa.array((anchor - first).astype(np.int32)), cuts],
                    names=["gram", "whole", "ord", "near", "far", "words"],
                )

    return cut


def _extend(length: int, size: int):
    """Windows of `size` words of each run. The starts of windows of `length` words are told by their distance from the
    first-level window; a window of `size` words stands for as many distances as have it in common, its slot."""
    width = length - size + 1

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, raw in text_chunks(batch.column("words"), 1 << 20):
                count = len(offsets) - 1
                near, far = (batch.column(c).slice(row, count).to_numpy().astype(np.int64) for c in ("near", "far"))
                low, high = near // width, far // width
                owner = np.repeat(np.arange(count), high - low + 1)
                slot = np.arange(len(owner)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1) + low[owner]
                # A slot serves the distances from slot * width on, of which the run may have only the later ones.
                open_at = batch.column("slots").slice(row, count) if "slots" in batch.schema.names else None
                if open_at is not None:
                    number = np.diff(open_at.offsets.to_numpy())
                    within = batch.column("within").slice(row, count).to_numpy().astype(np.int64)
                    listed = open_at.flatten().to_numpy().astype(np.int64)
                    of = np.repeat(np.arange(count), number)
                    known = np.unique(of * (1 << 20) + listed)
                    keep = np.isin(owner * (1 << 20) + slot * width // within[owner], known) | np.isin(
                        owner * (1 << 20) + np.minimum(slot * width + width - 1, far[owner]) // within[owner], known
                    )
                    owner, slot = owner[keep], slot[keep]
                words = raw.view(np.uint64) if len(raw) else np.zeros(0, np.uint64)
                start = offsets[owner] // 8 + far[owner] - slot * width
                with np.errstate(over="ignore"):
                    ids = doubled_windows(words, size)[start] if len(start) else np.zeros(0, np.uint64)
                columns = [batch.column(c).slice(row, count).take(pa.array(owner)) for c in ("gram", "whole", "ord")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(slot.astype(np.int32)), pa.array(ids.view(np.int64))], names=["gram", "whole", "ord", "slot", "id"]
                )

    return extend


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """ord (the key, null as the greatest), rid (xxhash64 of the text) and spans (first word, end) that an earlier document holds too;
    spans may overlap."""
    rows = _keyed(docs, key, text)
    schema = "ord long, rid long, first int, last int, anchor int, gram long, whole long"
    runs = materialize(rows.mapInArrow(_scan(length), schema), "runs")
    # First length.
    again = _shared_by(runs, ["gram"], "again")
    runs = materialize(join_split(runs, again, ["gram"], "n").drop("n", "lo"), "repeated")
    one = F.min(F.struct("ord", "rid", "first", "last", "anchor"))
    kinds = runs.groupBy("gram", "whole").agg(one.alias("one"), F.count(F.lit(1)).alias("n")).select("gram", "whole", "one.*", "n")
    kinds = materialize(kinds, "kinds")
    least = kinds.select("gram", "whole", F.col("ord").alias("least"), "n")
    marked = materialize(join_split(runs, least, ["gram", "whole"], "n").drop("n"), "marked")
    several = _shared_by(kinds, ["gram"], "several")
    left = materialize(join_split(kinds.drop("n"), several, ["gram"], "n").drop("n", "lo"), "left")
    asked = left.groupBy("ord", "rid").agg(F.collect_list(F.struct("gram", "whole", "first", "last", "anchor")).alias("runs"))
    given = rows.join(asked, ["ord", "rid"]).mapInArrow(
        _cut_words(length), "gram long, whole long, ord long, near int, far int, words binary"
    )
    runs_left = materialize(given.dropDuplicates(["gram", "whole"]), "words")
    table, found = runs_left, None
    for size in levels(length)[1:]:
        windows = table.mapInArrow(_extend(length, size), "gram long, whole long, ord long, slot int, id long")
        windows = materialize(windows, f"windows{size}")
        groups = _shared_by(windows, ["gram", "slot", "id"], "shared")
        met = join_split(windows, groups, ["gram", "slot", "id"], "n")
        if size == length:
            found = materialize(met.where("ord > lo").select("gram", "whole", F.col("slot").alias("distance")), "found")
            break
        slots = materialize(met.groupBy("gram", "whole").agg(F.collect_set("slot").alias("slots")), "slots")
        table = runs_left.join(slots, ["gram", "whole"]).withColumn("within", F.lit(length - size + 1))
        if slots.isEmpty():
            break
    later = marked.where("ord > least").select("ord", "rid", "first", "last")
    if found is not None:
        firsts = marked.where("ord = least").join(found, ["gram", "whole"])
        start = F.col("anchor") - F.col("distance")
        later = later.unionByName(firsts.select("ord", "rid", start.alias("first"), start.alias("last")))
    spans = later.distinct().groupBy("ord", "rid").agg(
        F.collect_list(F.struct("first", (F.col("last") + length).alias("end"))).alias("spans")
    )
    return materialize(spans, "spans")


def _shared_by(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Keys that rows of several documents have: how many rows have them, n, and the smallest document, lo."""
    groups = rows.groupBy(*keys).agg(F.min("ord").alias("lo"), F.max("ord").alias("hi"), F.count(F.lit(1)).alias("n"))
    return materialize(groups.where("lo < hi").drop("hi"), name)


def _ordinal(key: str) -> Column:
    return F.coalesce(F.col(key).cast("long"), F.lit(_LAST))


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    words = F.col(text).cast("string")
    return docs.select(_ordinal(key).alias("ord"), F.xxhash64(words).alias("rid"), words.alias("text"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        totals, removed, merged, kept = [], [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
            words = text.as_buffer().to_pybytes().split() if text.is_valid else []  # splits at the ASCII white space
            runs: list[list[int]] = []
            for first, end in sorted((s["first"], s["end"]) for s in spans or []):
                if runs and first <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], end)
                else:
                    runs.append([first, end])
            totals.append(len(words))
            for first, end in reversed(runs):
                del words[first:end]
            removed.append(totals[-1] - len(words))
            merged.append([{"first": a, "end": b} for a, b in runs])
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(merged, span),
             pa.array(kept, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "spans", "kept"],
        )


def remove_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans (maximal removed runs of words) and kept (the words left, joined
    by one space)."""
    spans = repeated_passages(docs, key, text, length)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), _ordinal(key).alias("ord"))
    rows = rows.withColumn("rid", F.xxhash64("text"))
    both = rows.join(spans, ["ord", "rid"], "left").select("doc_id", "text", "spans")
    return both.mapInArrow(_cut, f"doc_id {kind}, n_words long, n_removed long, spans array<struct<first: long, end: long>>, kept string")
