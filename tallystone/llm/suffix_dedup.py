"""Removal of byte strings that occur twice, by bucket-pointer refinement of sampled suffixes.

Every string of `length` bytes holds an anchor: the leftmost of its q-grams (32 bytes) with the least hash. A string is the
suffix at its start cut to `length`; its anchor orders it into a bucket, and equal strings have equal anchors at equal
distance. So the start positions of a text fall into runs with the same anchor, some 180 long, and only anchors are bucketed
over all texts.

1. Initial buckets: the bucket identifier of a q-gram is made by doubling, from the identifiers at a position and at a later offset.
2. First refinement: in a bucket, runs are told apart by the identifier of their whole context (from the first start to the
   end of the last string). Contexts that occur twice are done: all strings of the run are repeated. Buckets with one context
   of one occurrence are dropped.
3. Second refinement, for buckets with several contexts, one representative of each: blocks of 32 starts are bucketed by the
   identifier of the bytes that all strings of the block share. A block that is alone in its bucket is dropped.
4. Last refinement: for the blocks that are left, the identifier of each whole string is doubled from the identifiers of its parts
   at later offsets, so that the updates of one refinement serve the next. Strings in a bucket of several are repeated.

Identifiers are 64-bit hashes, always compared together with that of the anchor's q-gram: 128 bits.

Contexts with exact copies meet by partial aggregation, so neither a much copied text nor a common passage forms a large
group; every join and aggregation is on narrow rows. Texts are joined by digest twice: to fetch the contexts
of representatives, and to cut the texts.

Defined cases: a null text is empty; a text shorter than `length` keeps all its bytes; repeated rows are copies of each other, so
that all their bytes go if they are long enough; an empty table gives an empty result; null keys stay; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.llm.arrays import mix, powers, text_chunks
from tallystone.llm.common import whole_text
from tallystone.session import materialize

LENGTH, GRAM = 400, 32
SEGMENT = 1 << 19
_BASE = np.uint64(0xA24BAED4963EE407)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def doubled(ids: np.ndarray, offset: int) -> np.ndarray:
    """Identifiers of twice the length (or less, if offset is smaller): pairs of the identifiers here and at a later offset."""
    with np.errstate(over="ignore"):
        x = ids[:-offset] * np.uint64(0x9FB21C651E98DF25) + ids[offset:]
        x = x ^ (x >> np.uint64(32))
        return x * np.uint64(0xD6E8FEB86659FD93)


def gram_ids(data: np.ndarray, length: int, ids: np.ndarray | None = None, known: int = 1) -> np.ndarray:
    """Bucket identifiers of all substrings of a length, by doubling."""
    if ids is None:
        with np.errstate(over="ignore"):
            ids = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD)
    while known < length:
        offset = min(known, length - known)
        ids = doubled(ids, offset)
        known += offset
    return ids


def runs_of(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """first, last start, anchor, q-gram identifier and context identifier of each run of starts with a common anchor."""
    window = length - GRAM + 1
    firsts, lasts, anchors, grams = [], [], [], []
    for begin in range(0, len(data) - length + 1, SEGMENT):
        part = data[begin:begin + SEGMENT + length - 1]
        ids = gram_ids(part, GRAM)
        count = len(part) - length + 1
        keys = (mix(ids) & ~np.uint64((1 << 20) - 1)) | np.arange(len(ids), dtype=np.uint64)
        size = -(-len(keys) // window) * window
        padded = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[:len(keys)] = keys
        blocks = padded.reshape(-1, window)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:count], ahead[window - 1:window - 1 + count])
        at = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
        turn = np.flatnonzero(np.diff(at)) + 1
        first = np.concatenate([[0], turn])
        firsts.append(first + begin)
        lasts.append(np.concatenate([turn, [count]]) - 1 + begin)
        anchors.append(at[first] + begin)
        grams.append(ids[at[first]])
    first, last, anchor, gram = map(np.concatenate, (firsts, lasts, anchors, grams))
    with np.errstate(over="ignore"):
        power = powers(_BASE, len(data) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1])])
        # The inverse power of the start, by the power of what is left up to the end.
        end = last + length
        context = (sums[end] - sums[first]) * power[len(data) - first]
        context = mix(context + mix((anchor - first).astype(np.uint64) * np.uint64(1 << 20) + (end - first).astype(np.uint64)))
    return first, last, anchor, gram, context


def _scan(length: int):
    names = ["digest", "first", "last", "anchor", "gram", "context"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, raw in text_chunks(batch.column("text")):
                owners, parts = [], []
                for i in range(len(offsets) - 1):
                    if offsets[i + 1] - offsets[i] >= length:
                        runs = runs_of(raw[offsets[i]:offsets[i + 1]], length)
                        owners.append(np.full(len(runs[0]), row + i))
                        parts.append(runs)
                if parts:
                    columns = [np.concatenate(c) for c in zip(*parts)]
                    numbers = [pa.array(c.astype(np.int32)) for c in columns[:3]]
                    hashes = [pa.array(c.view(np.int64)) for c in columns[3:]]
                    digests = batch.column("digest").take(pa.array(np.concatenate(owners)))
                    yield pa.RecordBatch.from_arrays([digests, *numbers, *hashes], names=names)

    return scan


KIND = "gram long, context long, digest binary, first int, last int, anchor int"


def _cut_contexts(length: int):
    """Bytes of the context of each run that a text is asked for."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column("runs")
            for row, offsets, raw in text_chunks(batch.column("text")):
                part = runs.slice(row, len(offsets) - 1)
                asked = part.flatten()
                counts = np.diff(part.offsets.to_numpy())
                owner = np.repeat(np.arange(len(counts)), counts)
                first, last = asked.field("first").to_numpy(), asked.field("last").to_numpy()
                begin, end = offsets[owner] + first, offsets[owner] + last + length
                data = raw.tobytes()
                cuts = pa.array([data[a:b] for a, b in zip(begin.tolist(), end.tolist())], pa.binary())
                digests = batch.column("digest").take(pa.array(row + owner))
                yield pa.RecordBatch.from_arrays(
                    [asked.field("gram"), asked.field("context"), digests, asked.field("first"), asked.field("last"),
                     asked.field("anchor"), cuts],
                    names=["gram", "context", "digest", "first", "last", "anchor", "bytes"],
                )

    return cut


def _blocks(length: int, width: int, within: int):
    """The blocks of `width` starts of each context: identifiers of the bytes common to their strings, and of the bytes
    of all their strings together where all starts of the block are in the run. `within`: width of the blocks listed in
    `open` (0: all starts)."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, raw in text_chunks(batch.column("bytes"), 1 << 19):
                count = len(offsets) - 1
                first, last, anchor = (batch.column(c).slice(row, count).to_numpy().astype(np.int64) for c in ("first", "last", "anchor"))
                near, far = anchor - last, anchor - first  # distances of the starts from the anchor
                if within:
                    lists = batch.column("open").slice(row, count)
                    number = np.diff(lists.offsets.to_numpy())
                    listed = lists.flatten().to_numpy().astype(np.int64)
                    owner = np.repeat(np.arange(count), number)
                    low = np.maximum(listed * within, near[owner]) // width
                    high = np.minimum(listed * within + within - 1, far[owner]) // width
                else:
                    owner, low, high = np.arange(count), near // width, far // width
                sizes = high - low + 1
                owner = np.repeat(owner, sizes)
                block = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)
                # Distance d starts at byte (far - d) of the context.
                base = offsets[owner] + far[owner]
                shared = length - width + 1
                common = gram_ids(raw, shared)
                a = common[base - block * width]
                with np.errstate(over="ignore"):
                    salt = mix(block.astype(np.uint64) * np.uint64(64) + np.uint64(width))
                    a = mix(a ^ salt)
                    whole = (block * width >= near[owner]) & (block * width + width - 1 <= far[owner])
                    b = np.zeros(len(a), np.uint64)
                    if whole.any():
                        union = common if width == 1 else gram_ids(raw, length + width - 1, common, shared)
                        b[whole] = mix(union[(base - block * width - width + 1)[whole]] ^ salt[whole])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(row, count).take(pa.array(owner)) for c in ("gram", "context")]
                    + [pa.array(block.astype(np.int32)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64), mask=~whole)],
                    names=["gram", "context", "block", "common", "whole"],
                )

    return split


def _refined(contexts: DataFrame, length: int, width: int, opened: DataFrame | None, within: int) -> tuple[DataFrame, DataFrame | None]:
    """Repeated blocks (gram, context, block), and the blocks to refine: those that share their common bytes."""
    table = contexts if opened is None else contexts.join(
        opened.groupBy("gram", "context").agg(F.collect_list("block").alias("open")), ["gram", "context"]
    )
    # A run has at most `length` starts, so its list of blocks is short.
    rows = table.mapInArrow(_blocks(length, width, within), "gram long, context long, block int, common long, whole long")
    rows = materialize(rows, f"blocks{width}")
    several = (
        rows.where(F.col("whole").isNotNull()).groupBy("gram", "whole")
        .agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("lead")).where("n > 1").select("gram", "whole", "lead")
    )
    rows = materialize(rows.join(several, ["gram", "whole"], "left"), "marked")
    repeated = rows.where(F.col("lead").isNotNull()).select("gram", "context", "block")
    if width == 1:
        return repeated, None
    # Repeated blocks stay as partners of those that are not, one for each.
    waiting = F.max(F.col("lead").isNull())
    groups = rows.groupBy("gram", "common").agg(F.count(F.lit(1)).alias("n"), waiting.alias("waiting")).where("n > 1 AND waiting")
    partners = rows.where(F.col("lead").isNull() | (F.col("lead") == F.col("context")))
    opened = partners.join(groups, ["gram", "common"], "left_semi").select("gram", "context", "block")
    return repeated, materialize(opened, "open")


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """digest (MD5 of the text) and spans (first byte, end) of repeated strings of texts; spans may overlap."""
    rows = docs.select(F.unhex(F.md5(whole_text(text))).alias("digest"), F.col(text).cast("string").alias("text"))
    runs = materialize(
        rows.mapInArrow(_scan(length), "digest binary, first int, last int, anchor int, gram long, context long"), "runs"
    )
    kinds = materialize(
        runs.groupBy("gram", "context").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("digest", "first", "last", "anchor")).alias("one")
        ).select("gram", "context", "n", "one.*"), "kinds",
    )
    mixed = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("gram")
    mixed = materialize(kinds.join(mixed, "gram", "left_semi"), "mixed")

    # Contexts that occur twice: all starts of their runs.
    twice = kinds.where("n > 1").select("gram", "context")
    full = runs.join(twice, ["gram", "context"], "left_semi").select("digest", "first", "last")

    # One text of each digest serves its contexts; a text is asked for a bounded share of its own length.
    asked = mixed.groupBy("digest").agg(F.collect_list(F.struct("gram", "context", "first", "last", "anchor")).alias("runs"))
    given = rows.join(asked, "digest").mapInArrow(_cut_contexts(length), f"{KIND}, bytes binary")
    contexts = materialize(given.dropDuplicates(["gram", "context"]), "contexts")
    parts, opened, within = [], None, 0
    for width in (32, 4, 1):
        repeated, opened = _refined(contexts, length, width, opened, within)
        parts.append(repeated.select("gram", "context", (F.col("block") * width).alias("near"), (F.col("block") * width + width - 1).alias("far")))
        within = width
    found = parts[0].unionByName(parts[1]).unionByName(parts[2])
    single = found.join(mixed.where("n = 1"), ["gram", "context"]).select(
        "digest", (F.col("anchor") - F.col("far")).alias("first"), (F.col("anchor") - F.col("near")).alias("last")
    )
    every = full.unionByName(single).distinct()
    spans = every.groupBy("digest").agg(F.collect_list(F.struct("first", (F.col("last") + length).alias("end"))).alias("spans"))
    return materialize(spans, "spans")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for row, offsets, raw in text_chunks(batch.column("text")):
            lists = batch.column("spans").slice(row, len(offsets) - 1).to_pylist()
            removed, merged, kept = [], [], []
            for i, spans in enumerate(lists):
                data = raw[offsets[i]:offsets[i + 1]]
                if not spans:
                    removed.append(0)
                    merged.append([])
                    kept.append(data.tobytes())
                    continue
                change = np.zeros(len(data) + 1, dtype=np.int32)
                np.add.at(change, [s["first"] for s in spans], 1)
                np.add.at(change, [s["end"] for s in spans], -1)
                gone = np.cumsum(change[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                removed.append(int(gone.sum()))
                merged.append([{"first": int(a), "end": int(b)} for a, b in turns.reshape(-1, 2)])
                kept.append(data[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(row, len(lists)), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()),
                 pa.array(merged, span), pa.array(kept, pa.large_binary()).cast(pa.binary())], names=names,
            )


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, spans (maximal removed runs) and kept (the bytes left)."""
    spans = repeated_spans(docs, text, length)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), F.unhex(F.md5(whole_text(text))).alias("digest"))
    both = rows.join(spans, "digest", "left").select("doc_id", "text", "spans")
    schema = f"doc_id {kind}, n_bytes long, n_removed long, spans array<struct<first: long, end: long>>, kept binary"
    return both.mapInArrow(_cut, schema)
