"""Languages of documents as mixtures.

Learning: letter trigrams (a letter with its two neighbours, case folded, any non-letter as one border sign) are counted per
language in 2^16 hashed slots over all training rows; the counts are summed by Spark and smoothed to probabilities.

Prediction: each trigram of a text is drawn from one of the text's languages; expectation-maximisation estimates their shares. Languages are
then tried as a set, in the order of their shares in the full mixture: a further language is kept if the likelihood gains more than
the penalty of a parameter (half the logarithm of the text's trigrams, times `penalty`). Overlapping trigrams repeat
themselves, so the log-likelihood counts a third. The prediction is the language with the largest share of the selected set; its score
is that share times its posterior probability among the learned languages.

Tasks read the table of probabilities: 2^16 slots for each learned language, whatever the number of documents.

Defined cases: a text that is null or has no letter is `und` with score 0; with nothing to learn from, all are `und`; a row without
doc_id counts as the empty one in the split; repeated rows get equal results and count twice in learning; an empty table gives an
empty result; further columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.llm.arrays import text_chunks

SLOTS = 1 << 16
ROUNDS = 12


def held_out(key: str = "doc_id") -> Column:
    """The rows that nothing is learned from: a third, by the checksum of their key."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 3 == 1


@functools.cache
def _folded() -> np.ndarray:
    """Lower case of each letter's code point; 0 for all that is no letter."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def trigram_slots(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all letters' trigrams of a run of texts, and where each text's begin (one more than texts)."""
    text = raw.tobytes().decode("utf-8", "replace")
    codes = _folded()[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)]
    lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    starts = np.minimum(lead[offsets], len(codes))
    codes = np.insert(codes, starts, 0)  # a border before and after each text
    at = np.flatnonzero(codes)
    firsts = np.searchsorted(at, starts + np.arange(len(starts)))
    wide = codes.astype(np.uint64)
    with np.errstate(over="ignore"):
        mixed = wide[at - 1] * np.uint64(0x9E3779B97F4A7C15) ^ wide[at] * np.uint64(0xC2B2AE3D27D4EB4F) ^ wide[at + 1] * np.uint64(0x165667B19E3779F9)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(48)).astype(np.int64), firsts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for row, offsets, raw in text_chunks(batch.column("text")):
            slots, firsts = trigram_slots(offsets, raw)
            names = np.array(langs[row:row + len(firsts) - 1])
            of_letter = np.repeat(np.arange(len(names)), np.diff(firsts))
            for lang in set(names.tolist()):
                totals.setdefault(lang, np.zeros(SLOTS, np.int64))
                totals[lang] += np.bincount(slots[(names == lang)[of_letter]], minlength=SLOTS)
    for lang, counts in totals.items():
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(counts[used])], names=["lang", "slot", "n"]
        )


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    probability: np.ndarray  # languages x slots


def learn_languages(rows: DataFrame, text: str = "text", lang: str = "lang", smoothing: float = 0.05) -> LanguageModel:
    """From all rows with a language; those without text teach nothing."""
    labelled = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    labelled = labelled.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    counted = labelled.mapInArrow(_count, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    names = tuple(sorted(counted["lang"].unique()))
    counts = np.full((len(names), SLOTS), smoothing)
    index = {name: i for i, name in enumerate(names)}
    counts[counted["lang"].map(index).to_numpy(dtype=np.int64), counted["slot"].to_numpy(dtype=np.int64)] += counted["n"].to_numpy()
    return LanguageModel(names, (counts / counts.sum(axis=1, keepdims=True)).astype(np.float32) if names else counts)


def fit_shares(p: np.ndarray, times: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Shares and log-likelihood of a mixture. p: components x trigrams."""
    shares = np.full(len(p), 1.0 / len(p))
    for _ in range(rounds if len(p) > 1 else 0):
        mixed = shares @ p
        shares = shares * (p @ (times / mixed)) / times.sum()
    return shares, float(np.log(shares @ p) @ times)


def infer(slots: np.ndarray, model: LanguageModel, penalty: float = 1.0) -> tuple[dict[int, float], float]:
    """Shares of the selected languages (by their number), and the posterior probability of the first one."""
    seen = np.bincount(slots, minlength=SLOTS)
    used = np.flatnonzero(seen)
    times, p = seen[used].astype(np.float64), model.probability[:, used].astype(np.float64)
    alone = np.log(p) @ times / 3
    posterior = np.exp(alone - alone.max())
    posterior /= posterior.sum()
    shares, _ = fit_shares(p, times)
    order = np.argsort(-shares, kind="stable")
    order = np.concatenate([[np.argmax(alone)], order[order != np.argmax(alone)]]).astype(np.int64)
    chosen, best, chosen_shares = order[:1], float(alone[order[0]]), np.ones(1)
    cost = penalty * 0.5 * np.log(times.sum() + 1)
    for lang in order[1:]:
        tried = np.append(chosen, lang)
        new_shares, likelihood = fit_shares(p[tried], times)
        if likelihood / 3 - best > cost:
            chosen, best, chosen_shares = tried, likelihood / 3, new_shares
    top = chosen[np.argmax(chosen_shares)]
    sure = posterior[top] if len(chosen) == 1 else max(posterior[top], float(chosen_shares.max()))
    return {int(c): float(s) for c, s in zip(chosen, chosen_shares)}, float(sure)


def _predictor(model: LanguageModel, penalty: float):
    shares_type = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, offsets, raw in text_chunks(batch.column("text")):
                slots, firsts = trigram_slots(offsets, raw)
                langs, scores, mixtures = [], [], []
                for i in range(len(firsts) - 1):
                    own = slots[firsts[i]:firsts[i + 1]]
                    if not len(own) or not model.languages:
                        langs.append("und")
                        scores.append(0.0)
                        mixtures.append([])
                        continue
                    mixture, sure = infer(own, model, penalty)
                    top = max(mixture, key=mixture.get)
                    langs.append(model.languages[top])
                    scores.append(min(1.0, max(0.0, mixture[top] * sure)))
                    mixtures.append([{"lang": model.languages[c], "share": s} for c, s in mixture.items()])
                keys = [batch.column(c).slice(row, len(langs)) for c in ("doc_id", "held_out")]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(mixtures, shares_type)],
                    names=["doc_id", "held_out", "lang_pred", "score", "shares"],
                )

    return predict


def identify_languages(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text", penalty: float = 1.0) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, shares (of the selected languages)."""
    rows = docs.select(F.col(key).alias("doc_id"), held_out(key).alias("held_out"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double, shares array<struct<lang: string, share: double>>"
    return rows.mapInArrow(_predictor(model, penalty), schema)
