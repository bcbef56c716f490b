from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, count: int, vocabulary: int = 5000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(count))


@pytest.fixture(scope="session")
def corpus(spark):
    """Random texts, copies, near copies, a passage in several texts, nulls, empty and very long texts, repeated rows."""
    rng = random.Random(7)
    texts: list[str | None] = [words(rng, rng.randrange(3, 300)) for _ in range(120)]
    passage = words(rng, 120)
    for i in range(0, 40, 4):
        texts[i] = f"{texts[i]} {passage} {words(rng, 20)}"
    for i in range(12):
        texts.append(texts[3 * i])
        near = texts[50 + i].split(" ")
        near[len(near) // 2] = "changed"
        texts.append(" ".join(near))
    texts += [None, None, "", "", " ", "\n\n", "ab", "a" * 3000, "né ünï \n日本語 テキスト 😀 " * 30, words(rng, 40_000)]
    rows = [(i, t, None if i % 9 == 0 else ("en", "fr")[i % 2], (None, "b", "a", "c")[i % 4], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "no key", "en", "a", 6), (None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark):
    """Columns with names that the operators use themselves."""
    names = "rec key digest keep nth kept times bits own of node label text_sha256 rid size score evidence shard"
    columns = ", ".join(f"{n} string" for n in names.split())
    rows = [(i, t, "en", s, None, *["x"] * len(names.split())) for i, (t, s) in enumerate(
        [("one two three four five six", "a"), ("one two three four five six", "b"), (None, None), ("other words here", "a")])]
    return spark.createDataFrame(rows, f"{SCHEMA}, {columns}")
