"""Repeated passages, Merkle manifests and whitening against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystone.llm import manifest, passage_dedup, queries, whitening
from tests.llm.conftest import SCHEMA, words

# passages


def brute_passages(rows, length):
    least: dict = {}
    cut = [(k if k is not None else float("inf"), (t or "").encode().split()) for k, t in rows]
    for k, w in cut:
        for i in range(len(w) - length + 1):
            s = tuple(w[i:i + length])
            least[s] = min(k, least.get(s, k))
    for (key, _), (k, w) in zip(rows, cut):
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if least[tuple(w[i:i + length])] < k:
                gone[i:i + length] = [True] * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        yield key, len(w), sum(gone), spans, b" ".join(x for x, g in zip(w, gone) if not g).decode()


def passages(docs, **more):
    return Counter((r.doc_id, r.n_words, r.n_removed, len(r.spans), r.kept) for r in passage_dedup.remove_passages(docs, **more).collect())


def test_passages_are_removed(corpus, spark):
    rng = random.Random(3)
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect() if len(r.text or "") < 30_000]
    unit = words(rng, 300).split()
    for size in (49, 50, 51, 75, 100, 137):
        part = " ".join(unit[:size])
        rows.append((1000 + size, f"{words(rng, 30)} {part} {words(rng, 10)} {part}"))
        rows.append((5000 - size, f"{words(rng, size)}\n{' '.join(unit[60:60 + size])}"))
    rows += [(6000, "a " * 120), (6001, "a " * 49), (6002, "b a " * 60), (6003, "a b " * 80), (6004, "a b\t" * 70)]
    changed = list(unit)
    changed[100], changed[180] = "x", "y"
    rows += [(6005, " ".join(changed)), (6006, " ".join(unit)), (6006, " ".join(unit)), (7, " ".join(unit[120:260])), (None, " ".join(unit))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for length in (50, 7, 1):
        assert passages(docs, length=length) == Counter(brute_passages(rows, length))


def test_common_passage_in_many_texts(spark):
    rng = random.Random(4)
    common = words(rng, 70)
    rows = [(i, f"{words(rng, 20)} {common} {words(rng, 20)}") for i in range(400)]
    got = passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == Counter(brute_passages(rows, 50)) and sum(r[2] >= 70 for r in got) == 399


def test_runs_in_segments(monkeypatch):
    rng = np.random.default_rng(5)
    sequence = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    firsts = np.array([0, 40, 40, 1700, 3000])
    whole = passage_dedup.runs_of(sequence, firsts, 50)
    monkeypatch.setattr(passage_dedup, "SEGMENT", 600)
    parts = passage_dedup.runs_of(sequence, firsts, 50)
    spread = [{(t, s): (a, g) for t, f, la, a, g in zip(*(x.tolist() for x in r[:5])) for s in range(f, la + 1)} for r in (whole, parts)]
    assert spread[0] == spread[1] and len(spread[0]) == 1611 + 1251


def test_passage_edges(no_rows, clashing):
    assert passage_dedup.remove_passages(no_rows).collect() == []
    assert all(r.n_removed == 0 for r in passage_dedup.remove_passages(clashing).collect())


# manifest

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """Root and each node's path."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for i in range(len(paths)):
            run, place = nodes[at[i] // 8 * 8:at[i] // 8 * 8 + 8], at[i] % 8
            paths[i].append(("".join(run[:place]), "".join(run[place + 1:])))
        nodes = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
        at = [a // 8 for a in at]
    return nodes[0], paths


def brute_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r["lang"] is not None, (r["lang"] or "").encode())].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r.values()), r["doc_id"]))
    made = {g: (sorted(x[:3] for x in m), sorted(m, key=lambda x: x[:3])) for g, m in sorted(groups.items())}
    roots = {g: climb([x[2] for x in m[0]]) for g, m in made.items()}
    root, upper = climb([r[0] for r in roots.values()])
    for (g, m), up in zip(made.items(), upper):
        subroot, paths = roots[g]
        for x, path in zip(m[1], paths):
            yield x[3], x[2], subroot, root, tuple(path + up)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def check_manifest(docs):
    rows = [{c: r[c] for c in COLUMNS} for r in docs.collect()]
    got = manifest.manifest(docs, changed={"text": F.concat("text", F.lit("?"))})
    got = got.withColumn("own", manifest.folded(F.col("leaf"), F.col("path"))).withColumn("other", manifest.folded(F.col("changed_leaf"), F.col("path")))
    out = got.collect()
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple((p.before, p.after) for p in r.path)) for r in out) == Counter(brute_manifest(rows))
    assert all(r.own == r.root for r in out)
    assert all((r.other == r.root) == (r.changed_leaf == r.leaf) for r in out)
    return out


def test_manifest(corpus, no_rows, clashing):
    check_manifest(corpus)
    check_manifest(clashing)
    assert manifest.manifest(no_rows).collect() == []


@pytest.mark.parametrize("sizes", [(1,), (8,), (9,), (65,), (513, 1, 8, 4097), (1,) * 70 + (2,) * 5])
def test_manifest_of_sizes(spark, sizes):
    rows = [(g * 10_000 + i, f"t{i % 7}", f"é{g}", None, i) for g, n in enumerate(sizes) for i in range(n)]
    check_manifest(spark.createDataFrame(rows, SCHEMA).repartition(6))


def test_manifest_of_repeated_rows(spark):
    rows = [(5, "same", None, "a", 4)] * 700 + [(4, "other", None, "a", 5), (6, None, "en", None, None)]
    check_manifest(spark.createDataFrame(rows, SCHEMA).repartition(3))


# whitening

def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(1)
    for size in (1, 2, 5, 12):
        a = rng.standard_normal((size, size))
        a = a + a.T
        for shift in (-3.0, 0.0, 0.7, 40.0):
            assert whitening.inertia(a, shift)[0] == (np.linalg.eigvalsh(a) > shift).sum()
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0)[0] == 1


@pytest.mark.parametrize("values", [
    np.linspace(1, 30, 30), np.r_[np.ones(5), np.full(9, 2.0), np.zeros(6)], np.r_[1e-3, 1e6, 1e6 + 1e-3, np.ones(10)], np.r_[3.0], np.zeros(4),
])
def test_contour_integration(spark, values):
    turn = np.linalg.qr(np.random.default_rng(2).standard_normal((len(values), len(values))))[0]
    v = (turn * values) @ turn.T
    found, vectors = whitening.feast(spark, (v + v.T) / 2, 8)
    want = np.sort(values[values > 0])[::-1][:8]
    assert np.allclose(found, want, rtol=1e-9, atol=1e-9)
    assert np.allclose(vectors.T @ vectors, np.eye(len(want)), atol=1e-9)
    assert np.allclose(v @ vectors, vectors * found, atol=1e-9 * max(1.0, values.max()))


def brute_whitening(vectors):
    x = np.array([[int(np.floor(1024 * float(np.float64(c)))) + 100_000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    middle = (x - s[0] // n).astype(float)
    middle -= middle.mean(axis=0)
    v = middle.T @ middle / n
    e, turn = np.linalg.eigh(v)
    deviation = [int(d) for d in ((n * x - s) ** 2).sum(axis=1)]
    return n, deviation, e[::-1], (middle @ turn[:, ::-1]) / np.sqrt(np.maximum(e[::-1], 1e-300)), np.trace(v)


def test_whitening(spark):
    rng = np.random.default_rng(7)
    vectors = (rng.standard_normal((300, 12)) * np.linspace(0.1, 3, 12)).astype(np.float32).tolist()
    rows = [(i, v, 0) for i, v in enumerate(vectors)] + [(0, vectors[0], 1), (None, vectors[1], 1)]
    bad = [None, [], [None] * 12, [float("nan")] * 12, [1.0] * 11 + [float("inf")], [1.0] * 5, [3.0e38] * 12]
    table = spark.createDataFrame(rows + [(900 + i, b, 0) for i, b in enumerate(bad)], "vec_id long, embedding array<float>, component int").repartition(5)
    got = whitening.whiten(table).toPandas()
    n, deviation, e, z, trace = brute_whitening([r[1] for r in rows])
    assert len(got) == 8 * len(rows) and set(got["n"]) == {n} and got["identity_error"].nunique() == 1
    assert got["identity_error"].iloc[0] < 1e-9
    keys = [r[0] for r in rows]
    for c in range(1, 9):
        one = got[got["component"] == c]
        assert np.allclose(one["explained"], e[c - 1] / trace, rtol=1e-9)
        near = [sorted(zip(k.fillna(-1), d, s * w)) for k, d, w in [(one["vec_id"], one["deviation"], one["whitened"])] for s in (1, -1)]
        want = sorted((-1 if k is None else k, d, w) for k, d, w in zip(keys, deviation, z[:, c - 1]))
        assert any(np.allclose(np.array(x, dtype=float), np.array(want, dtype=float), atol=1e-8) for x in near)
    assert sorted(one["deviation"]) == sorted(deviation)


def test_large_entries_are_exact(spark):
    rng = np.random.default_rng(8)
    vectors = (rng.standard_normal((40, 3)) * 1e9).tolist()
    got = whitening.whiten(spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")).toPandas()
    n, deviation, e, _, trace = brute_whitening(vectors)
    assert np.allclose(got.groupby("component")["explained"].first(), e / trace, rtol=1e-9)
    assert got["deviation"].isna().all() and max(deviation) > 1 << 63


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).collect() == []
    two = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 2.0])], schema)).collect()
    assert sorted((r.vec_id, r.component, abs(round(r.whitened, 9))) for r in two) == [(1, 1, 1.0), (2, 1, 1.0)]


# the registered queries

def test_registered_queries(spark, tmp_path, corpus):
    corpus.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
    got = queries.QUERIES["op11_passage_dedup"](spark, str(tmp_path)).collect()
    want = Counter((k, n, gone, h(kept)) for k, n, gone, _, kept in brute_passages(rows, 50))
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
    done = queries.QUERIES["op12_manifest"](spark, str(tmp_path)).collect()
    by = {(r.doc_id, r.leaf): r for r in done}
    for key, own, subroot, root, path in brute_manifest([{c: r[c] for c in COLUMNS} for r in corpus.collect()]):
        r = by[key, own]
        assert (r.subroot, r.root, r.proof_sha256) == (subroot, root, h(*(b + a for b, a in path)))
        assert r.verified == (r.folded_root == root)
