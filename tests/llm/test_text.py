"""Suffix and near dedup, language, toxicity, segmentations and the pipeline against brute force."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystone.llm import components, language_id, near_dedup, segmentation, suffix_dedup, toxicity
from tests.llm.conftest import SCHEMA, words

# suffix dedup


def brute_removed(texts, length):
    seen = Counter()
    for b in texts:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] += 1
    out = []
    for b in texts:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        out.append(gone)
    return out


def test_repeats_are_removed(corpus, spark):
    rng = random.Random(11)
    rows = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect() if len(r.text or "") < 30_000]
    # Repeats of just 399, 400 and 401 bytes, within a text, at its ends, overlapping, and of one byte.
    unit = words(rng, 200)
    for size in (399, 400, 401, 432):
        rows.append((1000 + size, unit[:size] + words(rng, 60) + unit[:size]))
        rows.append((2000 + size, words(rng, 60) + unit[50:50 + size]))
    rows += [(3000, "xy" * 210), (3001, "z" * 399), (3002, "z" * 400), (3003, unit), (3004, "é" * 250)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts = [(k, (t or "").encode()) for k, t in rows]
    want = Counter()
    for (k, b), gone in zip(texts, brute_removed([b for _, b in texts], 400)):
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        want[k, len(b), sum(gone), spans, kept] += 1
    got = suffix_dedup.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == want


def test_long_text_in_segments(monkeypatch):
    rng = random.Random(5)
    data = np.frombuffer("".join(rng.choice("ab ") for _ in range(4000)).encode(), np.uint8)
    whole = suffix_dedup.runs_of(data)
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 700)
    parts = suffix_dedup.runs_of(data)
    spread = [{s: (a, g) for f, la, a, g in zip(*(x.tolist() for x in r[:4])) for s in range(f, la + 1)} for r in (whole, parts)]
    assert spread[0] == spread[1]


def test_suffix_edges(no_rows, clashing):
    assert suffix_dedup.remove_repeats(no_rows).collect() == []
    assert all(r.n_removed == 0 for r in suffix_dedup.remove_repeats(clashing).collect())


# near dedup

def shingle_set(text):
    w = text.lower().split()
    k = min(5, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute_classes(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if rows[i][1] == rows[j][1] or (union and len(sets[i] & sets[j]) / union >= 0.8):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        groups[find(i)].append(key)
    return Counter(tuple(sorted(map(str, g))) for g in groups.values())


def test_near_duplicates(corpus):
    rows = [(r.doc_id, r.text or "") for r in corpus.collect()]
    got = near_dedup.near_duplicate_classes(corpus).collect()
    groups = defaultdict(list)
    for r in got:
        groups[r.class_id].append(r)
    assert Counter(tuple(sorted(str(r.doc_id) for r in g)) for g in groups.values()) == brute_classes(rows)
    assert all(sum(r.kept for r in g) == 1 for g in groups.values())
    stay = near_dedup.drop_near_duplicates(corpus)
    assert stay.columns == corpus.columns and stay.count() == len(groups)


def test_chain_of_near_copies_is_one_class(spark):
    rng = random.Random(2)
    text, rows = words(rng, 200).split(" "), []
    for i in range(30):
        rows.append((i, " ".join(text)))
        text[rng.randrange(200)] = f"new{i}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.class_id for r in near_dedup.near_duplicate_classes(docs).collect()} == {0}


def test_samples_agree_as_often_as_texts_are_alike():
    rng = random.Random(1)
    weights = np.full(1 << near_dedup.SLOT_BITS, 1.5, np.float32)
    base = np.array([rng.getrandbits(64) for _ in range(1000)], np.uint64)
    other = base.copy()
    other[:100] = [rng.getrandbits(64) for _ in range(100)]
    (h1, w1), (h2, w2) = near_dedup._features(base, weights), near_dedup._features(other, weights)
    sampler = near_dedup._Sampler(2000)
    both = sampler(np.concatenate([h1, h2]), np.concatenate([w1, w2]), np.array([0, len(h1)]))
    want = len(np.intersect1d(h1, h2)) / len(np.union1d(h1, h2))
    assert abs((both[0] == both[1]).mean() - want) < 0.04


def test_few_texts_below_the_threshold_are_compared(spark, monkeypatch):
    """All pairs of a group are some 0.72 alike: sketches rule most of them out before they are compared exactly."""
    shared = [f"w{i}" for i in range(300)]
    docs = spark.createDataFrame([(i, " ".join(shared + [f"own{i}x{j}" for j in range(33)])) for i in range(40)], "doc_id long, text string")
    seen, real = [], near_dedup.materialize

    def counting(df, name="step"):
        out = real(df, name)
        if name == "open":
            seen.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "materialize", counting)
    got = near_dedup.near_duplicate_classes(docs).collect()
    assert len({r.class_id for r in got}) == 40
    assert seen[0] < 40 * 39 / 2 / 5


def test_sketches_do_not_depend_on_their_neighbours(spark):
    rng, mask = random.Random(3), (1 << 64) - (1 << near_dedup.WEIGHT_BITS)
    sets = [sorted({rng.getrandbits(64) & mask | near_dedup.WEIGHT_STEP for _ in range(n)}) for n in (500, 1, 40_000, 3)]
    sets.append(sorted([*sets[0][:450], *(rng.getrandbits(64) & mask | near_dedup.WEIGHT_STEP for _ in range(50))]))
    rows = [(bytes([i]), np.array(x, np.uint64).tobytes()) for i, x in enumerate(sets)] + [(b"none", b"")]
    rows = spark.createDataFrame(rows, "node binary, features binary")
    sketch = near_dedup._sketcher(1024)
    together = rows.coalesce(1).mapInArrow(sketch, "node binary, sketch array<bigint>")
    alone = {bytes(r.node): r.sketch for r in rows.repartition(6, "node").mapInArrow(sketch, "node binary, sketch array<bigint>").collect()}
    assert {bytes(r.node): r.sketch for r in together.collect()} == alone and len(alone) == 5
    agree = near_dedup._sketch_agreement("a", "b", 1024).alias("n")
    pairs = spark.createDataFrame([(alone[b"\0"], alone[bytes([i])]) for i in (0, 4, 1)], "a array<bigint>, b array<bigint>")
    same, alike, other = [r.n for r in pairs.select(agree).collect()]
    assert same == 1024 and other < 130
    assert abs(alike / 1024 - (450 / 550 + 100 / 550 / 16)) < 0.06


def test_near_edges(no_rows, clashing):
    assert near_dedup.near_duplicate_classes(no_rows).collect() == []
    got = near_dedup.drop_near_duplicates(clashing)
    assert got.columns == clashing.columns and sorted(r.doc_id for r in got.collect()) == [0, 2, 3]


def test_components(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.label for r in got} == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# languages

LETTERS = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}


def invented(rng, lang, count):
    return " ".join("".join(rng.choice(LETTERS[lang]) for _ in range(rng.randrange(2, 8))) for _ in range(count))


def test_languages_and_mixtures(spark):
    rng = random.Random(4)
    rows = [(i, invented(rng, lang, rng.randrange(5, 60)), lang) for i in range(300) for lang in [("aa", "bb", "cc")[i % 3]]]
    rows += [(900, f"{invented(rng, 'aa', 60)} {invented(rng, 'bb', 30)}", None), (901, None, "aa"), (902, "12 --", "bb"), (903, "", "cc"), (904, "ABC ÄÖ" * 5000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language_id.learn_languages(docs.where(~language_id.held_out()))
    got = {r.doc_id: r for r in language_id.identify_languages(docs, model).collect()}
    assert model.languages == ("aa", "bb", "cc") and len(got) == len(rows)
    assert all(got[k].lang_pred == lang for k, _, lang in rows[:300]) and any(got[k].held_out for k in range(300))
    assert all(len(got[k].shares) == 1 for k in range(300))
    shares = {s.lang: s.share for s in got[900].shares}
    assert set(shares) == {"aa", "bb"} and abs(shares["aa"] - 2 / 3) < 0.08 and got[900].lang_pred == "aa"
    assert {got[k].lang_pred for k in (901, 902, 903)} == {"und"} and got[904].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_set_is_the_best_of_all_sets():
    """Against every set of languages, fitted with many rounds; one language may have a hundredth of the letters."""
    rng = np.random.default_rng(4)
    tables = rng.dirichlet(np.full(300, 0.05), 4) + 1e-7
    model = language_id.LanguageModel(("a", "b", "c", "d"), np.zeros((4, language_id.SLOTS)) + 1e-9)
    model.probability[:, :300] = tables / tables.sum(axis=1, keepdims=True)
    for shares, size in (((1,), 400), ((0.5, 0.5), 400), ((0.99, 0.01), 30_000), ((0.6, 0.3, 0.1), 2000), ((0.98, 0.005, 0.015), 40_000), ((0.25,) * 4, 900), ((1,), 3)):
        slots = np.concatenate([rng.choice(300, max(1, round(size * s)), p=model.probability[i, :300] / model.probability[i, :300].sum()) for i, s in enumerate(shares)])
        times, p = np.bincount(slots, minlength=language_id.SLOTS), model.probability
        used = np.flatnonzero(times)
        best = None
        for n in range(1, 16):
            own = [i for i in range(4) if n >> i & 1]
            _, likelihood = language_id.fit_shares(p[own][:, used], times[used].astype(float), rounds=200)
            value = likelihood / 3 - (len(own) - 1) * 0.5 * np.log(len(slots) + 1)
            if best is None or value > best[0]:
                best = (value, set(own))
        got, _ = language_id.infer(slots, model)
        assert set(got) == best[1], (shares, got, best)
        assert all(abs(got[i] - s) < 0.06 for i, s in enumerate(shares) if i in got)


def test_language_counts_cover_all_training_rows(spark):
    docs = spark.createDataFrame([(1, "ab", "x"), (2, "ab ab", "x"), (3, "zz", "y")], "doc_id long, text string, lang string")
    model = language_id.learn_languages(docs, smoothing=1e-9)
    slots, _ = language_id.trigram_slots(np.array([0, 2]), np.frombuffer(b"ab", np.uint8))
    assert np.allclose(model.probability[0, slots], 0.5, atol=1e-4)


def test_language_edges(no_rows, clashing):
    model = language_id.learn_languages(no_rows)
    assert {r.lang_pred for r in language_id.identify_languages(clashing, model).collect()} == {"und"}
    assert language_id.identify_languages(no_rows, model).collect() == []


# toxicity

@pytest.mark.parametrize("common", [0, 5, 60])
def test_block_max_search_is_exact(common):
    rng = np.random.default_rng(3)
    vectors = []
    for _ in range(500):
        term = np.sort(rng.choice(60, rng.integers(1, 8), replace=False))
        weight = rng.integers(1, 4, len(term)).astype(float)  # few values: many ties
        vectors.append((term, weight / np.sqrt(weight @ weight)))
    dense = np.zeros((500, 60))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    index = toxicity.BlockMaxIndex(vectors, 60, block=16, common=common)
    for i, (t, w) in enumerate(vectors[:100]):
        cosine = dense @ dense[i]
        cosine[i] = 0
        found, got = index.search(t, w, 10, but=i)
        assert np.allclose(got, np.sort(cosine[cosine > 0])[::-1][:10]) and np.allclose(cosine[found], got)
    together = index.search_many(vectors, 10, list(range(500)))
    for i in range(0, 500, 7):
        alone = index.search(*vectors[i], 10, but=i)
        assert all(np.array_equal(a, b) for a, b in zip(together[i], alone))


def test_terms_of_a_chunk_are_those_of_its_texts():
    texts = ["Abc abcd ABCDE abcdef abcdefg abc", "", "É né1née_née", "x" * 9, None, "wörter wörtern"]
    data = [(t or "").encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in data])])
    text, term, times = toxicity.chunk_terms(offsets, np.frombuffer(b"".join(data), np.uint8))
    got = {(int(a), int(b)): int(n) for a, b, n in zip(text, term, times)}
    want = Counter()
    for i, t in enumerate(texts):
        for word, n in toxicity.word_counts(t).items():
            for name in toxicity.terms_of(word):
                want[i, toxicity.term_id(name)] += n
    assert got == want


@pytest.fixture(scope="module")
def toxic_corpus(spark):
    rng = random.Random(9)
    bad = ["vilewort", "badstuff", "meanterm"]
    rows, labels = [], []
    for i in range(900):
        text = words(rng, rng.randrange(10, 60)).split(" ")
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(bad) + rng.choice(["", "s", "en"])
        rows.append((i, " ".join(text), "en", "a", None))
        if i % 5:
            labels.append((i, 1, int(toxic)))
    rows += [(1000, None, None, None, None), (1001, "", "en", "a", 0), (None, "vilewort badstuff meanterm", "en", "a", 3), (1002, "w1 " * 30_000, "en", "b", 0)]
    labels += [(6, 0, 0), (7, 0, None), (None, 0, 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(toxic_corpus):
    docs, labels = toxic_corpus
    model = toxicity.learn_toxicity(docs, labels)
    got = toxicity.score_toxicity(docs, model).collect()
    assert len(got) == 904 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    for r in got:
        if r.doc_id is not None and r.doc_id < 1000:
            assert r.predicted == int(r.doc_id % 6 == 0)
            assert not r.predicted or {e.label for e in r.evidence} == {1}
    by = {r.doc_id: r for r in got}
    assert by[None].predicted == 1 and by[1000].score == by[1001].score < 0.1 and by[1002].predicted == 0
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if not r.predicted)


def test_held_out_labels_teach_nothing(toxic_corpus):
    docs, labels = toxic_corpus
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.learn_toxicity(docs, x) for x in (labels, flipped))
    assert a.vocabulary.terms.tolist() == b.vocabulary.terms.tolist() and a.labels.tolist() == b.labels.tolist() and a.base == b.base


def test_document_frequencies_cover_all_documents(toxic_corpus):
    docs, labels = toxic_corpus
    model = toxicity.learn_toxicity(docs, labels, examples=200)
    n, at = docs.count(), model.vocabulary.number("vile*")
    df = docs.where(F.col("text").contains("vilewort")).count()
    assert math.isclose(model.idf[at], math.log((1 + n) / (1 + df)) + 1)


def test_all_terms_of_a_text_are_searched(spark, toxic_corpus):
    docs, labels = toxic_corpus
    # Not one telling word: the text shares only words of a clean example, which is its nearest.
    first = docs.where("doc_id = 1").first().text
    more = spark.createDataFrame([(2000, first + " neverseen", "en", "a", None), (2001, "neverseen", "en", "a", None)], SCHEMA)
    docs = docs.union(more)
    model = toxicity.learn_toxicity(docs, labels)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    n, counts = docs.count(), Counter()
    texts = {r.doc_id: r.text for r in docs.collect()}
    terms = lambda t: Counter(x for w, k in toxicity.word_counts(t).items() for x in toxicity.terms_of(w) for _ in range(k))
    for r in docs.collect():
        counts.update(set(terms(r.text)))
    number = lambda t: model.vocabulary.number(t)

    def vector(text):
        weight = {t: (1 + math.log(k)) * (math.log((1 + n) / (1 + counts[t])) + 1) for t, k in terms(text).items()}
        weight = {t: w * (model.emphasis[number(t)] if number(t) < len(model.emphasis) else 1) for t, w in weight.items()}
        size = math.sqrt(sum(w * w for w in weight.values()))
        return {t: w / size for t, w in weight.items()}

    examples = [vector(texts[k]) for k in model.keys]
    for key in (1, 2, 6, 8, 11, 1002, 2000):
        own = vector(texts[key])
        want = sorted((sum(w * e.get(t, 0) for t, w in own.items()) for e in examples), reverse=True)[:3]
        assert got[key].evidence and np.allclose([e.cosine for e in got[key].evidence], want, atol=1e-5)
    assert got[2000].evidence[0].doc_id == 1 and got[2000].evidence[0].cosine < 1
    assert got[2001].evidence == [] and got[2001].score == got[1000].score


def test_toxicity_edges(no_rows, clashing, toxic_corpus):
    _, labels = toxic_corpus
    model = toxicity.learn_toxicity(no_rows, labels)
    assert {r.score for r in toxicity.score_toxicity(clashing, model).collect()} == {0.0}
    assert toxicity.score_toxicity(no_rows, model).collect() == []
    assert toxicity.drop_toxic(clashing, model).columns == clashing.columns


def test_isotonic_fit_does_not_fall():
    rng = np.random.default_rng(0)
    x = rng.random(300)
    at, value = toxicity.isotonic(x, (rng.random(300) < x).astype(float))
    assert (np.diff(at) >= 0).all() and (np.diff(value) >= 0).all() and abs(np.interp(0.5, at, value) - 0.5) < 0.2


# segmentations

@pytest.fixture(scope="module")
def model():
    with open(segmentation.MODEL, "rb") as file:
        return file.read()


def all_segmentations(pieces, names, unit):
    """Every way to cut a unit, with its log-probability."""
    if not unit:
        return [((), 0.0)]
    out = []
    for n in range(1, len(unit) + 1):
        if unit[:n] in names:
            out += [((names[unit[:n]][0], *rest), names[unit[:n]][1] + p) for rest, p in all_segmentations(pieces, names, unit[n:])]
    if unit[0] not in names:
        raw = unit[0].encode()
        own = tuple(int(pieces.byte_id[b]) for b in raw)
        out += [((*own, *rest), pieces.byte_log * len(raw) + p) for rest, p in all_segmentations(pieces, names, unit[1:])]
    return out


def names_of(pieces):
    return {pieces.text[pieces.begin[i]:pieces.begin[i + 1]].tobytes().decode().replace(" ", "▁"): (int(i), float(p))
            for i, p in zip(pieces.ids, pieces.log_prob)}


def exact_distribution(pieces, unit):
    every = all_segmentations(pieces, names_of(pieces), unit)
    total = np.logaddexp.reduce([p for _, p in every])
    return {ids: p - total for ids, p in every}


def sampled(spark, text, rows, samples):
    docs = spark.range(rows).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    got = defaultdict(list)
    for r in segmentation.sample_segmentations(docs, samples).orderBy("doc_id", "sample").collect():
        got[r.doc_id].append(r)
    return got


def test_samples_follow_the_lattice_without_replacement(spark, model):
    pieces = segmentation.Pieces(model)
    want = exact_distribution(pieces, "▁then")
    got = sampled(spark, "then", 6000, 3)
    first, pairs = Counter(), Counter()
    for rows in got.values():
        ids = [tuple(r.ids) for r in rows]
        assert len(set(ids)) == 3 and rows[0].perturbed >= rows[1].perturbed >= rows[2].perturbed
        assert all(abs(r.log_prob - want[tuple(r.ids)]) < 1e-9 and r.inclusion <= 1e-12 for r in rows)
        first[ids[0]] += 1
        pairs[ids[0], ids[1]] += 1
    for ids, p in want.items():
        assert abs(first[ids] / 6000 - math.exp(p)) < 0.025
    for (a, b), n in pairs.most_common(4):
        p = math.exp(want[a]) * math.exp(want[b]) / (1 - math.exp(want[a]))
        assert abs(n / 6000 - p) < 0.03
    # Inclusion scores weigh each sample right: the sum of p / inclusion over the samples is 1 on average.
    mean = np.mean([sum(math.exp(r.log_prob - r.inclusion) for r in rows) for rows in got.values()])
    assert abs(mean - 1) < 0.05


def test_all_segmentations_if_there_are_few(spark, model):
    want = exact_distribution(segmentation.Pieces(model), "▁it")
    got = sampled(spark, "it", 3, 50)
    for rows in got.values():
        assert {tuple(r.ids) for r in rows} == set(want) and all(r.inclusion == 0.0 for r in rows)


def test_long_unit(spark):
    rows = sampled(spark, "ab" * 20_000, 1, 2)[0]
    assert len({tuple(r.ids) for r in rows}) == 2


def test_round_trip(corpus, model):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_proto=model)
    texts = Counter((r.doc_id, r.text or "") for r in corpus.collect())
    rows = segmentation.sample_segmentations(corpus, 2)
    got = rows.collect()
    assert {(r.doc_id, r.sample) for r in got} >= {(k, 0) for k, _ in texts}
    by_key = defaultdict(set)
    for k, t in texts:
        by_key[k].add(t)
    assert all(sp.decode(list(r.ids)) in by_key[r.doc_id] for r in got)
    decoded = Counter((r.doc_id, bytes(r.decoded).decode()) for r in segmentation.decode_ids(rows.where("sample = 0")).collect())
    assert decoded == texts
    whole = segmentation.sample_segmentations(corpus, 2, checked=True)
    assert whole.where("round_trip").count() == len(got) and Counter(map(str, whole.drop("round_trip").collect())) == Counter(map(str, got))
    again = segmentation.sample_segmentations(corpus.repartition(3), 2).collect()
    assert Counter(map(str, again)) == Counter(map(str, got))


def test_segmentation_edges(no_rows, clashing):
    assert segmentation.sample_segmentations(no_rows).collect() == []
    got = segmentation.sample_segmentations(clashing).collect()
    assert [list(r.ids) for r in got if r.doc_id == 2] == [[]]


# pipeline

def test_pipeline(spark, tmp_path, toxic_corpus, corpus):
    import corpus_pipeline

    docs, labels = toxic_corpus
    docs.union(corpus.withColumn("doc_id", F.col("doc_id") + 5000)).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    stage = spark.read.parquet(str(tmp_path / "documents.parquet"))
    counts = []
    for name, function in corpus_pipeline.STAGES:
        before, stage = stage, corpus_pipeline.materialize(function(spark, stage, str(tmp_path)), name)
        if name != "segmentation":
            assert stage.columns == docs.columns
            # Nothing is made up: each row that is left is one of the stage before.
            assert stage.distinct().exceptAll(before.distinct()).isEmpty()
        counts.append(stage.count())
    rows = docs.union(corpus)
    assert counts[0] == rows.count() - 151  # toxic ones, one of them without key
    assert counts[1] <= counts[0] - 16 and counts[2] <= counts[1] - 8
    assert stage.columns[:4] == ["doc_id", "source", "sample", "ids"] and stage.where("round_trip").count() == counts[-1] > 0
    again = corpus_pipeline.run(spark, str(tmp_path))
    assert again.exceptAll(stage).isEmpty() and stage.exceptAll(again).isEmpty()


def test_stages_of_an_empty_table(spark, tmp_path, no_rows):
    import corpus_pipeline

    no_rows.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
