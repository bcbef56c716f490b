"""Exact dedup, sharding, url rules, mixing and fingerprints against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallystone.llm import exact_dedup, fingerprints, mixing, sharding, url_cascade
from tallystone.llm.queries import RULES


def texts_of(corpus):
    return [(r.doc_id, r.text or "") for r in corpus.select("doc_id", "text").collect()]


# exact dedup

def expected_groups(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[text].append(key)
    return {t: (max((k for k in ks if k is not None), default=None), len(ks)) for t, ks in groups.items()}


@pytest.mark.parametrize("counters", [2, 1024])
def test_duplicate_groups(corpus, counters):
    rows = texts_of(corpus)
    want = expected_groups(rows)
    got = exact_dedup.duplicate_groups(corpus, counters=counters).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in want.items()}
    assert all((r.keep_id, r.group_size) == by_sha[r.text_sha256] for r in got)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(want)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


@pytest.mark.parametrize("counters", [2, 1024])
def test_drop_duplicates_of_text(corpus, counters):
    want = expected_groups(texts_of(corpus))
    got = exact_dedup.drop_duplicates_of_text(corpus, counters=counters)
    assert got.columns == corpus.columns
    assert sorted((r.text or "", str(r.doc_id)) for r in got.collect()) == sorted((t, str(k)) for t, (k, _) in want.items())


def test_frequent_digests_are_found_and_verified(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text")
    ).repartition(7)
    digests = exact_dedup._digests(rows, "text", "doc_id")
    found = exact_dedup.frequent_digests(digests, 50).collect()
    assert [(bytes(r.digest), r.keep.key, r.group_size) for r in found] == [(hashlib.sha256(b"hot").digest(), 2997, 1000)]


def test_exact_dedup_edges(no_rows, clashing):
    assert exact_dedup.duplicate_groups(no_rows).collect() == []
    assert exact_dedup.drop_duplicates_of_text(no_rows).collect() == []
    got = exact_dedup.drop_duplicates_of_text(clashing)
    assert got.columns == clashing.columns and sorted(r.doc_id for r in got.collect()) == [1, 2, 3]


# sharding

def check_shards(rows, limit):
    """Shards form a prefix code, fit the limit, and no two siblings would fit together."""
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    names = sorted(by)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    for name, own in by.items():
        size = sum(r.n_bytes for r in own)
        assert {r.shard_bytes for r in own} == {size} and {r.depth for r in own} == {len(name)}
        assert size <= limit or all(r.oversized for r in own)
        if name and all(not r.oversized for r in own):
            parent = sum(r.n_bytes for n, rs in by.items() if n.startswith(name[:-1]) for r in rs)
            assert parent > limit
    return by


@pytest.mark.parametrize("limit", [10**9, 50_000, 3_000, 400])
def test_shards(corpus, limit):
    rows = sharding.shard_documents(corpus, limit).collect()
    assert len(rows) == corpus.count()
    by = check_shards(rows, limit)
    assert (len(by) == 1) == (limit == 10**9)


def test_hot_key_is_split(spark):
    rows = spark.range(400).select(F.lit(7).cast("long").alias("doc_id"), F.lit("x" * 100).alias("text"))
    by = check_shards(sharding.shard_documents(rows, 5_000).collect(), 5_000)
    assert len(by) >= 8


def test_sharding_edges(no_rows, clashing, tmp_path, spark):
    assert sharding.shard_documents(no_rows).collect() == []
    sharding.write_shards(clashing, str(tmp_path / "out"), 30)
    back = spark.read.parquet(*[str(p) for p in (tmp_path / "out").glob("shard_=*")])
    assert sorted(back.columns) == sorted(clashing.columns) and back.count() == 4


# url rules

def brute_rule(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.split(r"[/?#]", rest, maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in raw)
        path = re.split(r"[?#]", rest[len(raw):], maxsplit=1)[0]
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def many_urls():
    rng = random.Random(3)
    hosts = ["example.com", "www.example.com", "WWW.Example.COM", "a.b.net", "net", "x.org", "notexample.com", "com", "ü.com", "a..com", "x.com:80"]
    paths = ["", "/", "/en/", "/en", "/en/x", "/es/y?q=/fr/", "/fr/#a", "/EN/", "?a", "#b", "/es/"]
    urls = [f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(400)]
    return urls + [None, "", "no scheme", "://", "a://b://c/en/", "http://example.com\n/en/", "http://net/es/\n"]


@pytest.mark.parametrize("extra", [0, 300])
def test_url_rules(spark, extra):
    rules = RULES + [(f"h{i}.org", f"/p{i % 7}/" if i % 3 else "", ("block", "allow")[i % 2]) for i in range(extra)]
    urls = many_urls() + [f"http://s.h{i}.org/p{i % 5}/z" for i in range(extra)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_cascade.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute_rule(urls[r.page_id], rules), urls[r.page_id]


def test_cascade_is_exact_on_its_universe(spark):
    universe = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    listed = universe.where("id % 10 = 0")
    cascade = url_cascade.build_cascade(listed, universe.union(universe))
    assert len(cascade.levels) > 1
    bits = sum(x.bits() for x in cascade.levels)
    assert bits < 2_000 * 16  # some log2(s / r) + a few bits per listed key
    wrong = universe.where(cascade.has(F.col("key"), cascade.literals()) != (F.col("key").cast("long") % 10 == 0))
    assert wrong.count() == 0


def test_url_edges(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert url_cascade.judge_urls(none, rules).collect() == []
    page = spark.createDataFrame([(1, "http://a.com/"), (None, None)], "page_id long, url string")
    assert [r.verdict for r in url_cascade.judge_urls(page, rules.limit(0)).collect()] == ["allow", "allow"]
    with pytest.raises(ValueError):
        url_cascade.build_cascade(rules.select(F.col("path").alias("key")).distinct(), none.select(F.col("url").alias("key")), max_bits=1)


# mixing

def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else left * weight[s] / free for s in names}
        over = {s for s in names if s not in capped and target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mix_plan(corpus):
    rows = [(r.doc_id, r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in corpus.collect()]
    sizes = Counter()
    for _, source, size in rows:
        sizes[source] += size
    target = brute_targets(sizes)
    got = mixing.mix_plan(corpus).collect()
    assert Counter((r.doc_id, r.size, r.source_size) for r in got) == Counter((k, n, sizes[s]) for k, s, n in rows)
    for r in got:
        assert min(abs(r.target - t) for s, t in target.items() if sizes[s] == r.source_size) < 1e-6
        rate = r.target / r.source_size
        assert r.taken == r.size * r.copies and int(rate) <= r.copies <= min(3, int(rate) + 1)
    assert sorted(map(str, mixing.mix_plan(corpus.repartition(2)).collect())) == sorted(map(str, got))
    emitted = Counter(r.doc_id for r in mixing.mixed(corpus).collect())
    wanted = Counter()
    for r in got:
        wanted[r.doc_id] += r.copies
    assert emitted == +wanted


def test_mix_comes_near_its_targets(spark):
    rows = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 17 + 1).cast("int")).alias("text"),
        F.concat(F.lit("s"), (F.col("id") % 5).cast("string")).alias("source"),
    )
    got = mixing.mix_plan(rows).join(rows, "doc_id").groupBy("source", "target").agg(F.sum("taken").alias("taken")).collect()
    assert len(got) == 5 and all(abs(r.taken / r.target - 1) < 0.05 for r in got)


def test_mix_edges(no_rows, clashing):
    assert mixing.mix_plan(no_rows).collect() == [] and mixing.mixed(no_rows).collect() == []
    assert mixing.mixed(clashing).columns == clashing.columns
    only_empty = clashing.where("text IS NULL")
    assert [(r.size, r.target, r.taken) for r in mixing.mix_plan(only_empty).collect()] == [(0, 0.0, 0)]


# fingerprints

def brute_exact(text):
    lanes = [0] * 16
    for p in text.split("\n"):
        d = hashlib.sha512(p.encode()).hexdigest()
        lanes = [(a + int(d[8 * i:8 * i + 8], 16)) % 2**32 for i, a in enumerate(lanes)]
    return "".join(f"{x:08x}" for x in lanes)


def brute_cosine(a, b):
    def shingles(text):
        out = Counter()
        for p in text.split("\n"):
            w = p.split(" ")
            for i in range(max(1, len(w) - 2)):
                out[tuple(w[i:i + 3])] += 1
        return out
    x, y = shingles(a), shingles(b)
    dot = sum(n * y[k] for k, n in x.items())
    return dot / (sum(n * n for n in x.values()) * sum(n * n for n in y.values())) ** 0.5


def test_edited_fingerprints(corpus):
    rows = sorted(texts_of(corpus), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = []
    for i, (key, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        third = len(text) // 3
        edited = text[:len(text) - third] + following[:third]
        want.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), text, edited, following))
    got = fingerprints.edited_fingerprints(corpus).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == Counter(w[:3] for w in want)
    by = {(r.doc_id, r.edited_sha256): r for r in got}
    off = []
    for key, _, sha, text, edited, following in want:
        r = by[key, sha]
        assert r.fingerprint[:128] == brute_exact(text) and r.edited_fingerprint[:128] == brute_exact(edited)
        assert len(r.fingerprint) == 128 + 8 * 128 and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        off += [abs(r.near_edited - brute_cosine(text, edited)), abs(r.near_next - brute_cosine(text, following))]
    assert sum(off) / len(off) < 0.08 and max(off) < 0.45


def test_fingerprints_are_incremental(spark):
    a, b = "one two three four\nfive six seven", "eight nine\n"
    rows = spark.createDataFrame([(1, a), (2, b), (3, f"{b}\n{a}"), (4, f"{a}\n{b}"), (5, None), (6, "")], "doc_id long, text string")
    f = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(rows).collect()}
    assert f[3] == f[4] and f[5] == f[6] and len({f[1], f[2], f[3], f[5]}) == 4
    pair = spark.createDataFrame([(f[1], f[2], f[3])], "a string, b string, c string")
    row = pair.select(
        fingerprints.combine(F.col("a"), F.col("b")).alias("union"), fingerprints.combine(F.col("c"), F.col("b"), -1).alias("rest"),
        fingerprints.likeness(F.col("a"), F.col("a")).alias("same"), fingerprints.likeness(F.col("a"), F.col("b")).alias("unlike"),
    ).first()
    assert row.union == f[3] and row.rest == f[1] and row.same == 1.0 and row.unlike < 0.5


def test_likeness_of_long_repeats_is_that_of_the_fingerprints(spark):
    """A shingle that occurs more than 2^15 and 2^16 times."""
    rows = [(1, "a b c " * 40_000), (2, "d e f " * 70_000 + "a b c"), (3, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprints.edited_fingerprints(docs)
    by = {r.doc_id: r for r in got.select("*", fingerprints.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("own")).collect()}
    assert all(r.own == pytest.approx(r.near_edited, abs=1e-9) for r in by.values())
    pair = spark.createDataFrame([(by[3].fingerprint, by[2].fingerprint), (by[2].fingerprint, by[1].fingerprint)], "a string, b string")
    like = [r.v for r in pair.select(fingerprints.likeness(F.col("a"), F.col("b")).alias("v")).collect()]
    assert like == pytest.approx([by[3].near_next, by[2].near_next], abs=1e-9)


def test_fingerprint_edges(no_rows, clashing):
    assert fingerprints.edited_fingerprints(no_rows).collect() == []
    assert fingerprints.edited_fingerprints(clashing).count() == 4
    one = fingerprints.edited_fingerprints(clashing.limit(1)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
