import os
import random

import numpy as np
import pytest

from sieveworks.llm import ngram_join as N
from sieveworks.llm.common import WordHashes, connected_components


def shingle_set(text, n=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(rows, n=5, percent=75):
    sets = [(i, shingle_set(t, n)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            s, t = sets[a][1], sets[b][1]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                root[find(a)] = find(b)
    groups = {}
    for k, (i, s) in enumerate(sets):
        groups.setdefault(find(k), []).append(i)
    low = {g: min((i for i in m if i is not None), default=None) for g, m in groups.items()}
    return sorted(((i, len(s), low[find(k)] if s else i) for k, (i, s) in enumerate(sets)), key=str)


def corpus(seed, families=12, copies=14):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(300)]
    common = [f"shared{k}" for k in range(12)]
    rows = []
    for f in range(families):
        base = [r.choice(words) for _ in range(r.choice([4, 8, 30, 60, 90]))]
        for c in range(r.randrange(1, copies)):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3, 6])):
                w[r.randrange(len(w))] = r.choice(words)
            if r.random() < 0.3:
                w = common + w
            if r.random() < 0.2:
                w = w[: len(w) * 3 // 4] or w
            rows.append((len(rows) * 7 % 1009, " ".join(w).replace("w1", "W1") if c % 2 else "\t".join(w)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_brute_force(spark, docs, seed):
    rows = corpus(seed) + [(2000, None), (2001, ""), (2002, " \n "), (2003, "one"), (2004, "ONE"), (None, "one"), (2003, "other words"), (None, "alone here"), (5000, "x " * 20_000)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in N.components(docs(rows)).collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("percent", [50, 90])
def test_other_percentages_equal_brute_force(spark, docs, percent):
    """Sets of 100 and 190 shingles, whose shared shingles stand in the prefixes of sets between."""
    shared = [f"s{k}" for k in range(104)]
    rows = [(1, " ".join(shared)), (2, " ".join(shared + [f"t{k}" for k in range(90)]))]
    rows += [(10 + n, " ".join([f"u{n}x{k}" for k in range(30)] + shared[: 45 + n])) for n in range(40)] + corpus(9, families=4, copies=8)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in N.components(docs(rows), percent=percent).collect()), key=str)
    assert got == brute(rows, percent=percent)


def test_salted_buckets_and_blocks_lose_no_link(spark, docs, monkeypatch):
    rows = corpus(5, families=4, copies=40)
    monkeypatch.setattr(N, "BUSY", 1)
    monkeypatch.setattr(N, "FAMILY_ROWS", 5)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in N.components(docs(rows)).collect()), key=str)
    assert got == brute(rows)


def test_empty(spark, docs):
    assert N.components(docs([(1, "a")]).limit(0)).count() == 0
    assert N.one_of_each(docs([(1, "a")]).limit(0)).count() == 0


def test_one_of_each(spark, docs):
    long = " ".join(f"v{k}" for k in range(40))
    df = docs([(3, long), (1, long + " end"), (1, long + " end"), (2, "quite other text"), (4, None), (5, ""), (None, long)])
    clash = N.one_of_each(df.withColumnsRenamed({"n_chars": "__id", "lang": "_null", "sig": "_key", "source": "_hash"}))
    assert sorted((r.doc_id, r["__id"], r._key, r._null) for r in clash.collect()) == [(1, len(long) + 4, 7, "en"), (2, 16, 7, "en"), (4, 0, 7, "en"), (5, 0, 7, "en")]
    kept = N.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5]


def test_filters_never_lose_a_linked_pair():
    r, hashes = np.random.default_rng(3), WordHashes()
    for _ in range(300):
        w = [f"{k}" for k in r.integers(0, 50, r.integers(5, 60))]
        v = list(w)
        for k in r.integers(0, len(v), r.integers(0, 3)):
            v[k] = "z"
        s, t = (N.shingles(hashes, " ".join(x), 5) for x in (w, v))
        both = len(np.intersect1d(s, t))
        if 100 * both < 75 * (len(s) + len(t) - both):
            continue
        ps, pt = s[: N.prefix_length(len(s), 75)], t[: N.prefix_length(len(t), 75)]  # any common order will do
        shared = np.intersect1d(ps, pt)
        assert len(shared)
        i, j = int(np.flatnonzero(ps == shared[0])[0]), int(np.flatnonzero(pt == shared[0])[0])
        assert N._possible(np.array([len(s)]), np.array([i]), np.array([len(t)]), np.array([j]), 75).all()
        assert N.Profiles([N.profile(s), N.profile(t)]).alike(0, np.array([1]), np.array([len(s), len(t)]), 75).all()


def test_bloom_has_all_its_keys():
    bloom = N.Bloom(1 << 16)
    keys = np.arange(-500, 500)
    bloom.add(keys)
    assert bloom.has(keys).all() and bloom.has(np.arange(10**6, 10**6 + 1000)).mean() < 0.01


def test_connected_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, k) for k in range(5001, 5080)]
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    low = {n: n for e in edges for n in e}
    for _ in range(100):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    assert got == {n: c for n, c in low.items() if n in got} and set(got) == {n for a, b in edges if a != b for n in (a, b)}


def test_very_long_texts_of_many_shingles_are_compared_whole(spark, docs):
    words = [f"w{k}" for k in range(60_000)]
    near, half = words[:-200] + [f"x{k}" for k in range(200)], words[:30_000] + [f"y{k}" for k in range(30_000)]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(half)), (4, "a few words only here now")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.components(docs(rows)).collect()}
    assert got == {1: (59_996, 1), 2: (59_996, 1), 3: (59_996, 3), 4: (2, 4)}


@pytest.mark.parametrize("paired", [0, 4, 10_000])
def test_pairs_and_families_of_buckets_lose_no_link(spark, docs, monkeypatch, paired):
    """All large buckets by family, some, and none."""
    rows = corpus(6, families=5, copies=40)
    monkeypatch.setattr(N, "PAIRED", paired, raising=False)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in N.components(docs(rows)).collect()), key=str) == brute(rows)


def test_places_shared_by_chance_make_no_family(spark, docs, monkeypatch):
    """Texts that each share a passage with some others are not compared all with all."""
    met, crossings = [], N.crossings
    monkeypatch.setattr(N, "crossings", lambda members, percent: met.append(members.count()) or crossings(members, percent))
    r, texts = random.Random(8), [[] for _ in range(60)]
    for p in range(100):  # passages of twenty words, each in six texts
        for i in r.sample(range(60), 6):
            texts[i] += [f"p{p}x{k}" for k in range(20)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in N.components(docs(rows)).collect()), key=str) == brute(rows)
    assert met == [0]


def test_copies_of_a_set_are_joined_once_and_tables_go(spark, docs, monkeypatch):
    text = [" ".join(f"v{i}x{k}" for k in range(60)) for i in range(5)]
    df = docs([(100 * c + i, t) for c in range(9) for i, t in enumerate(text)]).repartition(9)
    found, stored = {}, N.stored

    def counted(df, tag):
        made = stored(df, tag)
        found.setdefault(tag, (made.count(), made.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]))
        return made

    monkeypatch.setattr(N, "stored", counted)
    assert {r.component_id for r in N.components(df).collect()} == set(range(5))
    assert found["neighbours"][0] == 0  # no bucket has two sets
    assert [os.path.exists(found[tag][1]) for tag in ("survey", "neighbours", "pairs", "large", "crossings")] == [True, False, False, False, False]
