import hashlib
import random
import zlib

import numpy as np
import pytest

from sieveworks.llm import runs

SPACE = " \t\n\x0b\x0c\r"


def by_hand(t, least=12):
    """All runs by every period, the smallest of nested ones."""
    n, out = len(t), set()
    for q in range(1, n // 2 + 1):
        x = 0
        while x + q < n:
            if t[x] != t[x + q]:
                x += 1
                continue
            s = x
            while x + q < n and t[x] == t[x + q]:
                x += 1
            if x - s + q >= max(least, 2 * q):
                out.add((s, x - s + q, q))
    smaller = lambda r: any(s <= r[0] and s + n >= r[0] + r[1] and q < r[2] and r[2] % q == 0 for s, n, q in out)
    return sorted((r for r in out if not smaller(r)), key=lambda r: (r[0], r[2]))


def collapsed(t, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(t) if i not in gone)


def texts(r):
    for _ in range(400):
        n, al = r.randint(0, 70), r.randint(1, 4)
        t = [r.choice("abcd"[:al]).encode() for _ in range(n)]
        p = r.randint(1, max(1, n))
        a, b = [b"a"], [b"a", b"b"]
        while len(b) <= n:
            a, b = b, b + a
        yield r.choice([t, [t[i % p] for i in range(n)], b[:n], t[: n // 3] + [t[n // 3 + (i % 5) % max(1, n - n // 3)] for i in range(n - n // 3)]])


@pytest.mark.parametrize("least", [2, 4, 12])
def test_runs_equal_brute_force(least):
    every = list(texts(random.Random(least)))
    for lo in range(0, len(every), 7):  # several texts in one array
        part = every[lo : lo + 7]
        for t, (found, left) in zip(part, runs._Finder(0, least).of(part), strict=True):
            want = by_hand(t, least)
            assert [tuple(x) for x in found.tolist()] == want and left == collapsed(t, want)


@pytest.mark.parametrize("kind", ["unary", "rising", "falling", "periodic", "fibonacci", "coins"])
def test_long_texts_take_no_square_time(kind):
    n, r = 60_000, random.Random(1)
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < n:
        a, b = b, b + a
    t = {"unary": [b"a"] * n, "rising": [b"%06d" % i for i in range(n)], "falling": [b"%06d" % (n - i) for i in range(n)], "periodic": [b"%d" % (i % 977) for i in range(n)], "fibonacci": b, "coins": [r.choice([b"a", b"b"]) for _ in range(n)]}[kind]
    held = runs.Stretches(runs._ranked([t]))
    seen = []
    held._ahead = lambda a, b, f=held._ahead: seen.append(f(a, b)) or seen[-1]
    found = runs.next_smaller(held.w, held)
    assert (found[1:-1] > np.arange(1, len(t) + 1)).all() and sum(seen) < 40 * len(t)  # equal words measured, in all
    if kind in ("unary", "periodic"):
        assert [tuple(x[:3]) for x in runs.runs_of(held.w).tolist()] == [(1, len(t), 1 if kind == "unary" else 977)]


def test_table_with_nulls_repeats_and_clashing_names(spark):
    long = " ".join(["x", "y"] * 30_000)
    rows = [(1, None, "k", 5), (2, "", "k", 5), (3, " \t\n ", "k", 5), (4, "a b " * 6, "k", 5), (4, "a b " * 6, "k", 5), (None, "é " * 11, "k", 5), (None, "é " * 12, "k", 5), (5, long, "k", 5), (6, "a\u00a0b " * 12, "k", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Runs string, n int").repartition(3)
    out = runs.periodic_runs(docs)
    assert out.columns == ["doc_id", "text", "n", "n_words", "runs", "collapsed"]
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect()), key=str)
    want = [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 12, [(0, 12, 2)], "a b"), (4, 12, [(0, 12, 2)], "a b"), (0, 11, [], " ".join(["é"] * 11)), (0, 12, [(0, 12, 1)], "é"), (5, 60_000, [(0, 60_000, 2)], "x y"), (6, 12, [(0, 12, 1)], "a\u00a0b")]
    assert got == sorted(want, key=str)
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    r = random.Random(3)
    rows = [(k, r.choice([None, "", "one"]) if k % 9 == 0 else "".join(r.choice(["a", "b", "cé"]) + r.choice(SPACE) for _ in range(r.randint(1, 120)))) for k in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: tuple(x) for x in runs.op13_lyndon_runs(spark, str(tmp_path)).collect()}
    for k, text in rows:
        t, h = (text or "").encode().split(), zlib.crc32(str(k).encode())
        n, g = len(t), h // 10
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            t = [t[i] if i < a else t[a + (i - a) % p] for i in range(n)]
        found = by_hand(t)
        top = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
        assert got[k] == (k, len(found), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(t, found)).hexdigest())
    assert len(got) == len(rows)
