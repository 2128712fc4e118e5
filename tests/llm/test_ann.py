import numpy as np
import pytest

from sieveworks.llm import ann


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rep int")


def brute(rows, k, every):
    use = {i: np.array(e, np.float32).astype(float) for i, e in rows}
    out = {}
    for q in use:
        if q % every == 0:
            s = [(-float((use[i] * use[q]).sum()), i) for i in use if i != q]
            out[q] = [i for _, i in sorted(s)[:k]]
    return out


def answer(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [v for _, v, _ in sorted(x)] for q, x in got.items()}


def test_a_full_target_is_exact_with_copies_ties_and_bad_vectors(spark):
    r = np.random.default_rng(1)
    rows = [(i, r.normal(size=6).tolist()) for i in range(150)]
    rows += [(200 + i, rows[7][1]) for i in range(30)] + [(500, [2.0] * 6), (505, [-2.0] * 6)]
    good = dict(rows)
    bad = [(300, None), (305, [0.0] * 6), (310, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (315, [float("nan")] * 6), (320, [float("inf")] + [1.0] * 5), (325, [1.0, 2.0]), (None, [1.0] * 6), (330, [])]
    df = frame(spark, [(i, e, 1) for i, e in rows + bad + rows[:3]])
    got = answer(ann.nearest(df, k=20, every=5, target=1.0))
    assert got == brute(list(good.items()), 20, 5)


def test_fewer_candidates_and_empty(spark):
    assert answer(ann.nearest(frame(spark, [(0, [1.0, 0.0], 1), (1, [0.5, 1.0], 1)]), every=1)) == {0: [1], 1: [0]}
    assert ann.nearest(frame(spark, [])).count() == 0
    assert ann.nearest(frame(spark, [(0, [1.0], 1)])).count() == 0


def test_forest_recall_and_exact_scores(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(4000, 24)) * r.uniform(0.5, 2, (4000, 1))
    rows = [(i, e.astype(np.float32).tolist()) for i, e in enumerate(x)]
    df = frame(spark, [(i, e, 1) for i, e in rows])
    out = ann.nearest(df, k=10, every=40)
    got, want = answer(out), brute(rows, 10, 40)
    assert sum(len(set(got[q]) & set(want[q])) for q in want) / sum(map(len, want.values())) >= 0.9
    e = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    assert all(abs(s.score - (e[s.query_id] * e[s.vec_id]).sum()) < 1e-12 for s in out.limit(50).collect())


@pytest.mark.parametrize("n", [1, 2, 5, 21, 22, 60])
def test_every_query_gets_all_that_it_asks_for(spark, n):
    r = np.random.default_rng(n)
    rows = [(i, r.integers(-2, 3, 4).tolist()) for i in range(n)]
    rows = [(i, e) for i, e in rows if any(e)]
    got = answer(ann.nearest(frame(spark, [(i, [float(v) for v in e], 1) for i, e in rows]), k=20, every=2, target=0.5))
    assert {q: len(v) for q, v in got.items()} == {i: min(20, len(rows) - 1) for i, _ in rows if i % 2 == 0 and len(rows) > 1}


def test_ties_of_different_vectors_on_both_sides_of_the_old_small_limit(spark):
    r = np.random.default_rng(7)
    for n, every in ((400, 8), (3000, 100)):
        rows = [(i, [float(v) for v in r.integers(-3, 4, 8)] + [1.0]) for i in range(n)]
        out = ann.nearest(frame(spark, [(i, e, 1) for i, e in rows]), k=20, every=every, target=1.0)
        assert answer(out) == brute(rows, 20, every)


def test_blocks_of_rows_and_queries_change_nothing(spark, monkeypatch):
    r = np.random.default_rng(8)
    rows = [(i, r.normal(size=5).tolist()) for i in range(300)]
    df = frame(spark, [(i, e, 1) for i, e in rows])
    monkeypatch.setattr(ann, "LEAF", (20, 60))
    want = answer(ann.nearest(df, k=7, every=3))
    monkeypatch.setattr(ann, "BLOCK", 6)
    assert answer(ann.nearest(df, k=7, every=3)) == want


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_fixtures(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()]
    got, want = answer(ann.op1_rp_forest(spark, f"/root/testdata/{sf}")), brute(rows, 20, 20)
    assert set(got) == set(want) and sum(len(set(got[q]) & set(want[q])) for q in want) / sum(map(len, want.values())) >= 0.9


def test_levels_grow_with_the_rows():
    assert [ann.levels_of(n) for n in (0, 1, 100, 500, 2000, 10_000, 131_072, 200_000, 10**6, 10**9)] == [1, 1, 1, 3, 5, 6, 6, 7, 9, 11]


def test_many_ties_at_the_cut_go_by_id():
    r = np.random.default_rng(3)
    x = np.c_[np.ones(300), r.permutation(300)].astype(float)
    ids = r.permutation(300)
    at, score = ann.best(np.array([[1.0, 0.0]]), x, ids, 21)[0]
    assert ids[at].tolist() == list(range(21)) and (score == 1).all()
