import random

import pytest

from sieveworks.llm import line_dedup as L

WHITE = " \t\r\f\x0b"


def brute(rows, hashes, gram_words=25, run_words=50):
    """rows in order, (doc_id, text); hashes: grams (tuples of lines) to their numbers.  The kept texts."""
    parsed = []
    for _, t in rows:
        lines = (t or "").split("\n")
        idx = [k for k, x in enumerate(lines) if x.strip(WHITE)]
        parsed.append((lines, idx, [lines[k].strip(WHITE) for k in idx]))
    marks, first = [], {}
    for d, (_, _, own) in enumerate(parsed):
        count = [len([w for w in x.replace("\t", " ").replace("\r", " ").split(" ") if w]) for x in own]

        def end(i, n):
            total = 0
            for e in range(i, len(own)):
                total += count[e]
                if total >= n:
                    return e
            return None

        picked = set()
        for i in range(len(own)):
            stop = end(i, run_words)
            if stop is None:
                continue
            inside = [(hashes(tuple(own[s : end(s, gram_words) + 1])), s) for s in range(i, stop + 1) if end(s, gram_words) is not None and end(s, gram_words) <= stop]
            picked.add(min(inside))
        for g, s in picked:
            marks.append((g, d, s))
            first[g] = min(first.get(g, (d, s)), (d, s))
    gone = [set() for _ in rows]
    for g, d, s in marks:
        rd, rs = first[g]
        if (rd, rs) == (d, s):
            continue
        a, b = parsed[d][2], parsed[rd][2]
        lo = hi = 0
        while s - lo - 1 >= 0 and rs - lo - 1 >= 0 and a[s - lo - 1] == b[rs - lo - 1]:
            lo += 1
        while s + hi + 1 < len(a) and rs + hi + 1 < len(b) and a[s + hi + 1] == b[rs + hi + 1]:
            hi += 1
        idx = parsed[d][1]
        gone[d] |= set(range(idx[s - lo], idx[s + hi] + 1))
    return ["\n".join(x for k, x in enumerate(lines) if k not in g) if g else t for (lines, _, _), g, (_, t) in zip(parsed, gone, rows, strict=True)]


@pytest.fixture
def gram_hash(spark):
    """The numbers that the operator gives to grams, looked up in bulk."""
    from pyspark.sql import functions as F

    known = {}

    def of(rows):
        grams = set()
        for _, t in rows:
            own = [x.strip(WHITE) for x in (t or "").split("\n") if x.strip(WHITE)]
            for i in range(len(own)):
                for e in range(i, min(len(own), i + 26)):
                    grams.add(tuple(own[i : e + 1]))
        data = sorted(grams)
        df = spark.createDataFrame([(k, list(g)) for k, g in enumerate(data)], "k long, g array<string>")
        for r in df.select("k", F.xxhash64(F.transform("g", lambda x: F.xxhash64(x))).alias("h")).collect():
            known[data[r.k]] = r.h
        return known.__getitem__

    return of


def corpus(seed):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(50)]
    line = lambda: " ".join(r.choice(words) for _ in range(r.choice([1, 3, 8, 14, 30, 60])))
    passages = [[line() for _ in range(r.randrange(1, 6))] for _ in range(6)]
    rows = []
    for d in range(40):
        lines = []
        for _ in range(r.randrange(0, 6)):
            lines += r.choice(passages) if r.random() < 0.5 else [line()]
            if r.random() < 0.2:
                lines.append(r.choice(["", "  ", "\t"]))
        rows.append((d, "\n".join(("  " + x if r.random() < 0.1 else x) for x in lines)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, docs, gram_hash, seed):
    rows = corpus(seed) + [(100, None), (101, ""), (102, "\n\n")]
    got = {r.doc_id: r for r in L.deduplicated(docs(rows)).collect()}
    want = brute(rows, gram_hash(rows))
    for (d, t), w in zip(rows, want, strict=True):
        assert got[d].text == w
        assert got[d].lines_removed == (0 if t is None else t.count("\n") - (w.count("\n") if w else -1 if got[d].lines_removed == got[d].lines_before else 0))


def earlier_runs(rows, run_words=50):
    """For each document the numbers of the lines in runs of run_words words that stand in any earlier document, or earlier in their own."""
    seen, out = set(), []
    for _, t in rows:
        lines = (t or "").split("\n")
        idx = [k for k, x in enumerate(lines) if x.strip(WHITE)]
        own, gone = [lines[k].strip(WHITE) for k in idx], set()
        for i in range(len(own)):
            for e in range(i, len(own)):
                if sum(len(x.split()) for x in own[i : e + 1]) >= run_words:
                    run = tuple(own[i : e + 1])
                    gone |= set(range(idx[i], idx[e] + 1)) if run in seen else set()
                    seen.add(run)
        out.append(gone)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_every_run_equals_brute_force_over_all_earlier_documents(spark, docs, seed):
    rows = corpus(seed)
    numbers = lambda runs: {k for r in runs for k in range(r.a, r.b + 1)}
    found = [{r.d: numbers(r.runs) for r in L.repeated_runs(docs(rows), every_run=every).collect()} for every in (False, True)]
    want = earlier_runs(rows)
    assert all(found[1].get(d, set()) == found[0].get(d, set()) | w for (d, _), w in zip(rows, want, strict=True))
    assert seed != 1 or any(w - found[0].get(d, set()) for (d, _), w in zip(rows, want, strict=True))
    got = {r.doc_id: r.lines_removed for r in L.deduplicated(docs(rows), every_run=True).collect()}
    assert all(got[d] == len(found[1].get(d, ())) for d, _ in rows)


def test_query_deletes_runs_whose_fingerprint_stands_elsewhere_first(spark, tmp_path):
    line = lambda name: " ".join(f"{name}x{j}" for j in range(30))
    rows = []
    for k in range(12):
        one, two = line(f"one{k}"), line(f"two{k}")
        rows += [(100 + k, line(f"other{k}") + "\n" + one), (200 + k, one + "\n" + two), (300 + k, one + "\n" + two)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.text for r in L.op10_line_winnow(spark, str(tmp_path)).collect()}
    assert [got[300 + k] for k in range(12)] == [""] * 12


def test_long_passages_are_always_found(spark, docs):
    passage = "\n".join(" ".join(f"p{k}x{j}" for j in range(13)) for k in range(4))
    df = docs([(1, "intro one\n" + passage + "\nend"), (2, "other start\n" + passage), (3, passage + "\n" + passage), (None, passage)])
    got = {r.doc_id: r.text for r in L.deduplicated(df).collect()}
    assert got == {1: "intro one\n" + passage + "\nend", 2: "other start", 3: "", None: ""}


def test_short_and_unique_text_stays(spark, docs):
    df = docs([(k, "common line of five words\nunique " + " ".join(f"u{k}n{j}" for j in range(60))) for k in range(10)])
    assert all(r.lines_removed == 0 for r in L.deduplicated(df).collect())


def test_repeated_rows_clashing_columns_and_empty(spark, docs):
    text = " ".join(f"a{k}" for k in range(60))
    df = docs([(1, text), (1, text), (2, text), (1, text + " more")]).withColumnRenamed("sig", "runs")
    out = L.deduplicated(df)
    assert out.columns == [*df.columns, "lines_before", "lines_removed"]
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, text), (1, text), (1, text + " more"), (2, "")]
    assert L.deduplicated(df.limit(0)).count() == 0
    clash = df.withColumnsRenamed({"n_chars": "lines_before", "lang": "_nd", "source": "__runs", "runs": "LINES_REMOVED"})
    again = L.deduplicated(clash)
    assert again.columns == ["doc_id", "text", "_nd", "__runs", "lines_before", "lines_removed"]
    assert sorted((r.doc_id, r.text, r.lines_before, r.lines_removed, r._nd) for r in again.collect()) == [(1, text, 1, 0, "en"), (1, text, 1, 0, "en"), (1, text + " more", 1, 0, "en"), (2, "", 1, 1, "en")]


def test_main_path_is_native(spark, docs):
    plan = L.deduplicated(docs([(1, "a b c")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
