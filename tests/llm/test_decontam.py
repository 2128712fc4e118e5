import itertools
import math
import random

import pytest

from sieveworks.llm import decontam
from sieveworks.llm.common import plain_words


def brute(docs, items, min_match=13, min_cover=0.75, least=8):
    """All diagonals of all pairs."""
    out = set()
    for d, t in docs:
        w = plain_words(t)
        for i, s in items:
            v = plain_words(s)
            if not v:
                continue
            if len(v) < least:
                if any(w[k : k + len(v)] == v for k in range(len(w))):
                    out.add((d, i))
                continue
            for g in range(-len(v) + 1, len(w)):
                best = run = 0
                matched = whole = 0
                for k in range(max(0, g), min(len(w), g + len(v))):
                    same = w[k] == v[k - g]
                    whole += same
                    if run == 0:
                        matched = 0
                    run = max(0, run + (1 if same else -2))
                    matched = matched + same if run else 0
                    if run > best:
                        best, got = run, matched
                if best and got >= min(min_match, math.ceil(min_cover * len(v))) or whole >= math.ceil(min_cover * len(v)):
                    out.add((d, i))
    return out


def test_equals_brute_force_with_substitutions(spark, docs):
    r = random.Random(8)
    vocabulary = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.choice([3, 7, 9, 15, 30, 60])))) for k in range(25)] + [(99, None), (98, ""), (97, "!!")]
    rows = []
    for d in range(80):
        words = [r.choice(vocabulary) for _ in range(r.randrange(0, 120))]
        if d % 2:
            v = (items[r.randrange(25)][1]).split()
            for _ in range(r.choice([0, 0, 1, 3])):
                v[r.randrange(len(v))] = "changed"
            at = r.randrange(len(words) + 1)
            words[at:at] = v
        rows.append((d, " ".join(words).upper() if d % 3 == 0 else ", ".join(words)))
    rows += [(200, items[0][1]), (201, None), (202, ""), (200, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontam.overlaps(docs(rows), bench).collect()}
    want = brute(rows, items)
    assert got == want


def test_every_placement_of_the_permitted_substitutions_is_found(spark, docs):
    items = [(n, " ".join(f"n{n}w{k}" for k in range(n))) for n in range(8, 17)]
    rows = []
    for n, text in items:
        for subs in itertools.combinations(range(n), n // 4):
            rows.append((n * 10_000 + len(rows), " ".join("other" if k in subs else w for k, w in enumerate(text.split()))))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id, x.matched) for x in decontam.overlaps(docs(rows), bench).collect()}
    assert len(rows) > 3_000 and got == {(d, d // 10_000, d // 10_000 - d // 10_000 // 4) for d, _ in rows}


def hit(word, n, masks):
    """Whether the last of n places, as bits, ends a seed."""
    return any(n >= len(m) and word & int(m, 2) == int(m, 2) for m in masks)


@pytest.mark.parametrize("masks, least", [(decontam.MASKS, decontam.SHORT_UNDER), (decontam.SHORT_MASKS, 8)])
def test_no_row_of_any_length_keeps_its_cover_without_a_seed(masks, least):
    kept = (1 << max(map(len, masks)) - 1) - 1
    most = {0: 0}  # equal words at most, by the last places
    for n in range(1, 200):
        after = {}
        for state, equal in most.items():
            for bit in (0, 1):
                word = state << 1 | bit
                if not hit(word, n, masks):
                    after[word & kept] = max(after.get(word & kept, 0), equal + bit)
        most = after
        assert n < least or max(most.values()) < math.ceil(0.75 * n)


def test_no_best_stretch_of_13_equal_words_is_without_a_seed():
    masks = decontam.MASKS
    kept = (1 << max(map(len, masks)) - 1) - 1
    todo, seen = [(0, 0, 0, 0, 0)], set()
    while todo:  # places, score, highest score before and equal words of every beginning of a best stretch
        state, n, score, high, equal = todo.pop()
        for bit in (0, 1):
            word, now, count = state << 1 | bit, score + (1 if bit else -2), min(equal + bit, 13)
            if now <= 0 or now > 40 or hit(word, n + 1, masks):
                continue
            assert count < 13 or now <= high
            step = (word & kept, min(n + 1, 10), now, max(high, now), count)
            if step not in seen:
                seen.add(step)
                todo.append(step)
    assert seen


def test_random_substitutions_equal_brute_force(spark, docs):
    r = random.Random(21)
    items = [(k, " ".join(r.choice("abcdefghijklmnopqrstuvwxyz") + str(r.randrange(9)) for _ in range(8 + k))) for k in range(24)]
    rows = []
    for d in range(300):
        v = items[d % 24][1].split()
        for k in r.sample(range(len(v)), r.randrange(0, len(v) // 3 + 1)):
            v[k] = "other"
        rows.append((d, " ".join(["start", *v, "end"][r.randrange(2) :])))
    got = {(x.doc_id, x.item_id) for x in decontam.overlaps(docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute(rows, items)


def test_two_substitutions_near_an_end_and_short_items_inside_texts(spark, docs):
    item = " ".join(f"q{k}" for k in range(15))
    changed = item.split()
    changed[2] = changed[7] = "other"
    bench = spark.createDataFrame([(1, item), (2, "which of these"), (3, "which of those"), (2, "one")], "item_id long, text string")
    rows = [(10, "before " + " ".join(changed) + " after"), (11, "so: Which of these, which OF these?"), (12, "which of them"), (13, "one")]
    got = sorted(map(tuple, decontam.overlaps(docs(rows), bench).select("doc_id", "item_id", "matched", "overlap", "doc_start", "doc_end").collect()))
    assert got == [(10, 1, 13, 15, 1, 16), (11, 2, 3, 3, 1, 4), (13, 2, 1, 1, 0, 1)]


def test_texts_that_repeat_one_word_are_compared_in_bounded_steps(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(1, "ha " * 600), (2, "other words " * 10)], "item_id long, text string")
    rows = [(1, "ha " * 4_000), (2, "ha " * 599), (3, "other words " * 9), (4, "none")]
    want = [(1, 1, 600), (2, 1, 599), (3, 2, 18)]
    got = lambda: sorted((x.doc_id, x.item_id, x.matched) for x in decontam.overlaps(docs(rows), bench).collect())
    assert got() == want
    monkeypatch.setattr(decontam._chunks, "__defaults__", (50_000,))
    assert got() == want


def test_blocks_give_the_same(spark, docs, monkeypatch):
    items = [(k, " ".join(f"i{k}w{j}" for j in range(20))) for k in range(30)]
    rows = [(k, "x y z " + items[k][1] + " tail") for k in range(30)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, decontam.overlaps(docs(rows), bench).collect()))
    monkeypatch.setattr(decontam.benchmark_blocks, "__defaults__", (300,))
    assert sorted(map(tuple, decontam.overlaps(docs(rows), bench).collect())) == one and len(one) == 30


def test_filter_keeps_columns_and_clean_rows(spark, docs):
    passage = " ".join(f"p{j}" for j in range(20))
    df = docs([(1, f"a b {passage} c"), (2, "a b c"), (3, None), (None, passage)])
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = decontam.uncontaminated(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert decontam.uncontaminated(df, bench.limit(0)).count() == 4 and decontam.overlaps(df.limit(0), bench).count() == 0
