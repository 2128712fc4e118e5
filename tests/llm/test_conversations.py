import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from sieveworks.llm import conversations as C


def trie(rows):
    """The contract's rows from (conv_id, turn, role, text), by a dictionary of prefixes."""
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c % 100 if c >= 0 else -(-c % 100))
        made[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = defaultdict(list)
    for s in members:
        if s:
            children[s[:-1]].append(s)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in children[s]) or 1
        saved[s] = sum(saved[k] for k in children[s]) + ((len(members[s]) - 1) * len(s[-1][1]) if s else 0)
    digest = lambda s: hashlib.sha256(",".join(map(str, sorted(ends[s]))).encode()).hexdigest()
    return sorted((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), len(children[s]), leaves[s], saved[s], digest(s)) for s, m in members.items())


def result(spark, rows, folder):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3).write.parquet(f"{folder}/conversations.parquet")
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return [tuple(x[n] for n in names) for x in C.op11_prefix_trie(spark, str(folder)).orderBy("conv_id", "depth").collect()]


def generated(r, n):
    rows = []
    for c in range(-3, n):
        copy = c % 7 == 0
        for t in range(r.choice([0, 1, 2, 5, 9])):
            text = r.choice(["hello", "", None, "été 🙂", "x" * 30]) if not copy else "same"
            rows.append((c * r.choice([1, 1, 1, 2]) if not copy else c, r.choice([t, t, t, None]), r.choice(["user", "assistant", None]) if not copy else "user", text))
    return rows + [(None, 1, "user", "lost"), (12, 1, "user", "twice"), (12, 1, "user", "twice")]


@pytest.mark.parametrize("n", [60, 320])
def test_nodes_equal_a_dictionary_of_prefixes(spark, tmp_path, n, monkeypatch):
    monkeypatch.setattr(C, "PIECE", 4)
    rows = generated(random.Random(n), n)
    assert result(spark, rows, tmp_path) == trie(rows)


def test_long_and_copied_conversations(spark, tmp_path):
    rows = [(5, t, "user", f"turn {t % 3}") for t in range(900)] + [(c, t, "user", f"turn {t % 3}") for c in range(200, 260) for t in range(c % 40)]
    assert result(spark, rows, tmp_path) == trie(rows)


def test_turnless_and_empty(spark, tmp_path):
    lonely = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 2)
    assert result(spark, [(lonely, 1, "user", "gone"), (lonely, 2, "user", "too")], tmp_path / "a") == [(lonely, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lonely).encode()).hexdigest())]
    assert result(spark, [], tmp_path / "b") == [] == trie([])


def test_sql_equals_a_dictionary_of_prefixes(tmp_path):
    rows = generated(random.Random(9), 150)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(con.execute(C.OP11_SQL).fetchall()) == trie(rows)
