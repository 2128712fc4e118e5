"""The answer ledger: what is asked, what is kept when a run breaks off, and that nothing is asked twice."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from sieveworks import judge as J
from sieveworks import runstate
from sieveworks.ledger import Ledger, answered, keyed


def listings(spark, n, size=5, lane="fractional", shift=0):
    base = spark.range(n).select((F.col("id") + shift).alias("id"), F.concat(F.lit("u"), F.col("id")).alias("url"), F.when(F.col("id") % 3 == 0, "Agent").otherwise("Other").alias("title"), F.lit("co").alias("company"), F.lit("s").alias("source"), F.lit(None).cast("string").alias("posted_date"), F.array(F.lit("t")).alias("tags"), F.lit("text").alias("snippet"))
    return base.withColumns({"lane": F.lit(lane), "chunk": F.floor((F.col("id") - shift) / size)})


class Counted:
    """A judge that notes the chunk of every call, and may end its process or raise."""

    def __init__(self, folder, die_at=None, fail=()):
        self.inner, self.folder, self.die_at, self.fail = J.RuleJudge({"fractional": [("agentic_ai_engineer", "agent")]}), str(folder), die_at, tuple(fail)

    def __call__(self, rows, lane):
        first = rows[0]["url"]
        if len(os.listdir(self.folder)) == self.die_at:
            os._exit(9)  # as a lost executor ends
        open(f"{self.folder}/{first}-{os.getpid()}-{os.urandom(4).hex()}", "w").close()
        if first in self.fail:
            raise RuntimeError("down")
        return self.inner(rows, lane)


def calls(folder):
    return sorted(f.split("-")[0] for f in os.listdir(folder))


def test_a_killed_run_pays_again_only_for_what_it_lacked(spark, tmp_path):
    seen = tmp_path / "calls"
    seen.mkdir()
    rows, ledger = listings(spark, 40), Ledger(spark, f"file://{tmp_path}/run")
    with pytest.raises(Exception):
        answered(rows, Counted(seen, die_at=3), ledger, callers=1)
    kept = ledger.entries().count()
    assert kept == 3 and len(calls(seen)) == 3
    got, attempt = answered(rows, Counted(seen), ledger, callers=2)
    assert len(calls(seen)) == 8 == len(set(calls(seen))) and attempt.groupBy("outcome").count().collect() == [("answered", 5)]
    assert {(r.id, r.chunk, r.verdict) for r in got.collect()} == {(i, i // 5, "match" if i % 3 == 0 else "no_match") for i in range(40)}
    again, attempt = answered(rows, Counted(seen, die_at=8), ledger)
    assert again.count() == 40 and attempt.count() == 0 and len(calls(seen)) == 8


def test_answers_follow_the_content_not_the_ids(spark, tmp_path):
    seen = tmp_path / "calls"
    seen.mkdir()
    ledger = Ledger(spark, f"file://{tmp_path}/run")
    answered(listings(spark, 10), Counted(seen), ledger)
    moved, attempt = answered(listings(spark, 10, shift=700), Counted(seen), ledger)
    assert attempt.count() == 0 and {(r.id, r.verdict) for r in moved.collect()} == {(700 + i, "match" if i % 3 == 0 else "no_match") for i in range(10)}
    for other, salt in ((listings(spark, 10).withColumn("snippet", F.lit("new")), {}), (listings(spark, 10), {"fractional": "other criteria"}), (listings(spark, 10, size=4), {})):
        assert answered(other, Counted(seen), ledger, salt=salt)[1].where("outcome = 'answered'").count() == other.select("chunk").distinct().count()


def test_failures_are_rows_and_asked_again(spark, tmp_path):
    seen = tmp_path / "calls"
    seen.mkdir()
    ledger = Ledger(spark, f"file://{tmp_path}/run")
    got, attempt = answered(listings(spark, 15), Counted(seen, fail=["u5"]), ledger, attempts=2, base_s=0.0)
    assert [(r.chunk, r.error, r.id) for r in got.where("error is not null").collect()] == [(1, "down", None)] and got.where("error is null").count() == 10
    assert attempt.where("outcome = 'failed'").first().calls == 2
    got, _ = answered(listings(spark, 15), Counted(seen), ledger)
    assert got.where("error is null").count() == 15 and calls(seen).count("u0") == 1 and calls(seen).count("u5") == 3


def test_equal_chunks_are_asked_once(spark, tmp_path):
    seen = tmp_path / "calls"
    seen.mkdir()
    twice = listings(spark, 5).unionByName(listings(spark, 5, shift=100).withColumn("chunk", F.lit(7).cast("long")))
    got, attempt = answered(twice, Counted(seen), Ledger(spark, f"file://{tmp_path}/run"))
    assert calls(seen) == ["u0"] and attempt.count() == 1 and sorted(r.id for r in got.collect()) == [0, 1, 2, 3, 4, 100, 101, 102, 103, 104]


def test_compaction_keeps_every_answer_and_damage_is_asked_again(spark, tmp_path):
    seen = tmp_path / "calls"
    seen.mkdir()
    ledger, rows = Ledger(spark, f"file://{tmp_path}/run"), listings(spark, 20)
    answered(rows, Counted(seen), ledger)
    loose = runstate.listed(spark, f"{ledger.root}/loose")
    broken = loose[0].replace("file:", "")
    text = open(broken).read()
    open(broken, "w").write(text[: len(text) // 2])
    os.path.exists(c := os.path.join(os.path.dirname(broken), f".{os.path.basename(broken)}.crc")) and os.remove(c)
    assert ledger.entries().count() == 3
    os.remove(broken)
    assert ledger.compact() == 3 and ledger.compact() == 0 and ledger.entries().count() == 3
    got, attempt = answered(rows, Counted(seen), ledger)
    assert got.count() == 20 and attempt.count() == 1
    assert answered(rows.limit(0), Counted(seen), ledger)[0].count() == 0


def test_keys_need_no_order(spark):
    rows = listings(spark, 20)
    one = {r.chunk: r.key for r in keyed(rows, {"fractional": "x"}).collect()}
    assert one == {r.chunk: r.key for r in keyed(rows.repartition(7, "url"), {"fractional": "x"}).collect()} and len(set(one.values())) == 4


def test_log_writers_lose_no_line(spark, tmp_path, monkeypatch):
    logs = [runstate.RunLog(spark, f"file://{tmp_path}", "2024-01-01") for _ in range(2)]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda k: [logs[k].event("s", f"{k}/{n}", n=n) for n in range(20)], range(2)))
    want = sorted(f"{k}/{n}" for k in range(2) for n in range(20))
    assert sorted(e["message"] for e in logs[0].events()) == want
    monkeypatch.setattr(runstate, "PARTS", 10)
    assert sorted(e["message"] for e in logs[1].events()) == want  # compacts on the way
    assert len(runstate.listed(spark, logs[0].folder)) == 1
    logs[0].event("s", "later")
    assert [e["message"] for e in logs[1].events()][-1] == "later" and len(logs[1].events()) == 41
