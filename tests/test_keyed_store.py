"""The bucketed store: first records, replays, broken writes, and what a batch writes and reads."""

import json

import pytest
from pyspark.sql import functions as F

from sieveworks import keyed_store, runstate
from sieveworks.keyed_store import BUCKET, KeyedStore
from sieveworks.operators import seen
from sieveworks.streaming import pool


def make(spark, tmp_path, **more):
    return KeyedStore(spark, f"file://{tmp_path}/s", "key string, pos bigint, v string", **more)


def rows(spark, data):
    return spark.createDataFrame(data, "key string, pos long, v string")


def size(spark, path):
    return sum(len(open(f.replace("file:", ""), "rb").read()) for f in runstate.listed(spark, path) if f.endswith(".parquet"))


@pytest.mark.parametrize("sent", [0, 200_000])
def test_first_records_stay(spark, tmp_path, monkeypatch, sent):
    monkeypatch.setattr(keyed_store, "SENT_ROWS", sent)
    store = make(spark, tmp_path)
    assert store.insert(rows(spark, [("a", 2, "late"), ("a", 1, "first"), ("b", 3, "x"), ("", 0, "no"), (None, 0, "no")]), "pos") == 2
    assert store.insert(rows(spark, [("a", 0, "again"), ("c", 5, "y")]), "pos") == 1 and store.insert(rows(spark, [("a", 0, "again")]), "pos") == 0
    assert store.insert(rows(spark, []), "pos") == 0
    assert sorted(tuple(r) for r in make(spark, tmp_path).read().collect()) == [("a", 1, "first"), ("b", 3, "x"), ("c", 5, "y")]


def test_bytes_written_follow_the_batch(spark, tmp_path):
    store = make(spark, tmp_path)
    store.insert(spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"), F.col("id").alias("pos"), F.sha2(F.concat(F.lit("v"), F.col("id")), 256).alias("v")), "pos")
    whole = size(spark, store.root)
    before = json.dumps(store.state["tables"])
    store.insert(rows(spark, [(f"new{k}", k, "x") for k in range(3)]), "pos")
    assert size(spark, store.root) - whole < whole / 100
    changed = {b for b, t in store.state["tables"].items() if t != json.loads(before).get(b)}
    assert 1 <= len(changed) <= 3
    assert len({f for f in store.read([int(b) for b in changed]).inputFiles()}) < len(store.read().inputFiles()) / 5


def test_a_write_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    store = make(spark, tmp_path)
    store.insert(rows(spark, [("a", 1, "x")]), "pos")
    with monkeypatch.context() as m:
        m.setattr(keyed_store, "write_text", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.insert(rows(spark, [("b", 1, "x")]), "pos")
    assert [r.key for r in make(spark, tmp_path).read().collect()] == ["a"] and store.insert(rows(spark, [("b", 2, "y")]), "pos") == 1
    store.vacuum()
    assert sorted(r.key for r in store.read().collect()) == ["a", "b"] and not runstate.listed(spark, f"{store.root}/staged")


def test_layers_are_compacted_and_updates_touch_their_buckets(spark, tmp_path):
    store = make(spark, tmp_path, buckets=4)
    for k in range(6):
        store.insert(rows(spark, [(f"k{n}", n, str(k)) for n in range(10 * k, 10 * k + 10)]), "pos")
    assert store.compact(2) and max(map(len, store.state["tables"].values())) <= 2 and store.read().count() == 60
    touched = store.update(rows(spark, [("k7", 0, ""), ("none", 0, "")]), {"v": F.lit("set")})
    assert len(touched) <= 2 and {r.key: r.v for r in store.read().collect()} == {f"k{n}": "set" if n == 7 else str(n // 10) for n in range(60)}
    store.vacuum()
    assert store.read().count() == 60 and {f.split(f"{BUCKET}=")[0].rstrip("/").rpartition("/")[2] for f in runstate.listed(spark, f"{store.root}/tables") if BUCKET in f} == {t.rpartition("/")[2] for ts in store.state["tables"].values() for t in ts}


def test_seen_store_takes_in_the_file_and_exports_in_order(spark, tmp_path):
    (tmp_path / "seen.json").write_text(json.dumps({"matched_urls": ["z", "ä\"\\", "a"]}))
    root = f"file://{tmp_path}"
    store = seen.SeenStore(spark, root)
    found = spark.createDataFrame([("a",), ("é",), ("m",), ("",), (None,), ("m",)], "url string")
    assert store.publish(found, "2024-01-08") == 2 and seen.SeenStore(spark, root).publish(found, "2024-01-15") == 0
    store.export()
    text = (tmp_path / "seen.json").read_text()
    held = json.loads(text)["seen"]
    assert list(held.items()) == [("a", ""), ("m", "2024-01-08"), ("z", ""), ("ä\"\\", ""), ("é", "2024-01-08")] and list(held) == sorted(held)
    assert sorted(r.url for r in seen.read_seen(spark, f"{root}/seen.json").collect()) == sorted(held) and [p.name for p in tmp_path.iterdir() if "seen.json." in p.name and not p.name.endswith(".crc")] == []
    empty = seen.SeenStore(spark, f"{root}/other")
    empty.publish(found.limit(0), "2024-01-08")
    empty.export()
    assert json.loads((tmp_path / "other/seen.json").read_text()) == {"seen": {}}


def test_pool_in_the_store(spark, tmp_path):
    data = spark.createDataFrame([("a", "2024-01-01 01:00:00", 2), ("a", "2024-01-01 02:00:00", 1), ("b", "2024-01-02", 3)], "key string, ts string, pos long").withColumn("ts", F.col("ts").cast("timestamp"))
    store = pool.pool_store(spark, f"file://{tmp_path}/p", data)
    assert pool.ingest(store, data, 0) == 2 and pool.ingest(store, data, 0) == 0 and pool.ingest(store, data.withColumn("key", F.lit("new")), 0) == 0
    assert pool.ingest(store, data.withColumn("key", F.lit("new")), 1) == 1
    assert pool.consume(store, data.where("key = 'a'"), "r1") and pool.consume(store, data, "r2")
    assert {r.key: (r.pos, str(r.first_ingested), r.consumed_by) for r in store.read().collect()} == {"a": (1, "2024-01-01", "r1"), "b": (3, "2024-01-02", "r2"), "new": (1, "2024-01-01", None)}
