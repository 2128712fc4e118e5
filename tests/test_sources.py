"""Landed files, live readers without a network, run state and the streaming pool."""

import json
import re
import urllib.error

import pytest
from pyspark.sql import functions as F

from sieveworks import runstate
from sieveworks.operators import status
from sieveworks.sources import landed, live
from sieveworks.streaming import pool


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return f"file://{tmp_path}/{name}"


def test_board_file_drops_what_has_no_position(spark, tmp_path):
    path = put(tmp_path, "b.json", json.dumps([{"legal": "x"}, {"position": "Dev", "tags": ["contract"], "url": "u"}, {"position": "Ops"}]))
    rows = landed.board_items(spark, path).orderBy("pos").collect()
    assert [(r.pos, r.position, r.tags) for r in rows] == [(1, "Dev", ["contract"]), (2, "Ops", None)]


def test_feed_files_follow_each_other(spark, tmp_path):
    item = "<item><title> A: B </title><link>{}</link><description>&lt;p&gt;x&lt;/p&gt;</description></item>"
    paths = [put(tmp_path, f"{k}.xml", f"<rss><channel>{item.format(f'{k}a')}{item.format(f'{k}b')}</channel></rss>") for k in "yx"]
    rows = landed.feed_items(spark, paths).orderBy("pos").collect()
    assert [r.link for r in rows] == ["ya", "yb", "xa", "xb"] and (rows[0].title, rows[0].pubDate, rows[0].description) == ("A: B", "", "<p>x</p>")


def test_thread_is_the_first_hit(spark, tmp_path):
    search = put(tmp_path, "s.json", json.dumps({"hits": [{"objectID": "2", "title": "new"}, {"objectID": "1", "title": "old"}]}))
    thread = put(tmp_path, "t.json", json.dumps({"id": 2, "children": [{"id": 5, "created_at": "d", "text": "x"}, {"id": 6, "text": "  "}, {"id": 7}]}))
    assert [(r.pos, r.thread_title, r.id) for r in landed.thread_items(spark, search, thread).collect()] == [(0, "new", "5")]


def test_companies(spark, tmp_path):
    path = put(tmp_path, "c.csv", "name,ats,token,headcount,source\n Acme , lever ,a,,x\nB,ashby,b,80,\n")
    assert [tuple(r) for r in landed.companies(spark, path).collect()] == [("Acme", "lever", "a", None, "x"), ("B", "ashby", "b", 80, "")]
    assert landed.companies(spark, f"file://{tmp_path}/none.csv").count() == 0


def test_company_results(spark):
    pages = spark.createDataFrame([(("A", "ashby", "a", None), 0, 200, '{"jobs":[{"title":"T"}]}'), (("L", "lever", "l", None), 1, 200, '[{"text":"T"}]'), (("M", "lever", "m", None), 2, 200, '{"ok":false}'), (("N", "ashby", "n", None), 3, 404, None), (("O", "ashby", "o", None), 4, 500, None)], "company struct<name:string,ats:string,token:string,headcount:int>, pos long, http_status int, body string")
    assert [(r.status, r["count"]) for r in landed.company_results(spark, pages).orderBy("pos").collect()] == [("success", 1), ("success", 1), ("success", 0), ("skipped", 0), ("failed", 0)]


def test_fetch_tolerates_only_its_errors():
    def read(code):
        def f(url):
            raise urllib.error.HTTPError(url, code, "x", {}, None)

        return f

    assert live.fetched("u", 2, 0, read(404), lambda s: None) == {"http_status": 404, "body": None, "error": None, "attempts": 1}
    assert live.fetched("u", 2, 0, read(503), lambda s: None)["http_status"] == 503
    with pytest.raises(KeyError):
        live.fetched("u", 2, 0, lambda u: {}["x"], lambda s: None)
    assert live.fetched("u", 1, 0, lambda u: b"ok")["body"] == "ok"


def test_urls_and_notice(spark):
    df = spark.createDataFrame([("greenhouse", "g"), ("ashby", "a"), ("lever", "l"), ("x", "x")], "ats string, token string")
    got = [r.u for r in df.select(live.job_url().alias("u")).collect()]
    assert got[0].endswith("/g/jobs?content=true") and got[2].endswith("/l?mode=json") and got[3] is None
    assert not live.notified("m", None, title="t") and not live.notified("m", "http://x", title="t", send=lambda *a, **k: 1 / 0) and live.notified("m", "http://x", title="t", send=lambda *a, **k: None)


def test_pages_source_reads_by_partition(spark):
    reader = live.PagesSource({"urls": json.dumps(["u1", "u2", "u3"]), "delay": "0", "partitions": "2"}).reader(None)
    assert len(reader.partitions()) == 2


def test_text_files_and_checkpoints(spark, tmp_path):
    root = f"file://{tmp_path}"
    runstate.write_text(spark, f"{root}/a.txt", "one")
    runstate.write_text(spark, f"{root}/a.txt", "two é")
    assert runstate.read_text(spark, f"{root}/a.txt") == "two é" and runstate.read_text(spark, f"{root}/b.txt") is None
    held, made = runstate.Checkpoints(spark, root, "2024-01-01"), []

    def make():
        made.append(1)
        return spark.range(3)

    assert held.memoized("s", make).count() == held.memoized("s", make).count() == 3 and len(made) == 1
    held.memoized("s", make, force=True)
    runstate.write_text(spark, f"{root}/runs/2024-01-01/s/all.json", "{broken")
    assert held.read("s") is None and len(made) == 2
    assert runstate.fingerprint(spark.range(5), "id") == runstate.fingerprint(spark.range(5).repartition(3), "id") != runstate.fingerprint(spark.range(6), "id")


def test_manifest_and_log(spark, tmp_path):
    root = f"file://{tmp_path}"
    m = runstate.Manifest(spark, root, "2024-01-01", ("fetch",))
    assert runstate.read_text(spark, m.path) is None
    m.run_started()
    m.stage("fetch", "running")
    m.stage("fetch", "success", count=3)
    m.run_finished("boom")
    m.run_finished()
    data = json.loads(runstate.read_text(spark, m.path))
    assert data["status"] == "success" and data["error"] is None and data["stages"]["fetch"]["count"] == 3 and data["stages"]["fetch"]["duration_s"] >= 0
    runstate.log(spark, root, "2024-01-01", "fetch", "hi", extra=1)
    runstate.log(spark, root, "2024-01-01", "fetch", "ho")
    assert [(e["message"], e.get("extra")) for e in runstate.RunLog(spark, root, "2024-01-01").events()] == [("hi", 1), ("ho", None)]


def events(spark, rows):
    return spark.createDataFrame(rows, "key string, ts string, pos long").withColumn("ts", F.col("ts").cast("timestamp"))


def test_pool(spark):
    empty = events(spark, [("x", "2024-01-01", 0)]).limit(0).withColumns({"first_ingested": F.to_date("ts"), "consumed_by": F.lit(None).cast("string")})
    day1 = events(spark, [("a", "2024-01-01 01:00:00", 2), ("a", "2024-01-01 02:00:00", 1), ("b", "2024-01-01", 3)])
    one = pool.merged(empty, day1)
    again = pool.merged(one, day1)
    assert sorted((r.key, r.pos) for r in one.collect()) == sorted((r.key, r.pos) for r in again.collect()) == [("a", 1), ("b", 3)]
    used = pool.consumed(again, again.where("key = 'a'"), "r1")
    assert {r.key: r.consumed_by for r in pool.consumed(used, used, "r2").collect()} == {"a": "r1", "b": "r2"}
    assert pool.window_of(used, "2023-12-31", "2024-01-07").count() == 1 and pool.window_of(used, "2023-12-31", "2024-01-07", report="r1").count() == 2
    assert pool.coverage(day1, "2024-01-03").first().covered_days == 1


def test_feed_items_at_any_depth_and_broken_feeds(spark, tmp_path):
    deep = tmp_path / "deep.xml"
    deep.write_text("<rdf><item><title> A: b </title></item><x><item><link>u</link></item></x></rdf>")
    rows = landed.feed_items(spark, [str(deep)]).orderBy("pos").collect()
    assert [(r.title, r.link) for r in rows] == [("A: b", ""), ("", "u")]
    broken = tmp_path / "broken.xml"
    broken.write_text("<rss><channel>")
    with pytest.raises(Exception, match="no element found"):
        landed.feed_items(spark, [str(broken)]).collect()


def test_answers_that_are_no_json_failed_and_attempts_are_kept(spark):
    pages = spark.createDataFrame([(("a", "lever"), 0, 200, "<html>", 3), (("b", "greenhouse"), 1, 200, '{"jobs": []}', 1), (("c", "greenhouse"), 2, 404, None, 2), (("d", "lever"), 3, 200, None, 1)], "company struct<name:string,ats:string>, pos long, http_status int, body string, attempts int")
    got = [(r.status, r.attempts, r["count"]) for r in landed.company_results(spark, pages).orderBy("pos").collect()]
    assert got == [("failed", 3, 0), ("success", 1, 0), ("skipped", 2, 0), ("failed", 1, 0)]


def test_a_failed_write_keeps_the_old_content(spark, tmp_path, monkeypatch):
    at = f"file://{tmp_path}/deep/seen.json"
    runstate.write_text(spark, at, "old")

    def fails(*a):
        raise OSError("no")

    with monkeypatch.context() as m:
        m.setattr(runstate.os, "replace", fails)
        with pytest.raises(OSError):
            runstate.write_text(spark, at, "new")
    assert runstate.read_text(spark, at) == "old" and [f.name for f in (tmp_path / "deep").iterdir()] == ["seen.json"]
    runstate.write_text(spark, at, "newer")
    assert runstate.read_text(spark, at) == "newer"


def test_a_failure_is_not_hidden_by_a_success(spark):
    rows = spark.createDataFrame([("a", "success", 1, 2), ("a", "failed", 2, 0), ("b", "skipped", 1, 0), ("b", "success", 1, 1)], "name string, status string, attempts int, count long")
    assert [tuple(r) for r in status.by_source(rows).orderBy("name").collect()] == [("a", "failed", 2, 2), ("b", "success", 1, 1)]


def test_only_hit_threads_are_read(spark, tmp_path, monkeypatch):
    comments = spark.createDataFrame([(str(t), k, f"{t}/{k}", "d", " " if k == 2 else f"text {t} {k}") for t in range(300) for k in range(4)], "thread string, pos long, id string, created_at string, text string")
    path = landed.land_threads(comments, f"file://{tmp_path}/threads")
    said = lambda *hits: json.dumps({"hits": [{"objectID": h, "title": f"T{h}"} for h in hits]})
    searches = spark.createDataFrame([("a", said("7", "8")), ("b", said("7")), ("c", said()), ("d", "<html>"), ("e", said("999", "9")), ("f", said("250")), ("g", None)], "search string, body string")
    want = sorted((s, t, k, f"T{t}", f"{t}/{k}") for s, t in (("a", "7"), ("b", "7"), ("f", "250")) for k in (0, 1, 3))
    found = landed.dependent_items(searches, path)
    assert sorted((r.search, r.thread, r.pos, r.thread_title, r.id) for r in found.collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*folder#\d+ IN \(", plan) and "PushedFilters: [In(thread" in plan
    monkeypatch.setattr(landed, "NAMED_THREADS", 1)
    assert sorted((r.search, r.thread, r.pos, r.thread_title, r.id) for r in landed.dependent_items(searches, path).collect()) == want
    assert landed.dependent_items(searches.limit(0), path).count() == 0
