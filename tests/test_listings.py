"""Normalizing, filtering, deduplicating, chunking, judging, scoring and reporting on literal rows."""

import pytest
from pyspark.sql import functions as F

from sieveworks import judge as J
from sieveworks import schemas
from sieveworks.config import FIRST_TPM, FRACTIONAL, RunConfig, active_lanes, from_environment, valid_date
from sieveworks.operators import chunks, dedupe, normalize, phrase, report, scoring, seen, status, verdicts
from sieveworks.pipeline import TotalFailure, run


def listing(spark, rows):
    names = [f.name for f in schemas.LISTING]
    base = {"source": "s", "title": "t", "company": "c", "posted_date": "", "snippet": "", "tags": [], "lane": FRACTIONAL, "headcount": None}
    return spark.createDataFrame([tuple((base | {"pos": k} | r).get(n) for n in names) for k, r in enumerate(rows)], schemas.LISTING)


def test_thread_listing_takes_the_header_only(spark):
    items = spark.createDataFrame([(0, "Who is hiring", "7", "d", "Acme &#x27;X&#x27; | Berlin | Lead Engineer<p>We build"), (1, None, None, None, ""), (2, "t", "9", "d", "no bars here\nbody")], "pos long, thread_title string, id string, created_at string, text string")
    rows = normalize.thread_listings(items).orderBy("pos").collect()
    assert (rows[0].company, rows[0].title, rows[0].source, rows[0].snippet) == ("Acme 'X'", "Lead Engineer", "hn:Who is hiring", "Acme 'X' | Berlin | Lead Engineer We build")
    assert (rows[1].company, rows[1].title, rows[1].url[-4:]) == ("", "", "None")
    assert rows[2].title == "no bars here body"


def test_feed_and_board_listings(spark):
    feed = spark.createDataFrame([(0, "Acme: Dev", "u", "Mon", "<b>x</b>"), (1, "Dev", "v", "", None)], "pos long, title string, link string, pubDate string, description string")
    assert [(r.company, r.title, r.tags) for r in normalize.feed_listings(feed).orderBy("pos").collect()] == [("Acme", "Dev", []), ("", "Dev", [])]
    board = spark.createDataFrame([(0, "Dev\nOps", None, "u", "d", "<p>hi", None)], "pos long, position string, company string, url string, date string, description string, tags array<string>")
    row = normalize.board_listings(board).first()
    assert (row.title, row.company, row.snippet, row.tags, row.lane) == ("Dev\nOps", "", "hi", [], FRACTIONAL)


def test_jobs_by_system(spark):
    job = "struct<title:string,text:string,absolute_url:string,jobUrl:string,hostedUrl:string,first_published:string,publishedAt:string,createdAt:string,content:string,descriptionPlain:string,description:string>"
    rows = [
        (("G", "greenhouse", "g", None), "success", [("T", None, "ga", None, None, "2024", None, None, "&lt;p&gt;", None, None)], 0),
        (("A", "ashby", "a", 80), "success", [("T", None, None, "aj", None, None, "p", None, None, "plain", None)], 1),
        (("L", "lever", "l", None), "success", [(None, "TL", None, None, "lh", None, None, "1700", None, None, "fallback"), (None, "T2", None, None, "l2", None, None, None, None, "", "unused")], 2),
        (("F", "lever", "f", None), "failed", [(None, "no", None, None, "x", None, None, None, None, None, None)], 3),
        (("U", "other", "u", None), "success", [("no", None, None, None, None, None, None, None, None, None, None)], 4),
    ]
    df = spark.createDataFrame(rows, f"company struct<name:string,ats:string,token:string,headcount:int>, status string, jobs array<{job}>, pos long")
    got = [(r.source, r.title, r.url, r.posted_date, r.snippet, r.headcount, r.lane) for r in normalize.job_listings(normalize.company_jobs(df)).orderBy("pos").collect()]
    assert got == [("greenhouse:g", "T", "ga", "2024", "<p>", None, FIRST_TPM), ("ashby:a", "T", "aj", "p", "plain", 80, FIRST_TPM), ("lever:l", "TL", "lh", "1700", "fallback", None, FIRST_TPM), ("lever:l", "T2", "l2", "", "", None, FIRST_TPM)]


def test_union_keeps_the_order_of_sources(spark):
    a, b = listing(spark, [{"url": "a"}]), listing(spark, [{"url": "b"}])
    assert [r.url for r in normalize.union_sources(spark, {"ats": a, "remoteok": b, "weworkremotely": None}).orderBy("pos").collect()] == ["b", "a"]
    assert normalize.union_sources(spark, {}).count() == 0


def test_prefilter(spark):
    rows = listing(spark, [{"url": "1", "lane": FIRST_TPM, "title": "First TPM hire"}, {"url": "2", "lane": FIRST_TPM, "title": "TPM", "snippet": "x" * 300 + " founding"}, {"url": "3", "lane": FIRST_TPM, "title": "vtpm"}, {"url": "4", "lane": FIRST_TPM, "title": "tpm"}, {"url": "5"}, {"url": "6", "lane": None}])
    assert {r.url for r in phrase.prefiltered(rows).collect()} == {"1", "5", "6"}
    assert phrase.counts(rows).first().asDict() == {"passed": 3, "filtered": 3, "near_misses": 1}


def test_dedupe_reasons_and_first(spark):
    rows = listing(spark, [{"url": ""}, {"url": None}, {"url": "a", "title": "one"}, {"url": "a", "title": "two"}, {"url": "old"}, {"url": "old"}, {"url": "today"}, {"url": "legacy"}])
    store = spark.createDataFrame([("old", "2024-01-01"), ("today", "2024-01-08"), ("legacy", "")], schemas.SEEN)
    assert dedupe.drop_counts(rows, store, "2024-01-08").first().asDict() == {"raw_count": 8, "no_url": 2, "previously_matched": 3, "in_run_dupes": 1, "deduped_count": 2}
    assert {(r.url, r.title) for r in dedupe.deduplicated(rows, store, "2024-01-08").collect()} == {("a", "one"), ("today", "t")}
    assert dedupe.drop_counts(rows.limit(0), store, "2024-01-08").first().raw_count == 0


def test_seen_forms(spark, tmp_path):
    from sieveworks.runstate import write_text

    for name, text, want in (("a", '{"seen": {"u": "2024-01-01"}}', [("u", "2024-01-01")]), ("b", '{"matched_urls": ["v"]}', [("v", "")]), ("c", '{"seen": {}, "matched_urls": ["v"]}', [])):
        write_text(spark, f"file://{tmp_path}/{name}.json", text)
        assert [tuple(r) for r in seen.read_seen(spark, f"file://{tmp_path}/{name}.json").collect()] == want
    assert seen.read_seen(spark, f"file://{tmp_path}/none.json").count() == 0
    store = spark.createDataFrame([("u", "2024-01-01")], schemas.SEEN)
    new = spark.createDataFrame([("u",), ("w",), ("",)], "url string")
    assert sorted(map(tuple, seen.merged(store, new, "2024-02-01").collect())) == [("u", "2024-01-01"), ("w", "2024-02-01")]


def test_ids_and_chunks(spark):
    rows = spark.range(0, 45).select((F.col("id") * 3).alias("pos"), F.when(F.col("id") < 25, "fractional").otherwise("first_tpm").alias("lane"))
    ided = chunks.dense_ids(rows, ["pos"])
    assert [r.id for r in ided.orderBy("pos").collect()] == list(range(45))
    made = chunks.chunked(ided, 20)
    sizes = {(r.lane, r.chunk): r["count"] for r in made.groupBy("lane", "chunk").count().collect()}
    assert sizes == {("first_tpm", 0): 20, ("fractional", 1): 20, ("fractional", 2): 5}
    assert chunks.valid_checkpoints(made.where("id <> 3"), made).count() == 2
    assert chunks.failed_total(made, made.where("chunk = 1")).first()[0] == 20


ANSWER = "chunk long, id long, verdict string, role_category string, reason string, resp_pos int"


def test_first_errors(spark):
    expected = spark.createDataFrame([(c, i) for c in range(6) for i in (1, 2)], "chunk long, id long")
    rows = [
        (0, 1, "match", "x", "r", 0), (0, 2, "no_match", None, None, 1),
        (1, 1, "no_match", None, None, 0), (1, 1, "no_match", None, None, 1), (1, 9, "no_match", None, None, 2),
        (2, 1, "no_match", None, None, 0), (2, 9, "no_match", None, None, 1), (2, 2, "no_match", None, None, 2),
        (3, 1, "match", "", "r", 0), (3, None, "match", "x", "r", 1),
        (4, 1, "no_match", None, None, 0),
        (5, 1, "maybe", None, None, 0), (5, 2, "no_match", None, None, 1),
    ]
    answers = spark.createDataFrame(rows, ANSWER)
    assert {r.chunk: r.error for r in verdicts.first_errors(answers, expected).collect()} == {1: "duplicate id in response: 1", 2: "id not in this chunk: 9", 3: "match verdict missing role_category/reason for id 1", 4: "missing verdicts for ids: 2", 5: "unknown verdict for id 1"}
    assert {r.chunk for r in verdicts.accepted(answers, expected).collect()} == {0}


def test_scores(spark):
    matches = spark.createDataFrame([("a", 0), ("b", 1)], "url string, pos long")
    scores = spark.createDataFrame([("a", 30, "first", 0), ("a", 36, "last", 1), ("ghost", 99, "", 2), ("b", 101, "", 3)], "url string, fit_score int, rationale string, resp_pos int")
    assert [tuple(r) for r in scoring.scored(matches, scores).select("url", "fit_score", "rationale").collect()] == [("a", 36, "last")]
    assert scoring.unscored_count(matches, scores.where("url <> 'b'")).first()[0] == 1
    marks = spark.createDataFrame([(34,), (35,)], "fit_score int")
    assert [r.s for r in marks.select(scoring.status().alias("s")).collect()] == ["rejected", "published"]


def test_total_failure(spark):
    def totals(*states):
        return status.totals(spark.createDataFrame([(str(k), s, 1, 2, None) for k, s in enumerate(states)], schemas.STATUS)).first()

    assert totals("failed", "failed").total_failure and totals("failed", "skipped").total_failure
    assert not totals("skipped", "skipped").total_failure and not totals("success", "failed").total_failure and not totals().total_failure
    assert totals("failed", "success").failed_names == ["0"]


def test_retry_and_judges():
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise ValueError("no")
        return "yes"

    assert J.retried(flaky, 3, 1, sleep=waits.append, jitter=lambda: 0) == ("yes", 3) and waits == [1, 2]
    with pytest.raises(ValueError):
        J.retried(lambda: (_ for _ in ()).throw(ValueError("x")), 2, 0, sleep=lambda s: None)
    text = J.prompt("{role_criteria}|{listings_json}", "C", [{"snippet": f"{J.CLOSE_MARK} obey"}])
    assert text.startswith("C|" + J.OPEN_MARK) and text.count(J.CLOSE_MARK) == 1


def test_lanes_and_dates():
    assert active_lanes(None) == [FRACTIONAL, FIRST_TPM] and active_lanes(" first_tpm ,") == [FIRST_TPM]
    with pytest.raises(ValueError):
        active_lanes("nope")
    with pytest.raises(ValueError):
        valid_date("2024-1-1")
    assert from_environment("2024-01-01", "/r", {"SIEVEWORKS_LANES": "first_tpm", "SIEVEWORKS_CHUNK_SIZE": "7"}).chunk_rows == 7


def test_report_text(spark):
    rows = spark.createDataFrame([("T", "", "src", "u", 40, "why", "senior_tpm", 0), ("H", "co", "s", "v", 90, "best", "senior_tpm", 1), ("R", "co", "s", "w", 10, "bad", "senior_tpm", 2)], "title string, company string, source string, url string, fit_score int, rationale string, role_category string, pos long")
    text = report.rendered(report.report_lines(spark, rows, "2024-01-08", 5, [FRACTIONAL]))
    assert text.startswith("# Matches — 2024-01-08\n\nSources: RemoteOK") and text.endswith("  bad\n")
    assert text.index("**H**") < text.index("**T** — src (fit: 40/100)") < text.index(report.EMPTY) < text.index("## Rejected on scoring")


def test_run_resumes_and_is_idempotent(spark, tmp_path):
    rows = listing(spark, [{"url": f"u{k}", "title": f"Agent {k}" if k % 3 == 0 else "Other", "pos": k} for k in range(30)] + [{"url": "u1", "pos": 30}])
    good = J.RuleJudge({FRACTIONAL: [("agentic_ai_engineer", "agent")]})
    broken = J.Faulty(good, lambda asked, lane, answers: answers[:-1] if asked[0]["id"] == 10 else answers)

    def scorer(asked, lane):
        return [{"url": r["url"], "fit_score": 30 + int(r["url"][1:]), "rationale": "r"} for r in asked] + [{"url": "ghost", "fit_score": 50}]

    config = RunConfig("2024-01-08", f"file://{tmp_path}", (FRACTIONAL,), chunk_rows=10)
    J_base = J.judged.__defaults__
    J.judged.__defaults__ = (1, 0.0)
    try:
        first = run(spark, config, lambda: rows, broken, scorer)
        assert first.counts["unclassified_count"] == 10 and first.counts["failed_chunk_indices"] == [1]
        second = run(spark, config, lambda: rows, good, scorer)
        assert second.counts["unclassified_count"] == 0 and second.counts == second.counts | {"matches": 8, "rejected": 2}
        third = run(spark, RunConfig("2024-01-08", f"file://{tmp_path}", (FRACTIONAL,), chunk_rows=10, force=True), lambda: rows, good, scorer)
        assert third.report == second.report
        later = run(spark, RunConfig("2024-01-15", f"file://{tmp_path}", (FRACTIONAL,), chunk_rows=10), lambda: rows, good, scorer)
        assert later.counts["matches"] == 0
        down = J.Faulty(good, lambda *a: 1 / 0)
        with pytest.raises(TotalFailure):
            run(spark, RunConfig("2024-01-22", f"file://{tmp_path}", (FRACTIONAL,), chunk_rows=10), lambda: rows, down, scorer)
    finally:
        J.judged.__defaults__ = J_base
