"""The whole run from a local server or landed files to the report, resumed, failing in part and failing whole."""

import json
import os
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from sieveworks import __main__ as cli
from sieveworks import judge as J
from sieveworks import runstate
from sieveworks.assets import read_assets
from sieveworks.config import FIRST_TPM, FRACTIONAL, RunConfig, from_environment
from sieveworks.pipeline import Run, TotalFailure
from sieveworks.sources import boards, live

SNIPPET = "We want our first TPM hire to establish the program management function from scratch."


@pytest.fixture
def web():
    """Pages by path, each a status and a body, and the paths that were asked for."""
    pages, asked = {}, []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            code, body = pages.get(self.path, (404, ""))
            if callable(code):
                code, body = code()
            self.send_response(code)
            self.end_headers()
            self.wfile.write(body.encode())

        def do_POST(self):
            asked.append((self.path, self.headers["Title"], self.rfile.read(int(self.headers["Content-Length"])).decode()))
            self.send_response(200)
            self.end_headers()

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", pages, asked
    server.shutdown()


def fill(pages):
    pages["/board"] = 200, json.dumps([{"legal": "x"}, {"position": "Agent engineer", "company": "B", "url": "b1", "date": "d", "description": "<p>contract", "tags": ["contract"]}])
    pages["/feed"] = 200, "<rss><channel><item><title>W: Agent lead</title><link>w1</link><description>x</description></item></channel></rss>"
    pages["/search"] = 200, json.dumps({"hits": [{"objectID": "7", "title": "Who"}, {"objectID": "6", "title": "old"}]})
    pages["/thread/7"] = 200, json.dumps({"id": 7, "children": [{"id": 70, "created_at": "d", "text": "Co | Agent dev | REMOTE<p>text"}, {"id": 71, "text": " "}]})
    pages["/g/acme"] = 200, json.dumps({"jobs": [{"title": "TPM", "absolute_url": "g1", "content": SNIPPET}, {"title": "Cook", "absolute_url": "g2", "content": "soup"}]})
    pages["/l/lev"] = 200, json.dumps([{"text": "First TPM", "hostedUrl": "l1", "createdAt": 5, "descriptionPlain": SNIPPET}])
    pages["/a/bad"] = 200, "<html>"
    pages["/a/down"] = 500, "no"


def endpoints(at):
    return json.dumps({"greenhouse": f"{at}/g/%s", "lever": f"{at}/l/%s", "ashby": f"{at}/a/%s"})


COMPANIES = [("Acme", "greenhouse", "acme", 80, "vc"), ("Lev", "lever", "lev", None, "vc"), ("Gone", "greenhouse", "gone", None, "vc"), ("Bad", "ashby", "bad", None, "vc"), ("Down", "ashby", "down", None, "vc"), ("Odd", "other", "odd", None, "vc"), ("Acme again", "greenhouse", "acme", 80, "vc")]


def companies(spark, rows=COMPANIES):
    return spark.createDataFrame(rows, "name string, ats string, token string, headcount int, source string")


def test_company_source_rows(spark, web):
    at, pages, asked = web
    fill(pages)
    rows = live.fetched_companies(spark, companies(spark), delay=0, backoff=0, endpoints=endpoints(at)).collect()
    status = {r.name: (r.status, r.attempts, r["count"]) for r in rows if r.kind == "status"}
    assert status == {"Acme": ("success", 1, 2), "Lev": ("success", 1, 1), "Gone": ("skipped", 1, 0), "Bad": ("failed", 2, 0), "Down": ("failed", 2, 0), "Odd": ("skipped", 0, 0)}
    assert sorted(json.loads(r.job).get("title") or json.loads(r.job)["text"] for r in rows if r.kind == "job") == ["Cook", "First TPM", "TPM"]
    assert asked.count("/g/acme") == 1 and asked.count("/a/down") == 2
    source = live._Companies({"companies": json.dumps([{"name": str(k), "ats": "lever", "token": "t"} for k in range(5)] + [{"name": "g", "ats": "greenhouse", "token": "t"}]), "callers": "2"})
    assert sorted(p.value for p in source.partitions()) == [[0, 2, 4], [1, 3], [5]]


def test_own_errors_end_the_read(spark, web):
    at, pages, _ = web
    with pytest.raises(Exception, match="format|not all arguments"):
        live.fetched_companies(spark, companies(spark, COMPANIES[:1]), delay=0, backoff=0, endpoints=json.dumps({"greenhouse": f"{at}/no-place"})).collect()


def test_total_failure_leaves_no_checkpoint_and_runs_again(spark, web, tmp_path):
    at, pages, asked = web
    config = RunConfig("2024-01-08", f"file://{tmp_path}", (FIRST_TPM,), delay_s=0)
    only = [c for c in COMPANIES if c[0] in ("Gone", "Bad", "Down")]
    fill(pages)
    run = Run(spark, config)
    ask = dict(backoff=0, endpoints=endpoints(at))
    with pytest.raises(TotalFailure):
        run.companies(lambda: companies(spark, only), **ask)
    assert run.held.read("fetch_ats") is None and run.manifest.data["stages"]["fetch_ats"] | {"started_at": 0, "finished_at": 0, "duration_s": 0} == {"status": "failed", "failed": ["Bad", "Down"], "started_at": 0, "finished_at": 0, "duration_s": 0}
    pages["/a/down"] = 200, json.dumps({"jobs": [{"title": "T", "jobUrl": "j", "descriptionPlain": "x"}]})
    assert [r.url for r in run.companies(lambda: companies(spark, only), **ask).collect()] == ["j"]
    before = len(asked)
    assert Run(spark, config).companies(lambda: companies(spark, only), **ask).count() == 1 and len(asked) == before
    assert run.boards({}) == {} and run.manifest.data["stages"]["fetch"]["status"] == "skipped"


def test_boards_fail_in_part_in_whole_or_by_our_own_error(spark, tmp_path):
    items = spark.createDataFrame([(0, "Dev", "c", "u", "d", "x", ["t"])], "pos long, position string, company string, url string, date string, description string, tags array<string>")
    tries = []

    def down():
        tries.append(1)
        raise TimeoutError("slow")

    run = Run(spark, RunConfig("2024-01-08", f"file://{tmp_path}", (FRACTIONAL,)))
    found = run.boards({"remoteok": lambda: items, "weworkremotely": down}, base_s=0)
    assert found["remoteok"].count() == 1 and len(tries) == 3 and list(found) == ["remoteok"]
    stage = run.manifest.data["stages"]["fetch"]
    assert stage["failed_sources"] == ["weworkremotely"] and stage["per_source"]["remoteok"] == {"status": "success", "count": 1, "attempts": 1} and stage["total_count"] == 1
    assert list(run.boards({"remoteok": down}, base_s=0)) == ["remoteok"] and len(tries) == 3  # from the stored tables
    other = Run(spark, RunConfig("2024-01-09", f"file://{tmp_path}", (FRACTIONAL,)))
    with pytest.raises(TotalFailure):
        other.boards({"remoteok": down, "missing": lambda: boards.landed.board_items(spark, f"file://{tmp_path}/none")}, base_s=0)
    assert other.held.read("fetch", "status") is None and other.manifest.data["stages"]["fetch"]["status"] == "failed"
    with pytest.raises(KeyError):
        other.boards({"remoteok": lambda: {}["bug"]}, base_s=0)


def arguments(at, tmp_path, *more):
    return ["--date", "2024-01-08", "--root", f"file://{tmp_path}/run", "--assets", f"file://{tmp_path}/assets", "--companies", f"file://{tmp_path}/companies.csv", "--board", f"{at}/board", "--feed", f"{at}/feed", "--search", f"{at}/search", "--thread", f"{at}/thread/%s", *more]


RULES = ["--rule", "fractional:agentic_ai_engineer:agent", "--rule", "first_tpm:first_tpm:first tpm"]


class Dying:
    """The rule judge, which ends its process at the first lane's first chunk of the other lane."""

    def __init__(self, folder):
        self.inner, self.folder = J.RuleJudge({FRACTIONAL: [("agentic_ai_engineer", "agent")], FIRST_TPM: [("first_tpm", "first tpm")]}), str(folder)

    def __call__(self, rows, lane):
        if len(os.listdir(self.folder)) == 2 and not os.path.exists(f"{self.folder}/../mended"):
            os._exit(7)
        open(f"{self.folder}/{rows[0]['url'].replace('/', '_')}-{os.urandom(3).hex()}", "w").close()
        return self.inner(rows, lane)


def test_command_line_from_pages_to_the_report_resumed_after_a_kill(spark, web, tmp_path, capsys):
    at, pages, asked = web
    fill(pages)
    for folder in ("assets", "calls"):
        (tmp_path / folder).mkdir()
    for name in ("ROLE_CRITERIA.md", "ROLE_CRITERIA_FIRST_TPM.md"):
        (tmp_path / "assets" / name).write_text(f"criteria of {name} {{}}")
    (tmp_path / "companies.csv").write_text("name,ats,token,headcount,source\n" + "".join(f"{n},{a},{t},{h or ''},{s}\n" for n, a, t, h, s in COMPANIES))
    env = {"SIEVEWORKS_CHUNK_SIZE": "1", "SIEVEWORKS_ATS_DELAY": "0", "SIEVEWORKS_TOPIC": f"{at}/topic", "SIEVEWORKS_CALLERS": "1"}
    judges = (Dying(tmp_path / "calls"), cli._ByLength())
    ask = dict(session=lambda: spark, env=env, fetch_backoff_s=0, endpoints=endpoints(at))
    assert cli.main(arguments(at, tmp_path), judges=judges, **ask) == 1
    notice = [a for a in asked if isinstance(a, tuple)]
    manifest = lambda: json.loads(runstate.read_text(spark, f"file://{tmp_path}/run/runs/2024-01-08/manifest.json"))
    assert "failed" in notice[0][1] and manifest()["status"] == "failed" and manifest()["stages"]["classify"]["status"] == "failed"
    fetched, called = [a for a in asked if not isinstance(a, tuple)], len(os.listdir(tmp_path / "calls"))
    (tmp_path / "mended").write_text("")
    assert called == 2 and cli.main(arguments(at, tmp_path), judges=judges, **ask) == 0
    assert [a for a in asked if not isinstance(a, tuple)] == fetched  # nothing is fetched again
    assert len(os.listdir(tmp_path / "calls")) == 5 and len({f.rsplit("-", 1)[0] for f in os.listdir(tmp_path / "calls")}) == 5
    text = (tmp_path / "run/matches/2024-01-08.md").read_text()
    assert all(u in text for u in ("b1", "w1", "item?id=70", "g1", "l1")) and "5 candidate listings" in text and "g2" not in text
    done = manifest()
    assert done["status"] == "success" and done["error"] is None and {s: done["stages"][s]["status"] for s in done["stages"]} == dict.fromkeys(("fetch", "fetch_ats", "normalize", "prefilter", "dedupe", "classify", "score", "digest"), "success")
    assert done["stages"]["prefilter"] | {"passed": 5, "filtered": 1, "near_misses": 0} == done["stages"]["prefilter"] and done["stages"]["dedupe"]["deduped_count"] == 5 and done["stages"]["fetch_ats"]["failed_companies"] == ["Bad", "Down"]
    last = [a for a in asked if isinstance(a, tuple)][-1]
    assert last[2].startswith("5 matches from 5 candidates") and "sources: companies 3, hn_whoishiring 1, remoteok 1, weworkremotely 1" in last[2]
    events = runstate.RunLog(spark, f"file://{tmp_path}/run", "2024-01-08").events()
    assert {e["stage"] for e in events} >= {"fetch", "fetch_ats", "classify", "digest"} and any(e["message"] == "using the stored table" for e in events)
    assert sorted(json.loads((tmp_path / "run/seen.json").read_text())["seen"]) == sorted(["b1", "w1", "https://news.ycombinator.com/item?id=70", "g1", "l1"])
    capsys.readouterr()
    assert cli.main([*arguments(at, tmp_path), "--force", *RULES], **ask) == 0 and (tmp_path / "run/matches/2024-01-08.md").read_text() == text
    assert "5 matches" in capsys.readouterr().out


def test_arguments_assets_and_settings(spark, tmp_path, capsys):
    with pytest.raises(SystemExit):
        cli.main(["--date", "2024-1-8", "--root", "r", "--assets", "a"])
    assert "YYYY-MM-DD" in capsys.readouterr().err
    assert cli.main(["--root", f"file://{tmp_path}", "--assets", f"file://{tmp_path}/none"], env={}, session=lambda: spark) == 1 and "criteria of lane" in capsys.readouterr().err
    (tmp_path / "ROLE_CRITERIA.md").write_text("{braces} stay")
    (tmp_path / "score_prompt.md").write_text("OWN {role_criteria} {listings_json}")
    assets = read_assets(spark, f"file://{tmp_path}", [FRACTIONAL])
    assert "{braces} stay" in assets.prompt([{"id": 1, "title": "x"}], FRACTIONAL) and assets.prompt([], FRACTIONAL, True).startswith("OWN {braces} stay")
    assert assets.salt("a")[FRACTIONAL] != assets.salt("b")[FRACTIONAL]
    config = from_environment("2024-01-01", "/r", {"SIEVEWORKS_MODEL": "m1", "SIEVEWORKS_JUDGE": "judge -p --model {model}", "SIEVEWORKS_TOPIC": "http://t"})
    assert (config.model, config.judge_command, config.topic) == ("m1", ("judge", "-p", "--model", "{model}"), "http://t")


def test_process_judge_is_called_with_prompt_model_and_schema(spark, tmp_path):
    from sieveworks.assets import process_judges

    (tmp_path / "ROLE_CRITERIA.md").write_text("criteria")
    program = tmp_path / "judge.sh"
    program.write_text('#!/bin/sh\ncat > "$0.in"\necho "$1 $2" > "$0.args"\necho \'{"verdicts":[{"id":1,"verdict":"no_match"}],"scores":[{"url":"u","fit_score":40,"rationale":"r"}]}\'\n')
    program.chmod(0o755)
    classify, score = process_judges([str(program), "{model}", "{schema}"], "m9", read_assets(spark, f"file://{tmp_path}", [FRACTIONAL]))
    assert classify([{"id": 1, "title": "T"}], FRACTIONAL) == [{"id": 1, "verdict": "no_match"}] and '"title": "T"' in (tmp_path / "judge.sh.in").read_text()
    assert (tmp_path / "judge.sh.args").read_text().startswith('m9 {"type": "object"') and "agentic_ai_engineer" in (tmp_path / "judge.sh.args").read_text()
    assert score([{"url": "u"}], FRACTIONAL)[0]["fit_score"] == 40


def test_counters_are_those_of_a_second_pass_and_of_no_rows(spark, tmp_path):
    from sieveworks.operators import dedupe, phrase

    rows = spark.range(60).select(F.concat(F.lit("u"), F.col("id") % 40).alias("url"), F.when(F.col("id") % 4 == 0, SNIPPET).otherwise("first things").alias("title"), F.lit("").alias("snippet"), F.when(F.col("id") % 2 == 0, FIRST_TPM).otherwise(FRACTIONAL).alias("lane"), F.col("id").alias("pos"))
    seen = spark.createDataFrame([("u3", "2023-01-01"), ("u5", "2024-01-08")], "url string, first_seen string")
    run = Run(spark, RunConfig("2024-01-08", f"file://{tmp_path}"))
    for n, given in enumerate((rows, rows.limit(0), rows.withColumn("url", F.lit("")))):
        passed = run.stored("prefilter", f"k{n}", lambda given=given: given, phrase.observed)
        want = phrase.counts(given).first().asDict()
        assert run.manifest.data["stages"]["prefilter"] | want == run.manifest.data["stages"]["prefilter"] and passed.count() == want["passed"]
        kept = run.stored("dedupe", f"k{n}", lambda: passed, lambda df: dedupe.observed(df, seen, "2024-01-08"))
        want = dedupe.drop_counts(passed, seen, "2024-01-08").first().asDict()
        assert run.manifest.data["stages"]["dedupe"] | want == run.manifest.data["stages"]["dedupe"] and kept.count() == want["deduped_count"] == dedupe.deduplicated(passed, seen, "2024-01-08").count()
