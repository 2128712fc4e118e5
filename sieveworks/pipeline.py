"""A run from sources or listings to the report, in stages that can be resumed."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import judge as J
from . import ledger as L
from . import schemas
from .config import FIRST_TPM, FRACTIONAL, LANES, RunConfig
from .operators import chunks, dedupe, normalize, phrase, report, scoring, seen, status, verdicts
from .runstate import Checkpoints, Manifest, RunLog, fingerprint, write_text
from .sources import boards, live
from .vocab import STAGES, PhraseRules


class TotalFailure(RuntimeError):
    """Every source, company, chunk or lane failed; the stage leaves no checkpoint and runs again next time."""


@dataclass
class Outcome:
    """What a run published."""

    report: str
    scored: DataFrame
    counts: dict


class Run:
    """One date's run: its stages, and where they note what became of them.

    Stages are stored by run date and by a key of the active lanes and the
    input's content, so a run with other lanes or listings reuses nothing stale.
    Counters are observed while a stage is written, not by a second pass; a
    stage that is reused keeps those of the run that made it.  A task that Spark
    runs again after it has ended may count twice in them.
    """

    def __init__(self, spark: SparkSession, config: RunConfig):
        self.spark, self.config, self.stage = spark, config, "fetch"
        self.manifest, self.held = Manifest(spark, config.root, config.run_date, STAGES), Checkpoints(spark, config.root, config.run_date)
        self.log = RunLog(spark, config.root, config.run_date)
        self.ledger = L.Ledger(spark, config.root)

    def guarded(self, work: Callable[[], Outcome]) -> Outcome:
        """The manifest says how work ended; a failure also goes to the topic, if there is one, and a success with its figures."""
        self.manifest.run_started()
        config = self.config
        try:
            out = work()
        except Exception as e:
            said = str(e)[:500] or type(e).__name__
            self.manifest.stage(self.stage, "failed", error=said)
            self.manifest.run_finished(f"{self.stage}: {said}")
            self.log.event(self.stage, "failed", "ERROR", error=said)
            live.notified(f"run {config.run_date} failed: {said}", config.topic, title="run failed", priority="high")
            raise
        self.manifest.run_finished()
        live.notified(self.heartbeat(), config.topic, title=f"run {config.run_date} ok")
        return out

    def heartbeat(self) -> str:
        """A13 of what the manifest says."""
        stages = self.manifest.data["stages"]
        each = stages.get("fetch", {}).get("per_source", {}) | ({"companies": {"count": stages["fetch_ats"]["total"]}} if "total" in stages.get("fetch_ats", {}) else {})
        sources = self.spark.createDataFrame([(n, r["count"]) for n, r in each.items()], "name string, count long")
        said = [stages.get(s, {}).get(c) for s, c in (("digest", "matches"), ("dedupe", "deduped_count"), ("digest", "rejected"), ("classify", "unclassified_count"))]
        summary = self.spark.createDataFrame([(*said, len(stages.get("classify", {}).get("failed_chunk_indices", [])))], "matches long, candidates long, rejected long, unclassified long, failed_chunks long")
        return report.heartbeat(sources, summary).first().message

    def skipped(self, stage: str) -> None:
        self.manifest.stage(stage, "skipped")

    def stored(self, stage: str, key: str, make: Callable[[], DataFrame], counters: Callable[[DataFrame], tuple[DataFrame, list[Column], Callable[[DataFrame], DataFrame]]] | None = None) -> DataFrame:
        """The stage's table if it is there, else what make gives; K8: counters gives the rows to observe, the counters and what is then stored."""
        self.stage = stage
        if not self.config.force and (found := self.held.read(stage, key)) is not None:
            self.log.event(stage, "using the stored table")
            self.manifest.stage(stage, "success")
            return found
        self.manifest.stage(stage, "running")
        rows, said = make(), {}
        if counters is None:
            out = self.held.write(stage, rows, key)
        else:
            rows, columns, rest = counters(rows)
            seen_by = Observation(f"{stage}-{key}"[:200])
            out = self.held.write(stage, rest(rows.observe(seen_by, *columns)), key)
            said = seen_by.get
        self.log.event(stage, "done", **said)
        self.manifest.stage(stage, "success", **said)
        return out

    # --- sources ----------------------------------------------------------

    def boards(self, given: Mapping[str, boards.Source], attempts: int = 3, base_s: float = 1.0) -> dict[str, DataFrame]:
        """The boards' listings (C2, C3, A2, A4): a source that fails is a status row; if all do, nothing is kept."""
        self.stage = "fetch"
        if FRACTIONAL not in self.config.lanes:
            self.skipped("fetch")
            return {}
        done = None if self.config.force else self.held.read("fetch", "status")
        if done is not None:
            self.log.event("fetch", "using the stored table")
            names = [r.name for r in done.where("status = 'success'").collect()]  # a row a source
            items = {n: self.held.read("fetch", n) for n in names}
            if all(df is not None for df in items.values()):
                self.manifest.stage("fetch", "success")
                return boards.listings(items)
        self.manifest.stage("fetch", "running")
        items, rows = boards.fetched(given, lambda name, df: self.held.write("fetch", df, name), attempts=attempts, base_s=base_s, on_retry=lambda name, k, e: self.log.event("fetch", "retry", "WARNING", source=name, attempt=k, error=str(e)[:500]))
        for name, state, used, count, error in rows:
            self.log.event("fetch", state, "INFO" if state == "success" else "ERROR", source=name, attempts=used, count=count, error=error)
        said = self.spark.createDataFrame(rows, schemas.STATUS)
        self._refuse_total(said, "all sources failed")
        self.held.write("fetch", said, "status")
        failed = sorted(r[0] for r in rows if r[1] == "failed")
        self.manifest.stage("fetch", "success", total_count=sum(r[3] for r in rows), failed_sources=failed, per_source={r[0]: {"status": r[1], "count": r[3], "attempts": r[2]} for r in rows})
        return boards.listings(items)

    def _refuse_total(self, rows: DataFrame, message: str) -> dict:
        totals = status.totals(rows).first().asDict()
        if totals["total_failure"]:
            self.manifest.stage(self.stage, "failed", failed=totals["failed_names"])
            raise TotalFailure(f"{self.stage}: {message}")
        return totals

    def companies(self, given: Callable[[], DataFrame] | None, **options) -> DataFrame | None:
        """The companies' listings: the network is read once, into the stage's table, which counts only if some reachable company answered."""
        self.stage = "fetch_ats"
        if FIRST_TPM not in self.config.lanes or given is None:
            self.skipped("fetch_ats")
            return None
        rows = None if self.config.force else self.held.read("fetch_ats")
        if rows is None:
            self.manifest.stage("fetch_ats", "running")
            totals: dict = {}
            asked = live.fetched_companies(self.spark, given(), delay=self.config.delay_s, **options)
            rows = self.held.write("fetch_ats", asked, check=lambda df: totals.update(self._refuse_total(live.company_status(df), "all reachable companies failed")))
            self.log.event("fetch_ats", "done", succeeded=totals["succeeded"], skipped=totals["skipped"], failed=totals["failed_names"])
            self.manifest.stage("fetch_ats", "success", **{k: totals[k] for k in ("total", "succeeded", "skipped", "failed")}, failed_companies=totals["failed_names"])
        else:
            self.log.event("fetch_ats", "using the stored table")
            self.manifest.stage("fetch_ats", "success")
        return normalize.job_listings(live.company_jobs(rows))

    # --- from listings on -------------------------------------------------

    def published(self, listings: Callable[[], DataFrame], judge: J.Judge, scorer: J.Judge, rules: PhraseRules, salt: Mapping[str, str]) -> Outcome:
        spark, config = self.spark, self.config
        lanes = "-".join(sorted(config.lanes))
        rows = self.stored("normalize", lanes, lambda: listings().where(F.coalesce("lane", F.lit(FRACTIONAL)).isin(*config.lanes)), lambda df: (df, [F.count(F.lit(1)).alias("count")], lambda x: x))
        key = f"{lanes}-{fingerprint(rows, 'url', 'title', 'snippet', 'lane', 'pos')}"

        passed = self.stored("prefilter", key, lambda: rows, lambda df: phrase.observed(df, rules))

        self.stage = "dedupe"
        store = seen.SeenStore(spark, config.root)
        known = store.read()
        key = f"{key}-{fingerprint(known.where(F.col('first_seen') != config.run_date), 'url')}"
        kept = self.stored("dedupe", key, lambda: passed, lambda df: dedupe.observed(df, known, config.run_date))
        candidates = self.manifest.data["stages"]["dedupe"].get("deduped_count")
        candidates = kept.count() if candidates is None else candidates

        self.stage = "classify"
        self.manifest.stage("classify", "running")
        ided = self.held.memoized("chunks", lambda: chunks.chunked(chunks.dense_ids(kept, ["pos"]), config.chunk_rows), f"{key}-{config.chunk_rows}", config.force)
        said = {lane: f"{config.run_date}\x00{salt.get(lane, '')}" for lane in config.lanes}
        given, attempt = L.answered(ided, judge, self.ledger, salt=said, callers=config.callers, attempts=config.judge_attempts, base_s=config.backoff_s)
        answers = self.held.write("classify", J.accepted(given, ided), f"answers-{key}")
        lost = ided.join(answers.select("chunk").distinct(), "chunk", "left_anti").groupBy("chunk").agg(F.count("*").alias("n"))
        worst = lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("chunks"), F.slice(F.array_sort(F.collect_list("chunk")), 1, 1000).alias("some")).first()
        calls = attempt.agg(F.coalesce(F.sum("calls"), F.lit(0)).alias("n")).first().n
        gap = {"unclassified_count": worst.n, "failed_chunk_indices": list(worst.some)}
        self.log.event("classify", "asked", calls=calls, failed_chunks=worst.chunks)
        if worst.n and answers.isEmpty():
            raise TotalFailure("every chunk failed")
        matches = self.held.write("classify", verdicts.matched(answers, ided), f"matches-{key}")
        self.manifest.stage("classify", "success", match_count=matches.count(), attempts=calls, **gap)

        self.stage = "score"
        self.manifest.stage("score", "running")
        flat = matches.select("id", "url", "role_category", "reason", *(f"listing.{c}" for c in ("title", "company", "source", "snippet", "headcount", "lane", "pos")))
        asked = self.held.write("score", J.score_lanes(flat, scorer, config.judge_attempts, config.backoff_s), f"scores-{key}")
        failed = sorted(r.lane for r in asked.where("error is not null").select("lane").distinct().collect())
        if failed and asked.where("error is null").isEmpty():
            raise TotalFailure("every lane failed")
        scores = asked.where("error is null").select("url", "fit_score", "rationale", "resp_pos")
        scored = self.held.write("score", scoring.scored(flat, scores), f"scored-{key}")
        self.log.event("score", "done", failed_lanes=failed)
        self.manifest.stage("score", "success", failed_lanes=failed, **scoring.unscored_count(flat, scores).first().asDict())

        self.stage = "digest"
        self.manifest.stage("digest", "running")
        lines = report.report_lines(spark, scored, config.run_date, candidates, list(config.lanes), LANES, config.score_floor, gap=(worst.n, worst.chunks))
        text = report.rendered(lines)
        write_text(spark, f"{config.root}/matches/{config.run_date}.md", text)
        store.publish(scored.where(F.col("fit_score") >= config.score_floor), config.run_date)
        store.export()
        counts = scoring.floor_counts(scored, config.score_floor).first().asDict()
        self.log.event("digest", "done", **counts)
        self.manifest.stage("digest", "success", **counts)
        return Outcome(text, scored, counts | gap)


def run(spark: SparkSession, config: RunConfig, listings: Callable[[], DataFrame], judge: J.Judge, scorer: J.Judge, rules: PhraseRules = PhraseRules(), salt: Mapping[str, str] | None = None) -> Outcome:
    """Normalized listings (schemas.LISTING) through filter, dedupe, judge, scores and report.

    Answers are kept in the ledger as they come; only chunks without one are
    asked about.  salt says for each lane what else an answer depends on.
    """
    made = Run(spark, config)
    for stage in ("fetch", "fetch_ats"):
        if made.manifest.data["stages"].get(stage, {}).get("status", "pending") == "pending":
            made.skipped(stage)
    return made.guarded(lambda: made.published(listings, judge, scorer, rules, salt or {}))


def run_all(spark: SparkSession, config: RunConfig, given: Mapping[str, boards.Source], companies: Callable[[], DataFrame] | None, judge: J.Judge, scorer: J.Judge, rules: PhraseRules = PhraseRules(), salt: Mapping[str, str] | None = None, *, fetch_backoff_s: float = 1.0, **options) -> Outcome:
    """The same from the boards and the company list; options go to sources.live.fetched_companies()."""
    made = Run(spark, config)

    def work() -> Outcome:
        parts: dict[str, DataFrame | None] = dict(made.boards(given, base_s=fetch_backoff_s))
        parts["ats"] = made.companies(companies, **{"backoff": fetch_backoff_s, **options})
        return made.published(lambda: normalize.union_sources(spark, parts), judge, scorer, rules, salt or {})

    return made.guarded(work)
