"""Live HTTP readers; nothing here runs unless a caller asks for it."""

from __future__ import annotations

import json
import socket
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..judge import retried
from ..vocab import ERROR_CHARS
from .landed import JOB

#: The errors that a fetch tolerates; anything else is a bug and ends the run.
FETCH_ERRORS = (urllib.error.URLError, socket.timeout, TimeoutError, json.JSONDecodeError)

# Endpoints by the company's system.
URLS = {
    "greenhouse": "https://boards-api.greenhouse.io/v1/boards/%s/jobs?content=true",
    "ashby": "https://api.ashbyhq.com/posting-api/job-board/%s",
    "lever": "https://api.lever.co/v0/postings/%s?mode=json",
}


def job_url(ats: str = "ats", token: str = "token") -> Column:
    """The endpoint of a company; null for an unknown system."""
    out = F.lit(None).cast("string")
    for name, url in URLS.items():
        out = F.when(F.col(ats) == name, F.format_string(url, F.col(token))).otherwise(out)
    return out


def get(url: str, timeout_s: float = 15, agent: str = "Mozilla/5.0") -> bytes:
    """S7."""
    with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=timeout_s) as r:
        return r.read()


def fetched(url: str, attempts: int, base_s: float, read: Callable[[str], bytes] = get, sleep: Callable[[float], None] = time.sleep) -> dict:
    """One page as a row: its HTTP status, body, attempts and error; 404 is an answer, other tolerated errors a failure."""
    try:
        body, used = retried(lambda: _page(url, read), attempts, base_s, sleep=sleep)
        return body | {"attempts": used}
    except FETCH_ERRORS as e:
        return {"http_status": getattr(e, "code", None) or 0, "body": None, "error": str(e)[:ERROR_CHARS], "attempts": attempts}


def _page(url: str, read: Callable[[str], bytes]) -> dict:
    try:
        return {"http_status": 200, "body": read(url).decode("utf-8", "replace"), "error": None}
    except urllib.error.HTTPError as e:
        if e.code == 404:
            return {"http_status": 404, "body": None, "error": None}
        raise


class _Pages(DataSourceReader):
    def __init__(self, options):
        self.urls = json.loads(options["urls"])
        self.delay, self.parts = float(options.get("delay", "0.3")), max(1, int(options.get("partitions", "1")))
        self.attempts, self.base = int(options.get("attempts", "2")), float(options.get("backoff", "1"))

    def partitions(self):
        return [InputPartition(k) for k in range(min(self.parts, max(1, len(self.urls))))]

    def read(self, partition):
        own = list(enumerate(self.urls))[partition.value :: self.parts]
        for n, (pos, url) in enumerate(own):
            if n:
                time.sleep(self.delay)
            r = fetched(url, self.attempts, self.base)
            yield pos, url, r["http_status"], r["body"], r["attempts"], r["error"]


class PagesSource(DataSource):
    """Spark format "sieveworks_pages": a row for each URL of the option urls, a JSON list; calls in a partition keep the delay."""

    @classmethod
    def name(cls):
        return "sieveworks_pages"

    def schema(self):
        return "pos long, url string, http_status int, body string, attempts int, error string"

    def reader(self, schema):
        return _Pages(self.options)


#: Columns of a company in the rows of CompaniesSource.
COMPANY = ("name", "ats", "token", "headcount", "source")


def jobs_of(company: Mapping, urls: Mapping[str, str], read: Callable[[str], bytes] = get) -> list | None:
    """The raw jobs of a company, None if its system doesn't know it (404); an answer that isn't JSON raises."""
    try:
        data = json.loads(read(urls[company["ats"]] % urllib.parse.quote(company["token"], safe="")))
    except urllib.error.HTTPError as e:
        if e.code == 404:
            return None
        raise
    if company["ats"] == "lever":
        return data if isinstance(data, list) else []
    return data.get("jobs") or [] if isinstance(data, dict) else []


class _Companies(DataSourceReader):
    def __init__(self, options):
        self.companies = json.loads(options["companies"])
        self.urls = URLS | json.loads(options.get("endpoints", "{}"))
        self.delay, self.callers = float(options.get("delay", "0.3")), max(1, int(options.get("callers", "1")))
        self.attempts, self.base = int(options.get("attempts", "2")), float(options.get("backoff", "1"))

    def partitions(self):
        """The companies of each system, dealt to callers: one system sees so many calls at a time, each caller's with the delay between them."""
        dealt: dict[tuple[str, int], list[int]] = {}
        count: dict[str, int] = {}
        for pos, c in enumerate(self.companies):
            n = count[c["ats"]] = count.get(c["ats"], -1) + 1
            dealt.setdefault((c["ats"], n % self.callers), []).append(pos)
        return [InputPartition(own) for own in dealt.values()] or [InputPartition([])]

    def read(self, partition):
        asked = False
        for pos in partition.value:
            company = self.companies[pos]
            about = tuple(company.get(f) for f in COMPANY)
            if company["ats"] not in self.urls:
                yield "status", pos, *about, "skipped", 0, 0, "unknown system", None, None
                continue
            if asked:
                time.sleep(self.delay)
            asked, jobs, used = True, [], [0]

            def call(company=company, used=used):
                used[0] += 1
                return jobs_of(company, self.urls)

            try:
                jobs, _ = retried(call, self.attempts, self.base)
                status, error = ("skipped", None) if jobs is None else ("success", None)
            except FETCH_ERRORS as e:
                status, error, jobs = "failed", str(e)[:ERROR_CHARS] or type(e).__name__, []
            yield "status", pos, *about, status, used[0], len(jobs or []), error, None, None
            for k, job in enumerate(jobs or []):
                yield "job", pos, *about, None, None, None, None, k, json.dumps(job, ensure_ascii=False)


class CompaniesSource(DataSource):
    """Spark format "sieveworks_companies" (S6, S7, C3, C7): the jobs of companies and what became of each call.

    The option companies is a JSON list of objects with name, ats, token,
    headcount and source; delay, callers (a system), attempts and backoff are
    seconds and counts; endpoints (JSON) replaces a system's address.  Every
    company has one row of kind status (success, skipped for 404 and unknown
    systems, or failed), and a row of kind job for each job.  Only transport and
    parse errors are tolerated; any other ends the read.  Reading calls the
    network each time, so a run reads it once, into a checkpoint.
    """

    @classmethod
    def name(cls):
        return "sieveworks_companies"

    def schema(self):
        return "kind string, pos long, name string, ats string, token string, headcount int, source string, status string, attempts int, count long, error string, job_pos long, job string"

    def reader(self, schema):
        return _Companies(self.options)


def fetched_companies(spark: SparkSession, companies: DataFrame, **options) -> DataFrame:
    """The rows of CompaniesSource for a company list, in the list's order by name, system and token.

    The list is a table that people keep, so it fits the driver; duplicates of
    (ats, token) are called once.
    """
    spark.dataSource.register(CompaniesSource)
    rows = companies.select(*COMPANY).dropDuplicates(["ats", "token"]).orderBy("name", "ats", "token").collect()
    given = json.dumps([r.asDict() for r in rows])
    return spark.read.format("sieveworks_companies").options(companies=given, **{k: str(v) for k, v in options.items()}).load()


def company_jobs(fetched: DataFrame) -> DataFrame:
    """The job rows as normalize.job_listings() takes them."""
    return fetched.where("kind = 'job'").select(*COMPANY, F.col("pos").alias("company_pos"), "job_pos", F.from_json("job", JOB).alias("job"))


def company_status(fetched: DataFrame) -> DataFrame:
    """One row of schemas.STATUS for each company."""
    return fetched.where("kind = 'status'").select("name", "status", "attempts", "count", "error")


def notified(message: str, topic: str | None, *, title: str, priority: str = "low", send: Callable[..., object] | None = None, timeout_s: float = 10) -> bool:
    """K9: posts a message if there is a topic URL; never raises."""
    if not topic:
        return False
    try:
        request = urllib.request.Request(topic, data=message.encode(), headers={"Title": title, "Priority": priority})
        (send or urllib.request.urlopen)(request, timeout=timeout_s)
    except Exception:  # the notice mustn't hide the run's own outcome
        return False
    return True
