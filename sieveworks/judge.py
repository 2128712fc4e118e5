"""Judges: an interface for the external classifier and scorer, and offline ones."""

from __future__ import annotations

import json
import random
import subprocess
import time
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import schemas
from .functions import text as X
from .operators import verdicts
from .vocab import ERROR_CHARS

#: rows of one chunk or lane (as dicts) and the lane -> answers (as dicts)
Judge = Callable[[list[dict], str], list[dict]]

OPEN_MARK, CLOSE_MARK = "<<<UNTRUSTED DATA", "UNTRUSTED DATA>>>"


def retried(call: Callable[[], object], attempts: int, base_s: float, *, on_retry: Callable[[int, Exception], None] | None = None, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] | None = None) -> tuple[object, int]:
    """The result and the attempts used; waits base * 2^(k-1) plus up to half a second between attempts, and raises the last error."""
    jitter = jitter or (lambda: random.uniform(0, 0.5))
    for k in range(1, attempts + 1):
        try:
            return call(), k
        except Exception as e:
            if k == attempts:
                raise
            if on_retry:
                on_retry(k, e)
            sleep(base_s * 2 ** (k - 1) + jitter())
    raise ValueError("attempts must be 1 at least")


def prompt(template: str, criteria: str, rows: Sequence[Mapping], context: Mapping[str, str] | None = None) -> str:
    """The template with its placeholders filled; the rows stand as JSON inside a fence, whatever they contain."""
    data = json.dumps([dict(r) for r in rows], indent=2, ensure_ascii=False, default=str).replace(CLOSE_MARK, CLOSE_MARK.replace(" ", "_")).replace(OPEN_MARK, OPEN_MARK.replace(" ", "_"))
    fenced = f"{OPEN_MARK}\n{data}\n{CLOSE_MARK}"
    return template.format(role_criteria=criteria, listings_json=fenced, **(context or {}))


class ProcessJudge:
    """An external program: the prompt on its standard input, JSON from its output; off unless a command is given."""

    def __init__(self, command: Sequence[str], make_prompt: Callable[[list[dict], str], str], field: str, timeout_s: float):
        self.command, self.make_prompt, self.field, self.timeout_s = list(command), make_prompt, field, timeout_s

    def __call__(self, rows: list[dict], lane: str) -> list[dict]:
        done = subprocess.run(self.command, input=self.make_prompt(rows, lane), text=True, capture_output=True, timeout=self.timeout_s)
        if done.returncode:
            raise RuntimeError(f"judge failed (exit {done.returncode}): {done.stderr[:ERROR_CHARS]}")
        return json.loads(done.stdout)[self.field]


class RuleJudge:
    """Matches the listings in which any of a lane's patterns is found; for runs without an external judge."""

    def __init__(self, rules: Mapping[str, Sequence[tuple[str, str]]]):
        self.rules = {lane: list(r) for lane, r in rules.items()}

    def __call__(self, rows: list[dict], lane: str) -> list[dict]:
        import re

        out = []
        for row in rows:
            text = f"{row.get('title') or ''} {row.get('snippet') or ''}"
            hit = next(((c, p) for c, p in self.rules.get(lane, ()) if re.search(p, text, re.IGNORECASE)), None)
            out.append({"id": row["id"], "verdict": "match" if hit else "no_match"} | ({"role_category": hit[0], "reason": f"mentions {hit[1]}"} if hit else {}))
        return out


class Faulty:
    """A judge with faults: it changes another's answers, or raises, by chunk or lane."""

    def __init__(self, inner: Judge, fault: Callable[[list[dict], str, list[dict]], list[dict]]):
        self.inner, self.fault = inner, fault

    def __call__(self, rows: list[dict], lane: str) -> list[dict]:
        return self.fault(rows, lane, self.inner(rows, lane))


#: What a judge and a scorer see of a listing.
JUDGE_FIELDS = ("id", "url", "title", "company", "source", "posted_date", "tags", "snippet")
SCORE_FIELDS = ("url", "role_category", "reason", "title", "company", "source", "snippet", "headcount")


def _rows(df: pd.DataFrame, fields: Sequence[str]) -> list[dict]:
    return [{f: (list(v) if hasattr(v, "__len__") and not isinstance(v, str) else None if v is None or v != v else v.item() if hasattr(v, "item") else v) for f, v in zip(fields, row, strict=True)} for row in df[list(fields)].itertuples(index=False)]


def _problem(answers: list[dict], asked: set) -> str | None:
    """The first violation in one response, as verdicts.first_errors() finds it over all; it decides whether to ask again."""
    seen = set()
    for a in answers:
        i = a.get("id")
        if i is None or i in seen or i not in asked or a.get("verdict") not in ("match", "no_match"):
            return f"bad answer {a!r}"[:ERROR_CHARS]
        if a["verdict"] == "match" and not (a.get("role_category") and a.get("reason")):
            return f"incomplete match for id {i}"
        seen.add(i)
    return f"missing ids {sorted(asked - seen)}"[:ERROR_CHARS] if asked - seen else None


def judged(chunks: DataFrame, judge: Judge, attempts: int = 2, base_s: float = 2.0) -> DataFrame:
    """The answers for every chunk, one row each, with resp_pos; a chunk that fails has one row with error instead.

    A chunk is one group of bounded size.  The judge is called inside the task,
    which retries by itself; store the result before using it twice, and keep
    task retries and speculation low, or calls are paid again.
    """
    names = [f.name for f in schemas.JUDGED]

    def ask(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("id")
        chunk, rows = int(df["chunk"].iloc[0]), _rows(df, JUDGE_FIELDS)

        def call():
            answers = judge(rows, df["lane"].iloc[0])
            if problem := _problem(answers, {r["id"] for r in rows}):
                raise ValueError(problem)
            return answers

        try:
            answers, _ = retried(call, attempts, base_s)
        except Exception as e:  # a chunk's failure is a row, not the run's
            return pd.DataFrame([(chunk, None, None, None, None, None, str(e)[:ERROR_CHARS] or type(e).__name__)], columns=names).astype({"id": "Int64", "resp_pos": "Int32"})
        return pd.DataFrame([(chunk, a["id"], a["verdict"], a.get("role_category"), a.get("reason"), k, None) for k, a in enumerate(answers)], columns=names).astype({"id": "Int64", "resp_pos": "Int32"})

    return chunks.groupBy("chunk").applyInPandas(ask, schemas.JUDGED)


def table_judged(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """The same from a table of answers by id: a judge without calls, in the plan itself."""
    return chunks.select("chunk", "id").join(answers, "id", "left").select("chunk", "id", "verdict", "role_category", "reason", F.col("id").cast("int").alias("resp_pos"), F.lit(None).cast("string").alias("error")).where("verdict is not null")


def accepted(answers: DataFrame, chunks: DataFrame) -> DataFrame:
    """The answers of chunks that neither failed nor violate a rule."""
    failed = answers.where("error is not null").select("chunk").distinct()
    good = answers.where("error is null").join(failed, "chunk", "left_anti")
    return verdicts.accepted(good, chunks.select("chunk", "id").join(failed, "chunk", "left_anti"))


def score_lanes(matches: DataFrame, scorer: Judge, attempts: int = 2, base_s: float = 2.0) -> DataFrame:
    """One call for each lane over its matches, which an earlier stage has reduced to few; a lane that fails has one row with error.  No matches, no call."""
    names = [f.name for f in schemas.SCORED]

    def ask(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("pos")
        lane = df["lane"].iloc[0]
        try:
            scores, _ = retried(lambda: scorer(_rows(df, SCORE_FIELDS), lane), attempts, base_s)
            rows = [(lane, s["url"], s["fit_score"], s.get("rationale"), k, None) for k, s in enumerate(scores)]
        except Exception as e:
            rows = [(lane, None, None, None, None, str(e)[:ERROR_CHARS] or type(e).__name__)]
        return pd.DataFrame(rows, columns=names).astype({"fit_score": "Int32", "resp_pos": "Int32"})

    return matches.groupBy("lane").applyInPandas(ask, schemas.SCORED)


def payload(*fields: str):
    """P15 as a column: the JSON that a judge would get of a row, nulls kept."""
    return X.json_of(*fields)
