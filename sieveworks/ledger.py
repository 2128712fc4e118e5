"""Answers of a judge, kept by the content of what was asked, one committed file for each call."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import schemas
from .functions.text import json_of
from .judge import JUDGE_FIELDS, Judge, _problem, _rows, retried
from .runstate import exists, listed, moved_in, removed, stored
from .vocab import ERROR_CHARS

#: What a ledger file holds: the key, the rows asked about and their answers by place in the chunk.
ENTRY = "key string, rows int, calls int, answers array<struct<place:int,verdict:string,role_category:string,reason:string>>"

#: What an attempt says of each call: held (found in the ledger meanwhile), answered or failed.
ATTEMPT = "key string, outcome string, calls int, error string"


def _local(uri: str) -> str:
    """A URI as pyarrow's file systems take it."""
    return re.sub(r"^file:/+", "/", uri)


class Ledger:
    """The answers under a folder that driver and executors share, which pyarrow's file systems can open.

    Loose files come from the tasks, each written under another name and moved
    into place when it is whole; compact() gathers them in a table of their own.
    An entry that can't be read counts as missing, so it is asked again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root.rstrip('/')}/answers"

    def entries(self) -> DataFrame:
        """One row for each key."""
        loose, packed = f"{self.root}/loose", f"{self.root}/packed"
        found = self.spark.createDataFrame([], ENTRY)
        if exists(self.spark, loose):
            found = found.unionByName(self.spark.read.schema(ENTRY).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(loose))
        if exists(self.spark, packed):
            found = found.unionByName(self.spark.read.schema(ENTRY).option("recursiveFileLookup", "true").parquet(packed))
        whole = found.where("key is not null and answers is not null").where(F.size("answers") == F.col("rows"))
        return whole.groupBy("key").agg(*(F.min_by(c, F.struct("calls", "answers")).alias(c) for c in ("rows", "calls", "answers")))

    def compact(self) -> int:
        """Moves what the loose files hold into one table and deletes those files; returns their number.

        The new table is whole before a file goes, and entries are one row a key,
        so a compaction that ends in between loses and doubles nothing.
        """
        files = [f for f in listed(self.spark, f"{self.root}/loose") if f.endswith(".json")] if exists(self.spark, f"{self.root}/loose") else []
        if files:
            part = f"{self.root}/part-{uuid.uuid4().hex}"
            self.spark.read.schema(ENTRY).json(files).where("key is not null").write.parquet(part)
            moved_in(self.spark, part, f"{self.root}/packed/{uuid.uuid4().hex}")
            for f in files:
                removed(self.spark, f)
        return len(files)


def keyed(chunks: DataFrame, salt: Mapping[str, str], fields: tuple[str, ...] = JUDGE_FIELDS) -> DataFrame:
    """(chunk, key, ids): what each chunk asks as one hash, and its ids in order.

    The hash covers the lane, what salt says of the lane (criteria, model, date)
    and the listings in order, but not their ids, which are only places of a run.
    A chunk is a group of bounded size.
    """
    said = F.lit("")
    for lane, text in salt.items():
        said = F.when(F.col("lane") == lane, F.lit(text)).otherwise(said)
    content = json_of(*(f for f in fields if f != "id"))
    rows = chunks.select("chunk", "id", F.coalesce("lane", F.lit("")).alias("lane"), content.alias("content")).withColumn("said", said)
    made = rows.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("id", "content"))).alias("r"), F.min("lane").alias("lane"), F.min("said").alias("said"))
    parts = F.concat(F.array("lane", "said"), F.transform("r", lambda x: F.sha2(x["content"].cast("binary"), 256)))
    return made.select("chunk", F.sha2(F.to_json(parts).cast("binary"), 256).alias("key"), F.transform("r", lambda x: x["id"]).alias("ids"))


def _groups(frames: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """The rows of each key; they follow each other."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        for value, part in frame.groupby(key, sort=False):
            if held and held[0][key].iloc[0] != value:
                yield pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held)


def _asking(root: str, judge: Judge, attempts: int, base_s: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        files, base = fs.FileSystem.from_uri(_local(root))
        for rows in _groups(frames, "key"):
            rows = rows.sort_values("id")
            key, used = rows["key"].iloc[0], 0
            folder = f"{base}/loose/{key[:2]}"
            name = f"{folder}/{key}.json"

            def call(rows=rows):
                asked = _rows(rows, JUDGE_FIELDS)
                answers = judge(asked, rows["lane"].iloc[0])
                if problem := _problem(answers, {r["id"] for r in asked}):
                    raise ValueError(problem)
                return answers

            if files.get_file_info(name).type != fs.FileType.NotFound:  # an earlier attempt of this task got so far
                yield pd.DataFrame([(key, "held", 0, None)], columns=["key", "outcome", "calls", "error"])
                continue
            try:
                answers, used = retried(call, attempts, base_s)
            except Exception as e:  # a chunk's failure is a row, not the run's
                yield pd.DataFrame([(key, "failed", attempts, str(e)[:ERROR_CHARS] or type(e).__name__)], columns=["key", "outcome", "calls", "error"])
                continue
            place = {i: k for k, i in enumerate(rows["id"].tolist())}
            entry = {"key": key, "rows": len(place), "calls": used, "answers": [{"place": place[a["id"]], **{f: a.get(f) for f in ("verdict", "role_category", "reason")}} for a in answers]}
            files.create_dir(folder, recursive=True)
            part = f"{folder}/.{uuid.uuid4().hex}.part"
            with files.open_output_stream(part) as out:
                out.write(json.dumps(entry, ensure_ascii=False).encode())
            files.move(part, name)
            yield pd.DataFrame([(key, "answered", used, None)], columns=["key", "outcome", "calls", "error"])

    return ask


def answered(chunks: DataFrame, judge: Judge, ledger: Ledger, *, salt: Mapping[str, str] | None = None, callers: int = 4, attempts: int = 2, base_s: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """The answers for every chunk (schemas.JUDGED), and the attempt (ATTEMPT): one row for each call that was due.

    Chunks whose key the ledger holds are left out before anything is asked; the
    others are dealt to callers tasks, each of which commits an answer as soon as
    it has it.  A run that is killed pays again only for the calls it was in.  A
    task that is tried again finds what it had committed; where speculation is on
    the calls run in a barrier stage, of which Spark never runs two copies.  Two
    chunks that ask the same are asked once.  Chunks that failed have one row
    with error.  No chunks, no call.
    """
    spark = chunks.sparkSession
    keys = stored(keyed(chunks, salt or {}), "keyed")
    todo = keys.join(ledger.entries().select("key"), "key", "left_anti").groupBy("key").agg(F.min("chunk").alias("chunk"))
    todo = stored(todo, "todo")
    if not todo.isEmpty():
        rows = chunks.join(todo, "chunk").select("key", "lane", *JUDGE_FIELDS)
        dealt = rows.repartition(callers, "key").sortWithinPartitions("key", "id")
        ask = _asking(ledger.root, judge, attempts, base_s)
        alone = spark.conf.get("spark.speculation", "false").lower() == "true"
        attempt = stored(dealt.mapInPandas(ask, ATTEMPT, barrier=alone), "attempt")
    else:
        attempt = spark.createDataFrame([], ATTEMPT)
    given = keys.join(ledger.entries(), "key").select("chunk", "ids", F.posexplode("answers").alias("resp_pos", "a"))
    good = given.select("chunk", F.get("ids", F.col("a.place")).alias("id"), "a.verdict", "a.role_category", "a.reason", F.col("resp_pos").cast("int").alias("resp_pos"), F.lit(None).cast("string").alias("error"))
    failed = keys.join(attempt.where("outcome = 'failed'"), "key").select("chunk", *(F.lit(None).cast(t).alias(c) for c, t in (("id", "long"), ("verdict", "string"), ("role_category", "string"), ("reason", "string"), ("resp_pos", "int"))), "error")
    return good.unionByName(failed).select([f.name for f in schemas.JUDGED]), attempt
