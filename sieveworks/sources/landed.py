"""Readers of landed raw files, each row with its position in the file."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as X
from ..runstate import exists, stored

BOARD_ITEM = "struct<id:string,date:string,company:string,position:string,tags:array<string>,description:string,url:string>"
JOB = "struct<id:string,title:string,text:string,absolute_url:string,jobUrl:string,hostedUrl:string,first_published:string,publishedAt:string,createdAt:string,content:string,descriptionPlain:string,description:string>"

#: Rows of a feed at most, which part its positions from those of the next.
FEED_SPAN = 1 << 30


def _whole(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def board_items(spark: SparkSession, path: str) -> DataFrame:
    """The elements of a JSON array that have a position."""
    rows = _whole(spark, path).select(F.posexplode(F.from_json("value", f"array<{BOARD_ITEM}>", {"mode": "FAILFAST"})).alias("pos", "item"))
    return rows.where("item.position is not null").select(F.col("pos").cast("long").alias("pos"), "item.*")


def feed_items(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The items of RSS files at any depth, in the files' order; missing children are ''.  A file that isn't XML is an error."""
    fields = ("title", "link", "pubDate", "description")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for feed in batch.column(0).to_pylist():
                items = [[(item.findtext(f) or "").strip() for f in fields] for item in ElementTree.fromstring(feed).iterfind(".//item")]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(items)), pa.int64()), *(pa.array([i[k] for i in items], pa.string()) for k in range(len(fields)))], names=["pos", *fields])

    def one(k: int, path: str) -> DataFrame:
        rows = _whole(spark, path).mapInArrow(parse, "pos long, title string, link string, pubDate string, description string")
        return rows.withColumn("pos", F.col("pos") + F.lit(k * FEED_SPAN))

    return reduce(DataFrame.unionByName, (one(k, p) for k, p in enumerate(paths)))


#: A search's answer, and a thread's.
HITS = "hits array<struct<objectID:string,title:string>>"
THREAD = "id string, children array<struct<id:string,created_at:string,text:string>>"


def first_hit(spark: SparkSession, search_path: str) -> DataFrame:
    """L4: one row, thread and thread_title of the hit that a search names first; nulls if it names none."""
    hits = _whole(spark, search_path).select(F.posexplode(F.from_json("value", HITS, {"mode": "FAILFAST"})["hits"]).alias("k", "hit"))
    return hits.agg(F.min_by("hit", "k").alias("hit")).select(F.col("hit.objectID").alias("thread"), F.col("hit.title").alias("thread_title"))


def no_items(spark: SparkSession) -> DataFrame:
    """The items of no thread."""
    return spark.createDataFrame([], "pos long, thread_title string, id string, created_at string, text string")


def thread_items(spark: SparkSession, search_path: str, thread_path: str) -> DataFrame:
    """S3, L4: the comments of the thread that the search names first; blank ones are left out."""
    first = first_hit(spark, search_path)
    thread = _whole(spark, thread_path).select(F.from_json("value", THREAD, {"mode": "FAILFAST"}).alias("t"))
    rows = thread.select(F.col("t.id").alias("thread"), F.posexplode("t.children").alias("pos", "c")).join(F.broadcast(first), "thread")  # one row
    return rows.where(X.strip(F.coalesce("c.text", F.lit(""))) != "").select(F.col("pos").cast("long").alias("pos"), "thread_title", "c.*")


#: Folders that landed threads are dealt to, and threads up to which their numbers become a filter of the read.
THREAD_FOLDERS, NAMED_THREADS = 64, 10_000

THREAD_ROW = "thread string, pos long, id string, created_at string, text string, folder int"


def _folder(thread: str = "thread"):
    return F.pmod(F.xxhash64(F.col(thread)), F.lit(THREAD_FOLDERS)).cast("int")


def land_threads(comments: DataFrame, path: str) -> str:
    """Comments (thread, pos, id, created_at, text) of many threads, in folders by thread, so that a read of some threads opens theirs only."""
    rows = comments.select("thread", F.col("pos").cast("long").alias("pos"), F.col("id").cast("string").alias("id"), F.col("created_at").cast("string").alias("created_at"), "text", _folder().alias("folder"))
    rows.repartition("folder").sortWithinPartitions("folder", "thread", "pos").write.partitionBy("folder").parquet(path)
    return path


def first_hits(searches: DataFrame) -> DataFrame:
    """L4 of many searches: (search, thread, thread_title) of the hit that each answer (search, body) names first; answers without hits or that aren't JSON give none."""
    hits = searches.select("search", F.posexplode(F.from_json("body", HITS)["hits"]).alias("k", "hit"))
    return hits.groupBy("search").agg(F.min_by("hit", "k").alias("hit")).select("search", F.col("hit.objectID").alias("thread"), F.col("hit.title").alias("thread_title")).where("thread is not null")


def dependent_items(searches: DataFrame, threads_path: str) -> DataFrame:
    """S3 for many searches: the comments of the thread that each names first, read after the hits are known.

    The hits are stored first.  While they name few threads, the threads' numbers
    and folders are filters of the second read, so other folders are never opened
    and other threads' row groups are skipped; beyond that the folders still are
    pruned, by a join at run time.  A thread that several searches hit gives its
    comments to each; one that isn't landed gives none; blank comments are left out.
    """
    spark = searches.sparkSession
    hits = stored(first_hits(searches).withColumn("folder", _folder()), "hits")
    wanted = hits.select("thread", "folder").distinct()
    named = wanted.limit(NAMED_THREADS + 1).collect()
    threads = spark.read.schema(THREAD_ROW).parquet(threads_path)
    if len(named) <= NAMED_THREADS:
        threads = threads.where(F.col("folder").isin(sorted({r.folder for r in named})) & F.col("thread").isin(sorted({r.thread for r in named})))
        hits = F.broadcast(hits) if hits.count() <= NAMED_THREADS else hits
    rows = threads.join(hits, ["folder", "thread"])
    return rows.where(X.strip(F.coalesce("text", F.lit(""))) != "").select("search", "thread", "pos", "thread_title", "id", "created_at", "text")


def companies(spark: SparkSession, path: str) -> DataFrame:
    """The company list, trimmed; none if the file is missing; a blank headcount is unknown, another than digits an error."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.COMPANY)
    raw = spark.read.csv(path, header=True, schema="name string, ats string, token string, headcount string, source string")
    text = lambda c: X.strip(F.coalesce(F.col(c), F.lit(""))).alias(c)
    return raw.select(text("name"), text("ats"), text("token"), X.optional_int("headcount").alias("headcount"), text("source"))


def company_results(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Pages (company, pos, http_status, body and, if there, attempts) to company, pos, status, attempts, count, jobs, error.

    404 is skipped, an answer that isn't JSON failed, as any other HTTP status;
    lists are read by the company's system.
    """
    inside = F.from_json("body", f"jobs array<{JOB}>")["jobs"]
    bare = F.when(F.ltrim("body").startswith("["), F.from_json("body", f"array<{JOB}>"))
    jobs = F.coalesce(F.when(F.col("company.ats") == "lever", bare).otherwise(inside), F.from_json(F.lit("[]"), f"array<{JOB}>"))
    readable = F.try_parse_json("body").isNotNull()
    status = F.when(F.col("http_status") == 404, "skipped").when((F.col("http_status") == 200) & readable, "success").otherwise("failed")
    out = pages.withColumn("status", status).withColumn("jobs", F.when(F.col("status") == "success", jobs))
    error = F.when(F.col("http_status") == 200, "no JSON in the answer").otherwise(F.concat(F.lit("HTTP "), F.col("http_status").cast("string")))
    attempts = F.col("attempts") if "attempts" in pages.columns else F.lit(1).alias("attempts")
    return out.select("company", "pos", "status", attempts, F.coalesce(F.size("jobs"), F.lit(0)).cast("long").alias("count"), "jobs", F.when(F.col("status") == "failed", error).alias("error"))
