"""The store of published keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..keyed_store import KeyedStore
from ..runstate import exists, put_together


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    """Url and first_seen; the legacy list has no dates (''); nothing if the file is missing.  A store with the current key is read by it, even if empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.SEEN)
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "seen map<string,string>, matched_urls array<string>", {"mode": "FAILFAST"}).alias("j"))
    current = raw.where("j.seen is not null").select(F.explode("j.seen").alias("url", "first_seen"))
    legacy = raw.where("j.seen is null").select(F.explode("j.matched_urls").alias("url"), F.lit("").alias("first_seen"))
    return current.unionByName(legacy)


def merged(seen: DataFrame, published: DataFrame, run_date: str) -> DataFrame:
    """K5: published urls that weren't in the store join it with the run's date; those that were keep theirs."""
    new = published.where(F.coalesce("url", F.lit("")) != "").select("url").distinct().join(seen, "url", "left_anti").withColumn("first_seen", F.lit(run_date))
    old = seen.groupBy("url").agg(F.min("first_seen").alias("first_seen"))
    return old.unionByName(new)


class SeenStore:
    """The published urls with the date of each first publication, in a KeyedStore below a folder.

    A seen.json of earlier runs, the legacy list included, is taken in when the
    store is made.  Urls that come again keep their date.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.file = spark, f"{root.rstrip('/')}/seen.json"
        self.store = KeyedStore(spark, f"{root.rstrip('/')}/seen", schemas.SEEN, "url", buckets)
        if self.store.is_new and exists(spark, self.file):
            self.store.insert(read_seen(spark, self.file), "first_seen", ("file", 0))

    def read(self) -> DataFrame:
        return self.store.read()

    def publish(self, published: DataFrame, run_date: str) -> int:
        """Adds the urls that are new, with the run's date; returns their number."""
        new = self.store.insert(published.select("url", F.lit(run_date).alias("first_seen")), "first_seen")
        self.store.compact()
        return new

    def export(self) -> None:
        """L2: seen.json in url order, from parts that are sorted by range and copied one after another; nothing passes through Python."""
        rows = self.read()
        least = rows.agg(F.min("url")).first()[0]
        pair = F.to_json(F.create_map("url", F.coalesce("first_seen", F.lit(""))))
        comma = F.when(F.col("url") == F.lit(least), F.lit("")).otherwise(",")
        entry = F.concat(F.lit("    "), F.expr("substring(j, 2, length(j) - 2)"))
        lines = rows.withColumn("j", pair).orderBy("url").select(F.concat(comma, entry).alias("value"))
        put_together(self.spark, self.file, '{"seen": {\n', lines, "}}\n")
