"""The pool of ingested records: merge, consumption and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..keyed_store import KeyedStore
from ..operators.dedupe import keep_first


def merged(pool: DataFrame, batch: DataFrame, key: str = "key", at: str = "ts", pos: str = "pos") -> DataFrame:
    """The batch's first record of each key that isn't in the pool joins it with first_ingested and no consumer; the same batch twice changes nothing."""
    new = keep_first(batch, key, pos).join(pool.select(key), key, "left_anti").withColumns({"first_ingested": F.to_date(at), "consumed_by": F.lit(None).cast("string")})
    return pool.unionByName(new, allowMissingColumns=True)


def consumed(pool: DataFrame, keys: DataFrame, report: str, key: str = "key") -> DataFrame:
    """Marks the keys with the report that used them first; nothing is deleted, and a forced second run marks the same."""
    used = keys.select(key).distinct().withColumn("__used", F.lit(True))
    return pool.join(used, key, "left").withColumn("consumed_by", F.coalesce("consumed_by", F.when(F.col("__used"), report))).drop("__used")


def window_of(pool: DataFrame, after, upto, day: str = "first_ingested", report: str | None = None) -> DataFrame:
    """The records ingested after one day up to another, that no other report has consumed."""
    free = F.col("consumed_by").isNull() if report is None else F.col("consumed_by").isNull() | (F.col("consumed_by") == report)
    return pool.where((F.col(day) > F.lit(after).cast("date")) & (F.col(day) <= F.lit(upto).cast("date")) & free)


def unseen_in_window(rows: DataFrame, seen: DataFrame, after, upto, key: str = "url") -> DataFrame:
    """T5: without keys first seen outside the report's window; unknown dates ('') lie outside."""
    first = F.try_to_date("first_seen")
    outside = seen.where(~F.coalesce((first > F.lit(after).cast("date")) & (first <= F.lit(upto).cast("date")), F.lit(False)))
    return rows.join(outside.select(F.col("url").alias(key)).distinct(), key, "left_anti")


def coverage(rows: DataFrame, upto, days: int = 7, at: str = "ts") -> DataFrame:
    """T4: one row, covered_days and days: on how many of the last days something came in."""
    day, last = F.to_date(at), F.lit(upto).cast("date")
    return rows.where((day > F.date_sub(last, days)) & (day <= last)).agg(F.count_distinct(day).alias("covered_days")).withColumn("days", F.lit(days))


def pool_store(spark: SparkSession, root: str, rows: DataFrame, key: str = "key", buckets: int = 64) -> KeyedStore:
    """The pool as a KeyedStore for records like rows, with first_ingested and consumed_by."""
    kinds = [f for f in rows.schema if f.name not in ("first_ingested", "consumed_by")]
    return KeyedStore(spark, root, T.StructType([*kinds, T.StructField("first_ingested", T.DateType()), T.StructField("consumed_by", T.StringType())]), key, buckets)


def ingest(store: KeyedStore, batch: DataFrame, number: int | None = None, *, stream: str = "stream", at: str = "ts", pos: str = "pos") -> int:
    """As merged(), into the store: only new records are written, and a batch of a stream that comes again adds none."""
    made = batch.withColumns({"first_ingested": F.to_date(at), "consumed_by": F.lit(None).cast("string")})
    return store.insert(made, pos, None if number is None else (stream, number))


def consume(store: KeyedStore, keys: DataFrame, report: str) -> list[int]:
    """As consumed(), in the store: the buckets of the keys are written anew, the others are left."""
    return store.update(keys, {"consumed_by": F.coalesce("consumed_by", F.lit(report))})


def stream_into(stream: DataFrame, store: KeyedStore, checkpoint: str, *, name: str = "stream", at: str = "ts", pos: str = "pos", layers: int = 8):
    """T1 as a stream: each micro-batch goes into the store once, under its number.

    Event times are timestamps with a time zone.  Buckets of many layers are made
    one table between batches.
    """

    def each(batch: DataFrame, number: int) -> None:
        ingest(store, batch, number, stream=name, at=at, pos=pos)
        store.compact(layers)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
