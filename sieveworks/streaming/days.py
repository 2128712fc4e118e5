"""Days as a stream: records counted by event day until a watermark closes it, later records kept aside."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: What the stream writes: a part of a closed day's number of records, or a late record as JSON.
KIND = "day date, records long, record string, kind string"

#: Keys that the records of a day are dealt to; each has its number in the state store.
SALTS = 32

#: A hundred years.
LEAD_HOURS = 100 * 365 * 24

_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def _count(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    day, end = key[0], int(key[1])
    held = state.get[0] if state.exists else 0
    late = not state.hasTimedOut and end <= max(state.getCurrentWatermarkMs(), 0)
    if late:
        for f in frames:
            yield pd.DataFrame({"day": day, "records": 1, "record": f["record"], "kind": "late"})
    if late or state.hasTimedOut:
        if held:
            yield pd.DataFrame({"day": [day], "records": [held], "record": [None], "kind": ["closed"]})
            state.remove()
        return
    state.update((held + sum(len(f) for f in frames),))
    state.setTimeoutTimestamp(end - 1)  # passed once the watermark has reached the day's end


def count_days(stream: DataFrame, path: str, checkpoint: str, *, at: str = "ts", delay: str = "2 days", salts: int = SALTS):
    """Starts the stream on what is there: records counted by day of the time zone, late ones written whole.

    The watermark is the latest event time of the batches before, less the
    delay.  A day is open until the watermark reaches its end; its number is then
    written and its state goes.  A record of a day that has ended is late: it is
    written aside, and so is one without a time or with one outside 1970 to 2100,
    which moves no watermark.  Closed days, open days and late records together
    are all records.  A record counts
    once also when a batch is run again, as state and files belong to the batch.

    A day's records are dealt to a set number of keys, so that today's, which may
    be nearly all, are counted by many tasks; a key's state is one number.
    Repeated records count each; columns may have any name.
    """
    time = F.col(at).cast("timestamp")
    usable = time.between(F.lit("1970-01-02").cast("timestamp"), F.lit("2100-01-01").cast("timestamp"))
    day = F.date_trunc("day", F.when(usable, time))
    # Spark drops what is older than the watermark before the function sees it.  So the marked time lies LEAD
    # ahead of the record's own, and the delay is longer by as much: the watermark is the same, and nothing is older.
    ahead = F.timestamp_micros(F.unix_micros(F.when(usable, time)) + F.lit(LEAD_HOURS * 3_600_000_000))
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in stream.columns]), _JSON)
    marked = stream.select(ahead.alias("ahead"), F.to_date(day).alias("day"), F.coalesce(F.unix_millis(day + F.expr("INTERVAL 1 DAY")), F.lit(0)).alias("end"), record.alias("record"))
    rows = marked.withWatermark("ahead", f"{delay} {LEAD_HOURS} hours").withColumn("salt", F.pmod(F.xxhash64("record"), F.lit(salts)))
    counted = rows.groupBy("day", "end", "salt").applyInPandasWithState(_count, KIND, "records long", "append", GroupStateTimeout.EventTimeTimeout)
    return counted.writeStream.format("parquet").option("path", path).partitionBy("kind").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def closed_days(spark: SparkSession, path: str) -> DataFrame:
    """(day, records) of the days that are closed."""
    return spark.read.schema(KIND).parquet(path).where("kind = 'closed'").groupBy("day").agg(F.sum("records").alias("records"))


def late_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The late records, with the columns of the stream."""
    late = spark.read.schema(KIND).parquet(path).where("kind = 'late'")
    return late.select(F.from_json("record", schema, _JSON).alias("r")).select("r.*")


def report_window(days: DataFrame, after, upto) -> DataFrame:
    """One row for the days after one up to another: records, covered_days and days; late records are in none."""
    first, last = F.lit(after).cast("date"), F.lit(upto).cast("date")
    rows = days.where((F.col("day") > first) & (F.col("day") <= last))
    return rows.agg(F.coalesce(F.sum("records"), F.lit(0)).cast("long").alias("records"), F.count_distinct("day").alias("covered_days")).withColumn("days", F.datediff(last, first))
