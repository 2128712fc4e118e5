"""Dense ids and fixed-size chunks in order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import FRACTIONAL
from .prefix import running


def dense_ids(rows: DataFrame, order: list[str], name: str = "id") -> DataFrame:
    """The 0-based place of each row in the order."""
    return running(rows, [], order, number=name).withColumn(name, F.col(name) - 1)


def chunked(rows: DataFrame, size: int, lane: str = "lane", order: str = "id", default_lane: str = FRACTIONAL) -> DataFrame:
    """Adds lane_pos, local_chunk and the chunk's index over all lanes, which follow each other by name."""
    laned = rows.withColumn(lane, F.coalesce(lane, F.lit(default_lane)))
    placed = dense_ids(laned, [lane, order], "__place")
    lanes = placed.groupBy(lane).agg(F.min("__place").alias("__start"), F.ceil(F.count("*") / size).alias("__chunks"))
    before = Window.orderBy(lane).rowsBetween(Window.unboundedPreceding, -1)  # a row for each lane
    lanes = lanes.withColumn("__base", F.coalesce(F.sum("__chunks").over(before), F.lit(0)))
    out = placed.join(F.broadcast(lanes), lane).withColumn("lane_pos", F.col("__place") - F.col("__start"))
    out = out.withColumn("local_chunk", F.floor(F.col("lane_pos") / size).cast("long"))
    return out.withColumn("chunk", (F.col("__base") + F.col("local_chunk")).cast("long")).select(*laned.columns, "lane_pos", "local_chunk", "chunk")


def failed_total(chunks: DataFrame, failed: DataFrame) -> DataFrame:
    """unclassified_count, the rows in chunks that failed."""
    return chunks.join(failed.select("chunk").distinct(), "chunk", "left_semi").agg(F.count("*").alias("unclassified_count"))


def valid_checkpoints(stored_ids: DataFrame, chunks: DataFrame) -> DataFrame:
    """The chunks whose stored set of ids equals the expected one; chunks hold a bounded number of ids."""
    want = chunks.groupBy("chunk").agg(F.array_sort(F.collect_set("id")).alias("want"))
    have = stored_ids.groupBy("chunk").agg(F.array_sort(F.collect_set("id")).alias("have"))
    return want.join(have, "chunk").where(F.col("want") == F.col("have")).select("chunk")
