"""Roll-ups of status rows and total failure (A2, A3, A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_source(rows: DataFrame) -> DataFrame:
    """A2: status, attempts and count of each source; of several rows a failure counts before a success, and that before a skip."""
    worst = F.when(F.bool_or(F.col("status") == "failed"), "failed").when(F.bool_or(F.col("status") == "success"), "success").otherwise(F.max("status"))
    return rows.groupBy("name").agg(worst.alias("status"), F.max("attempts").alias("attempts"), F.sum("count").alias("count"))


def totals(rows: DataFrame) -> DataFrame:
    """A2, A3, A4: one row of total, succeeded, skipped, failed, failed_names and total_failure: there is something to reach, and all of it failed."""
    failed, skipped = F.col("status") == "failed", F.col("status") == "skipped"
    out = rows.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total"),
        F.count_if(F.col("status") == "success").alias("succeeded"),
        F.count_if(skipped).alias("skipped"),
        F.count_if(failed).alias("failed"),
        F.array_sort(F.collect_set(F.when(failed, F.col("name")))).alias("failed_names"),
        F.count("*").alias("__n"),
    )
    reachable = F.col("__n") - F.col("skipped")
    return out.withColumn("total_failure", (reachable > 0) & (F.col("failed") == reachable)).drop("__n")
