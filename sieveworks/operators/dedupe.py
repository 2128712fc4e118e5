"""Duplicates within a run and records published before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_key(key: str = "url") -> Column:
    """The key is neither null nor empty."""
    return F.coalesce(F.col(key), F.lit("")) != ""


def keep_first(rows: DataFrame, key: str = "url", pos: str = "pos") -> DataFrame:
    """Of each key the row with the smallest pos; an aggregate, so hot keys shrink before the shuffle."""
    first = rows.groupBy(key).agg(F.min_by(F.struct(*(c for c in rows.columns if c != key)), F.col(pos)).alias("__first"))
    return first.select(*(F.col(c) if c == key else F.col(f"__first.{c}") for c in rows.columns))


def unseen(rows: DataFrame, seen: DataFrame, run_date: str, key: str = "url") -> DataFrame:
    """Without rows whose key was first seen on another date."""
    earlier = seen.where(F.col("first_seen") != run_date).select(F.col("url").alias(key)).distinct()
    return rows.join(earlier, key, "left_anti")


def with_reason(rows: DataFrame, seen: DataFrame, run_date: str, key: str = "url", pos: str = "pos") -> DataFrame:
    """A1: adds reason: no_url, previously_matched, in_run_dupe or kept, in this priority."""
    earlier = seen.where(F.col("first_seen") != run_date).select(F.col("url").alias(key)).distinct().withColumn("__seen", F.lit(True))
    first = rows.where(has_key(key)).groupBy(key).agg(F.min(pos).alias("__first"))
    some = rows.withColumn("__key", F.when(has_key(key), F.col(key)).otherwise(F.concat(F.lit("\x00"), F.col(pos).cast("string"))))  # rows without a key don't meet in one partition
    out = some.join(earlier.withColumnRenamed(key, "__key"), "__key", "left").join(first.withColumnRenamed(key, "__key"), "__key", "left")
    reason = F.when(~has_key(key), "no_url").when(F.col("__seen"), "previously_matched").when(F.col(pos) > F.col("__first"), "in_run_dupe").otherwise("kept")
    return out.withColumn("reason", reason).select(*rows.columns, "reason")


def deduplicated(rows: DataFrame, seen: DataFrame, run_date: str, key: str = "url", pos: str = "pos") -> DataFrame:
    return keep_first(unseen(rows.where(has_key(key)), seen, run_date, key), key, pos)


def _reasons() -> list[Column]:
    reason = F.col("reason")
    return [F.count(F.lit(1)).alias("raw_count"), *(F.count_if(reason == r).alias(n) for r, n in (("no_url", "no_url"), ("previously_matched", "previously_matched"), ("in_run_dupe", "in_run_dupes"), ("kept", "deduped_count")))]


def drop_counts(rows: DataFrame, seen: DataFrame, run_date: str, key: str = "url", pos: str = "pos") -> DataFrame:
    """One row: raw_count, no_url, previously_matched, in_run_dupes, deduped_count."""
    return with_reason(rows, seen, run_date, key, pos).agg(*_reasons())


def observed(rows: DataFrame, seen: DataFrame, run_date: str, key: str = "url", pos: str = "pos") -> tuple[DataFrame, list[Column], Callable[[DataFrame], DataFrame]]:
    """What drop_counts() counts, for one pass: the rows with their reason, the counters to observe on them, and those that are kept."""
    return with_reason(rows, seen, run_date, key, pos), _reasons(), lambda made: made.where("reason = 'kept'").select(*rows.columns)
