"""Scores joined to matches, the floor and the ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..vocab import SCORE_FLOOR
from .prefix import running


def last_score(scores: DataFrame, key: str = "url", pos: str = "resp_pos") -> DataFrame:
    """Of each key the score given last; scores outside 0 to 100 don't count."""
    valid = scores.where(F.col("fit_score").between(0, 100))
    values = [c for c in scores.columns if c not in (key, pos)]
    return valid.groupBy(key).agg(F.max_by(F.struct(*values), F.col(pos)).alias("__s")).select(key, *(F.col(f"__s.{c}").alias(c) for c in values))


def scored(matches: DataFrame, scores: DataFrame, key: str = "url", pos: str = "resp_pos") -> DataFrame:
    """The matches that have a score; scores of unknown keys are ignored."""
    return matches.join(last_score(scores, key, pos), key)


def unscored_count(matches: DataFrame, scores: DataFrame, key: str = "url") -> DataFrame:
    """A10: one row, unscored_count."""
    return matches.join(scores.select(key).distinct(), key, "left_anti").agg(F.count("*").alias("unscored_count"))


def status(score: str = "fit_score", floor: int = SCORE_FLOOR) -> Column:
    """Published from the floor on, else rejected."""
    return F.when(F.col(score) >= floor, "published").otherwise("rejected")


def floor_counts(rows: DataFrame, floor: int = SCORE_FLOOR) -> DataFrame:
    """One row, matches and rejected."""
    return rows.agg(F.count_if(F.col("fit_score") >= floor).alias("matches"), F.count_if(F.col("fit_score") < floor).alias("rejected"))


def ranked(rows: DataFrame, by: list[str], score: str = "fit_score", pos: str = "pos") -> DataFrame:
    """Adds rank, by score downwards; ties keep their order.  A group of any size is spread over partitions."""
    out = running(rows, by, [F.desc(score), pos], number="rank")
    return out.withColumn("rank", F.col("rank").cast("int"))
