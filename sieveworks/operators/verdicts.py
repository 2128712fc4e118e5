"""Checks of a judge's answers and their joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..vocab import VERDICTS


def first_errors(answers: DataFrame, expected: DataFrame, values: tuple[str, ...] = VERDICTS) -> DataFrame:
    """(chunk, error) of every chunk whose answers can't be accepted, with its first violation.

    In the order of the answers: no id, duplicate id, an id of another chunk, a
    verdict outside values, a match without category or reason; a missing answer
    comes last.  answers has chunk, id, verdict, role_category, reason and
    resp_pos, expected has chunk and id.
    """
    nth = F.row_number().over(Window.partitionBy("chunk", "id").orderBy("resp_pos"))
    known = expected.select("chunk", "id").distinct().withColumn("__known", F.lit(True))
    checked = answers.withColumn("__nth", nth).join(known, ["chunk", "id"], "left")
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    error = (
        F.when(F.col("id").isNull(), F.lit("verdict missing id"))
        .when(F.col("__nth") > 1, F.concat(F.lit("duplicate id in response: "), F.col("id").cast("string")))
        .when(F.col("__known").isNull(), F.concat(F.lit("id not in this chunk: "), F.col("id").cast("string")))
        .when(~F.coalesce(F.col("verdict").isin(*values), F.lit(False)), F.concat(F.lit("unknown verdict for id "), F.col("id").cast("string")))
        .when((F.col("verdict") == "match") & (blank("role_category") | blank("reason")), F.concat(F.lit("match verdict missing role_category/reason for id "), F.col("id").cast("string")))
    )
    wrong = checked.withColumn("error", error).where("error is not null").select("chunk", "error", F.col("resp_pos").cast("long").alias("__at"))
    gaps = missing(answers, expected).groupBy("chunk").agg(F.concat(F.lit("missing verdicts for ids: "), F.array_join(F.array_sort(F.collect_set("id")).cast("array<string>"), ", ")).alias("error"))
    every = wrong.unionByName(gaps.withColumn("__at", F.lit((1 << 62))))
    return every.groupBy("chunk").agg(F.min_by("error", "__at").alias("error"))


def missing(answers: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected (chunk, id) without an answer."""
    return expected.select("chunk", "id").join(answers.select("chunk", "id"), ["chunk", "id"], "left_anti")


def foreign(answers: DataFrame, expected: DataFrame) -> DataFrame:
    """Answered (chunk, id) that weren't asked."""
    return answers.where("id is not null").select("chunk", "id").join(expected.select("chunk", "id"), ["chunk", "id"], "left_anti")


def duplicates(answers: DataFrame) -> DataFrame:
    """(chunk, id) answered more than once."""
    return answers.where("id is not null").groupBy("chunk", "id").agg(F.count("*").alias("answers")).where("answers > 1")


def accepted(answers: DataFrame, expected: DataFrame) -> DataFrame:
    """The answers of chunks without any violation: a chunk is taken whole or not at all."""
    return answers.join(first_errors(answers, expected), "chunk", "left_anti")


def matched(answers: DataFrame, listings: DataFrame) -> DataFrame:
    """Id, url, role_category, reason and the whole listing of every match."""
    listing = F.struct(*(c for c in listings.columns if c not in ("id",))).alias("listing")
    return answers.where("verdict = 'match'").select("id", "role_category", "reason").join(listings.select("id", "url", listing), "id").select("id", "url", "role_category", "reason", "listing")
