"""The report as ordered rows of lines, and the summary of a run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LANES, Lane
from ..functions import text as X
from ..vocab import SCORE_FLOOR
from . import scoring

# Headings and sentences of the report.
EMPTY = "No matches this week."
REJECTED = "Rejected on scoring"
REJECTED_NOTE = "Cleared the initial match bar but scored below {floor}/100 — kept here for auditability, and deliberately *not* recorded as seen, so they can resurface if re-posted."


def entry_lines(rows: DataFrame, by: list[str]) -> DataFrame:
    """Four lines of each scored row: heading, url, rationale, blank; rank, line_ord and line besides by.  rows has title, company, source, url, fit_score, rationale and pos."""
    title = F.concat(F.lit("- **"), F.coalesce("title", F.lit("")), F.lit("** — "), X.present("company", "source"), F.lit(" (fit: "), F.col("fit_score").cast("string"), F.lit("/100)"))
    lines = F.array(title, F.concat(F.lit("  "), F.coalesce("url", F.lit(""))), F.concat(F.lit("  "), F.coalesce("rationale", F.lit(""))), F.lit(""))
    return scoring.ranked(rows, by).select(*by, "rank", F.posexplode(lines).alias("line_ord", "line"))


def report_lines(spark: SparkSession, rows: DataFrame, run_date: str, candidates: int, lanes: list[str], known: Mapping[str, Lane] = LANES, floor: int = SCORE_FLOOR, gap: tuple[int, int] = (0, 0)) -> DataFrame:
    """(section, category, rank, line_ord, line): all lines of the report, to be ordered by these.

    Rows whose category is in no active lane get a section of their own after
    the lanes, so that nothing published goes unreported.  gap is the number of
    listings without a verdict and of their chunks; if there are any, the head
    says so.
    """
    head = [(0, 0, 0, k, line) for k, line in enumerate((
        f"# Matches — {run_date}",
        "",
        f"Sources: {'; '.join(known[name].sources for name in lanes)}. {candidates} candidate listings reviewed against {' and '.join(f'[`{known[name].criteria}`](../{known[name].criteria})' for name in lanes)}.",
        "",
        *([f"{gap[0]} listings in {gap[1]} chunks could not be classified and are not part of this report.", ""] if gap[0] else []),
    ))]
    places, frame = {}, []
    for s, name in enumerate(lanes, 1):
        frame += [(s, 0, 0, 0, f"## {known[name].label}"), (s, 0, 0, 1, "")]
        for c, (category, label) in enumerate(known[name].categories.items(), 1):
            places[category] = (s, c)
            frame += [(s, c, 0, 0, f"### {label}"), (s, c, 0, 1, "")]
    other, gone = len(lanes) + 1, len(lanes) + 2
    where = spark.createDataFrame([(k, *v) for k, v in places.items()], "role_category string, section int, category int")
    fixed = spark.createDataFrame(head + frame, "section int, category int, rank int, line_ord int, line string")
    status = scoring.status(floor=floor)
    flat = rows.withColumn("__status", status)
    published = flat.where("__status = 'published'").join(F.broadcast(where), "role_category", "left").withColumns({"section": F.coalesce("section", F.lit(other)), "category": F.coalesce("category", F.lit(0))})
    rejected = flat.where("__status = 'rejected'").withColumns({"section": F.lit(gone), "category": F.lit(0)})
    lines = entry_lines(published, ["section", "category"]).unionByName(entry_lines(rejected, ["section", "category"])).select(fixed.columns)
    filled = lines.select("section", "category").distinct()
    empty = where.join(filled, ["section", "category"], "left_anti").select("section", "category", F.lit(0).alias("rank"), F.posexplode(F.array(F.lit(EMPTY), F.lit(""))).alias("line_ord", "line")).withColumn("line_ord", F.col("line_ord") + 2)
    titles = spark.createDataFrame([(other, 0, "## Uncategorized"), (gone, 0, f"## {REJECTED}")], "section int, category int, title string")
    note = F.when(F.col("section") == gone, F.array(F.col("title"), F.lit(""), F.lit(REJECTED_NOTE.format(floor=floor)), F.lit(""))).otherwise(F.array(F.col("title"), F.lit("")))
    extra = titles.join(filled, ["section", "category"], "left_semi").select("section", "category", F.lit(0).alias("rank"), F.posexplode(note).alias("line_ord", "line"))
    return fixed.unionByName(lines).unionByName(empty.select(fixed.columns)).unionByName(extra.select(fixed.columns))


def rendered(lines: DataFrame) -> str:
    """The report's text: one trailing line feed.  What is published is read by people, so it fits the driver."""
    ordered = lines.orderBy("section", "category", "rank", "line_ord").select("line")
    return "\n".join(r.line for r in ordered.collect()).rstrip() + "\n"


def heartbeat(per_source: DataFrame, summary: DataFrame) -> DataFrame:
    """One row, message.  per_source has name and count; summary one row of matches, candidates, rejected, unclassified, failed_chunks, null where unknown."""
    counts = per_source.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", F.coalesce("count", F.lit(0)).alias("n")))), lambda s: F.concat(s["name"], F.lit(" "), s.n.cast("string"))), ", ").alias("counts"))
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("?"))
    rejected = F.when(F.coalesce("rejected", F.lit(0)) > 0, F.concat(F.lit(" ("), F.col("rejected").cast("string"), F.lit(" rejected on scoring)"))).otherwise("")
    gap = F.when(F.coalesce("unclassified", F.lit(0)) > 0, F.concat(F.lit(" ("), F.col("unclassified").cast("string"), F.lit(" listings unclassified, "), F.coalesce(F.col("failed_chunks"), F.lit(0)).cast("string"), F.lit(" chunks failed)"))).otherwise("")
    message = F.concat(known("matches"), F.lit(" matches from "), known("candidates"), F.lit(" candidates"), rejected, gap, F.lit("\nsources: "), F.col("counts"))
    return summary.join(F.broadcast(counts)).select(message.alias("message"))  # one row each
