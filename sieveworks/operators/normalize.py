"""Raw records of each source to the common listing schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import FIRST_TPM, FRACTIONAL
from ..functions import text as X
from ..vocab import COMPANY_CHARS, THREAD_HEAD_CHARS, TITLE_CHARS, RoleRules, SnippetRules

#: The order in which the sources' listings follow each other.
SOURCE_ORDER = ("remoteok", "weworkremotely", "hn_whoishiring", "ats")

#: An upper bound of the rows of a source, which parts its positions from those of the next.
SPAN = 1 << 40


def _or_empty(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _listing(df: DataFrame, lane: str, **cols: Column) -> DataFrame:
    values = {"tags": F.array().cast("array<string>"), "lane": F.lit(lane), "headcount": F.lit(None).cast("int"), **cols}
    return df.select(*(values[f.name].cast(f.dataType).alias(f.name) for f in schemas.LISTING))


def board_listings(items: DataFrame, rules: SnippetRules = SnippetRules()) -> DataFrame:
    """Items with position, company, url, date, description, tags and pos."""
    return _listing(items, FRACTIONAL, source=F.lit("remoteok"), title=_or_empty("position"), company=_or_empty("company"), url=_or_empty("url"), posted_date=_or_empty("date"), snippet=X.snippet(X.strip_html("description"), rules), tags=F.coalesce("tags", F.array().cast("array<string>")), pos=F.col("pos"))


def feed_listings(items: DataFrame, rules: SnippetRules = SnippetRules()) -> DataFrame:
    """Feed items with title, link, pubDate, description and pos."""
    parted = items.withColumn("__t", X.title_parts("title"))
    return _listing(parted, FRACTIONAL, source=F.lit("weworkremotely"), title=_or_empty("__t.role"), company=_or_empty("__t.company"), url=_or_empty("link"), posted_date=_or_empty("pubDate"), snippet=X.snippet(X.strip_html("description"), rules), pos=F.col("pos"))


def thread_listings(items: DataFrame, roles: RoleRules = RoleRules(), rules: SnippetRules = SnippetRules(head=THREAD_HEAD_CHARS)) -> DataFrame:
    """Thread comments with thread_title, id, created_at, text and pos."""
    base = items.withColumns({"__clean": X.strip_html("text"), "__header": X.strip(X.strip_html(X.before_paragraph(_or_empty("text"))))})
    base = base.withColumn("__fields", X.header_fields("__header"))
    role = F.when(F.size("__fields") > 1, X.pick_role("__fields", roles)).otherwise(F.substring("__clean", 1, TITLE_CHARS))
    company = F.when(F.size("__fields") > 0, F.substring(X.one_line(F.get("__fields", F.lit(0))), 1, COMPANY_CHARS)).otherwise("")
    return _listing(base, FRACTIONAL, source=F.concat(F.lit("hn:"), _or_empty("thread_title")), title=X.one_line(role), company=company, url=F.concat(F.lit("https://news.ycombinator.com/item?id="), F.coalesce(F.col("id").cast("string"), F.lit("None"))), posted_date=_or_empty("created_at"), snippet=X.snippet("__clean", rules), pos=F.col("pos"))


#: Field names of a job by the company's system: title, url, date, description and what stands in for it if the key is absent.
JOB_FIELDS = {
    "greenhouse": ("title", "absolute_url", "first_published", "content", None),
    "ashby": ("title", "jobUrl", "publishedAt", "descriptionPlain", None),
    "lever": ("text", "hostedUrl", "createdAt", "descriptionPlain", "description"),
}


def company_jobs(results: DataFrame) -> DataFrame:
    """One row for each job of a company that was read, with the company's columns; results has company, status, jobs and pos."""
    return results.where("status = 'success'").select("company.*", F.col("pos").alias("company_pos"), F.posexplode("jobs").alias("job_pos", "job"))


def job_listings(jobs: DataFrame, rules: SnippetRules = SnippetRules()) -> DataFrame:
    """Jobs given as maps or structs whose missing keys are null."""
    has = set(jobs.schema["job"].dataType.fieldNames()) if hasattr(jobs.schema["job"].dataType, "fieldNames") else None

    def value(key: str | None) -> Column:
        if key is None or has is not None and key not in has:
            return F.lit(None).cast("string")
        return (F.col("job").getItem(key)).cast("string")

    def of(k: int) -> Column:
        out = None
        for ats, fields in JOB_FIELDS.items():
            v = F.coalesce(value(fields[k]), value(fields[4])) if k == 3 else value(fields[k])
            out = F.when(F.col("ats") == ats, v) if out is None else out.when(F.col("ats") == ats, v)
        return F.coalesce(out, F.lit(""))

    known = jobs.where(F.col("ats").isin(*JOB_FIELDS))
    return _listing(known, FIRST_TPM, source=F.concat_ws(":", "ats", "token"), title=X.one_line(of(0)), company=F.col("name"), url=of(1), posted_date=of(2), snippet=X.snippet(X.strip_html(of(3)), rules), headcount=F.col("headcount"), pos=F.col("company_pos") * 1_000_000 + F.col("job_pos"))


def union_sources(spark: SparkSession, parts: dict[str, DataFrame | None]) -> DataFrame:
    """The listings of all sources in the fixed order; a missing source gives none."""
    found = [parts[s].withColumn("pos", F.lit(k * SPAN) + F.col("pos")) for k, s in enumerate(SOURCE_ORDER) if parts.get(s) is not None]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schemas.LISTING)
