"""Filter by phrases and by terms that stand close."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FIRST_TPM
from ..functions import text as X
from ..vocab import PhraseRules


def evaluated(listings: DataFrame, rules: PhraseRules = PhraseRules(), text: Column | None = None) -> DataFrame:
    """Adds tier1, tier2, passes and near_miss; text defaults to title and snippet."""
    text = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("snippet", F.lit(""))) if text is None else text
    base = listings.withColumn("__text", X.match_text(text))
    tier1 = reduce(lambda a, b: a | b, (F.col("__text").contains(p) for p in rules.phrases), F.lit(False))
    role, foundation = X.matches("__text", rules.role), X.matches("__text", rules.foundation)
    base = base.withColumns({"tier1": tier1, "tier2": role & foundation & X.near("__text", rules.role, rules.foundation, rules.window), "near_miss": role != foundation})
    return base.withColumn("passes", F.col("tier1") | F.col("tier2")).drop("__text")


def bypassed(lane: str = "lane", gated: str = FIRST_TPM) -> Column:
    """Rows of other lanes pass untouched."""
    return F.coalesce(F.col(lane), F.lit("")) != gated


def prefiltered(listings: DataFrame, rules: PhraseRules = PhraseRules(), gated: str = FIRST_TPM) -> DataFrame:
    return evaluated(listings, rules).where(bypassed(gated=gated) | F.col("passes")).select(*listings.columns)


def counts(listings: DataFrame, rules: PhraseRules = PhraseRules(), gated: str = FIRST_TPM) -> DataFrame:
    """A5: one row of passed (bypassed included), filtered and near_misses (of filtered rows)."""
    out = bypassed(gated=gated) | F.col("passes")
    return evaluated(listings, rules).agg(F.count_if(out).alias("passed"), F.count_if(~out).alias("filtered"), F.count_if(~out & F.col("near_miss")).alias("near_misses"))


def observed(listings: DataFrame, rules: PhraseRules = PhraseRules(), gated: str = FIRST_TPM) -> tuple[DataFrame, list[Column], Callable[[DataFrame], DataFrame]]:
    """What counts() counts, for one pass: the evaluated rows, the counters to observe on them, and which of them pass."""
    out = bypassed(gated=gated) | F.col("passes")
    counters = [F.count_if(out).alias("passed"), F.count_if(~out).alias("filtered"), F.count_if(~out & F.col("near_miss")).alias("near_misses")]
    return evaluated(listings, rules), counters, lambda rows: rows.where(out).select(*listings.columns)
