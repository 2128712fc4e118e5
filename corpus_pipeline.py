"""A cleaning run over ``documents``, each stage one operator, written and read again between stages.

In every stage rows with equal or null ids are documents of their own, texts of any
length are taken whole, an empty table stays empty, and all columns of documents go
on as they are, whatever else their names are in an operator; what a stage does with
null, empty and wordless texts its docstring says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveworks.llm import bpe, decontam, line_dedup, ngram_join, toxicity
from sieveworks.llm.common import free, heap_back, read_table, stored


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below 0.5; the network learns from the labelled ones outside the held-out fold.

    Null and empty texts are scored as texts without words; with no labelled
    documents, or of one class only, see toxicity.train().
    """
    return toxicity.accepted(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated runs of lines, and n_chars to match; a document of which nothing is left goes.

    Null, empty and wordless texts, of which nothing was cut, stay as they are.
    """
    clash = [c for c in docs.columns if c.lower() in ("lines_before", "lines_removed")]
    aside = dict(zip(clash, free(docs.columns, *clash), strict=True))  # the operator's own columns have these names
    cut = line_dedup.deduplicated(docs.withColumnsRenamed(aside), every_run=True)
    left = cut.where((F.col("lines_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    chars = F.when(F.col("lines_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", chars).select(*(F.col(aside.get(c, c)).alias(c) for c in docs.columns))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component at five words and a similarity of 0.75: that with the smallest id.

    Null and wordless texts are in no component and all stay; of repeated rows one stays.
    """
    return ngram_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item; null and wordless texts overlap with none, and an empty benchmark with nothing."""
    return decontam.uncontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token counts and digests, a row each; a null text is encoded as an empty one."""
    return bpe.encoded(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("ngram_join", without_near_copies),
    ("decontamination", without_benchmark),
    ("byte_bpe", tokenized),
]

#: The classifier, the spaced seeds and the merges can't be expressed in SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, on the documents of sf_dir."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        heap_back(spark)  # what the stage's many small jobs left on the driver
    return docs
