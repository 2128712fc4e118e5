"""Line dedup by winnowing, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free, read_table, stored

#: White space that is stripped from a line and that parts its words.
SPACE = " \t\r\f\x0b"

KEY = ("nd", "d", "m")


def _place(doc_id: str, text: str) -> list[Column]:
    """The document's place in the order of documents: null ids last, equal ids by a hash of the text."""
    return [F.col(doc_id).isNull(), F.coalesce(F.col(doc_id).cast("long"), F.lit(0)), F.xxhash64(F.coalesce(F.col(text), F.lit("")))]


def _stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE))


def line_arrays(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """For each distinct document the numbers, hashes and word counts of its lines that hold a word."""
    lines = documents.select(*(c.alias(k) for k, c in zip(KEY, _place(doc_id, text), strict=True)), F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1).alias("lines"))
    lines = lines.withColumn("idx", F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda j: _stripped(F.get("lines", j)) != ""))
    found = lines.select(
        *KEY,
        "idx",
        F.transform("idx", lambda j: F.xxhash64(_stripped(F.get("lines", j)))).alias("hs"),
        F.transform("idx", lambda j: F.regexp_count(F.get("lines", j), F.lit(r"[^ \t\r\f\x0B]+"))).alias("ws"),
    ).where(F.size("idx") > 0)
    return found.groupBy(*KEY).agg(F.any_value(F.struct("idx", "hs", "ws")).alias("v")).select(*KEY, "v.*")


def stretches(arrays: DataFrame, gram_words: int, run_words: int) -> DataFrame:
    """(key, i, g, a, b, s): the stretches of run_words words of each document, each with its winnowed gram.

    From every line on, and up to every line, the shortest stretch that holds
    run_words words is taken: line numbers a to b, of the hash s.  Together they
    cover every run of run_words words or more, and never reach out of it.

    A gram is the shortest stretch of lines from line i on that holds gram_words
    words.  Among the grams inside the shortest stretch from a line on that
    holds run_words words, that with the smallest hash g (the first of equals) is
    selected.  The choice depends on the stretch alone, so a run of at least
    run_words words yields the same fingerprint wherever it stands.
    """
    lines = arrays.select(*KEY, F.posexplode(F.arrays_zip("idx", "hs", "ws")).alias("i", "x")).select(*KEY, "i", F.col("x.idx").alias("no"), F.col("x.hs").alias("h"), F.col("x.ws").cast("long").alias("w"))
    by = Window.partitionBy(*KEY)
    start = lines.withColumn("at", F.sum("w").over(by.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)) - F.col("w"))
    gram, run = by.orderBy("at").rangeBetween(0, gram_words - 1), by.orderBy("at").rangeBetween(0, run_words - 1)
    grams = start.withColumns({"gl": F.collect_list("h").over(gram), "gw": F.sum("w").over(gram)})
    grams = grams.select(*KEY, "i", "no", "h", "at", "w", F.when(F.col("gw") >= gram_words, F.xxhash64("gl")).alias("g"), (F.col("i") + F.size("gl") - 1).alias("e"))
    runs = grams.withColumns({"rl": F.collect_list(F.struct("g", "i", "e", "h", "no")).over(run), "rw": F.sum("w").over(run)})
    last = F.col("i") + F.size("rl") - 1
    least = F.array_min(F.transform(F.filter("rl", lambda x: x.g.isNotNull() & (x.e <= last)), lambda x: F.struct(x.g.alias("g"), x.i.alias("i"))))
    on = F.struct(least.alias("p"), F.col("no").alias("a"), F.element_at("rl", -1)["no"].alias("b"), F.xxhash64(F.transform("rl", lambda x: x.h)).alias("s"))
    runs = runs.select(*KEY, "no", "h", "w", (F.col("at") + F.col("w")).alias("end"), F.when(F.col("rw") >= run_words, on).alias("on"))
    back = by.orderBy("end").rangeBetween(1 - run_words, 0)
    runs = runs.withColumns({"bl": F.collect_list("h").over(back), "bw": F.sum("w").over(back), "bo": F.first(F.struct("on")).over(back)["on"]})
    upto = F.struct(F.col("bo.p").alias("p"), F.col("bo.a").alias("a"), F.col("no").alias("b"), F.xxhash64("bl").alias("s"))
    both = F.array_compact(F.array("on", F.when((F.col("bw") >= run_words) & (F.col("bo.b") < F.col("no")), upto)))
    return runs.select(*KEY, F.explode(both).alias("x")).select(*KEY, "x.p.i", "x.p.g", "x.a", "x.b", "x.s")


def repeated_runs(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", gram_words: int = 25, run_words: int = 50, every_run: bool = False) -> DataFrame:
    """(nd, d, m, runs): for each document the first and last numbers of lines that repeat an earlier run."""
    arrays = stored(line_arrays(documents, doc_id, text), "lines")
    marks = stored(stretches(arrays, gram_words, run_words), "marks")
    mark = F.struct(*KEY, "i")
    first = marks.groupBy("g").agg(F.min(mark).alias("r"), F.max(mark).alias("z")).where("r < z").select("g", "r")
    shared = stored(marks.join(first, "g").drop("g"), "shared")
    ends = extended(shared.where(mark != F.col("r")), arrays)
    if every_run:
        ends = ends.unionByName(stood_earlier(shared))
    return merged(ends).groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("runs"))


def extended(matches: DataFrame, arrays: DataFrame) -> DataFrame:
    """(key, a, b): the matches with a fingerprint's first occurrence, extended both ways over equal lines."""
    matches = matches.select(*KEY, "i", *(F.col(f"r.{k}").alias(f"r{k}") for k in KEY), (F.col("i") - F.col("r.i")).alias("off"))
    diagonals = matches.groupBy(*KEY, *(f"r{k}" for k in KEY), "off").agg(F.collect_set("i").alias("starts"))
    refs = arrays.select(*(F.col(k).alias(f"r{k}") for k in KEY), F.col("hs").alias("rhs"))
    pairs = diagonals.join(arrays.select(*KEY, "idx", "hs"), list(KEY)).join(refs, [f"r{k}" for k in KEY])
    low = F.greatest(F.col("off"), F.lit(0))
    count = F.least(F.size("hs"), F.size("rhs") + F.col("off")) - F.col("low")
    pairs = pairs.withColumn("low", low).withColumn("n", count)
    same = F.array_join(F.zip_with(F.slice("hs", F.col("low") + 1, F.col("n")), F.slice("rhs", F.col("low") - F.col("off") + 1, F.col("n")), lambda a, b: F.when(a == b, "1").otherwise("0")), "")
    pairs = pairs.withColumn("same", same)
    ends = F.transform("starts", lambda s: F.struct(
        F.get("idx", F.col("low") + F.length(F.rtrim(F.substring("same", F.lit(1), s - F.col("low")), F.lit("1")))).alias("a"),
        F.get("idx", F.col("low") + F.col("n") - F.length(F.ltrim(F.substring(F.col("same"), s - F.col("low") + 1, F.col("n")), F.lit("1"))) - 1).alias("b"),
    ))
    return pairs.select(*KEY, F.explode(F.array_distinct(ends)).alias("x")).select(*KEY, "x.a", "x.b")


def stood_earlier(shared: DataFrame) -> DataFrame:
    """(key, a, b): the stretches that stand in any earlier document, or earlier in their own; equal ones share their gram, so those of unshared grams are not needed."""
    at = F.struct(*KEY, "a")
    first = shared.groupBy("s").agg(F.min(at).alias("f"), F.max(at).alias("z")).where("f < z").select("s", "f")
    return shared.select(*KEY, "a", "b", "s").join(first, "s").where(at != F.col("f")).select(*KEY, "a", "b")


def merged(ends: DataFrame) -> DataFrame:
    """Overlapping runs of a document as one."""
    by = Window.partitionBy(*KEY).orderBy("a", "b")
    before = F.max("b").over(by.rowsBetween(Window.unboundedPreceding, -1))
    parted = ends.withColumn("new", F.coalesce(F.col("a") > before, F.lit(True)).cast("int"))
    return parted.withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*KEY, "run").agg(F.min("a").alias("a"), F.max("b").alias("b"))


def deduplicated(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", gram_words: int = 25, run_words: int = 50, every_run: bool = False) -> DataFrame:
    """documents with later repeated runs of lines deleted from text, and the columns lines_before and lines_removed.

    Lines part at line feeds; they are compared without surrounding white space,
    and lines without a word are passed over.  Winnowed fingerprints of the
    lines are joined with their first occurrence (smallest doc_id, then line);
    each match is extended both ways over equal lines of the two documents, and
    the later run is deleted with the blank lines inside it.  Runs are found from
    gram_words words on where a fingerprint falls on them, and no run under
    gram_words words is deleted.  One copy of each line always stays.

    A fingerprint's first occurrence may stand in another document than the
    rest of a run.  With every_run the stretches of run_words words around shared
    fingerprints are also joined with their own first occurrence, so that every
    run of run_words words or more that stands in any earlier document, or
    earlier in its own, is deleted, whole lines given; without it only what the
    first occurrences hold.

    Null texts stay null and have no lines.  Null ids come last in the order;
    rows with equal ids and texts count as one document and all get its result;
    equal ids with different texts are ordered by a hash of the text.  An empty
    table gives no rows.  A long text is a long array of lines, in one row.
    Columns of the input named lines_before or lines_removed give way to those
    of the result; others may have any names.
    """
    runs = repeated_runs(documents, doc_id=doc_id, text=text, gram_words=gram_words, run_words=run_words, every_run=every_run)
    *key, found, kept, before = free(documents.columns, *KEY, "runs", "kept", "before")
    placed = documents.withColumns(dict(zip(key, _place(doc_id, text), strict=True)))
    joined = placed.join(runs.select(*(F.col(k).alias(n) for k, n in zip(KEY, key, strict=True)), F.col("runs").alias(found)), key, "left")
    lines = F.split(F.col(text), "\n", -1)
    left = F.transform(
        F.filter(F.transform(lines, lambda x, j: F.struct(x.alias("x"), j.alias("j"))), lambda s: ~F.exists(found, lambda r: s.j.between(r.a, r.b))),
        lambda s: s.x,
    )
    cut = F.col(found).isNotNull()
    out = joined.withColumn(before, F.coalesce(F.size(lines), F.lit(0))).withColumn(kept, F.when(cut, left))
    own = [c for c in documents.columns if c.lower() not in ("lines_before", "lines_removed")]
    return out.select(
        *(F.when(cut, F.array_join(kept, "\n")).otherwise(F.col(text)).alias(text) if c == text else F.col(c) for c in own),
        F.col(before).alias("lines_before"),
        F.when(cut, F.col(before) - F.size(kept)).otherwise(0).alias("lines_removed"),
    )


def op10_line_winnow(spark, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that an earlier one, or itself, holds already."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicated(docs, every_run=True).select("doc_id", "lines_before", "lines_removed", "text")
