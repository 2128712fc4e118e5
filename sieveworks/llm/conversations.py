"""The prefix trie of conversations, with totals of subtrees by heavy-path decomposition.

A node is a distinct sequence of first turns.  Turns become two 64-bit hashes;
the exclusive-or of a conversation's hashed (place, turn) up to a turn names the
node, so that nodes come from running values and one aggregate, not from a round
a level.  The child with most members is a node's heavy child; heavy edges make
paths that end in a childless node each, and the path of a node is found from the
rows of that node's conversation: it begins where the last light edge is.

Totals of subtrees are suffix sums along paths.  A path's own total is needed
before the path it hangs on can have one: a light child has at most half of its
parent's members, so paths are taken by the logarithm of the members at their
top, a round each, and never more rounds than the number of conversations has
bits.  Suffix sums are running values over ranged rows: a path of any length is
spread over partitions and nothing gathers it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prefix import running
from .common import read_table, shared_path, stored

#: Ids of conversations in one piece of an ordered list at most.
PIECE = 4096

#: The class of the path from the root, above any logarithm.
TOP = 64

KEY = ["depth", "k1", "k2"]


def placed_turns(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, place, t1, t2, chars): each turn's place from 0, its two hashes and the characters of its text.

    The order is that of turn, nulls first; turns that tie follow each other by
    role and text.  Null roles and texts are empty.  Rows without a conversation
    take no part.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = turns.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), empty(role).alias("role"), empty(text).alias("text"))
    found = running(rows, ["conv_id"], ["turn", "role", "text"], number="place")
    return found.select("conv_id", (F.col("place") - 1).alias("place"), F.xxhash64(F.lit(1), "role", "text").alias("t1"), F.xxhash64(F.lit(2), "role", "text").alias("t2"), F.char_length("text").cast("long").alias("chars"))


def grafted(placed: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another, as (conv_id) and (conv_id, depth from 1, t1, t2, chars).

    Conversation c takes the first h turns of conversation c - c % every, h being
    the crc32 of its number modulo most, in place of its own first h.
    """
    convs = placed.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = convs.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("h"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("held"))
    convs = stored(convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("held", F.lit(0)))), "convs")
    own = placed.join(convs.select("conv_id", "h", "taken"), "conv_id").where("place >= h").select("conv_id", (F.col("place") - F.col("h") + F.col("taken") + 1).alias("depth"), "t1", "t2", "chars")
    heads = placed.where((F.col("place") < most - 1) & (F.col("conv_id") % every == 0)).withColumnRenamed("conv_id", "base")  # most - 1 rows a base, for every conversations
    first = heads.join(convs.select("conv_id", "base", "h"), "base").where("place < h").select("conv_id", (F.col("place") + 1).alias("depth"), "t1", "t2", "chars")
    return convs.select("conv_id"), own.unionByName(first)


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, chars): the node of each turn and the node before."""
    made = turns.select("conv_id", "depth", "chars", F.xxhash64("depth", "t1").alias("g1"), F.xxhash64("depth", "t2", F.lit(2)).alias("g2"))
    rows = running(made, ["conv_id"], ["depth"], xors={"k1": "g1", "k2": "g2"})
    return stored(rows.select("conv_id", "depth", "k1", "k2", F.expr("k1 ^ g1").alias("p1"), F.expr("k2 ^ g2").alias("p2"), "chars"), "prefixes")


def _nodes(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """Nodes by KEY with conv_id, n_convs, own (saved characters), n_children, parent_conv_id and heavy (is its parent's heavy child)."""
    zero = [F.lit(0).cast("long").alias(c) for c in ("k1", "k2", "p1", "p2")]
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(F.lit(0).cast("long").alias("depth"), *zero, "conv_id", "n_convs", F.lit(0).cast("long").alias("own"))
    below = rows.groupBy(*KEY).agg(F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("chars").alias("chars"))
    nodes = root.unionByName(below.withColumn("own", (F.col("n_convs") - 1) * F.col("chars")).drop("chars").select(root.columns))
    size = F.struct("n_convs", (-F.col("conv_id")).alias("minus"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"), F.max(size).alias("largest"))
    nodes = stored(nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("largest.minus").alias("minus"))
    joined = nodes.drop("largest").join(above, ["depth", "p1", "p2"], "left")  # a hot parent's children are split by the adaptive skew join
    return stored(joined.withColumn("heavy", F.coalesce(F.col("minus") == -F.col("conv_id"), F.lit(False))).drop("minus", "p1", "p2"), "tree")


def _paths(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes with path (the conversation of the childless node it ends in), top (the depth where it begins) and class."""
    ends = nodes.where("n_children = 0").select("conv_id")
    along = rows.select("conv_id", *KEY).join(ends, "conv_id", "left_semi").withColumnRenamed("conv_id", "path").join(nodes, KEY)
    along = stored(along, "along")
    tops = along.where("not heavy").groupBy("path").agg(F.max(F.struct("depth", "n_convs")).alias("t"))
    kind = F.when(F.col("t").isNull(), TOP).otherwise(F.floor(F.log2("t.n_convs") + 1e-9)).cast("int")
    tops = ends.withColumnRenamed("conv_id", "path").join(tops, "path", "left").select("path", F.coalesce("t.depth", F.lit(0)).alias("top"), kind.alias("class"))
    tops = stored(tops, "tops")
    found = along.join(tops, "path").where("depth >= top")
    root = nodes.where("depth = 0").join(tops.where("top = 0").withColumn("depth", F.col("top").cast("long")), "depth")  # a row each
    return stored(found.unionByName(root.select(found.columns)), "paths")


def _totals(spark: SparkSession, found: DataFrame) -> DataFrame:
    """(path, depth, n_leaves, saved): what light paths bring to the nodes they hang on."""
    sums = found.groupBy("path", "class").agg(F.sum("own").alias("saved"))
    places = found.select(F.col("conv_id").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"), F.col("path").alias("above"), F.col("class").alias("above_class"))
    hung = found.where("depth = top and depth > 0").select("path", "parent_conv_id", "depth").join(places, ["parent_conv_id", "depth"])
    light = stored(sums.join(hung, "path").withColumn("at", F.col("depth") - 1).select("path", "class", "above", "above_class", "at", F.lit(1).cast("long").alias("n_leaves"), "saved"), "light")
    root = shared_path(spark, "hung")
    done: list[str] = []
    for k in sorted(r["class"] for r in light.select("class").distinct().collect()):  # at most 64 values
        own = light.where(F.col("class") == k)
        if done:
            got = spark.read.schema(light.schema).option("basePath", root).parquet(*done).where(F.col("above_class") == k)
            got = got.groupBy(F.col("above").alias("path")).agg(F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
            own = own.join(got, "path", "left").withColumns({"n_leaves": F.col("n_leaves") + F.coalesce("l", F.lit(0)), "saved": F.col("saved") + F.coalesce("s", F.lit(0))})
        done.append(f"{root}/round={k}")
        own.select(light.columns).write.partitionBy("above_class").parquet(done[-1])  # a round reads what hangs on its own paths only
    if not done:
        return light.select(F.col("above").alias("path"), F.col("at").alias("depth"), "n_leaves", "saved")
    every = spark.read.schema(light.schema).option("basePath", root).parquet(*done)
    return every.groupBy(F.col("above").alias("path"), F.col("at").alias("depth")).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))


def prefix_trie(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of the conversations' prefix trie, and which conversation ends where.

    convs has conv_id, once each, turns (conv_id, depth from 1, t1, t2, chars)
    without gaps in depth; a conversation without turns ends at the root.  Nodes
    have depth, k1 and k2 (their key), conv_id (the smallest member),
    parent_conv_id (null for the root), n_convs, n_children, n_leaves (childless
    nodes below or at it) and saved (of all nodes below or at it, members but one
    times the characters of the last text).  The second table has the key and
    conv_id.  No conversations give no nodes.  Nodes are told apart by 128 bits
    of hashes.
    """
    spark = convs.sparkSession
    rows = _prefixes(turns)
    found = _paths(rows, _nodes(convs, rows))
    brought = _totals(spark, found).withColumnsRenamed({"n_leaves": "more", "saved": "more_saved"})
    valued = found.join(brought, ["path", "depth"], "left").withColumns({"n_leaves": (F.col("n_children") == 0).cast("long") + F.coalesce("more", F.lit(0)), "saved": F.col("own") + F.coalesce("more_saved", F.lit(0))}).drop("more", "more_saved")
    summed = running(valued, ["path"], [F.desc("depth")], sums={"n_leaves": "n_leaves", "saved": "saved"})
    last = rows.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("e"))
    ends = convs.join(last, "conv_id", "left").select(*(F.coalesce(f"e.{c}", F.lit(0).cast("long")).alias(c) for c in KEY), "conv_id")
    return summed.select(*KEY, "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "path"), ends


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each key, of pieces that follow each other, joined by commas."""
    key, held = None, None
    for batch in batches:
        out: list[tuple] = []
        for *k, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if k == key:
                held.update(b",")
            else:
                if held:
                    out.append((*key, held.hexdigest()))
                key, held = k, hashlib.sha256()
            held.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.string() if c == 3 else pa.int64()) for c in range(4)], names=[*KEY, "ends_sha256"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.string() if c == 3 else pa.int64()) for c, x in enumerate((*key, held.hexdigest()))], names=[*KEY, "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """KEY and ends_sha256: of each node the digest of its ending conversations' numbers, ascending and joined by commas.

    Numbers are listed in pieces first, wherever a node's pieces fall; a digest
    is made in order, so the task that makes it reads the pieces as they come and
    holds one.
    """
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = running(ends, KEY, ["conv_id"], number="no").withColumn("piece", F.floor((F.col("no") - 1) / PIECE))
    pieces = numbered.groupBy(*KEY, "piece").agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    ordered = pieces.repartition(parts, *KEY).sortWithinPartitions(*KEY, "piece").select(*KEY, "ids")
    return ordered.mapInArrow(_digests, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    placed = stored(placed_turns(read_table(spark, sf_dir, "conversations")), "turns")
    nodes, ends = prefix_trie(*grafted(placed))
    digests = end_digests(ends)
    return nodes.join(digests, KEY, "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295::BIGINT)"

OP11_SQL = f"""WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS i, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, i, role, text FROM c JOIN t ON t.conv_id = c.base WHERE i < h UNION ALL SELECT c.conv_id, i, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE i >= h),
s AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY i) AS d, md5(length(role) || ':' || role || text) AS m, length(text) AS chars FROM r),
p AS (SELECT conv_id, d, md5(array_to_string(list(m) OVER (PARTITION BY conv_id ORDER BY d), '')) AS k, chars FROM s UNION ALL SELECT conv_id, 0, '', 0 FROM c),
q AS (SELECT *, lag(k) OVER (PARTITION BY conv_id ORDER BY d) AS pk, max(d) OVER (PARTITION BY conv_id) AS len FROM p),
n AS (SELECT d, k, any_value(pk) AS pk, min(conv_id) AS conv_id, count(*) AS n, any_value(chars) AS chars, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = len), '') AS ends FROM q GROUP BY d, k),
e AS (SELECT d - 1 AS d, pk AS k, count(*) AS children FROM n WHERE d > 0 GROUP BY ALL),
w AS (SELECT n.*, coalesce(children, 0) AS children FROM n LEFT JOIN e ON e.d = n.d AND e.k = n.k),
u AS (SELECT q.d, q.k, sum((w.children = 0)::BIGINT) AS leaves, sum((w.n - 1) * w.chars) AS saved FROM w JOIN q ON q.conv_id = w.conv_id AND q.d <= w.d GROUP BY ALL)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, a.conv_id AS parent_conv_id, w.n AS n_convs, CAST(w.children AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM w JOIN u ON u.d = w.d AND u.k = w.k LEFT JOIN n a ON a.d = w.d - 1 AND a.k = w.pk"""
