"""Helpers that the operators share: shared storage, tables, word hashing, components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import pickle
import re
import tempfile
import uuid
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Distinct words whose hash or features a Python worker keeps; beyond it the cache starts anew.
CACHE_WORDS = 400_000

#: Bytes of labelled text that a training reads at most, about; a document is read whole or not at all.
SAMPLE_BYTES = 64 << 20

#: Bytes of text that a Python worker takes up at once where it works row by row, and where it looks for distinct words.
PART_BYTES, UNIT_BYTES = 4 << 20, 16 << 20

#: ASCII punctuation and control characters become spaces when words are compared.
_BLANKED = bytes(
    c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Where none is set, one of our own on a single machine; on a cluster that
    would be a folder of each executor's own, so it is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sieveworks-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def shared_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_root(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Writes df to the shared folder and reads it back, which also cuts its lineage."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def handed_out(spark: SparkSession, value) -> Broadcast:
    """A broadcast of one of our own objects, classes included, so that workers need no copy of this package; see taken_in()."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def taken_in(held: Broadcast):
    return pickle.loads(held.value)


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, limit: int) -> Iterator[None]:
    """Arrow batches of about limit bytes for what runs within; the session's own setting stands again afterwards."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a table of the shared folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discarded(df: DataFrame) -> None:
    """Deletes a table of stored() that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        removed(df.sparkSession, path)


def give_back() -> None:
    """Returns a Python process's freed memory to the system, after a training or a task of a worker that others follow in."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def heap_back(spark: SparkSession) -> None:
    """A collection of the driver's heap: Spark then drops shuffles and broadcasts that nothing refers to any more, and free memory goes back to the system."""
    gc.collect()  # Python's hold on them goes first
    spark._jvm.System.gc()


def executors_back(spark: SparkSession) -> None:
    """The same on the executors, before a step that takes much memory: a small task for each of their cores."""
    cores = spark.sparkContext.defaultParallelism
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):  # there heap_back() has done it
        spark.range(0, cores, 1, cores).select(F.expr("java_method('java.lang.System', 'gc')")).write.format("noop").mode("overwrite").save()


def small(batches: Iterator[pa.RecordBatch], text: int | str, limit: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about limit bytes of the column text, a row at least."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def units(batches: Iterator[pa.RecordBatch], text: int | str, key: int | str | None = None, limit: int = UNIT_BYTES) -> Iterator[pa.Table]:
    """The rows in tables of about limit bytes of the column text; with a key column, of one key each."""
    held, size, last = [], 0, None
    for batch in small(batches, text, limit // 4):
        cuts = [0]
        if key is not None:
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            cuts += (np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()
            if held and keys[0] != last:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            last = keys[-1]
        for k, (lo, hi) in enumerate(pairwise([*cuts, batch.num_rows])):
            if k:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            part = batch.slice(lo, hi - lo)
            held.append(part)
            size += pc.sum(pc.binary_length(part.column(text))).as_py() or 0
        if size >= limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_BLANKED).split() if text else []


class WordHashes(dict):
    """Word to 64-bit hash, computed once per distinct word and bounded in size."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit values, so that low and high bits are all usable."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def multipliers(n: int) -> np.ndarray:
    """n odd 64-bit factors, one for each position of a window."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def windowed(h: np.ndarray, offsets: tuple[int, ...] | list[int]) -> np.ndarray:
    """A hash for every window of h, of the values at the given offsets only."""
    span = offsets[-1] + 1
    n = len(h) - span + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    factors = multipliers(span)
    out = np.zeros(n, np.uint64)
    for o in offsets:
        out += h[o : o + n] * factors[o]
    return mixed(out)


def crc_mod(column: str, n: int):
    """crc32 of the id's text modulo n, the contract's fold."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def connected_components(edges: DataFrame, tag: str = "components") -> DataFrame:
    """(node, component): the smallest node of each connected component of edges (a, b).

    Every round hooks each label to its smallest neighbouring label and then
    halves the chains of hooks; labels of components at least halve in number,
    so the rounds grow with the logarithm of the nodes.  Only aggregates by key
    and equi-joins are used: a node with very many edges is pre-aggregated in
    the map tasks and split by the adaptive skew join.  Each round is written
    to the shared folder.
    """
    edges = stored(edges.where("a != b").select("a", "b").distinct(), tag)
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().select("node", F.col("node").alias("component"))
    labels = stored(labels, tag)
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("up"))
        hooks = stored(hooks, tag)
        while True:
            parents = hooks.select(F.col("node").alias("up"), F.col("up").alias("upper"))
            jumped = hooks.join(parents, "up", "left").select("node", F.coalesce("upper", "up").alias("up"), (F.coalesce("upper", "up") != F.col("up")).alias("moved"))
            jumped = stored(jumped, tag)
            hooks = jumped.select("node", "up")
            if jumped.where("moved").isEmpty():
                break
        to = hooks.select(F.col("node").alias("component"), "up")
        labels = stored(labels.join(to, "component", "left").select("node", F.coalesce("up", "component").alias("component")), tag)
        a, b = hooks.select(F.col("node").alias("a"), F.col("up").alias("ua")), hooks.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        edges = stored(edges.join(a, "a").join(b, "b").where("ua != ub").select(F.col("ua").alias("a"), F.col("ub").alias("b")).distinct(), tag)
    return labels


def free(columns: list[str], *names: str) -> list[str]:
    """The names, with as many underscores before them as keep them apart from the columns."""
    taken, mark = {c.lower() for c in columns}, "_"
    while any((mark + n).lower() in taken for n in names):
        mark += "_"
    return [mark + n for n in names]


def labelled_sample(documents: DataFrame, labels: DataFrame, *, label: str, fold: int, held_out: int, per_class: int, doc_id: str = "doc_id", text: str = "text", max_bytes: int = SAMPLE_BYTES) -> list[tuple[int, str, int]]:
    """(id, whole text, label) of at most per_class documents and about half of max_bytes of text of each class, outside the held-out fold.

    Those with the smallest hash of their id are taken, so the sample does not
    depend on partitions; a text that would pass the bound is left out and those
    after it are tried.  Of several labels of a document
    the largest counts, of several texts the smallest: repeated rows are made one
    before anything reaches the driver.  Null ids, labels and texts are left out.
    """
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").where(crc_mod("doc_id", fold) != held_out)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    taken = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        taken = part if taken is None else taken.unionByName(part)
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    found = docs.join(F.broadcast(taken), "doc_id")  # at most 2 * per_class ids are broadcast
    found = stored(found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y")), "labelled")
    sizes, keep, used = found.select("doc_id", "y", F.octet_length("text").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect(), [], {0: 0, 1: 0}
    for r in sizes:
        if used[r.y] + r.n <= max_bytes // 2:
            keep.append(r.doc_id)
            used[r.y] += r.n
    if len(keep) < len(sizes):
        found = found.where(F.col("doc_id").isin(keep))
    return sorted((r.doc_id, r.text, r.y) for r in found.collect())
