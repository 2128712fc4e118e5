"""Nearest neighbours by inner product: a forest of random-projection trees and exact reranking."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import handed_out, read_table, stored, taken_in

#: Trees, their usual levels and the most, the fewest and most rows of a leaf for which levels are given up or added, and vectors (about; those with the smallest hashes) that the splits are fitted on.
TREES, LEVELS, MOST, LEAF, SAMPLE = 6, 6, 11, (32, 2048), 40_000

#: Rows and queries of a leaf meet in blocks of this size.
BLOCK = 2048

#: Queries (about) on which the search budget is set against brute force, and the recall it is set for.
TUNE, TARGET = 200, 0.96

#: Times the rounding unit, the lengths of both vectors and the dimensions: what a score from a matrix product may differ from an exact sum by, with room to spare.
SLACK = 8


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part, once for each id."""
    e = F.col("embedding")
    found = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding")).where("vec_id is not null and embedding is not null")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    found = found.where(F.coalesce(finite & F.exists(e, lambda x: x != 0), F.lit(False)))
    return found.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


class Forest:
    """Trees as arrays: node k of a level has the children 2k and 2k + 1 in the next.

    Vectors get one more coordinate, which makes all of them as long as the
    longest; then the nearest by inner product are the nearest by angle.
    """

    def __init__(self, sample: np.ndarray, longest: float, levels: int, trees: int, seed: int = 5):
        self.longest, self.levels, self.trees = longest, levels, trees
        self.leaves = 1 << levels
        x, random = self.lifted(sample), np.random.default_rng(seed)
        self.normals = np.zeros((self.trees, self.leaves - 1, x.shape[1]), np.float32)
        self.cuts = np.zeros((self.trees, self.leaves - 1), np.float32)
        for t in range(self.trees):
            parts = [np.arange(len(x))]
            for level in range(levels):
                split = []
                for k, own in enumerate(parts):
                    w = self._normal(x, own, random)
                    p = x[own] @ w
                    cut = np.median(p) if len(own) else 0.0
                    at = (1 << level) - 1 + k
                    self.normals[t, at], self.cuts[t, at] = w, cut
                    split += [own[p <= cut], own[p > cut]]
                parts = split
        #: Rows of each leaf, queries that reach it, and rows that a query is to reach.
        self.counts, self.visits, self.budget = np.zeros(self.trees * self.leaves, np.int64), np.zeros(self.trees * self.leaves, np.int64), 0

    @staticmethod
    def _normal(x: np.ndarray, own: np.ndarray, random) -> np.ndarray:
        """The direction between two means that a few random members are drawn to."""
        w = random.normal(size=x.shape[1])
        if len(own) >= 2:
            some = x[random.choice(own, min(len(own), 256), replace=False)]
            a, b = some[0], some[1]
            for _ in range(4):
                near = ((some - a) ** 2).sum(1) <= ((some - b) ** 2).sum(1)
                if near.all() or not near.any():
                    break
                a, b = some[near].mean(0), some[~near].mean(0)
            if np.any(a != b):
                w = a - b
        return (w / np.linalg.norm(w)).astype(np.float32)

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        x = x / self.longest if self.longest else x
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))
        return np.c_[x, last].astype(np.float32)

    def cells(self, x: np.ndarray) -> np.ndarray:
        """For each vector its leaf in every tree, as tree * leaves + leaf."""
        x = self.lifted(x)
        out = np.empty((len(x), self.trees), np.int32)
        for t in range(self.trees):
            above, at = x @ self.normals[t].T > self.cuts[t], np.zeros(len(x), np.int64)
            for level in range(self.levels):
                at = 2 * at + above[np.arange(len(x)), (1 << level) - 1 + at]
            out[:, t] = t * self.leaves + at
        return out

    def search(self, x: np.ndarray):
        """For each query the leaves of all trees from one priority queue, nearest first.

        A leaf waits with the squared distances from the query to the cuts on
        whose other side it lies.
        """
        side = np.einsum("qd,tnd->qtn", self.lifted(x, query=True), self.normals, optimize=True) - self.cuts
        for margins in side:
            queue = [(0.0, t, 0, 0) for t in range(self.trees)]
            margins = margins.tolist()

            def leaves(queue=queue, margins=margins):
                while queue:
                    cost, t, level, k = heapq.heappop(queue)
                    while level < self.levels:
                        v = margins[t][(1 << level) - 1 + k]
                        near = 1 if v > 0 else 0
                        heapq.heappush(queue, (cost + v * v, t, level + 1, 2 * k + 1 - near))
                        k, level = 2 * k + near, level + 1
                    yield t * self.leaves + k

            yield leaves()

    def reached(self, x: np.ndarray):
        """For each query the leaves that hold its budget of rows."""
        for leaves in self.search(x):
            own, seen = [], 0
            for cell in leaves:
                if self.counts[cell]:
                    own.append(cell)
                    seen += self.counts[cell]
                    if seen >= self.budget:
                        break
            yield np.array(own, np.int32)

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """Blocks of each leaf's rows, and of its queries."""
        return np.maximum(1, -(-self.counts // BLOCK)), -(-self.visits // BLOCK)


def levels_of(rows: int) -> int:
    """The usual levels; fewer where leaves would hold too few rows, more, as far as the sample goes, where too many; one split at least."""
    fit = [math.log2(max(1, rows) / n) for n in LEAF]
    return max(1, min(LEVELS, math.floor(fit[0])), min(MOST, math.ceil(fit[1])))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def best(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the places and exact inner products of the k best rows of x; equal ones go by their ids."""
    out, n = [], min(k, x.shape[0])
    unit = SLACK * np.finfo(np.float64).eps * x.shape[1] * np.sqrt((x * x).sum(1).max(initial=0.0))
    for lo in range(0, len(q), 256):
        part = q[lo : lo + 256]
        scores = part @ x.T
        least = np.partition(scores, x.shape[0] - n, axis=1)[:, x.shape[0] - n] - unit * np.sqrt((part * part).sum(1))
        for i in range(len(part)):
            at = np.flatnonzero(scores[i] >= least[i])
            exact = (x[at] * part[i]).sum(1)
            order = np.lexsort((ids[at], -exact))[:k]
            out.append((at[order], exact[order]))
    return out


def nearest(vectors: DataFrame, *, k: int = 20, every: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", trees: int = TREES, levels: int | None = None, target: float = TARGET) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other vectors of every vector whose id is divisible by every.

    The trees, of as many levels as the rows ask for or as given, are fitted on a
    bounded sample; all vectors are indexed.  Per query
    the leaves of all trees are taken from one priority queue until they hold so
    many rows as, measured against brute force over all rows on a sample of
    queries, give the target recall, and k others, if there are so many, in any case.  All their rows are scored exactly, in
    double precision; ties go to the smaller id.

    Equal vectors are indexed once, with the k + 1 smallest ids, which is all
    that a result can hold of them.  A leaf's rows and queries meet in blocks of
    bounded size; a leaf's rows are copied once for each block of the queries
    that reach it, and not at all where none does.

    Vectors null, empty, zero, of another length than most (which have no inner
    product with the others), or with null or non-finite components take no
    part, nor do null ids; of several vectors with one id the smallest counts.
    An empty table gives no rows.  Other columns are ignored, whatever their
    names.
    """
    spark, schema = vectors.sparkSession, "query_id long, rank int, vec_id long, score double"
    base = stored(usable(vectors, vec_id, embedding), "vectors")
    lengths = base.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], schema)
    base = base.where(F.size("embedding") == lengths[0].d)
    same = Window.partitionBy("embedding")
    ranked = base.withColumn("nth", F.row_number().over(same.orderBy("vec_id"))).where(F.col("nth") <= k + 1)
    ranked = stored(ranked.withColumns({"rep": F.min("vec_id").over(same), "copies": F.max("nth").over(same)}), "ranked")
    reps = ranked.where("nth = 1").select("rep", "embedding")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    rows, longest = reps.agg(F.count("*"), F.max(norm)).first()

    share = lambda c, n, of: F.pmod(F.xxhash64(c), F.lit(1 << 30)) < int((1 << 30) * min(1.0, n / max(1, of)))
    sample = [r.embedding for r in reps.where(share("rep", SAMPLE, rows)).collect()]
    forest = Forest(np.array(sample, np.float64).reshape(-1, lengths[0].d), float(longest), levels_of(rows) if levels is None else levels, trees)
    held = handed_out(spark, forest)

    def count(batches):
        forest = taken_in(held)
        total = np.zeros(forest.trees * forest.leaves, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(forest.cells(_matrix(batch.column("embedding"))).ravel(), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["cell", "n"])

    for r in reps.select("embedding").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        forest.counts[r.cell] = r.n
    queries = base.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    asked = queries.count()
    least = trees * min(rows, k + 2)  # so many rows of all trees are k others at least, or all there are
    forest.budget = max(least, _budget(reps, queries.where(share("query_id", TUNE, asked)), forest, held, k, target))
    counted = handed_out(spark, forest)

    def visit(batches):
        forest = taken_in(counted)
        total = np.zeros(len(forest.counts), np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                for cells in forest.reached(_matrix(batch.column("q").slice(lo, 256))):
                    total[cells] += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["cell", "n"])

    for r in queries.select("q").mapInArrow(visit, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        forest.visits[r.cell] = r.n
    held = handed_out(spark, forest)

    def index(batches):
        forest = taken_in(held)
        of_rows, of_queries = forest.blocks()
        for batch in batches:
            if not batch.num_rows:
                continue
            cells, ids = forest.cells(_matrix(batch.column("embedding"))), batch.column("rep").to_numpy()
            for t in range(forest.trees):
                cell = cells[:, t]
                block = (ids % of_rows[cell]).astype(np.int32)
                for b in range(int(of_queries[cell].max())):
                    at = np.flatnonzero(of_queries[cell] > b)
                    yield pa.RecordBatch.from_arrays([pa.array(cell[at]), pa.array(block[at]), pa.array(np.full(len(at), b, np.int32)), *batch.select(["rep", "embedding"]).take(pa.array(at)).columns], names=["cell", "v", "b", "rep", "embedding"])

    def probe(batches):
        forest = taken_in(held)
        of_rows, of_queries = forest.blocks()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part, ids = batch.slice(lo, 256), batch.column("query_id").to_numpy()[lo : lo + 256]
                reached = [(i, cells, of_rows[cells]) for i, cells in enumerate(forest.reached(_matrix(part.column("q"))))]
                at = np.repeat([i for i, *_ in reached], [n.sum() for *_, n in reached])
                cells = np.concatenate([np.repeat(cells, n) for _, cells, n in reached])
                blocks = np.concatenate([np.arange(m) for *_, n in reached for m in n.tolist()])
                b = ids[at] // every % of_queries[cells]
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(blocks.astype(np.int32)), pa.array(b.astype(np.int32)), *part.select(["query_id", "q"]).take(pa.array(at)).columns], names=["cell", "v", "b", "query_id", "q"])

    kind = reps.schema["embedding"].dataType.simpleString()
    left = reps.mapInArrow(index, f"cell int, v int, b int, rep long, embedding {kind}")
    right = queries.mapInArrow(probe, f"cell int, v int, b int, query_id long, q {kind}")

    def meet(key: tuple, x: pa.Table, q: pa.Table) -> pa.Table:
        ids, asked, scores, names = x.column("rep").to_numpy(), [], [], []
        if x.num_rows and q.num_rows:
            found = best(_matrix(q.column("q").combine_chunks()), _matrix(x.column("embedding").combine_chunks()), ids, k + 1)
            for query, (at, score) in zip(q.column("query_id").to_pylist(), found, strict=True):
                asked.append(np.full(len(at), query))
                names.append(ids[at])
                scores.append(score)
        cols = [np.concatenate(c) if c else np.empty(0, t) for c, t in ((asked, np.int64), (names, np.int64), (scores, np.float64))]
        return pa.table([pa.array(c) for c in cols], names=["query_id", "rep", "score"])

    keys = ["cell", "v", "b"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, rep long, score double")
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "rep")
    found = found.groupBy("query_id", "rep").agg(F.max("score").alias("score")).withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    copies = ranked.where("copies > 1").select("rep", "vec_id")
    out = found.join(copies, "rep", "left").withColumn("vec_id", F.coalesce("vec_id", "rep")).where("vec_id <> query_id")
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def _budget(reps: DataFrame, queries: DataFrame, forest: Forest, held, k: int, target: float) -> int:
    """The rows that leaves must hold for the target recall: for each true neighbour, as brute force over all rows finds it, what stands before the first of its leaves in the queue."""
    asked = queries.collect()
    if not asked:
        return int(forest.counts.sum())
    q = np.array([r.q for r in asked], np.float64)

    def brute(batches):
        forest = taken_in(held)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("embedding"))
            found = best(q, x, batch.column("rep").to_numpy(), k + 1)
            at = np.concatenate([f[0] for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(q), dtype=np.int32), [len(f[0]) for f in found])), batch.column("rep").take(pa.array(at)), pa.array(np.concatenate([f[1] for f in found])), pa.array(forest.cells(x[at]).tolist(), pa.list_(pa.int32()))], names=["i", "rep", "score", "cells"])

    best_first = Window.partitionBy("i").orderBy(F.desc("score"), "rep")
    true = reps.mapInArrow(brute, "i int, rep long, score double, cells array<int>").withColumn("nth", F.row_number().over(best_first)).where(F.col("nth") <= k + 1)
    wanted: dict[int, list] = {}
    for r in true.collect():
        if r.rep != asked[r.i].query_id:
            wanted.setdefault(r.i, []).append(r.cells)
    needs = []
    for i, leaves in enumerate(forest.search(q)):
        before, seen = {}, 0
        for cell in leaves:
            before[cell] = seen
            seen += int(forest.counts[cell])
        needs += [min(before[c] for c in cells) + 1 for cells in wanted.get(i, ())]
    return int(np.quantile(needs, target, method="higher")) if needs else int(forest.counts.sum())


def op1_rp_forest(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector, among all others."""
    return nearest(read_table(spark, sf_dir, "embeddings"))
