"""Periodic runs of words in a text, from Lyndon arrays in both orders of the alphabet.

A run is a stretch that repeats with a smallest period, at least twice, and
can't be made longer.  By the runs theorem its period is the length of the
longest Lyndon word at some place in it, in the order of the words or in the
inverse order; so the next smaller suffix of every place, in both orders, names
all candidates, and two extensions of equal words around a candidate decide.

Words are numbered in their own order and only ever compared: there is no
suffix structure and no fingerprint.  The texts of a unit stand in one array,
with an end mark between them that is smaller than any word, and are worked on
together; a place whose next smaller suffix waits for another's is taken up
when that one is known (there is one such place at most), so every comparison
is made once.  A stretch of equal words at a distance is measured once and
serves all later comparisons at this distance within it, in both orders.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import PART_BYTES, free, give_back, handed_out, read_table, taken_in, units

#: Words of a run at least; it also repeats twice.
LEAST = 12

#: Places that are compared one by one, and equal words that are compared for all places at once before a stretch is measured.
FEW, SHORT = 24, 16

RUN = "struct<start:bigint,length:bigint,period:bigint>"


class Stretches:
    """Measured stretches [s, e) with w[x] == w[x + d] for all x in them, by distance d."""

    def __init__(self, w: np.ndarray):
        self.w, self.by = w, {}

    def _ahead(self, a: int, b: int) -> int:
        w, step, n = self.w, 32, 0
        while True:
            differ = w[a + n : a + n + step][: len(w) - b - n] != w[b + n : b + n + step]
            k = int(differ.argmax()) if len(differ) else 0
            if not len(differ) or differ[k]:
                return n + k
            n += len(differ)
            step = min(2 * step, 1 << 20)

    def _behind(self, a: int, b: int) -> int:
        """Equal words before a and b; the array begins with an end mark, so the search stops there."""
        w, step, n = self.w, 32, 0
        while True:
            size = min(step, a - n)
            if size <= 0:
                return n
            differ = (w[a - n - size : a - n] != w[b - n - size : b - n])[::-1]
            k = int(differ.argmax())
            if differ[k]:
                return n + k
            n += size
            step = min(2 * step, 1 << 20)

    def at(self, i: int, d: int) -> tuple[int, int]:
        """The whole stretch around i, whose word equals the one d further on."""
        starts, ends = self.by.setdefault(d, ([], []))
        k = bisect_right(starts, i)
        if k and i < ends[k - 1]:
            return starts[k - 1], ends[k - 1]
        s, e = i - self._behind(i, i + d), i + self._ahead(i, i + d)
        starts.insert(k, s)
        ends.insert(k, e)
        return s, e


def _smaller_after_tie(k: np.ndarray, i: np.ndarray, c: np.ndarray, held: Stretches) -> np.ndarray:
    """Whether the suffix at c is smaller than that at i, where their first words are equal."""
    out, left = np.zeros(len(i), bool), np.arange(len(i))
    for o in range(1, SHORT):
        a, b = k[i[left] + o], k[c[left] + o]
        out[left[b < a]] = True
        left = left[a == b]
        if not len(left):
            return out
    for n in left.tolist():
        x, d = int(i[n]), int(c[n] - i[n])
        e = held.at(x, d)[1]
        out[n] = k[e + d] < k[e]
    return out


def next_smaller(k: np.ndarray, held: Stretches) -> np.ndarray:
    """The Lyndon array, as the next smaller suffix of each word; k holds ranks, and -1 first and after each text.  End marks get 0."""
    found, waiter = np.zeros(len(k), np.int64), np.zeros(len(k), np.int64)
    i = np.flatnonzero(k >= 0)
    c = i + 1
    while len(i):
        if len(i) <= FEW:
            more: list[tuple[int, int]] = []
            for x, y in zip(i.tolist(), c.tolist(), strict=True):
                a, b = k[x], k[y]
                if a == b:
                    e = held.at(x, y - x)[1]
                    a, b = k[e], k[e + y - x]
                if b < a:
                    found[x] = y
                    if z := int(waiter[x]):
                        more.append((z, y))
                elif to := int(found[y]):
                    more.append((x, to))
                else:
                    waiter[y] = x
            i, c = (np.array([m[n] for m in more], np.int64) for n in (0, 1))
            continue
        a, b = k[i], k[c]
        less, tie = b < a, np.flatnonzero(a == b)
        if len(tie):
            less[tie] = _smaller_after_tie(k, i[tie], c[tie], held)
        done, at = i[less], c[less]
        found[done] = at
        woken = waiter[done]
        waits = woken > 0
        i, c = i[~less], c[~less]
        to = found[c]
        waiter[c[to == 0]] = i[to == 0]
        i, c = np.concatenate([woken[waits], i[to > 0]]), np.concatenate([at[waits], to[to > 0]])
    return found


def runs_of(w: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, length, period) of all runs of least words and two periods, by start, then period; w as k in next_smaller()."""
    held, out, words = Stretches(w), set(), np.flatnonzero(w >= 0)
    ends = np.flatnonzero(w < 0)
    if not len(words):
        return np.empty((0, 3), np.int64)
    sides = min(3, -(-(least - least // 2) // 2))  # of so many words at least one extension is, see below
    padded = np.concatenate([np.full(3, -2, w.dtype), w, np.full(3, -3, w.dtype)])
    for k in (w, np.where(w >= 0, w.max() - w, w)):
        j = next_smaller(k, held)[words]
        p = j - words
        # the extensions have max(p, least - p) words in all, so one has half of that
        after, before = np.ones(len(words), bool), np.ones(len(words), bool)
        for o in range(sides):
            after &= padded[words + 3 + o] == padded[j + 3 + o]
            before &= padded[words + 2 - o] == padded[j + 2 - o]
        for mask, back in ((after, 0), (before & ~after, 1)):
            x, d = words[mask] - back, p[mask]
            order = np.lexsort((x, d))
            x, d = x[order], d[order]
            bounds = np.flatnonzero(np.diff(d, prepend=-1, append=-1))
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                own, q = x[lo:hi], int(d[lo])
                n = 0
                while n < len(own):
                    s, e = held.at(int(own[n]), q)
                    if e - s >= max(q, least - q):
                        out.add((s, e - s + q, q))
                    n = int(np.searchsorted(own, e))
    found = np.array(sorted((s, q, n) for s, n, q in out), np.int64).reshape(-1, 3)[:, [0, 2, 1]]
    first = ends[np.searchsorted(ends, found[:, 0]) - 1] + 1  # of the run's text
    return np.column_stack([found, first])


def _ranked(texts: list[list[bytes]]) -> np.ndarray:
    """The words' ranks in byte order, an end mark first and after each text."""
    rank = {x: n for n, x in enumerate(sorted(set().union(*texts)))}
    w = np.full(1 + sum(len(t) + 1 for t in texts), -1, np.int32)
    at = 1
    for t in texts:
        w[at : at + len(t)] = np.fromiter(map(rank.__getitem__, t), np.int32, len(t))
        at += len(t) + 1
    return w


class _Finder:
    def __init__(self, at: int, least: int):
        self.at, self.least = at, least

    def of(self, texts: list[list[bytes]]) -> Iterator[tuple[np.ndarray, bytes]]:
        """(runs, the words that are left) of each text."""
        found = runs_of(_ranked(texts), self.least)
        first = 1
        lows = np.cumsum([first, *(len(t) + 1 for t in texts)])
        cuts = np.searchsorted(found[:, 0], lows)
        for t, low, a, b in zip(texts, lows.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=False):
            own = found[a:b, :3] - [low, 0, 0]
            if not len(own):
                yield own, b" ".join(t)
                continue
            edge = np.zeros(len(t) + 1, np.int64)
            np.add.at(edge, own[:, 0] + own[:, 2], 1)
            np.add.at(edge, own[:, 0] + own[:, 1], -1)
            yield own, b" ".join(compress(t, (np.cumsum(edge[:-1]) == 0).tolist()))

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for part in units(batches, self.at, limit=PART_BYTES):
            texts = [(x or b"").split() for x in part.column(self.at).cast(pa.binary()).to_pylist()]
            every = list(self.of(texts))
            flat = np.concatenate([r for r, _ in every])
            offsets = np.cumsum([0, *(len(r) for r, _ in every)])
            runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])).cast(kind)
            text = pa.array([x for _, x in every], pa.binary()).cast(pa.string())
            columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in part.columns]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([len(t) for t in texts], pa.int64()), runs, text], names=[*part.schema.names, "n", "r", "c"])
        give_back()


def periodic_runs(documents: DataFrame, *, text: str = "text", least: int = LEAST, n_words: str = "n_words", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """The rows with n_words, runs (start, length, period, by start, then period) and collapsed.

    Words are what stands between ASCII white space, numbered from 0.  A run has
    least words and twice its period at least; collapsed holds the words, one
    space between them, without those that stand in a run after its first
    period.  A null or empty text, or one of white space, has no words, no runs
    and an empty collapsed text.  A text is worked on whole, however long, in
    memory that grows with the longest text of a task; rows are independent, so
    repeated rows have equal results and no key gathers anything.  An empty table
    stays empty.  All other columns are kept; one with the name of a new column
    gives way to it.
    """
    spark = documents.sparkSession
    kept = documents.select([documents[c] for c in documents.columns if c.lower() not in {n_words.lower(), runs.lower(), collapsed.lower()}])
    finder = handed_out(spark, _Finder(kept.columns.index(text), least))
    names = free(kept.columns, "n", "r", "c")
    kinds = [T.LongType(), T._parse_datatype_string(f"array<{RUN}>"), T.StringType()]
    schema = T.StructType([*kept.schema.fields, *(T.StructField(n, k) for n, k in zip(names, kinds, strict=True))])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in taken_in(finder)(batches):
            yield batch.rename_columns([*batch.schema.names[:-3], *names])

    return kept.mapInArrow(find, schema).withColumnsRenamed(dict(zip(names, (n_words, runs, collapsed), strict=True)))


def with_periods(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with a tenth of the texts made periodic from some word on, as the query's contract says; a null id changes nothing."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g, words = F.floor(h / 10), F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    n = F.size(words)
    place, own, own_n, a_name, p_name, g_name = free(documents.columns, "h", "w", "n", "a", "p", "g")
    chosen = documents.withColumn(place, F.coalesce(h % 10 == 0, F.lit(False))).withColumn(own, F.when(F.col(place), words)).withColumns({own_n: F.size(own), g_name: g})
    chosen = chosen.withColumn(place, F.col(place) & (F.col(own_n) > 0)).withColumn(a_name, F.when(F.col(place), F.col(g_name) % F.col(own_n)).cast("int"))
    chosen = chosen.withColumn(p_name, (1 + F.floor((F.col(own_n) - F.col(a_name)) / (3 + F.col(g_name) % 8))).cast("int"))
    rest = F.col(own_n) - F.col(a_name)
    again = F.slice(F.flatten(F.array_repeat(F.slice(own, F.col(a_name) + 1, F.col(p_name)), F.ceil(rest / F.col(p_name)).cast("int"))), F.lit(1), rest)
    made = F.array_join(F.concat(F.slice(own, F.lit(1), F.col(a_name)), again), " ")
    return chosen.withColumn(text, F.when(F.col(place), made).otherwise(F.col(text))).select(documents.columns)


def op13_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs of words as counts, the longest run and digests; documents prepared by with_periods()."""
    docs = with_periods(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs(docs).select("doc_id", "runs", "collapsed")
    longest = F.reduce("runs", F.expr("cast(null as " + RUN + ")"), lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best))
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    listed = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("top", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.floor(F.col("top.length") * 1000 / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
