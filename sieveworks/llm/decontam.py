"""Benchmark decontamination by spaced seeds."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, handed_out, plain_words, read_table, small, taken_in, windowed

#: Each mask hashes the positions marked 1 and ignores the others, so that a substituted word between them does no harm.
#: No row of 13 words or more with three equal words of four, and no stretch of 13 equal words that scores best, avoids all of MASKS;
#: SHORT_MASKS do the same from 8 words on, with fewer words a seed.
MASKS = ("111011", "1100001011", "111100001", "11111")
SHORT_MASKS, SHORT_UNDER = ("11101", "100111", "1101001"), 13

#: Bytes of benchmark text that one broadcast index may be built from; a larger benchmark is searched in several such blocks.
BLOCK_BYTES = 8 << 20

SCHEMA = "doc_id long, item_id long, matched int, overlap int, item_tokens int, doc_start int, doc_end int"


def _offsets(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


class SeedIndex:
    """Seeds of a block of benchmark items, sorted by hash, and the items' word hashes."""

    def __init__(self, items: list[tuple[int, str]], min_item_tokens: int):
        hashes = WordHashes()
        self.ids, self.words, short = [], [], {}
        for item_id, text in items:
            h = hashes.of(plain_words(text))
            if len(h) >= min_item_tokens:
                self.ids.append(item_id)
                self.words.append(h)
            elif len(h):
                short.setdefault(len(h), []).append((item_id, h))
        self.seeds = []
        for masks, owners in ((MASKS, [k for k, h in enumerate(self.words) if len(h) >= SHORT_UNDER]), (SHORT_MASKS, [k for k, h in enumerate(self.words) if len(h) < SHORT_UNDER])):
            if owners:
                self.seeds += [(_offsets(m), *_sorted_seeds([windowed(self.words[k], _offsets(m)) for k in owners], owners)) for m in masks]
        #: For each length of shorter items their ids and words, and the hashes of the items as wholes.
        self.short = [(own, n, *_sorted_seeds([windowed(h, range(n)) for _, h in own], range(len(own)))[:2]) for n, own in sorted(short.items())]

    def hits(self, h: np.ndarray) -> np.ndarray:
        """item << 32 | diagonal (from 2^31) of every seed that the document shares with an item, each once."""
        found = [np.empty(0, np.int64)]
        for offsets, at, owner, pos in self.seeds:
            place, seed = _shared(windowed(h, offsets), at)
            counts = np.searchsorted(at, at[seed], "right") - seed
            for lo, hi in _chunks(counts):
                n = counts[lo:hi]
                k = np.repeat(seed[lo:hi] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                found = [np.unique(np.concatenate([*found, owner[k] << 32 | np.repeat(place[lo:hi], n) - pos[k] + (1 << 31)]))]
        return found[0]

    def overlaps(self, h: np.ndarray, min_match: int, min_cover: float) -> list[tuple]:
        """The best verified overlap with each item: (item_id, matched, overlap, item tokens, start, end)."""
        out, hits = [], self.hits(h)
        items, starts = np.unique(hits >> 32, return_index=True)
        for item, own in zip(items.tolist(), np.split(hits, starts[1:]) if len(items) else (), strict=True):
            words = self.words[item]
            cover = math.ceil(min_cover * len(words))
            matched, start, end = aligned(h, words, (own & (1 << 32) - 1) - (1 << 31), min(min_match, cover), cover)
            if len(matched):
                k = np.lexsort((start, -matched))[0]
                out.append((self.ids[item], int(matched[k]), int(end[k] - start[k]), len(words), int(start[k]), int(end[k])))
        for own, n, at, owner in self.short:
            place, seed = _shared(windowed(h, range(n)), at)
            first: dict[int, int] = {}
            for k, i in dict(zip(seed[::-1].tolist(), place[::-1].tolist(), strict=True)).items():
                for j in range(k, int(np.searchsorted(at, at[k], "right"))):
                    if np.array_equal(own[owner[j]][1], h[i : i + n]):
                        first[int(owner[j])] = i
            out += [(own[o][0], n, n, n, i, i + n) for o, i in sorted(first.items())]
        return out


def _sorted_seeds(parts: list[np.ndarray], owners) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes in order, whose they are and where they stand."""
    at = np.concatenate([*parts, np.empty(0, np.uint64)])
    owner = np.repeat(np.array([*owners], np.int64), [len(p) for p in parts]) if parts else np.empty(0, np.int64)
    pos = np.concatenate([*(np.arange(len(p)) for p in parts), np.empty(0, np.int64)])
    order = np.argsort(at, kind="stable")
    return at[order], owner[order], pos[order]


def _shared(own: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of own whose value stands in the sorted at, and its first place there."""
    if not len(own) or not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low = np.searchsorted(at, own)
    place = np.flatnonzero(at[np.minimum(low, len(at) - 1)] == own)
    return place, low[place]


def _chunks(counts: np.ndarray, limit: int = 1 << 20):
    """Ranges whose counts add up to limit at most, or hold one entry."""
    ends, lo = np.cumsum(counts), 0
    while lo < len(counts):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + limit, "right")))
        yield lo, hi
        lo = hi


def aligned(h: np.ndarray, item: np.ndarray, diagonals: np.ndarray, need: int, cover: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(matched, start, end) in the document of the overlaps on the diagonals.

    A diagonal's overlap is the stretch that scores highest with 1 for an equal
    word and -2 for a substituted one, if it holds need equal words; else all
    from its first to its last equal word, if cover of them are equal.
    """
    out, n = [], len(item)
    for lo in range(0, len(diagonals), max(1, (1 << 18) // n)):
        d = diagonals[lo : lo + max(1, (1 << 18) // n)]
        at = d[:, None] + np.arange(n)
        inside = (at >= 0) & (at < len(h))
        same = inside & (h[np.clip(at, 0, len(h) - 1)] == item)
        row, equal = np.arange(len(d)), np.concatenate([np.zeros((len(d), 1), np.int64), np.cumsum(same, axis=1)], axis=1)
        total = np.concatenate([np.zeros((len(d), 1), np.int64), np.cumsum(np.where(inside, np.where(same, 1, -2), 0), axis=1)], axis=1)
        least = np.minimum.accumulate(total, axis=1)
        last = np.argmax(total - least, axis=1)
        upto = np.arange(n + 1) <= last[:, None]
        first = n - np.argmax((upto & (total == least[row, last][:, None]))[:, ::-1], axis=1)
        matched = equal[row, last] - equal[row, first]
        whole = (matched < need) & (equal[:, n] >= cover)
        matched = np.where(whole, equal[:, n], matched)
        first = np.where(whole, np.argmax(same, axis=1), first)
        last = np.where(whole, n - np.argmax(same[:, ::-1], axis=1), last)
        good = matched >= need
        out.append((matched[good], (d + first)[good], (d + last)[good]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str, min_item_tokens: int, block_bytes: int = BLOCK_BYTES):
    """Indexes of the benchmark, each from a bounded number of bytes."""
    items = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where("t is not null")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(2 * size / block_bytes))
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        yield SeedIndex(sorted(((r.i, r.t) for r in own.collect()), key=lambda x: (x[0] is None, x[0] or 0)), min_item_tokens)


def overlaps(documents: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", min_match: int = 13, min_cover: float = 0.75, min_item_tokens: int = 8) -> DataFrame:
    """One row for each document and benchmark item that overlap.

    Words are lower-cased and lose ASCII punctuation.  Spaced seeds of the items
    are looked up for every position of every whole document; around each hit
    the whole diagonal is compared, and the stretch that scores best (1 for an
    equal word, -2 for a substituted one) must hold min_match equal words, or
    min_cover of a shorter item; or the whole diagonal must hold min_cover of the
    item.  With the given min_match and min_cover, or higher ones, every such
    overlap holds a seed, wherever its substituted words stand; with lower ones
    some have none and are missed.  Items under min_item_tokens words are too short
    for seeds; they are found wherever all their words stand in a row.

    The benchmark is the query set: it is indexed in blocks of bounded size, and
    every document is compared with every block in the map tasks, without a
    shuffle.  The work for a document grows with its words, times an item's where
    both repeat one seed throughout.

    Null or wordless texts on either side overlap with nothing, and so do empty
    tables; rows with equal ids are separate documents or items; null ids stay
    null; other columns are ignored, whatever their names.
    """
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = None
    for index in benchmark_blocks(benchmark, item_id, item_text, min_item_tokens):
        held = handed_out(docs.sparkSession, index)

        def scan(batches, held=held):
            index, hashes = taken_in(held), WordHashes()
            for batch in small(batches, 1):
                rows = []
                for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    rows += [(d, *x) for x in index.overlaps(hashes.of(plain_words(t)), min_match, min_cover)]
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 2 else pa.int32()) for k, c in enumerate(cols)], names=["doc_id", "item_id", "matched", "overlap", "item_tokens", "doc_start", "doc_end"])

        part = docs.mapInArrow(scan, SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out


def uncontaminated(documents: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", min_match: int = 13, min_cover: float = 0.75, min_item_tokens: int = 8) -> DataFrame:
    """The rows of documents, all columns, that overlap with no benchmark item; see overlaps()."""
    schema, at = documents.schema, documents.columns.index(text)
    for index in benchmark_blocks(benchmark, item_id, item_text, min_item_tokens):
        held = handed_out(documents.sparkSession, index)

        def keep(batches, held=held):
            index, hashes = taken_in(held), WordHashes()
            for batch in small(batches, at):
                clean = [not index.overlaps(hashes.of(plain_words(t)), min_match, min_cover) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        documents = documents.mapInArrow(keep, schema)
    return documents


def op5_spaced_seeds(spark, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that overlap."""
    return overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
