"""Token ids of documents in ORC files, in the order of the documents' ids.

Texts are ranged by id and sorted, one range a file; each task then encodes its
range as it passes and counts the ids before each document, so ids are never
shuffled.  The ids are a list of integers, which ORC stores run-length encoded,
in stripes with row indexes; ``doc_id`` also has Bloom filters.  A document of
many ids stands in several rows of bounded size.  Stripes are read in parallel;
what asks for some documents reads only the row groups whose index and filter
may hold them, and what asks for a span of ids only the shards that it touches.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import PART_BYTES, arrow_batches, give_back, handed_out, read_table, shared_path, stored, taken_in, units

#: The id that ends a document, ids of a row at most, and rows between two entries of an index.
END, ROW_IDS, STRIDE = 2, 1 << 18, 1000

#: Characters that are encoded at once, about; a longer text is encoded in segments between cuts.
SEGMENT = 8 << 20

# Stops, which the pattern parts from letters.
STOPS = string.punctuation

#: What a space and a line feed become at the start of a token in the model file.
SPACE, LINE_FEED = "Ġ", "Ċ"

#: New pieces in a text that goes to the library, and distinct pieces whose ids a worker keeps.
LINES, CACHE_PIECES = 64, 800_000

ROWS = "shard int, doc_no bigint, doc_id bigint, piece int, last boolean, n_ids int, before bigint, ids array<int>"

_CUT = re.compile(r"(?<=\S) ")
_CUTS = re.compile(r"(?<=\S) (?!\n)|(?<=\S)(?=\n)")
_BLANK = r"\x00-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_ENDS_IN_SPACE = f"(?:^|[{_BLANK}])$"
_PLAIN = f"^\\n?[^{_BLANK}]+$"
_CLOSED = r"[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}][[:punct:]]+$"
_END = np.array([END], np.int32)


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int32)


def _spans(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every span, one span after another."""
    ends = np.cumsum(count)
    return np.repeat(start - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


class _Encoder:
    """Ids of whole texts by the tokenizers library, each distinct piece between cuts encoded once.

    The tokenizer's pattern never matches across a space or line feed that
    follows another character than white space, so a text cut before these has
    the same ids in pieces.  A piece begins with its line feed or lacks its
    space.  New pieces go to the library many in a text; the ids of each begin
    with the one token that has its space or line feed.  Pieces that hold other
    white space go alone, and so does the first of a text, which has neither
    before it.  Ids are gathered for all pieces of a unit at once.
    """

    def __init__(self, model: str):
        self.model, self.made = model, None
        self.forget()

    def __getstate__(self):
        return {"model": self.model}

    def __setstate__(self, state):
        self.__init__(state["model"])

    def forget(self) -> None:
        self.known, self.values, self.starts = pa.array([], pa.large_string()), np.empty(0, np.int32), np.zeros(1, np.int64)
        self.used = np.empty(0, np.int32)

    def shrink(self) -> None:
        """Keeps the half of the pieces that were used most."""
        kept = np.sort(np.argpartition(-self.used, CACHE_PIECES // 2)[: CACHE_PIECES // 2])
        chosen = np.zeros(len(self.used), bool)
        chosen[kept] = True
        count, self.known = np.diff(self.starts), self.known.take(pa.array(kept))
        self.values = self.values[np.repeat(chosen, count)]
        self.starts, self.used = np.concatenate([[0], np.cumsum(count[chosen])]), self.used[chosen] // 2

    def tokenizer(self):
        if self.made is None:
            from tokenizers import Tokenizer

            self.made = Tokenizer.from_str(self.model)
            self.made.encode_special_tokens = True  # their names in a text are ordinary text
            self.spaced = np.array([(self.made.id_to_token(n) or "").startswith((SPACE, LINE_FEED)) for n in range(self.made.get_vocab_size())])
        return self.made

    def pieces(self, texts: list[str]) -> tuple[list[str], np.ndarray, pa.DictionaryArray]:
        """Each text cut before spaces, which the pieces then lack, and before line feeds, which they keep: the first pieces, and of all others how many a text has and which."""
        marked = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n")
        marked = pc.replace_substring(marked, "\r \n", "\r\n")
        while pc.any(pc.match_substring(marked, "\n \n")).as_py():  # between two line feeds is no cut
            marked = pc.replace_substring(marked, "\n \n", "\n\n")
        cut = pc.split_pattern(marked, " ").cast(pa.large_list(pa.large_string()))
        heads, sizes, coded = self.parted(cut)
        odd = self.odd(heads, sizes, coded)
        if len(odd):
            at = np.arange(len(texts))
            at[odd] = len(texts) + np.arange(len(odd))
            own = pa.array([_CUTS.split(texts[n]) for n in odd.tolist()], cut.type)
            heads, sizes, coded = self.parted(pa.concat_arrays([cut, own]).take(pa.array(at)))
        return heads, sizes, coded

    @staticmethod
    def odd(heads: list[str], sizes: np.ndarray, coded: pa.DictionaryArray) -> np.ndarray:
        """The texts with white space before some cut."""
        found = (sizes > 0) & np.fromiter((x[-1:].isspace() for x in heads), bool, len(heads))
        blank = pc.match_substring_regex(coded.dictionary, _ENDS_IN_SPACE).to_numpy(zero_copy_only=False)
        if blank.any():
            ends = np.cumsum(sizes)
            at = np.flatnonzero(blank[coded.indices.to_numpy()])
            owner = np.searchsorted(ends, at, "right")
            found[owner[at < ends[owner] - 1]] = True  # nothing is cut after the last piece
        return np.flatnonzero(found)

    @staticmethod
    def parted(cut: pa.LargeListArray) -> tuple[list[str], np.ndarray, pa.DictionaryArray]:
        bounds = cut.offsets.to_numpy()
        flat, first = cut.values[bounds[0] : bounds[-1]], bounds[:-1] - bounds[0]
        rest = np.ones(len(flat), bool)
        rest[first] = False
        return flat.take(pa.array(first)).to_pylist(), np.diff(bounds) - 1, flat.filter(pa.array(rest)).dictionary_encode()

    def encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer().encode_batch_fast(texts, add_special_tokens=False)]

    def numbered(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """The number of each of these distinct pieces; new ones are learnt, those that end in stops after a letter from the piece before the stops."""
        closed = pc.match_substring_regex(pieces, _CLOSED)
        bases = pc.utf8_rtrim(pieces.filter(closed), characters=STOPS)
        found = pc.fill_null(pc.index_in(pa.concat_arrays([pieces, bases]), self.known), -1).to_numpy().astype(np.int64)
        number, base = found[: len(pieces)], found[len(pieces) :]
        lacking = number < 0
        if not lacking.any():
            return number
        new, apart, first = pieces.filter(pa.array(lacking)), closed.to_numpy(zero_copy_only=False), len(self.known)
        number[lacking] = first + np.arange(len(new))
        bases, base, apart = bases.filter(pa.array(lacking[apart])), base[lacking[apart]], apart[lacking]
        stops = [x[len(b) :] for x, b in zip(new.filter(pa.array(apart)).to_pylist(), bases.to_pylist(), strict=True)]
        sought = base < 0
        unknown = bases.filter(pa.array(sought))
        more = pc.unique(unknown.filter(pc.invert(pc.is_in(unknown, new))))
        new = pa.concat_arrays([new, more])
        base[sought] = first + pc.index_in(unknown, new).to_numpy()
        self.learn(new, np.concatenate([apart, np.zeros(len(more), bool)]), base, stops)
        return number

    def learn(self, new: pa.LargeStringArray, apart: np.ndarray, base: np.ndarray, stops: list[str]) -> None:
        """Appends the ids of new pieces; those set apart have the ids of a base, which is no such piece, and of stops."""
        self.tokenizer()
        own = new.filter(pa.array(~apart))
        plain = pc.match_substring_regex(own, _PLAIN)
        own = pc.binary_join_element_wise(pc.if_else(pc.starts_with(own, "\n"), pa.scalar("", own.type), pa.scalar(" ", own.type)), own, pa.scalar("", own.type))
        lines = own.filter(plain)
        lines = pa.LargeListArray.from_arrays(pa.array([*range(0, len(lines), LINES), len(lines)], pa.int64()), lines)
        joined = _flat(self.encoded(pc.binary_join(lines, pa.scalar("", own.type)).to_pylist()))
        other = self.encoded(own.filter(pc.invert(plain)).to_pylist())
        plain = plain.to_numpy(zero_copy_only=False)
        counts = np.empty(len(own), np.int64)
        counts[plain] = np.diff(np.flatnonzero(self.spaced[joined]), append=len(joined))
        counts[~plain] = [len(x) for x in other]
        found = np.empty(int(counts.sum()), np.int32)
        mask = np.repeat(plain, counts)
        found[mask], found[~mask] = joined, _flat(other)
        distinct = list(dict.fromkeys(stops))
        ends = dict(zip(distinct, self.encoded(distinct), strict=True))
        tails = [ends[x] for x in stops]
        sizes, length = np.empty(len(new), np.int64), np.fromiter(map(len, tails), np.int64, len(tails))
        sizes[~apart] = counts
        sizes[apart] = np.concatenate([np.diff(self.starts), sizes])[base] + length
        into = len(self.known) + np.flatnonzero(apart)
        starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        values = np.empty(int(starts[-1]), np.int32)
        values[: len(self.values)] = self.values
        kept = np.repeat(~apart, sizes)
        values[len(self.values) :][kept] = found
        into, room = starts[into], starts[base + 1] - starts[base]
        values[_spans(into, room)] = values[_spans(starts[base], room)]
        values[_spans(into + room, length)] = _flat(tails)
        self.known, self.starts, self.values = pa.concat_arrays([self.known, new]), starts, values

    def segments(self, texts: list[str]) -> Iterator[tuple[list[str], list[int]]]:
        """The texts in lists of about SEGMENT characters, and which text each comes from; a longer text in segments."""
        held, owner, size = [], [], 0
        for n, t in enumerate(texts):
            lo = 0
            while True:
                cut = _CUT.search(t, lo + SEGMENT) if len(t) - lo > SEGMENT else None
                hi = cut.start() if cut else len(t)
                held.append(t[lo:hi] if lo or cut else t)
                owner.append(n)
                size += hi - lo
                lo = hi
                if size >= SEGMENT:
                    yield held, owner
                    held, owner, size = [], [], 0
                if not cut:
                    break
        if held:
            yield held, owner

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, END included."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for held, owner in self.segments(texts):
            if len(self.known) > CACHE_PIECES:
                self.shrink()
            first, sizes, coded = self.pieces(held)
            heads = self.encoded(first)  # without a space before
            piece = self.numbered(coded.dictionary)[coded.indices.to_numpy()]
            now = np.bincount(piece, minlength=len(self.known)).astype(np.int32)
            now[: len(self.used)] += self.used
            self.used = now
            start = self.starts[piece]
            count = self.starts[piece + 1] - start
            ends = np.concatenate([[0], np.cumsum(count)])
            ids = self.values[_spans(start, count)]
            places = ends[np.cumsum(sizes)].tolist()
            for n, head, (lo, hi) in zip(owner, heads, pairwise([0, *places]), strict=True):
                out[n] += [np.array(head, np.int32), ids[lo:hi]]
        return [np.concatenate([*parts, _END]) for parts in out]


class _Writer:
    """Rows of ROWS from (doc_id, text) in order."""

    def __init__(self, encoder: _Encoder, row_ids: int):
        self.encoder, self.row_ids = encoder, row_ids

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a core a task
        shard, before, doc_no = TaskContext.get().partitionId(), 0, 0
        for batch in units(batches, 1, limit=SEGMENT):
            found = self.encoder.ids([t or "" for t in batch.column(1).to_pylist()])
            counts = np.array([len(f) for f in found], np.int64)
            parts = -(-counts // self.row_ids)
            row = np.repeat(np.arange(len(found)), parts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            n = np.minimum(self.row_ids, counts[row] - piece * self.row_ids)
            starts = before + np.cumsum(n) - n
            values, rows = np.concatenate(found), len(row)
            offsets = np.concatenate([[0], np.cumsum(n)])
            doc_ids = batch.column(0).combine_chunks().take(pa.array(row))
            columns = [pa.array(np.full(rows, shard, np.int32)), pa.array(doc_no + row), doc_ids, pa.array(piece.astype(np.int32)), pa.array(piece == parts[row] - 1), pa.array(n.astype(np.int32)), pa.array(starts)]
            lo = 0
            while lo < rows:  # batches of bounded ids
                hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + 4 * self.row_ids, "right")) - 1)
                ids = pa.ListArray.from_arrays(pa.array((offsets[lo : hi + 1] - offsets[lo]).astype(np.int32)), pa.array(values[offsets[lo] : offsets[hi]]))
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in columns), ids], names=["shard", "doc_no", "doc_id", "piece", "last", "n_ids", "before", "ids"])
                lo = hi
            before, doc_no = before + int(counts.sum()), doc_no + len(found)
        give_back()


def write_tokens(documents: DataFrame, path: str, model_path: str, *, doc_id: str = "doc_id", text: str = "text", shards: int | None = None, row_ids: int = ROW_IDS, stride: int = STRIDE, stripe_bytes: int = 16 << 20) -> str:
    """Writes the documents' token ids under path, which must be new, and returns it.

    The order is that of doc_id, nulls first; rows with the same id follow each
    other by a hash of their text, so equal rows can't be told apart and the
    files' content does not depend on the input's partitions.  A null or empty
    text has END alone.  Of other columns nothing is kept; an empty table gives
    files without rows.  A text is encoded whole; its ids are cut into rows of
    row_ids only in storage.
    """
    spark = documents.sparkSession
    with open(model_path, encoding="utf-8") as f:
        writer = handed_out(spark, _Writer(_Encoder(f.read()), row_ids))
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"), F.monotonically_increasing_id().alias("tie"))
    shards = shards or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.repartitionByRange(shards, "doc_id", "h", "tie")  # the last only parts equal rows, which may be many
    ordered = ranged.sortWithinPartitions("doc_id", "h").select("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not hasattr(writer, "made"):  # a worker has one broadcast object for all its tasks, and so one encoder
            writer.made = taken_in(writer)
        return writer.made(batches)

    with arrow_batches(spark, PART_BYTES):
        out = ordered.mapInArrow(encode, ROWS).write
        out.option("orc.bloom.filter.columns", "doc_id").option("orc.row.index.stride", stride).option("orc.stripe.size", stripe_bytes).option("orc.create.index", "true").option("orc.rows.between.memory.checks", "64").option("compression", "lz4").orc(path)
    return path


def read_tokens(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The rows of ROWS, or some columns; filters on doc_id reach the files' indexes and Bloom filters."""
    rows = spark.read.schema(ROWS).orc(path)
    return rows.select(*columns) if columns else rows


def shard_table(spark: SparkSession, path: str) -> DataFrame:
    """(shard, documents, n_tokens, start): one row for each file that has rows; the ids themselves are not read."""
    rows = read_tokens(spark, path, "shard", "doc_no", "n_ids")
    sums = rows.groupBy("shard").agg(F.count_distinct("doc_no").alias("documents"), F.sum("n_ids").alias("n_tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    return sums.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def located(spark: SparkSession, path: str) -> DataFrame:
    """The rows with start, the ids of all rows before."""
    starts = shard_table(spark, path).select("shard", F.col("start").alias("__start"))
    return read_tokens(spark, path).join(F.broadcast(starts), "shard").withColumn("start", F.col("__start") + F.col("before")).drop("__start")


def documents_of(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """(doc_id, doc_no, shard, piece, ids) of some documents by id."""
    return read_tokens(spark, path).where(F.col("doc_id").isin(*ids)).select("doc_id", "shard", "doc_no", "piece", "ids")


def span(spark: SparkSession, path: str, lo: int, hi: int) -> DataFrame:
    """(start, ids): the ids from place lo up to hi of the whole sequence, a row for each stored row that the span touches; other shards are skipped by their index."""
    shards = shard_table(spark, path).where((F.col("start") < hi) & (F.col("start") + F.col("n_tokens") > lo)).select("shard", F.col("start").alias("__start"))
    first, last = shards.agg(F.min("shard"), F.max("shard")).first()
    rows = read_tokens(spark, path).where(F.col("shard").between(-1 if first is None else first, -1 if last is None else last))
    rows = rows.join(F.broadcast(shards), "shard").withColumn("start", F.col("__start") + F.col("before"))  # a row a file at most
    rows = rows.where((F.col("start") < hi) & (F.col("start") + F.col("n_ids") > lo))
    skip = F.greatest(F.lit(0), F.lit(lo) - F.col("start"))
    take = F.least(F.col("n_ids"), F.lit(hi) - F.col("start")) - skip
    return rows.select((F.col("start") + skip).alias("start"), F.slice("ids", (skip + 1).cast("int"), take.cast("int")).alias("ids"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """crc32 of each row's ids as little-endian unsigned integers in place of the ids, which are last."""
    for batch in batches:
        ids = batch.column(batch.num_columns - 1)
        values, offsets = ids.values.to_numpy().astype("<i4", copy=False), ids.offsets.to_numpy()
        crc = pa.array([zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], crc], names=[*batch.schema.names[:-1], "crc"])


def _matrix_times(matrix: list[int], value: int) -> int:
    out, n = 0, 0
    while value:
        if value & 1:
            out ^= matrix[n]
        value >>= 1
        n += 1
    return out


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """The crc32 of pieces put together, from each piece's crc32 and bytes: a crc passes zero bytes as a linear map over bits, which is squared."""
    bit = [0xEDB88320, *(1 << n for n in range(31))]  # one zero bit
    powers = [bit]
    out = 0
    for crc, n in parts:
        bits, k = 8 * n, 0
        while bits:
            if k == len(powers):
                powers.append([_matrix_times(powers[-1], v) for v in powers[-1]])
            if bits & 1:
                out = _matrix_times(powers[k], out)
            bits >>= 1
            k += 1
        out ^= crc
    return out


def document_sums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    rows = located(spark, path).select("shard", "doc_no", "doc_id", "piece", "last", "start", F.col("n_ids").cast("long").alias("n_tokens"), "ids")
    with arrow_batches(spark, PART_BYTES):
        rows = stored(rows.mapInArrow(_sums, "shard int, doc_no bigint, doc_id bigint, piece int, last boolean, start bigint, n_tokens bigint, crc bigint"), "token-sums")
    one = (F.col("piece") == 0) & F.col("last")
    whole = rows.where(one).select("doc_id", "start", "n_tokens", F.col("crc").alias("ids_crc32"))

    @F.pandas_udf("bigint")
    def join(pieces):  # a document's rows, one for each ROW_IDS of its ids
        return pieces.map(lambda p: joined_crc([(int(x["crc"]), 4 * int(x["n_tokens"])) for x in p]))

    pieces = F.array_sort(F.collect_list(F.struct("piece", "crc", "n_tokens")))
    long = rows.where(~one).groupBy("shard", "doc_no").agg(F.min("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("n_tokens").alias("n_tokens"), pieces.alias("p"))
    return whole.unionByName(long.select("doc_id", "start", "n_tokens", join("p").alias("ids_crc32")))


def op12_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of every document, written as ORC and read back."""
    path = write_tokens(read_table(spark, sf_dir, "documents"), shared_path(spark, "tokens"), public_tokenizers.path("byte_bpe_50k.json"))
    return document_sums(spark, path)
