"""Byte-level BPE: ranked merges folded by higher-order functions over distinct words."""

from __future__ import annotations

import base64
import contextlib
import functools
import hashlib
import heapq
import math
import os
import re
from array import array
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batches, executors_back, give_back, heap_back, read_table, removed, shared_path, stored, units

#: Longer words are merged with a heap: the fold's work grows with the square of a word's bytes.
FOLD_BYTES = 48

#: Bytes of files whose rows make a block, bytes of text that are taken up at once, and distinct pieces of a block that a Python worker remembers.
BLOCK_BYTES, UNIT, MEMORY = 64 << 20, 4 << 20, 2_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def splitter(pattern: str):
    """A function from text to its words, the matches of the pattern."""
    import regex

    return regex.compile(pattern).findall


#: A place that no match of the public pattern reaches over: before a space between two characters that aren't white space.
_CUT = re.compile(r"(?<=\S)(?= \S)")

#: The same characters as \S above has not, for the vectorised matcher.
_BLANK = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def pieces(text: str) -> list[str]:
    """The text cut at every place that no match of the public pattern reaches over."""
    return _CUT.split(text)


def _unused(texts: pa.Array) -> str:
    """A character that no text holds."""
    raw = texts.buffers()[2]
    raw = raw.to_pybytes() if raw is not None else b""
    return next(c for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))) if c not in " \n" and bytes_of(c) not in raw)


def cut(texts: pa.Array) -> pa.ListArray:
    """pieces() of every text, at once: where each space stands between two characters that aren't white space, before each space."""
    uneven = pc.match_substring_regex(texts, f"^ | $|[{_BLANK}] | [{_BLANK}]").to_numpy(zero_copy_only=False)
    mark = _unused(texts)
    parted = pc.replace_substring(texts, " ", f"{mark} ")
    if uneven.any():
        parted = pa.array([mark.join(pieces(t.as_py())) if odd else p.as_py() for t, p, odd in zip(texts, parted, uneven.tolist(), strict=True)], pa.string())
    return pc.split_pattern(parted, mark)


class Pieces:
    """The pieces of some texts, each text one piece where cuts is false."""

    def __init__(self, texts: pa.Array, cuts: bool):
        texts = pc.fill_null(texts, "")
        lists = cut(texts) if cuts else None
        coded = (lists.flatten() if cuts else texts).dictionary_encode()
        #: The distinct pieces, the piece at each place of the texts, and where each text's pieces begin and end.
        self.distinct, self.at = coded.dictionary, coded.indices.to_numpy()
        self.text_ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]) if cuts else np.arange(len(texts) + 1)


class Words:
    """The words of distinct pieces."""

    def __init__(self, find, pieces: pa.Array, cuts: bool):
        joins = pc.match_substring_regex(pieces, f"(?s)^ [^{_BLANK}](.*[^{_BLANK}])?$").to_numpy(zero_copy_only=False) if cuts else np.zeros(len(pieces), bool)
        some = pieces.filter(pa.array(joins))
        words = find("".join(some.to_pylist()))  # these pieces still part when they are put together
        lengths = np.zeros(len(pieces), np.int64)
        if words:
            ends, starts = np.cumsum(pc.utf8_length(some).to_numpy()), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
            lengths[joins] = np.diff(np.searchsorted(starts, ends, "right"), prepend=0)
        alone = [find(p) for p in pieces.filter(pa.array(~joins)).to_pylist()]
        lengths[~joins] = [len(a) for a in alone]
        coded = pa.array(words + list(chain.from_iterable(alone)), pa.string()).dictionary_encode()
        order = np.concatenate([np.flatnonzero(joins), np.flatnonzero(~joins)])  # the pieces in the order of their words
        #: The distinct words, and those at each place of the pieces.
        self.distinct, self.at = coded.dictionary, coded.indices.to_numpy()
        self.places, self.piece_ends = np.argsort(order), np.concatenate([[0], np.cumsum(lengths[order])])

    def pieces(self, values: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """From bytes of each distinct word those of each piece."""
        return _grouped(values.take(pa.array(self.at)), self.piece_ends).take(pa.array(self.places))


def _offsets(values: pa.LargeBinaryArray) -> np.ndarray:
    return np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)


def _grouped(values: pa.LargeBinaryArray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """Neighbouring values put together."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(np.ascontiguousarray(_offsets(values)[ends])), values.buffers()[2]])


def bytes_of(word: str) -> bytes:
    return word.encode("utf-8", "surrogatepass")


def latin(raw: bytes) -> str:
    """Bytes as characters of the same numbers, so that SQL strings and maps can hold them."""
    return raw.decode("latin-1")


#: A state of the fold packs each part into a long: the rank of the pair it begins, its place in the word, its id.
ID_BITS, PLACE_BITS = 17, 16
NONE = 1 << ID_BITS

#: A place of the rank map that no pair has; it yields more than NONE for every row.
NO_ENTRY = 1 << 62


class RankMap:
    """The rank of every pair of tokens that concatenates to a token, as literal arrays.

    A literal map would be searched from its front, so the pairs' sparse matrix
    is stored with displaced rows: the pair (a, b) can only stand at place
    shift[a] + b, and an entry holds its row's a above the rank.  An entry of
    another row, or NO_ENTRY, therefore yields a number of NONE or more.
    """

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=0) + 1
        if size > NONE - 2:
            raise ValueError(f"the fold holds ids below {NONE - 2}")
        self.edge = size  # an id without any pair, at both ends of a word
        flat = array("q")
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    flat.extend((a, b, rank))
        pairs = np.frombuffer(flat, np.int64).reshape(-1, 3) if len(flat) else np.empty((0, 3), np.int64)
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        owners, starts, lengths = np.unique(pairs[:, 0], return_index=True, return_counts=True)
        values = np.full(4 * (size + len(pairs)), -1, np.int64)
        shift, free, last, end = np.full(size + 1, len(values), np.int64), 0, 0, 0
        for k in np.lexsort((owners, -lengths)).tolist():
            row = pairs[starts[k] : starts[k] + lengths[k]]
            columns = row[:, 1]
            while values[free] >= 0:
                free += 1
            at, wide = (max(free, last) if len(row) > 2 else free) - int(columns[0]), 256  # small rows fill the gaps that large ones leave
            while True:
                clear = np.arange(at, at + wide)
                for c in columns.tolist():
                    clear = clear[values[clear + c] < 0]
                if len(clear):
                    break
                at += wide
            shift[owners[k]] = clear[0]
            last = int(clear[0] + columns[0])
            values[clear[0] + columns] = row[:, 0] << ID_BITS | row[:, 2]
            end = max(end, int(clear[0] + columns[-1]) + 1)
        single = np.array([ranks.get(bytes([i]), 0) for i in range(256)])
        shift = np.where(shift < len(values), shift, end + 1)
        self.entries, self.shift, self.single = np.where(values[:end] < 0, NO_ENTRY, values[:end]), shift, single

    def literal(self, spark: SparkSession) -> Column:
        """The map as one literal: entries e, shifts s and the ids b of single bytes."""
        return F.struct(*(_longs(spark, v).alias(k) for k, v in (("e", self.entries), ("s", self.shift), ("b", self.single))))


@functools.lru_cache(maxsize=4)
def _rank_map(path: str, changed: int) -> RankMap:
    """The rank map of a vocabulary file as it stands; it takes some seconds to build."""
    table = RankMap(read_ranks(path))
    give_back()
    return table


def _longs(spark: SparkSession, values: np.ndarray) -> Column:
    """Whole numbers as a literal array in Spark's packed form.

    An array of boxed numbers, and a JSON text of them, would stand in full in
    every description of the plan that Spark keeps, some megabytes each; this
    form is named there only.
    """
    jvm = spark._jvm
    longs = spark.sparkContext._gateway.new_array(jvm.long, len(values))
    jvm.java.nio.ByteBuffer.wrap(bytearray(values.astype(">i8").tobytes())).asLongBuffer().get(longs)
    catalyst = jvm.org.apache.spark.sql.catalyst.expressions
    packed = catalyst.UnsafeArrayData.fromPrimitiveArray(longs)
    kind = jvm.org.apache.spark.sql.types.DataType.fromDDL("array<bigint>")
    return Column(jvm.org.apache.spark.sql.classic.ExpressionUtils.column(catalyst.Literal(packed, kind)))


def pair_rank(table: Column, a: Column, b: Column) -> Column:
    """The rank of a pair of ids, or NONE."""
    return F.least(F.lit(NONE).cast("long"), F.get(table.e, F.get(table.s, a) + b).bitwiseXOR(F.shiftleft(a, ID_BITS)))


def let(value: Column, body) -> Column:
    """body of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def merged(word: Column, ranks: RankMap) -> Column:
    """The token ids of a word given as latin characters: the pair of the lowest rank, the first of equals, is merged until none has a rank.

    The fold's state is one array of packed parts between two edges.  Its
    minimum is the pair to merge; a merge replaces two parts and looks up the
    two ranks that it changes.  The literal rank map is bound once, so that it
    stands in the plan once.
    """
    n = F.length(word)
    low_bits = ID_BITS + PLACE_BITS
    edge = F.array(F.lit(NONE << low_bits | ranks.edge).cast("long"))

    def ident(part: Column) -> Column:
        return part.bitwiseAND(NONE - 1)

    def packed(rank: Column, rest: Column) -> Column:
        return F.shiftleft(rank, low_bits).bitwiseOR(rest)

    def fold(table: Column) -> Column:
        ids = F.transform(F.sequence(F.lit(1), n), lambda i: F.get(table.b, F.ascii(F.substring(word, i, F.lit(1)))))
        parts = let(ids, lambda x: F.transform(x, lambda v, i: packed(pair_rank(table, v, F.get(x, i + 1)), F.shiftleft(i.cast("long"), ID_BITS).bitwiseOR(v))))

        def merge(s: Column, low: Column) -> Column:
            new = F.shiftright(low, low_bits)

            def placed(at: Column) -> Column:  # the two parts are at and at + 1, from 1; the first of all is an edge
                left = F.get(s, at - 2)
                before = packed(pair_rank(table, ident(left), new), left.bitwiseAND((1 << low_bits) - 1))
                own = packed(pair_rank(table, new, ident(F.get(s, at + 1))), low.bitwiseAND(((1 << PLACE_BITS) - 1) << ID_BITS).bitwiseOR(new))
                return F.concat(F.slice(s, F.lit(1), at - 2), F.array(before, own), F.slice(s, at + 2, n + 2))

            return let(F.array_position(s, low).cast("int"), placed)

        def step(s: Column, _: Column) -> Column:
            return let(F.array_min(s), lambda low: F.when(low < F.lit(NONE << low_bits), merge(s, low)).otherwise(s))

        def found(s: Column) -> Column:
            return F.transform(F.slice(s, F.lit(2), F.size(s) - 2), lambda v: ident(v).cast("int"))

        return F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), F.concat(edge, parts, edge), step, found)

    return F.when(n == 0, F.array().cast("array<int>")).otherwise(let(ranks.literal(SparkSession.active()), fold))


def heap_merged(raw: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a long word, in n log n steps: a heap of ranks and places, and links between the parts."""
    if raw in ranks:
        return [ranks[raw]]
    n = len(raw)
    size, left, right = array("q", [1]) * n, array("q", range(-1, n - 1)), array("q", range(1, n + 1))
    heap: list[int] = []

    def rank(i: int) -> int | None:
        j = right[i]
        return ranks.get(raw[i : i + size[i] + size[j]]) if j < n else None

    def offer(i: int) -> None:
        if (r := rank(i)) is not None:
            heapq.heappush(heap, r << 40 | i)

    for i in range(n - 1):
        offer(i)
    while heap:
        low = heapq.heappop(heap)
        i = low & (1 << 40) - 1
        if not size[i] or rank(i) != low >> 40:
            continue
        j = right[i]
        size[i] += size[j]
        size[j], right[i] = 0, right[j]
        if right[i] < n:
            left[right[i]] = i
        offer(i)
        if left[i] >= 0:
            offer(left[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[raw[i : i + size[i]]])
        i = right[i]
    return out


def distinct_words(docs: DataFrame, pattern: str) -> DataFrame:
    """(block, word): the distinct words of up to FOLD_BYTES bytes of each block, as latin characters; from some megabytes of text at a time, so a word can come twice."""

    def scan(batches):
        find, cuts, own = splitter(pattern), pattern == public_tokenizers.PATTERN, None
        pieces = words = pa.array([], pa.string())
        for unit in units(batches, "text", "block", UNIT):
            unit = unit.combine_chunks()
            block = unit.column("block")[0].as_py()
            if block != own or len(pieces) > MEMORY:
                own, pieces, words = block, pieces[:0], words[:0]
            fresh = Pieces(unit.column("text").chunk(0), cuts).distinct
            fresh = fresh.filter(pc.invert(pc.is_in(fresh, value_set=pieces)))
            found = Words(find, fresh, cuts).distinct
            found = found.filter(pc.less_equal(pc.binary_length(found), FOLD_BYTES))
            found = found.filter(pc.invert(pc.is_in(found, value_set=words)))
            pieces, words = pa.concat_arrays([pieces, fresh]), pa.concat_arrays([words, found])
            for i in range(0, len(found), 50_000):
                part = [latin(bytes_of(w)) for w in found.slice(i, 50_000).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block)), pa.array(part, pa.string())], names=["block", "word"])
        pieces = words = unit = fresh = found = None
        give_back()

    return docs.mapInArrow(scan, "block long, word string")


class Encoder:
    """Texts to ids by the words of their block; words too long for the fold are merged here."""

    def __init__(self, pattern: str, ranks: dict[bytes, int]):
        self.find, self.cuts, self.ranks = splitter(pattern), pattern == public_tokenizers.PATTERN, ranks
        pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        #: The bytes of each token id.
        self.tokens = pa.array(pieces, pa.large_binary())
        self.block([])

    def block(self, tables: list[pa.Table]) -> None:
        """From now on texts are made of these tables' words (word, ids)."""
        self.words = pa.chunked_array([t.column("word").combine_chunks() for t in tables], pa.string()) if tables else pa.chunked_array([], pa.string())
        self.ids = pa.concat_arrays([_as_bytes(t.column("ids").combine_chunks()) for t in tables]) if tables else pa.array([], pa.large_binary())
        #: The pieces that were met, and their ids.
        self.pieces, self.piece_ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def ids_of(self, words: pa.Array) -> pa.LargeBinaryArray:
        """The ids of distinct words as little-endian unsigned 32-bit integers."""
        raw = [bytes_of(w) for w in words.to_pylist()]
        own = pc.index_in(self.words, value_set=pa.array(map(latin, raw), pa.string()))
        at, places = np.full(len(raw), -1), pc.fill_null(own, -1).to_numpy()
        known = np.flatnonzero(places >= 0)
        at[places[known]] = np.arange(len(known))
        other = np.flatnonzero(at < 0)
        at[other] = len(known) + np.arange(len(other))
        merged = [np.array(heap_merged(raw[i], self.ranks), "<u4").tobytes() for i in other.tolist()]
        return pa.concat_arrays([self.ids.take(pa.array(known)), pa.array(merged, pa.large_binary())]).take(pa.array(at))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Buffer, np.ndarray]:
        """The ids of all texts and where each text's begin and end, and the bytes that they decode to, the tokens' binary pieces put together, likewise."""
        if len(self.pieces) > MEMORY:
            self.pieces, self.piece_ids = self.pieces[:0], self.piece_ids[:0]
        own = Pieces(texts, self.cuts)
        at = pc.fill_null(pc.index_in(own.distinct, value_set=self.pieces), -1).to_numpy().astype(np.int64)
        fresh = own.distinct.filter(pa.array(at < 0))
        if len(fresh):
            words = Words(self.find, fresh, self.cuts)
            at[at < 0] = len(self.pieces) + np.arange(len(fresh))
            self.pieces = pa.concat_arrays([self.pieces, fresh])
            self.piece_ids = pa.concat_arrays([self.piece_ids, words.pieces(self.ids_of(words.distinct))])
        parts = self.piece_ids.take(pa.array(at[own.at]))
        ends = _offsets(parts)[own.text_ends] // 4
        ids = np.frombuffer(parts.buffers()[2], "<u4", count=int(ends[-1])) if ends[-1] else np.empty(0, "<u4")
        decoded = self.tokens.take(pa.array(ids))
        return ids, ends, decoded.buffers()[2], _offsets(decoded)[ends]


def _as_bytes(ids: pa.ListArray) -> pa.LargeBinaryArray:
    values, ends = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"), np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())]).astype(np.int64) * 4
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(values)])


def _tables_of_block(root: str, block: int) -> list[pa.Table]:
    """The encoded words of a block, from the shared folder."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    filesystem, path = fs.FileSystem.from_uri(f"{root}/block={block}")
    if filesystem.get_file_info(path).type == fs.FileType.NotFound:
        return []
    return [ds.dataset(path, filesystem=filesystem, format="parquet").to_table(columns=["word", "ids"]).combine_chunks()]


def _digests(data: pa.Buffer | None, ends: np.ndarray) -> pa.Array:
    view = memoryview(data) if data is not None else b""
    ends = ends.tolist()
    return pa.array([hashlib.sha256(view[i:j]).hexdigest() for i, j in pairwise(ends)], pa.string())


def in_blocks(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text, block): blocks are runs of rows of a file, about BLOCK_BYTES of it each.

    A row's block depends on its file and its place in it alone, not on how a
    scan is split.  Rows that don't come straight from Parquet files are written
    to the shared folder first.
    """
    own = [F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")]
    docs = None
    if documents.inputFiles() and not _shuffles(documents):
        with contextlib.suppress(AnalysisException):  # of a format without row numbers
            docs = _placed(documents, own)
    return docs if docs is not None else _placed(stored(documents.select(own), "texts"), [F.col("doc_id"), F.col("text")])


def _placed(documents: DataFrame, own: list[Column]) -> DataFrame:
    rows, plan = documents.count(), documents._jdf.queryExecution().optimizedPlan()
    while plan.children().size():
        plan = plan.children().head()
    size = int(str(plan.stats().sizeInBytes()))  # of all files
    per_block = max(1, math.ceil(BLOCK_BYTES * rows / max(1, size)))
    place = documents.metadataColumn("_metadata")
    return documents.select(*own, F.xxhash64(place["file_path"], F.floor(place["row_index"] / per_block)).alias("block"))


def encoded(documents: DataFrame, path: str, *, pattern: str = public_tokenizers.PATTERN, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if with_ids, the ids of every whole text.

    The distinct words of each block of the input (some rows of a file) are
    brought together, so that every distinct word of the corpus is encoded once,
    by a fold over its bytes with the ranks of the file at path; the result goes
    to the shared folder by block, and each block's texts are put together from
    its own words.  Texts are never shuffled, and no table of all words meets in
    one place.  Words over FOLD_BYTES bytes are merged with a heap as the texts
    are put together, and so would be a word that the block's table lacks.  The
    ids are decoded again by concatenating the tokens' bytes.

    Texts reach the workers and are taken up some megabytes at a time; a longer
    text makes a unit of its own and is encoded whole.  The result is written to
    the shared folder, so that this holds in the caller's action too, and the
    words' table is deleted then.  Null and empty texts have no ids; repeated
    rows are encoded each; a null id stays null; an empty table gives no rows;
    other columns are ignored, whatever their names.
    """
    spark, ranks = documents.sparkSession, read_ranks(path)
    heap_back(spark)
    executors_back(spark)
    docs, root, table = in_blocks(documents, doc_id, text), shared_path(spark, "words"), _rank_map(path, os.stat(path).st_mtime_ns)
    by_word = distinct_words(docs.select("text", "block"), pattern).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "word")
    # The block is kept on both sides of the join so that they read one exchange.
    own = by_word.groupBy("word").agg(F.min("block").alias("least")).where("least is not null").select("word", merged(F.col("word"), table).alias("ids"))
    with arrow_batches(spark, UNIT):
        by_word.join(own, "word").select("block", "word", "ids").repartition("block").write.partitionBy("block").parquet(root)

    held = spark.sparkContext.broadcast(ranks)  # of the size of the vocabulary
    del by_word, own
    give_back()
    heap_back(spark)
    executors_back(spark)

    def scan(batches):
        encoder, own = Encoder(pattern, held.value), None
        for unit in units(batches, "text", "block", UNIT):
            unit = unit.combine_chunks()
            block = unit.column("block")[0].as_py()
            if block != own:
                encoder.block([])  # gone before the next block's words come
                encoder.block(_tables_of_block(root, block))
                give_back()
                own = block
            ids, ends, decoded, decoded_ends = encoder.encode(unit.column("text").chunk(0))
            cols = [unit.column("doc_id").chunk(0), pa.array(np.diff(ends)), _digests(pa.py_buffer(ids), ends * 4), _digests(decoded, decoded_ends)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array([ids[i:j].astype(np.int32) for i, j in pairwise(ends.tolist())], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)
        encoder = unit = ids = decoded = cols = None
        give_back()

    with arrow_batches(spark, UNIT):
        found = stored(docs.mapInArrow(scan, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids), "encoded")
    removed(spark, root)
    return found


def _shuffles(df: DataFrame) -> bool:
    """Whether anything but a projection or filter stands between df and its files."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.children().size():
        if plan.nodeName() not in ("Project", "Filter") or plan.children().size() > 1:
            return True
        plan = plan.children().head()
    return plan.nodeName().split(" ")[0] not in ("LogicalRelation", "Relation")


def op9_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return encoded(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
