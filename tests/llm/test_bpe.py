import functools
import hashlib
import random
import struct

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sieveworks.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    "", "hello world", " lead", "trail ", "a  b", "a \n b", "line\nline two\r\n", "tabs\tand\xa0spaces　", "it's we'll I'M", "don't  ", "x1y2 300,000.5", "日本語 テキスト", "😀😀 🇩🇪", "é́ ſ",
    "nul\0 nul \0x", "\x1c \x1f", "<|endoftext|>", "a" * 40, "a" * 500 + " b", "!" * 300, "   ", " ", "\n\n\n", "ab​cd", "½ ² Ⅷ", "word " * 3000, "\U00010ffff", "ÀÉ ñandú çà",
]


def digests(ids):
    return hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def test_ids_equal_the_library(spark, docs, library):
    r = random.Random(4)
    alphabet = "abc é\n\t 1.!'日😀sS "
    texts = TEXTS + ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(200)]
    rows = list(enumerate(texts)) + [(9000, None), (None, "x y"), (1, texts[1])]
    got = bpe.encoded(docs(rows), PATH, with_ids=True).collect()
    assert len(got) == len(rows)
    want = {i: library.encode_ordinary(t or "") for i, t in rows}
    for x in got:
        assert x.ids == want[x.doc_id] and x.n_tokens == len(x.ids) and x.ids_sha256 == digests(x.ids)
        assert x.decoded_sha256 == hashlib.sha256((dict(rows)[x.doc_id] or "").encode()).hexdigest()


def test_from_files_and_empty(spark, docs, library, tmp_path):
    docs([(1, "from a file"), (2, "another one")]).write.parquet(str(tmp_path / "d"))
    got = bpe.encoded(spark.read.parquet(str(tmp_path / "d")), PATH)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")  # another split of the files when the texts are read again
    try:
        got = {x.doc_id: x.n_tokens for x in got.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {1: len(library.encode_ordinary("from a file")), 2: len(library.encode_ordinary("another one"))}
    assert bpe.encoded(docs([(1, "x")]).limit(0), PATH).count() == 0


@pytest.mark.parametrize("rows_of_bytes", [1, 400, 1 << 26])
def test_blocks_of_any_size_and_other_words_give_the_same(spark, docs, library, tmp_path, monkeypatch, rows_of_bytes):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", rows_of_bytes)
    r = random.Random(6)
    rows = [(i, " ".join(r.choice(["one", "two,", "three\n", "été", "x" * 60]) for _ in range(i % 9))) for i in range(60)]
    docs(rows).coalesce(1).write.parquet(str(tmp_path / "d"))
    got = bpe.encoded(spark.read.parquet(str(tmp_path / "d")), PATH, with_ids=True).collect()
    assert {x.doc_id: x.ids for x in got} == {i: library.encode_ordinary(t) for i, t in rows}


def test_a_word_that_its_table_lacks_is_encoded(ranks, library):
    encoder = bpe.Encoder(public_tokenizers.PATTERN, ranks)
    encoder.encode(pa.array(["words", "no"]))
    ids, ends, decoded, _ = encoder.encode(pa.array(["new words", None, "", "here"]))
    assert ids.tolist() == library.encode_ordinary("new words") + library.encode_ordinary("here") and ends.tolist()[1:4] == [2, 2, 2]
    assert decoded.to_pybytes()[:13] == b"new wordshere"


def test_another_pattern_is_matched_on_whole_texts(spark, docs, ranks):
    pattern = r"\w+ \w+|\s|."
    library = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rows = [(1, "two words more of them"), (2, "a b c"), (3, "")]
    got = bpe.encoded(docs(rows), PATH, pattern=pattern, with_ids=True).collect()
    assert {x.doc_id: x.ids for x in got} == {i: library.encode_ordinary(t) for i, t in rows}


def test_very_long_texts(spark, docs, library):
    rows = [(1, "word two, " * 300_000), (2, "qx" * 400_000), (3, "!" * 300_000 + " é" * 100_000)]
    got = {x.doc_id: x for x in bpe.encoded(docs(rows), PATH).collect()}
    assert {i: x.decoded_sha256 for i, x in got.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in rows}
    assert got[1].ids_sha256 == digests(library.encode_ordinary(rows[0][1]))


def test_fold_equals_the_heap(spark, ranks):
    r = random.Random(5)
    words = ["".join(r.choice("abcdeinorst é") for _ in range(r.randrange(1, 40))) for _ in range(400)]
    df = spark.createDataFrame([(bpe.latin(w.encode()),) for w in words], "w string")
    got = [x.ids for x in df.select(bpe.merged(F.col("w"), bpe.RankMap(ranks)).alias("ids")).collect()]
    assert got == [bpe.heap_merged(w.encode(), ranks) for w in words]


def test_small_vocabularies(spark):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"aba": 257, b"aa": 258, b"aaa": 259}
    words = ["ababa", "aaaaa", "aabab", "a", "zz"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [x.ids for x in df.select(bpe.merged(F.col("w"), bpe.RankMap(ranks)).alias("ids")).collect()]
    assert got == [bpe.heap_merged(w.encode(), ranks) for w in words]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\té!1'\0\x1c　日", max_size=30))
def test_pieces_split_only_where_the_pattern_does(text):
    find = bpe.splitter(public_tokenizers.PATTERN)
    assert [w for p in bpe.pieces(text) for w in find(p)] == find(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \n\té!1'\0\x01\x1c　日", max_size=20)), max_size=8))
def test_texts_are_put_together_from_distinct_words(texts):
    find = bpe.splitter(public_tokenizers.PATTERN)
    arr = pa.array(texts, pa.string())
    assert bpe.cut(pa.array([t or "" for t in texts], pa.string())).to_pylist() == [bpe.pieces(t or "") for t in texts]
    own = bpe.Pieces(arr, True)
    words = bpe.Words(find, own.distinct, True)
    assert words.pieces(words.distinct.cast(pa.large_binary())).to_pylist() == [p.encode() for p in own.distinct.to_pylist()]
    parts = [own.distinct[i].as_py() for i in own.at]
    assert ["".join(parts[i:j]) for i, j in zip(own.text_ends, own.text_ends[1:], strict=False)] == [t or "" for t in texts]
    assert set(words.distinct.to_pylist()) == {w for t in texts for w in find(t or "")}


@functools.cache
def own():
    ranks = bpe.read_ranks(PATH)
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=60))
def test_heap_equals_the_library(raw):
    ranks, library = own()
    assert bpe.heap_merged(raw, ranks) == library._encode_single_piece(raw)
