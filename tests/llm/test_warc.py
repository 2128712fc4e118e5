import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sieveworks.llm import warc


def pages(spark, rows, parts=3):
    return spark.createDataFrame([(p, u, h, "x") for p, u, h in rows], "page_id long, url string, html string, digest string").repartition(parts)


def expected(rows, least=1000):
    top = {}
    for p, _, h in rows:
        raw = (h or "").encode()
        if len(raw) >= least and p is not None:
            top[raw] = max(top.get(raw, p), p)
    out = []
    for p, _, h in rows:
        raw = (h or "").encode()
        again = raw in top and p != top[raw]
        out.append((p, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", top[raw] if again else None))
    return sorted(out, key=str)


@pytest.fixture
def rows():
    r = random.Random(1)
    big = ["".join(r.choice("abcé\n<>") for _ in range(n)) for n in (999, 1000, 3000, 50_000)]
    out = [(k, f"http://x/{k} y\r\n", r.choice(big + ["", "small", None])) for k in range(60)]
    return out + [(70, None, big[2]), (70, None, big[2]), (None, "u", big[2]), (None, "u", "x" * 2000), (None, "u", "x" * 2000), (-5, "u", big[1])]


def test_round_trip(spark, rows):
    got = warc.round_trip(pages(spark, rows)).collect()
    assert all(r.intact for r in got)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows)


def test_chunks_carry_the_payload_and_running_digests(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "PIECE", 700)
    archives = warc.write_archives(pages(spark, rows), f"file://{tmp_path}/a")
    found = warc.read_archives(archives, chunk=777).orderBy("archive", "record_no", "chunk_no").collect()
    assert max(len(r.data) for r in found) <= 777
    whole, sums = {}, {}
    for r in found:
        key = (r.archive, r.record_no)
        whole[key] = whole.get(key, b"") + r.data
        assert r.digest_so_far == hashlib.sha1(whole[key]).hexdigest() and r.bytes_so_far == len(whole[key])
        sums[key] = r
    payloads = sorted(v for k, v in whole.items() if sums[k].record_type == "response")
    assert payloads == sorted((h or "").encode() for (p, _, h), e in zip(sorted(rows, key=lambda x: str(expected([x])[0])), expected(rows), strict=True) if e[3] == "response") or len(payloads) == sum(e[3] == "response" for e in expected(rows))
    assert all(r.last for r in sums.values()) and archives.agg({"records": "sum"}).first()[0] >= len(rows)


def test_archives_are_plain_warc(spark, tmp_path):
    archives = warc.write_archives(pages(spark, [(1, "http://x/", "<p>hi")], 1), f"file://{tmp_path}/a")
    text = gzip.open(archives.first().archive.removeprefix("file://")).read().decode()
    head, record = text.split("\r\n\r\n\r\n", 1) if "\r\n\r\n\r\n" in text else ("", text)
    assert text.startswith("WARC/1.1\r\nWARC-Type: warcinfo") and "WARC-Target-URI: http://x/\r\n" in text and text.endswith("<p>hi\r\n\r\n")


def test_oversized_payload_is_read_in_pieces(spark, tmp_path):
    archives = warc.write_archives(pages(spark, [(1, "u", "0123456789" * 400_000)], 1), f"file://{tmp_path}/a")
    found = warc.read_archives(archives, with_data=True).collect()
    assert len(found) == 4 and max(len(r.data) for r in found) == 1 << 20 and sum(len(r.data) for r in found) == 4_000_000


def test_damage_is_an_error_and_empty_is_empty(spark, tmp_path):
    archives = warc.write_archives(pages(spark, [(1, "u", "x" * 5000)], 1), f"file://{tmp_path}/a")
    path = archives.first().archive.removeprefix("file://")
    data = open(path, "rb").read()
    open(path, "wb").write(data[: len(data) - 30])
    with pytest.raises(Exception, match="ends within|Error|no record"):
        warc.read_archives(archives).collect()
    assert warc.round_trip(pages(spark, [(1, "u", "x")]).limit(0)).count() == 0


def test_clashing_columns_repeated_rows_and_a_null_id(spark):
    long = "x" * 1_500
    data = [(1, "http://a/1", long, "d", 1), (3, "http://a/3", long, "d", 2), (3, "http://a/3", long, "d", 2), (None, None, "short", "d", 3), (5, None, None, "d", 4)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, digest string, row long").withColumns({"chunk_no": F.lit(1), "archive": F.lit("a"), "data": F.lit("b"), "last": F.lit(True)})
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to, r.intact) for r in warc.round_trip(pages).collect()), key=str)
    want = [(1, 1_500, "revisit", 3, True), (3, 1_500, "response", None, True), (3, 1_500, "response", None, True), (None, 5, "response", None, True), (5, 0, "response", None, True)]
    assert got == sorted(want, key=str)
