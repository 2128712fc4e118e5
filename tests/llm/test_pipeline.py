"""The stages in order on small tables, each held against what it must do."""

import random

import corpus_pipeline as C
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from sieveworks.llm import bpe, ngram_join


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    r, at = random.Random(11), tmp_path_factory.mktemp("tables")
    clean = [f"c{k}" for k in range(400)]
    sentence = lambda n: " ".join(r.choice(clean) for _ in range(n))
    passage, shared = sentence(30), "\n".join(sentence(15) for _ in range(5))
    rows, labels = [], []
    for i in range(400):
        text = "\n".join(sentence(r.randrange(20, 60)) for _ in range(3))
        if i % 5 == 0:
            w = text.split(" ")
            for _ in range(6):
                w.insert(r.randrange(len(w)), "idiot")
            text = " ".join(w)
        rows.append((i, text))
        labels.append((i, 1, int(i % 5 == 0)))
    rows[1] = (1, shared + "\n" + rows[1][1])
    rows[2] = (2, rows[2][1] + "\n" + shared)
    rows[3] = (3, rows[3][1] + " " + passage)
    words = rows[4][1].split(" ")
    words[5] = "edited"
    rows.append((500, " ".join(words).replace("\n", " ")))
    rows.append((501, rows[6][1]))
    rows += [(600, None), (601, "")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(0, passage)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at), dict(rows), shared


def test_stages(spark, tables):
    at, texts, shared = tables
    docs = C.read_table(spark, at, "documents")
    seen = {}
    for name, stage in C.STAGES:
        out = C.stored(stage(spark, docs, at), name)
        if name != "byte_bpe":
            assert out.columns == docs.columns
        docs = out
        seen[name] = {r.doc_id: r for r in docs.collect()}
    toxic = {i for i in texts if i < 400 and i % 5 == 0}
    assert not toxic & set(seen["toxicity"]) and set(seen["toxicity"]) == set(texts) - toxic
    cut = seen["line_dedup"]
    assert cut[1].text == texts[1] and shared not in cut[2].text and cut[2].n_chars == len(cut[2].text)
    assert set(seen["toxicity"]) - set(cut) == {501}
    assert set(cut) - set(seen["ngram_join"]) == {500}
    assert set(seen["ngram_join"]) - set(seen["decontamination"]) == {3}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    last = seen["byte_bpe"]
    assert {i: r.n_tokens for i, r in last.items()} == {i: len(library.encode_ordinary(cut[i].text or "")) for i in seen["decontamination"]}
    assert {(r.doc_id, r.ids_sha256) for r in C.run(spark, at).collect()} == {(r.doc_id, r.ids_sha256) for r in last.values()}


def test_stage_names():
    assert [n for n, _ in C.STAGES] == ["toxicity", "line_dedup", "ngram_join", "decontamination", "byte_bpe"] and C.ORACLE_SQL is None and ngram_join


def test_odd_rows_and_clashing_names_go_through_every_stage(spark, tables, tmp_path):
    """Null and repeated ids, null, empty and very long texts, and columns named as the operators name their own."""
    at, texts, _ = tables
    r = random.Random(3)
    words = [f"c{r.randrange(400)}" for _ in range(50_000)]
    long, near = " ".join(words), " ".join(["edited" if k == 40_000 else w for k, w in enumerate(words)])
    odd = [(None, "only a null id here with words of its own"), (7, "another text under an id that is taken by one before"), (800, long), (801, near), (802, "  \n "), (803, None)]
    docs = C.read_table(spark, at, "documents").unionByName(spark.createDataFrame([(i, t, None, None, None) for i, t in odd], "doc_id long, text string, lang string, source string, n_chars long"))
    docs = docs.withColumns({"sig": F.lit(1), "h": F.lit("h"), "score": F.lit(0.5), "key": F.lit("k"), "_id": F.lit(2), "lines_removed": F.lit(3), "size": F.lit(4)})
    for name, stage in C.STAGES[:-1]:
        out = C.stored(stage(spark, docs, at), name)
        assert out.columns == docs.columns and out.where("sig != 1 or h != 'h' or score != 0.5 or key != 'k' or _id != 2 or lines_removed != 3 or size != 4").isEmpty()
        docs = out
        assert odd[2] in {(r.doc_id, r.text) for r in docs.where("doc_id = 800").collect()}, name
    kept = {(r.doc_id, r.text) for r in docs.collect()}
    assert {odd[0], odd[1], odd[2], odd[4], odd[5]} <= kept and 801 not in {i for i, _ in kept}
    last = C.STAGES[-1][1](spark, docs, at).collect()
    assert len(last) == len(docs.collect()) and {r.n_tokens for r in last if r.doc_id in (600, 601, 803)} == {0}


def test_empty_tables_give_no_rows(spark, tables, tmp_path):
    at, _, _ = tables
    for name in ("documents", "labels", "benchmark"):
        C.read_table(spark, at, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert C.run(spark, str(tmp_path)).collect() == []
