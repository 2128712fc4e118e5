"""Scalar functions against literal rows and plain Python restatements."""

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from sieveworks.functions import text as X
from sieveworks.vocab import EMPLOYMENT_TERMS, SnippetRules


def values(spark, texts, expr):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", expr.alias("v")).orderBy("i").collect()]


def test_strip_html_makes_spaces_then_decodes(spark):
    got = values(spark, ["<p>a&amp;b</p>", "x&lt;i&gt;y", None, "no &eacute; <br/>", "a &notit; &#x1F600;"], X.strip_html("t"))
    assert got == [" a&b ", "x<i>y", "", "no é  ", html.unescape("a &notit; &#x1F600;")]


def test_one_line_and_match_text(spark):
    odd = ["  a\n\tb  ", "a\xa0 b c", "", None, "\x1cq\x85"]
    assert values(spark, odd, X.one_line("t")) == [re.sub(r"\s+", " ", t or "").strip() for t in odd]
    assert values(spark, odd, X.match_text("t")) == [re.sub(r"\s+", " ", t or "").lower() for t in odd]


def plain_snippet(text, head, cap):
    text = (text or "").strip()
    tail = text[head:]
    hits = [s.strip() for s in re.split(r"(?<=[.!?\n])\s+", tail) if re.search(EMPLOYMENT_TERMS, s, re.I)] if tail else []
    return (text[:head] + " […] " + " ".join(hits))[:cap] if hits else text[:head]


def test_snippet_equals_a_restatement_on_random_texts(spark):
    r = random.Random(3)
    words = ["we", "build", "contract.", "Part-time!", "\n", "it?", "\xa0", "hourly", "x" * 9, "é😀.", "role", " "]
    texts = ["".join(r.choice(words) + r.choice([" ", "", "\n"]) for _ in range(r.randrange(40))) for _ in range(300)] + [None, "", " " * 80]
    rules = SnippetRules(head=30, cap=80)
    assert values(spark, texts, X.snippet("t", rules)) == [plain_snippet(t, 30, 80) for t in texts]


def test_buried_terms_survive(spark):
    text = "About us. " * 60 + "This is a fractional role. More talk."
    assert values(spark, [text], X.snippet("t"))[0].endswith(" […] This is a fractional role.")


def test_title_parts(spark):
    got = values(spark, ["Acme: Lead", "Lead", "A: ", " A :  B: C ", None], X.title_parts("t"))
    assert [tuple(g) for g in got] == [("Acme", "Lead"), ("", "Lead"), ("", "A:"), ("A", "B: C"), ("", "")]


@pytest.mark.parametrize(
    ("header", "role"),
    [
        ("Acme | Remote | Senior Engineer | $100k", "Senior Engineer"),
        ("Acme | https://engineer.example | Rustacean", "Rustacean"),
        ("Acme | REMOTE (US) | full-time", "REMOTE (US) | full-time"),
        ("Acme | 150-250k | W23 | Berlin", "Berlin"),
        ("Acme | | Founding PM", "Founding PM"),
        ("Acme | misleading Tools", "misleading Tools"),
        ("Acme | " + "r" * 200 + " lead", "r" * 100),
    ],
)
def test_pick_role(spark, header, role):
    assert values(spark, [header], X.pick_role(X.header_fields("t"))) == [role]


def test_no_fields_of_an_empty_header(spark):
    assert values(spark, ["", "a|b "], X.header_fields("t")) == [[], ["a", "b"]]


def test_near_is_start_to_start(spark):
    texts = ["tpm " + "x" * (n - 5) + " first" for n in (199, 200, 201)] + ["first a tpm", "vtpm first", "tpmd first", "tpm only"]
    assert values(spark, texts, X.near("t", r"\btpm\b", r"\bfirst\b", 200)) == [True, True, False, True, False, False, False]


def test_near_equals_offsets_on_random_texts(spark):
    r = random.Random(5)
    texts = [" ".join(r.choice(["tpm", "first", "é", "😀", "zz" * r.randrange(1, 9), "second"]) for _ in range(r.randrange(12))) for _ in range(400)]

    def plain(t):
        a = [m.start() for m in re.finditer(r"\btpm\b", t)]
        b = [m.start() for m in re.finditer(r"\bfirst\b|\bsecond\b", t)]
        return any(abs(x - y) <= 20 for x in a for y in b)

    assert values(spark, texts, X.near("t", r"\btpm\b", r"\bfirst\b|\bsecond\b", 20)) == list(map(plain, texts))


def test_optional_int(spark):
    assert values(spark, [" 12 ", "", "  ", None], X.optional_int("t")) == [12, None, None, None]
    with pytest.raises(Exception, match="x1"):
        values(spark, ["x1"], X.optional_int("t"))


def test_present_and_json_keep_their_nulls(spark):
    assert values(spark, ["", None, "a"], X.present("t", F.lit("z"))) == ["z", "z", "a"]
    assert values(spark, [None, "b"], X.json_of("i", "t")) == ['{"i":0,"t":null}', '{"i":1,"t":"b"}']


def test_entities_equal_the_standard_library(spark):
    import random
    from html.entities import html5

    r = random.Random(1)
    numbers = [*range(300), 0xD800, 0xDFFF, 0xFDD0, 0xFFFE, 0xFFFF, 0x10000, 0x1FFFE, 0x10FFFF, 0x110000, 0x1F600, 99_999_999, 10**12, 10**30]
    given = [f"a&{n}b" for n in html5] + [f"&{n.rstrip(';')} &{n}" for n in html5] + [f"&#{n};x&#x{n:x}&#X{n:X};" for n in numbers]
    given += ["&#;", "&#x;", "&", "&&amp;&", "& amp;", "&amp", "&ampamp;", "&notit;", "&#0065;", "&#x00000000000041;", "&" + "a" * 40 + ";", "", "no", "&lt;p&gt; &amp;lt;"]
    given += ["".join(r.choice(["&", "#", "x", "amp", "lt", ";", " ", "not", "in", "1", "f", "é"]) for _ in range(r.randint(1, 10))) for _ in range(1500)]
    plan = spark.createDataFrame([(k, t) for k, t in enumerate(given)], "k int, t string").select("k", X.decode_entities("t").alias("d"))
    assert {x.k: x.d for x in plan.collect()} == {k: html.unescape(t) for k, t in enumerate(given)}
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
