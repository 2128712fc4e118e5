"""Text functions as Column expressions, all in the JVM."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from html import unescape
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import RoleRules, SnippetRules

#: White space as an explicit class, equal in every regular-expression dialect in use.
WS = r"[\t-\r\x1c-\x20\x85\xa0  -     　]"

ELLIPSIS = " […] "


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(_col(c), rf"\A{WS}+|{WS}+\z", "")


def one_line(c) -> Column:
    """white-space runs as one space, stripped; null becomes ''."""
    return F.btrim(F.regexp_replace(F.coalesce(_col(c), F.lit("")), f"{WS}+", " "))


def match_text(c) -> Column:
    """white-space runs as one space, lower case, not stripped."""
    return F.lower(F.regexp_replace(F.coalesce(_col(c), F.lit("")), f"{WS}+", " "))


def strip_tags(c) -> Column:
    """Each tag becomes a space; null becomes ''."""
    return F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"<[^<]+?>", " ")


#: The five markup entities and a few frequent ones.
COMMON = ("&lt;", "&gt;", "&quot;", "&#x27;", "&#39;", "&nbsp;", "&copy;", "&middot;", "&amp;")


def decode_common(c) -> Column:
    """The references of COMMON, in the JVM; the ampersand last."""
    out = _col(c)
    for name in COMMON:
        out = F.replace(out, F.lit(name), F.lit(unescape(name)))
    return out


#: What a reference to a number outside the allowed ones becomes: C1 controls stand for the characters of code page 1252.
_NUMBERS = {0: "\ufffd", 13: "\r"} | {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}


def _map(pairs: dict, kind: str) -> Column:
    """A map as one constant, which the optimizer reads once."""
    return F.from_json(F.lit(json.dumps(pairs)), kind)


@lru_cache(maxsize=1)
def _names() -> tuple[dict[str, dict[str, str]], str]:
    """The names that end in a semicolon by their first two characters, and a pattern of those that needn't, longest first."""
    by: dict[str, dict[str, str]] = {}
    for name, text in html5.items():
        if name.endswith(";"):
            by.setdefault(name[:2], {})[name] = text
    return by, "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))


def _code_point(n: Column) -> Column:
    """The text of a reference to a number, by the rules of HTML; n is null if it is over any code point."""
    special = F.element_at(_map(_NUMBERS, "map<string,string>"), n.cast("string"))
    beyond = n.isNull() | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
    none = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (F.pmod(n, F.lit(0x10000)) >= 0xFFFE)
    plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return F.when(beyond, "\ufffd").when(special.isNotNull(), special).when(none, "").otherwise(plain)


def _reference(part: Column) -> Column:
    """What stands after an ampersand, the reference at its start decoded."""
    digits, hexed = F.regexp_extract(part, r"^#([0-9]+);?", 1), F.regexp_extract(part, r"^#[xX]([0-9a-fA-F]+);?", 1)
    small = lambda x, base, most: F.when(F.length(F.ltrim(x, F.lit("0"))) <= most, F.conv(F.concat(F.lit("0"), x), base, 10).cast("long"))
    number = _code_point(F.when(digits != "", small(digits, 10, 9)).otherwise(small(hexed, 16, 7)))
    rest = F.regexp_replace(part, r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", "")
    by, loose = _names()
    name = F.regexp_extract(part, r"^[^\t\n\f <&#;]{1,32};", 0)
    found = F.element_at(F.element_at(_map(by, "map<string,map<string,string>>"), F.substring(name, 1, 2)), name)
    short = F.regexp_extract(part, rf"^(?:{loose})", 0)
    bare = F.element_at(_map({n: t for n, t in html5.items() if not n.endswith(";")}, "map<string,string>"), short)
    return (
        F.when((digits != "") | (hexed != ""), F.concat(number, rest))
        .when(found.isNotNull(), F.concat(found, F.substring(part, F.length(name) + 1, F.length(part))))
        .when(short != "", F.concat(bare, F.substring(part, F.length(short) + 1, F.length(part))))
        .otherwise(F.concat(F.lit("&"), part))
    )


def _one_of(part: Column, only: tuple[str, ...]) -> Column:
    """What stands after an ampersand, decoded if just these references stand at its start, letter by letter."""
    found = F.regexp_extract(part, "^(?:" + "|".join(re.escape(r[1:]) for r in only) + ")", 0)
    char = F.element_at(_map({r[1:]: unescape(r) for r in only}, "map<string,string>"), found)
    return F.when(found != "", F.concat(char, F.substring(part, F.length(found) + 1, F.length(part)))).otherwise(F.concat(F.lit("&"), part))


def decode_entities(c, only: tuple[str, ...] | None = None) -> Column:
    """all HTML references, named with or without their semicolon (the longest name that fits) and numbered, in the JVM.

    only: none but these whole references, written as "&amp;"; others stay as they are.
    """
    c = _col(c)
    parts = F.split(c, "&")
    decode = _reference if only is None else lambda part: _one_of(part, only)
    decoded = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), decode)
    return F.when(c.contains("&"), F.concat(F.get(parts, F.lit(0)), F.array_join(decoded, ""))).otherwise(c)


def strip_html(c, only: tuple[str, ...] | None = None) -> Column:
    """tags out, then entities decoded, see decode_entities(); bodies of scripts and escaped markup stay."""
    return decode_entities(strip_tags(c), only)


def matches(c, pattern: str) -> Column:
    """a case-insensitive search, by Unicode case."""
    return _col(c).rlike(f"(?iu){pattern}")


def starts(c, pattern: str) -> Column:
    """The same, at the start only."""
    return _col(c).rlike(f"(?iu)^(?:{pattern})")


def snippet(c, rules: SnippetRules = SnippetRules()) -> Column:
    """the head, and the sentences after it that hold a term, up to the cap."""
    text = strip(F.coalesce(_col(c), F.lit("")))
    head, tail = F.substring(text, 1, rules.head), F.substring(text, rules.head + 1, 1 << 30)
    parts = F.split(tail, rf"(?<=[.!?\n]){WS}+")
    hits = F.transform(F.filter(parts, lambda s: matches(s, rules.terms)), strip)
    joined = F.substring(F.concat(head, F.lit(ELLIPSIS), F.array_join(hits, " ")), 1, rules.cap)
    return F.when((tail == "") | (F.size(hits) == 0), head).otherwise(joined)


def before_paragraph(c) -> Column:
    """what stands before the first <p> or line feed."""
    return F.get(F.split(_col(c), "<p>|\n", 2), F.lit(0))


def title_parts(c) -> Column:
    """F8: company and role around the first ': '; without a role the whole title is the role."""
    title = F.coalesce(_col(c), F.lit(""))
    parts = F.split(title, ": ", 2)
    role = F.coalesce(strip(F.get(parts, F.lit(1))), F.lit(""))
    plain = F.coalesce(F.get(parts, F.lit(1)), F.lit("")) == ""
    return F.when(plain, F.struct(F.lit("").alias("company"), strip(title).alias("role"))).otherwise(F.struct(strip(F.get(parts, F.lit(0))).alias("company"), role.alias("role")))


def header_fields(c) -> Column:
    """the fields between bars, stripped; none of an empty header."""
    header = _col(c)
    return F.when(header == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(header, r"\|"), strip))


def pick_role(fields, rules: RoleRules = RoleRules()) -> Column:
    """the first field after the company that names a role, else the first that is neither terms nor a link, else all of them."""
    rest = F.filter(F.slice(_col(fields), 2, 1 << 30), lambda f: f != "")
    named = F.get(F.filter(rest, lambda f: matches(f, rules.roles) & ~starts(f, rules.urls)), F.lit(0))
    other = F.get(F.filter(rest, lambda f: ~starts(f, rules.metadata) & ~starts(f, rules.urls)), F.lit(0))
    return F.substring(F.coalesce(named, other, F.array_join(rest, " | ")), 1, rules.cap)


def near(c, a: str, b: str, window: int) -> Column:
    """A hit of a and a hit of b whose starts lie at most window characters apart."""
    return _col(c).rlike(rf"(?iu)(?s)(?=(?:{a}))(?=.{{0,{window}}}(?:{b}))|(?=(?:{b}))(?=.{{0,{window}}}(?:{a}))")


def present(c, default) -> Column:
    """the value unless it is null or empty."""
    return F.coalesce(F.nullif(_col(c), F.lit("")), _col(default))


def optional_int(c) -> Column:
    """null for blank, an error for other than digits."""
    return F.nullif(strip(_col(c)), F.lit("")).cast("int")


def elapsed_seconds(start, end) -> Column:
    """F16: seconds to two places, null without a start."""
    return F.round((F.unix_micros(_col(end)) - F.unix_micros(_col(start))) / 1e6, 2)


def json_of(*cols) -> Column:
    """a JSON object that keeps nulls."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
