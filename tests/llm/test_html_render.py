import random
import re
from html.parser import HTMLParser

import pytest

from sieveworks.llm.html_render import render, rendered


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("plain  \n text", "plain text"),
        ("<p>a<p>b", "a\n\nb"), ("<div>a</div><div>b</div>", "a\nb"), ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "- a\n- b\n  - c"), ("<ol start=9><li>a<li>b</ol>", "9. a\n10. b"),
        ("<title>no</title><script>if(a<b){}</script><style>p{}</style>x<!-- no -->y", "xy"),
        ("<div hidden>no</div><p style='display: none'>no<p style='visibility:hidden'>no<b style='visibility:visible'>yes</b>", "yes"),
        ("<table><tr><th>Name<th align=right>N<tr><td>Ann<td align=right>7</table>", "Name | N\nAnn  | 7"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a | b\n  | c"),
        ("<table><tr><td colspan=2>wide<tr><td>a<td>b</table>", "wide\na | b"),
        ("<pre>\n a\n  b</pre>", " a\n  b"), ("<blockquote>q</blockquote>", "> q"), ("<dl><dt>t<dd>d</dl>", "t\n    d"),
        ("a &amp; b &lt;c&gt; &nbsp;d", "a & b <c>  d"), ("1 < 2 and <3", "1 < 2 and <3"), ("<textarea>a <b></textarea>", "a <b>"),
        ("<p>a</div></p></b>b", "a\n\nb"), ("x<a href='q>r'>y</a>", "xy"), ("<a title=\"open>z", "z"), ("<![CDATA[<k>]]>", "<k>"),
        ("<head><title>t</title><body>b", "b"), ("<input type=submit value=Go><input type=hidden value=no>", "Go"),
    ],
)
def test_layout(html, text):
    assert render(html) == text


class Words(HTMLParser):
    """Only what needs no layout: all text outside scripts and titles."""

    def __init__(self):
        super().__init__()
        self.words, self.off = [], 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style") and self.off > 0

    def handle_data(self, data):
        if not self.off:
            self.words += re.findall(r"w\d+", data)


def test_no_visible_word_is_lost_or_moved_in_random_markup():
    r = random.Random(4)
    tags = ["p", "div", "b", "ul", "li", "ol", "blockquote", "dl", "dd", "dt", "span", "h2", "section", "pre", "a"]
    for n in range(300):
        parts = []
        for k in range(r.randrange(60)):
            t = r.choice(tags)
            parts.append(r.choice([f"<{t}>", f"</{t}>", f" w{k} ", f"w{k}<br>", "<script>w0</script>", "&amp;"]))
        html = "".join(parts)
        p = Words()
        p.feed(html)
        p.close()
        assert re.findall(r"w\d+", render(html)) == p.words, html


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p style='backface-visibility: hidden'>a", "a"), ("<p style='content-visibility: auto'>a", "a"), ("<p style='--display: none'>a", "a"), ("<p style='x-display:none;color:red'>a", "a"),
        ("<p style='visibility: inherit'>a", "a"), ("<p style='visibility: initial'>a", "a"), ("<p style='visibility: unset'>a", "a"), ("<p style='visibility: nonsense'>a", "a"),
        ("<div style='visibility:hidden'>no<p style='visibility: inherit'>no<p style='visibility:initial'>a</div>", "a"), ("<p style='visibility:collapse'>no", ""),
        ("<p style='display:none;display:block'>a", "a"), ("<p style='DISPLAY : NONE'>no", ""), ("<p style='color:red; display:none !important; display:block'>no", ""), ("<p style='/* display:none */color:red'>a", "a"),
        ("<xmp>a <b> &amp;</xmp>c", "a <b> &amp;\n\nc"), ("x<xmp>\n  y</xmp>", "x\n\n\n  y"),
        (f"<table><tr><td>{'w' * 70}<td>b<tr><td>c<td>d</table>", f"{'w' * 70} | b\n{'c'.ljust(70)} | d"),
        ("<table><tr><td colspan=150>a<td>z</table>", "a" + " " * (3 * 149 - 1) + " | z"),
    ],
)
def test_visibility_and_widths(html, text):
    assert render(html) == text


def test_visibility_of_random_nested_styles():
    r = random.Random(8)
    values = ["", "visibility:hidden", "visibility:visible", "visibility:inherit", "visibility:initial", "visibility: collapse;", "display:none", "display:block", "color:red;visibility:hidden", "content-visibility:hidden", "--visibility:hidden"]
    for _ in range(300):
        parts, want, stack = [], [], [(True, True)]
        for k in range(40):
            if r.random() < 0.4 and len(stack) > 1:
                parts.append("</div>")
                stack.pop()
            elif r.random() < 0.6:
                value = r.choice(values)
                parts.append(f'<div style="{value}">')
                box, seen = stack[-1]
                said = value.split("visibility:")[-1].strip(" ;") if re.search(r"(^|;)visibility", value) else ""
                stack.append((box and value != "display:none", {"hidden": False, "collapse": False, "visible": True, "initial": True}.get(said, seen)))
            parts.append(f" w{k} ")
            if all(stack[-1]):
                want.append(f"w{k}")
        assert re.findall(r"w\d+", render("".join(parts))) == want, "".join(parts)


def test_padding_is_bounded():
    page = "<table><tr><td>" + "w" * 100_000 + "<td>b" + "<tr><td>c<td>d" * 2000 + "</table>"
    assert len(render(page)) < 3 * len(page) and "c | d" in render(page)


def test_deep_and_hostile_pages_end():
    assert render("<div>" * 50_000 + "x") == "x"
    assert render("<table><tr><td>" * 300 + "x").count("x") == 1
    assert "x" in render("<" * 20_000 + "x") and "x" in render('<a b="' * 2000 + "x>x")


def test_frame(spark):
    df = spark.createDataFrame([(1, "<p>a", "u", 3), (1, "<p>a", "u", 3), (None, None, None, None), (2, "", "u", 1)], "page_id long, html string, url string, text int")
    assert sorted(map(tuple, rendered(df).collect()), key=str) == [(1, "a", 1, 1), (1, "a", 1, 1), (2, "", 0, 0), (None, "", 0, 0)]
    assert rendered(df.limit(0)).count() == 0


def test_a_table_is_laid_out_alike_at_every_length():
    """Rows of the same widths stand alike, however many there are and however long another cell is."""
    head = "<tr><td>aa<td>b<td>c<tr><td>a<td>" + "b" * 250 + "<td>c"
    few, many = (render(f"<table>{head}" + "<tr><td>x<td>y<td>z" * n + "</table>").split("\n") for n in (2, 20_000))
    assert few[2] == "x  | y" + " " * 249 + " | z" and set(many[2:]) == {few[2]}
    long = render("<table><tr><td>" + "w" * 100_000 + "<td>b" + "<tr><td>cc<td>d<tr><td>c<td>d" * 500 + "</table>").split("\n")
    assert long[1:3] == ["cc | d", "c  | d"]
    spans = render("<table><tr>" + "".join(f"<td>{'v' * 200}" for _ in range(30)) + "<tr><td colspan=29>s<td>t</table>").split("\n")
    assert spans[1] == "s" + " " * (255 + 3 * 28) + " | t"
