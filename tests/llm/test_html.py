import random
import re

import pytest
from lodestar.llm import html

CASES = {
    "<p>One<p>Two <b>bold<br>next</p>tail": "One\n\nTwo bold\nnext\n\ntail",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "- a\n- b\n  - c\n- d",
    "<ol start=9><li>a<li>b<p>more</ol>x": "9. a\n10. b\n\n    more\n\nx",
    "<table><tr><th>Name<th>N<tr><td>Anna<td>1<tr><td colspan=2>wide cell here</table>": "Name  N\nAnna  1\nwide cell here",
    "<table><caption>C</caption><tbody><tr><td>a<td><p>b<p>c<tr><td>long<td>d</table>": "C\na     b\n\n      c\nlong  d",
    "<head><title>t</title><style>p{}</style></head><body>x<script>var t='</p>';</script>y<!-- no -->z": "xyz",
    "a<div hidden>b</div><span style='display: none'>c</span><input type=hidden><p style=\"visibility:hidden\">d</p>e": "ae",
    "<pre>  a\n   b</pre>c": "  a\n   b\n\nc",
    "&lt;b&gt; &amp; &copy; 1 < 2": "<b> & © 1 < 2",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n    d\nu\n    e",
    "<select><option>a<option>b</select>": "a\nb",
    "x</p>y</div></table>z": "x\n\nyz",
    "<a title='>'>t</a><a title=\"x>u": "tu",
    "": "", "<p> \n </p>": "", "<div": "", "plain  text\n here": "plain text here",
    "<h1>H</h1><hr>t<blockquote>q</blockquote>": "H\n\n---\n\nt\n\n    q",
    "<b>a</b> <i>b</i><i> c</i>": "a b c",
}


@pytest.mark.parametrize("page", CASES)
def test_rendering(page):
    assert html.render(page) == CASES[page]


def test_no_visible_word_is_lost_or_added():
    rng = random.Random(4)
    tags = "div p span b li ul ol table tr td th tbody h2 section blockquote dd dt dl pre option em".split()
    for n in range(300):
        parts, want = [], []
        for k in range(rng.randint(0, 40)):
            kind = rng.random()
            if kind < 0.4:
                want.append(f"w{n}x{k}")
                parts.append(f" {want[-1]} ")
            elif kind < 0.75:
                parts.append(f"<{rng.choice(tags)}>")
            else:
                parts.append(f"</{rng.choice(tags)}>")
        assert sorted(re.findall(r"w\d+x\d+", html.render("".join(parts)))) == sorted(want)


def test_deep_and_hostile_pages():
    deep = "<div>" * 50_000 + "in" + "</div>" * 50_000 + "out"
    assert html.render(deep).split() == ["in", "out"]
    assert html.render("<ul><li>" * 3000 + "x").split()[-1] == "x"
    assert html.render("<a b=\"'" * 2000 + ">") == ""
    html.render("<" * 20_000 + "</" * 20_000)


def test_frame(spark):
    rows = [(1, "<p>a"), (1, "<p>a"), (None, "<p>b"), (2, None), (3, "")]
    pages = spark.createDataFrame([(*r, "u", "t", 1) for r in rows], "page_id long, html string, url string, text string, n_chars int")
    got = sorted(((r.page_id is None, r.page_id or 0, r.text, r.n_lines, r.n_chars) for r in html.extract_text(pages).collect()), key=str)
    assert got == sorted([(False, 1, "a", 1, 1), (False, 1, "a", 1, 1), (True, 0, "b", 1, 1), (False, 2, None, None, None), (False, 3, "", 0, 0)], key=str)
    assert html.extract_text(pages.limit(0)).count() == 0


def test_text_of_formulas_and_drawings_is_kept():
    assert html.render("x <math><mi>a</mi><mo>+</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> y") == "x a+ 1 2 y"
    assert html.render("<math><semantics><mi>a</mi><annotation encoding='x'>b</annotation></semantics></math>c") == "ac"
    assert html.render("<svg><title>t</title><desc>d</desc><metadata>m</metadata><path d='a'/><text x=1>one <tspan>two</tspan></text>"
                       "<text>three<![CDATA[ <4>]]></text> loose</svg>end") == "one two\nthree <4>\nend"
    assert html.render("<svg><defs/><style/><text display=none>no</text><foreignObject><p>a<p>b</foreignObject></svg>") == "a\n\nb"
    assert html.render("<svg><desc>no<p hidden>x</desc><g><p>out") == "out"


def test_spanned_rows_keep_their_columns():
    assert html.render("<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e<tr><td>f<td>g<td>h</table>") == "a  b  c\n   d  e\nf  g  h"
    assert html.render("<table><tr><td>a<td rowspan=0 colspan=2>b<td>c<tr><td>d<td>e<tbody><tr><td>f<td>g<td>h</table>") == \
        "a  b     c\nd        e\nf  g  h"
    assert html.render("<table><tr><td rowspan=3>a<td>b<tr><td></td></tr><tr><td>c</table>") == "a  b\n   c"


def test_depth_keeps_cells_apart_and_hidden_text_out():
    deep = "<div>" * 1000
    assert html.render(deep + "<p hidden>no</p><table><tr><td>a</td><td>b</td></table><b style='display:none'>no</b>c") == "a  b\n\nc"
    nested = "<table><tr><td>a</td><td>" * 1000 + "x</td><td>y"
    assert html.render(nested).split() == ["a"] * 1000 + ["x", "y"]
