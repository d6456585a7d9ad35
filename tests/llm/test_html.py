"""Rendering of pages."""
import pytest

from early_warning.llm.html_text import extract_text, render

CASES = {
    "<p>a <b>b</b>\n  c<p>d": "a b c\n\nd",
    "x<br>y<br><br>z": "x\ny\n\nz",
    "<div>a<div>b</div>c</div>": "a\nb\nc",
    "<h1>T</h1>text": "T\n\ntext",
    "<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>e": "- a\n- b\n  3. c\n  4. d\n\ne",
    "<table><tr><th>Name<th>Qty<tr><td>apple<td>10<tr><td>fig<td>7</table>": "Name   Qty\napple  10\nfig    7",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c</table>": "a  b\n   c",
    "<table><tr><td colspan=2>wide<tr><td>x<td>y</table>": "wide\nx  y",
    "<table>stray<tr><td>a<p>b</table>": "stray\n\na\n\nb",
    "<pre>a\n  b</pre>c": "a\n  b\n\nc",
    "<script>if (a<b) x</script><style>p{}</style><title>t</title>v": "v",
    "a<span hidden>no</span><i style='display : none'>no</i>b": "ab",
    "<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b></div>": "yes",
    "<style>.x,p#y{display:none} b{color:red}</style><b class='z x'>no</b><p id=y>no<p id=z>yes": "yes",
    "<details><summary>s</summary>no</details><details open><summary>s</summary>yes</details>": "s\ns\nyes",
    "a&amp;b &lt;c&gt; &eacute;&#8212;": "a&b <c> é—",
    "<!-- <p>no</p> -->a<!doctype html>b</ >c": "abc",
    "<select><option>one<option>two</select>": "one\ntwo",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e",
    "<blockquote>q<br>r</blockquote>s": "  q\n  r\n\ns",
    "<b>a<p>b</b>c</p>d": "a\n\nbc\n\nd",
    "<a title='x>y' data-z=\"<p>\">t</a>": "t",
    "<p>unclosed <a href='": "unclosed",
    "<input type=submit value=Go><input type=hidden value=no>": "Go",
    "<table><tr><td>a<table><tr><td>x<td>y</table><td>b</table>": "a     b\n\nx  y",
    "<style>@media print { .a{display:none} .b{display:none} } .c{display:none}</style><b class=a>x</b><b class=b>y<b class=c>no": "xy",
    "<style>@media screen{.a{display:none}} @import 'x'; .d{display:none}</style><b class=a>no</b><b class=d>no</b>y": "y",
    "<style>.m{display:none} .m{display:block}</style><b class=m>x": "x",
    "<style>#i{display:none} p{display:block}</style><p id=i>no</p>x": "x",
    "<style>.m{display:none !important} .m{display:block}</style><b class=m>no</b>x": "x",
    "<style>/* } .x{ */ .h /* y */ {color:red; display:none}</style><b class=h>no</b><b class=x>x": "x",
    "<style>.h{visibility:hidden} i.h{visibility:visible}</style><b class=h>no<i class=h>x</i></b>": "x",
    "<style>.h{display:none}</style><b class=h style='display:inline'>x": "x",
    "<input type=text value=shown> <input value=also> <input type=password value=no>": "shown also",
    "<table><tr><td>k<td>" + "<br>".join("abcdefghijklmnopqrstuvwxyz") + "<tr><td>l<td>z</table>":
        "k  " + "\n   ".join("abcdefghijklmnopqrstuvwxyz") + "\nl  z",
    "<table role=presentation><tr><td>a<td>b<tr><td>c</table>": "a\nb\nc",
    "": "",
}


@pytest.mark.parametrize("page", CASES)
def test_rendering(page):
    assert render(page) == CASES[page]


def test_alignment_counts_the_widest_cell():
    rows = [("a", "bbbb", "c"), ("aaaa", "b", "cc"), ("", "b", "c")]
    page = "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) for r in rows) + "</table>"
    lines = render(page).split("\n")
    assert [x.index("b") for x in lines] == [6, 6, 6] and [x.index("c") for x in lines] == [12, 12, 12]


def test_layout_tables_stay_in_proportion():
    cell = "<p>" + "<p>".join("word " * 50 for _ in range(200))
    page = "<table><tr>" + f"<td>{cell}</td>" * 5 + "</table>"
    assert len(render(page)) < 1.1 * len(page)
    assert len(render("<table><tr><td colspan=999999999>a<td rowspan=999999999>b" + "<tr><td>c" * 500 + "</table>")) < 50_000


def test_hostile_pages_take_linear_time():
    for page in ("<div>" * 50_000 + "x", "<a " * 100_000, '<a "' * 100_000, "<b title='" * 50_000, "<!--" * 50_000,
                 "<p><b>" * 20_000, "<style>" + "x" * 300_000, "<table><tr><td>" * 1000 + "x", "</p>" * 50_000,
                 "&" * 50_000, "<ul><li>" * 3000 + "x"):
        render(page)


def test_query(spark):
    rows = [(1, "<p>a<p>b", "own"), (2, None, "own"), (None, "", "own"), (2, None, "own")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = sorted((tuple(r) for r in extract_text(pages).collect()), key=repr)
    assert got == sorted([(1, "a\n\nb", 3, 4), (2, "", 0, 0), (None, "", 0, 0), (2, "", 0, 0)], key=repr)
    assert extract_text(pages.limit(0)).count() == 0


def test_all_visible_words_are_there(spark, sf_dir):
    """On the given pages, whose markup is regular, every word between tags outside the head is rendered in order."""
    import html
    import re
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        body = re.sub(r"<head>.*?</head>|<!--.*?-->", " ", r.html, flags=re.S)
        want = html.unescape(re.sub(r"</?(?:p|div|li|ul|h1|br|nav|article|footer|body|html)\b[^>]*>", " ", body))
        want = re.sub(r"<[^>]*>", "", want).split()
        assert [w for w in render(r.html).split() if w != "-"] == [w for w in want if w != "-"]
