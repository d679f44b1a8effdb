import random

import pytest

from shelfmark.llm import html_text

CASES = [
    ("<p>One <b>two</b>\n three<p>Four", "One two three\n\nFour"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
    ("<ol start=3><li>x<li value=9>y<li>z</ol>", "3. x\n9. y\n10. z"),
    ("<ol reversed><li>x<li>y</ol>", "2. x\n1. y"),
    ("<table><tr><th>Name<th>Count<tr><td>apple<td>12<tr><td>pear and plum<td>3</table>",
     "Name           Count\napple          12\npear and plum  3"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    ("<table><td>a<br>b<td>c</table>", "a  c\nb"),
    ("a<script>x</p>y</script><style>z</style><!-- c -->b", "ab"),
    ("<style>.x, p.gone{display:none}</style><div class=x>no</div><p class='gone y'>no<p>yes", "yes"),
    ("<span hidden>h</span><span style='display: none'>n</span>end", "end"),
    ("<details><summary>Sum</summary>closed</details><details open>open</details>", "Sum\nopen"),
    ("<pre>  keep\n   this</pre>", "  keep\n   this"),
    ("<dl><dt>t<dd>d</dl>", "t\n    d"),
    ("&copy; A&amp;B &#x263a; &unknown;", "© A&B ☺ &unknown;"),
    ("a<br><br>b", "a\n\nb"),
    ("one <i>two</i><i> three</i>", "one two three"),
    ("<h1>T</h1>text<hr>more", "T\n\ntext\n\nmore"),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"),
    ("a < b and <notclosed", "a < b and"),
    ("", ""), ("   ", ""), (None, ""),
]


@pytest.mark.parametrize("source, text", CASES)
def test_layout(source, text):
    assert html_text.extract(source)[1] == text


SHOWN = "<div class=x>text</div>end"
STYLES = [
    ("@media print { .x { display:none } }", True),
    ("@media (max-width:600px) { .x { display:none } }", True),
    ("@media screen and (max-width: 40em), print { .y{color:red} .x { display:none } }", True),
    ("@media (width <= 600px) { .x { display:none } }", True),
    ("@media (400px <= width <= 700px) { .x { display:none } }", True),
    ("@media (prefers-color-scheme: dark) { .x { display:none } }", True),
    ("@media not screen { .x { display:none } }", True),
    ("@media print { @supports (display:grid) { .x { display:none } } } .y { display:none }", True),
    ("@media print { .y { color:red } } .x { display:none }", False),
    ("@media screen { .x { display:none } }", False),
    ("@media only screen and (min-width: 768px) { .x { display:none } }", False),
    ("@media not print { .x { display:none } }", False),
    ("@media print, (width > 600px) { .x { display:none } }", False),
    ("@supports (display:grid) { @media all { .x { display:none } } }", False),
    ("@import 'a.css'; .x { display:none }", False),
    (".x { content:'}'; display:none }", False),
    (".x { display:none } @media (min-width:768px) { .x { display:block } }", True),
    (".x { display:none } .x { display:flex }", True),
    (".x { display:flex } .x { display:none }", False),
    (".x { display:none !important } .x { display:flex }", False),
    ("div.x { display:none } .x { display:block }", False),
    (".x { display:none } div { display:block }", False),
    (".x { visibility:hidden } .x { visibility:visible }", True),
    (".y { color:red; .x { display:none } }", True),
    ("@keyframes f { from { display:none } } .x { color:red", True),
    (".x { display:none", False),
]


@pytest.mark.parametrize("style, visible", STYLES)
def test_styles_hide_what_they_hide_on_a_wide_screen(style, visible):
    assert html_text.extract(f"<style>{style}</style>{SHOWN}")[1] == ("text\nend" if visible else "end")


@pytest.mark.parametrize("source, text", [
    ("<style>.x{display:none}</style><div class=x style='display:block'>a</div>b", "a\nb"),
    ("<style>.x{display:none!important}</style><div class=x style='display:block'>a</div>b", "b"),
    ("<style>.x{display:block}</style><div class=x style='display:none'>a</div>b", "b"),
    ("<style media=print>.x{display:none}</style><div class=x>a</div>b", "a\nb"),
    ("<style media=screen>.x{display:none}</style><div class=x>a</div>b", "b"),
    ("<style>.y{color:red</style><style>.x{display:none}</style><div class=x>a</div>b", "b"),
    ("<div hidden style='display:block'>a</div>b", "a\nb"),
    ("<div style='visibility:hidden'>a<p style='visibility:visible'>b</p></div>c", "b\n\nc"),
    ("<div style='visibility:hidden'>a<p>b</p><input type=submit value=v></div>c", "c"),
])
def test_the_winning_style_counts(source, text):
    assert html_text.extract(source)[1] == text


def test_title():
    assert html_text.extract("<title> A \n&amp; B</title>x") == ("A & B", "x")


def test_deep_and_broken_pages():
    assert html_text.extract("<div>" * 50_000 + "deep")[1] == "deep"
    assert html_text.extract("<table>" * 300 + "<td>" * 300 + "x")[1].strip() == "x"
    assert "y" in html_text.extract("</p></div></table>y<li>z")[1]


def test_wide_cells_do_not_pad_the_others():
    source = "<table><tr><td>" + "x" * 50_000 + "<td>b" + "<tr><td>a<td>b" * 2000 + "</table>"
    assert len(html_text.extract(source)[1]) < 70_000


def test_pages(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a"), (None, None, None), (1, "u", "<p>a")],
                                  "page_id long, url string, html string")
    got = html_text.page_texts(pages).collect()
    assert sorted(r["text"] for r in got) == ["", "a", "a"]
    assert html_text.page_texts(pages.limit(0)).count() == 0


def test_marked_sections_are_comments():
    assert html_text.extract("a<![foo[bar]]>b<![ foo>c<![if IE]>d<![endif]>e<![")[1] == "abcde"


def test_random_markup_never_fails():
    rng = random.Random(1)
    bits = ["<", "</", ">", "<!", "<![", "[", "]]>", "<!--", "-->", '"', "'", "=", "/", "&", "&#", "&#x", ";", "table", "td",
            "tr", "li", "ul", "p", "a", "style", "script", " ", "\n", "x", "<ul><li>", "<table>", "<td>", "<?", "\0", "é",
            "<!doctype", "select", "option", "svg", "title", "textarea", "plaintext", "noscript", "iframe"]
    for _ in range(10_000):
        html_text.extract("".join(rng.choice(bits) for _ in range(rng.randint(1, 40))))


@pytest.mark.parametrize("one", ["<ul><li>x", "<ol><li>x", "<blockquote>x", "<dl><dd>x", "<table><tr><td>x"])
def test_deep_nesting_keeps_all_text_and_stays_small(one):
    text = html_text.extract(one * 20_000)[1]
    assert text.count("x") == 20_000 and len(text) < 4_000_000
    # Down to the bound every level is set apart, as before.
    assert html_text.extract("<ul><li>x" * 3)[1] == "- x\n  - x\n    - x"


def test_numbers_go_on_below_the_bound(monkeypatch):
    monkeypatch.setattr(html_text, "DEEPEST", 1)
    assert html_text.extract("<ul><li>a<ol><li>b<li>c</ol></ul>")[1] == "- a\n  1. b\n  2. c"
    assert html_text.extract("<table><tr><td>a<table><tr><td>b<td>c</table></table>")[1] == "a\n\nb\nc"


def test_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a", "t", "x", "p")],
                                  "page_id long, url string, html string, title string, text string, page string")
    assert [tuple(r) for r in html_text.page_texts(pages).collect()] == [(1, "u", None, "a")]
