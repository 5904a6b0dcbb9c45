import re
from html import unescape
from html.parser import HTMLParser

import pytest

from basketry.llm import html as H
from basketry.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>one<p>two", "one\n\ntwo"),  # implied </p>
        ("a<div>b</div>c", "a\nb\nc"),
        ("<h1>T</h1>x  <b>y</b>\n z<br>w", "T\n\nx y z\nw"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
        ("<ol start=9><li>a<li value=20>b<li>c</ol>", "9. a\n20. b\n21. c"),
        ("<table><tr><th>name<th>n<tr><td>apple pie<td>3</table>", "name       n\napple pie  3"),
        ("<table><td>a<td>b</table>", "a  b"),  # implied row
        ("<table><tr><td rowspan=2>x<td>1<tr><td>2</table>", "x  1\n   2"),
        ("<table><tr><td colspan=2>wide<td>z<tr><td>a<td>b<td>c</table>", "wide  z\na  b  c"),
        ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
        ("<table>out<tr><td>in</table>", "out\n\nin"),  # moved in front of the table
        ("<table><b>x</b><tr><td>in<td>side</table>", "x\n\nin  side"),
        ("<table><tr><td><table><tr><td>i<td>j</table><td>k</table>", "i  j  k"),
        ("<pre>\n a\n  b</pre>", " a\n  b"),
        ("<dl><dt>t<dd>d</dl>", "t\n  d"),
        ("<blockquote>q<p>r</blockquote>", "  q\n\n  r"),
        ("<script>if (a<b) x('</p>')</script>y<style>p{}</style><!-- c > --><template>t</template>", "y"),
        ("<div hidden>a</div><p style='display : none'>b</p><i style='visibility:hidden'>c</i>d", "d"),
        ("<style>.x, #y{color:red;display:none}</style><p class='q x'>a<p id=y>b<p class=xx>c", "c"),
        ("<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details>", "s\nt\nyes"),
        ("a &amp; b&nbsp;c &lt;i&gt; &unknown; &#8364;", "a & b\xa0c <i> &unknown; €"),
        ("<a href='x>y' title=\"p>q\">l</a> 1 < 2 <3", "l 1 < 2 <3"),
        ("<title>no</title><body>yes<body>again", "yesagain"),
        ("</p>x</div></b>", "x"),
        ("<textarea>a<b></textarea>", "a<b>"),
        ("", ""),
        ("<unclosed", "<unclosed"),
        ("<!-- open", ""),
        ("<script>open", ""),
    ],
)
def test_render(page, text):
    assert H.render(page) == text


def test_deep_nesting_and_long_pages():
    assert H.render("<div>" * 50_000 + "x") == "x"
    assert H.render("<table><tr><td>" * 300 + "x") == "x"
    assert len(H.render("<p>word " * 50_000).split()) == 50_000


class Words(HTMLParser):
    """All words outside hidden elements, in order, without layout."""

    def __init__(self):
        super().__init__()
        self.skip, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "title"):
            self.skip += 1
        elif tag not in ("b", "a"):
            self.out.append(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "title"):
            self.skip -= 1
        elif tag not in ("b", "a"):
            self.out.append(" ")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def test_all_visible_words_of_every_page(spark):
    """Against the standard library's parser, list bullets aside."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = registry.op3_html(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        words = Words()
        words.feed(pages[r["page_id"]] or "")
        want = [w for w in re.split(r"[ \t\n\r\f]+", "".join(words.out)) if w]
        assert [w for w in re.split(r"[ \t\n\r\f]+", r["text"] or "") if w and w != "-"] == want


def naive_layout(html):
    """Lines of the kinds of elements that the pages have, by one scan: blocks
    on lines of their own, blank lines around paragraphs, headings and lists,
    bullets, line breaks; no tree."""
    html = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->|<!DOCTYPE[^>]*>", "", html)
    out, line, gap, mark, p_open = [], "", 0, "", False

    def flush(blank=0, forced=False):
        nonlocal line, gap, mark
        words = [w for w in re.split(r"[ \t\n\r\f]+", line) if w]
        if words:
            out.extend([""] * (gap if out else 0))
            out.append(mark + " ".join(words))
            gap, mark = 0, ""
        elif forced and out:
            gap += 1
        line, gap = "", max(gap, blank)

    for tag, data in re.findall(r"<(/?[a-z0-9]+)[^>]*>|([^<]+)", html):
        name = tag.removeprefix("/")
        if data:
            line += unescape(data)
        elif name == "br":
            flush(forced=True)
        elif name in ("p", "h1", "ul", "li", "nav", "div", "article", "footer", "html", "body"):
            flush(int(p_open or name in ("p", "h1", "ul")))  # any block ends an open paragraph
            p_open, mark = tag == "p", "- " if tag == "li" else ""
        else:
            assert name in ("a", "b"), name
    flush()
    return "\n".join(out)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_layout_of_every_page(spark, sf):
    where = f"/root/testdata/sf{sf}"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{where}/pages.parquet").collect()}
    got = {r["page_id"]: r["text"] for r in registry.op3_html(spark, where).collect()}
    assert set(got) == set(pages)
    for k, page in pages.items():
        assert got[k] == (None if page is None else naive_layout(page))


@pytest.mark.parametrize("unit", ["<a ", '<a b="', '<a =">"', "<", "<a", "<!-", '<a b="\'><b c=\'>', "</a ", "<style>a{", "<style>@media x{", '<a y="> " ', "<!-- -->", "<!--", "<![CDATA[x", "&", "<table><tr>", "<p><form>"])
@pytest.mark.parametrize("tail", ["", ">", '">x'])
def test_broken_pages_take_linear_time(unit, tail):
    """A megabyte of each; quadratic time would be minutes."""
    import time

    start = time.process_time()
    H.render(unit * (1_000_000 // len(unit)) + tail)
    assert time.process_time() - start < 8


@pytest.mark.parametrize(
    "page, text",
    [
        ("<!-- a --!>rest", "rest"),
        ("<!-->x", "x"),
        ("<!--->x", "x"),
        ("<!-- a -- b --->x", "x"),
        ("<style>@media print{.m{display:none}}</style><p class=m>a", "a"),
        ("<style>@media screen, print{.m{display:none}}</style><p class=m>a<p>b", "b"),
        ("<style>@media (max-width:9px){.m{display:none}} .n{display:none}</style><p class=m>a<p class=n>b", "a"),
        ("<style>/* .m{ */ .n{display:none} @import 'x'; .o{content:'}';display:none}</style><p class=m>a<p class=n>b<p class=o>c", "a"),
        ("<style>.m{display:none}</style><p class=m style='display:block'>a", "a"),
        ("<style>.m{display:none !important}</style><p class=m style='display:block'>a<p>b", "b"),
        ("<style>.m{display:none}.m{display:inline}</style><p class=m>a", "a"),
        ("<style>#i{display:block}p{display:none}</style><p id=i>a<p>b", "a"),
        ("<p hidden style='display:block'>a<p hidden>b", "a"),
        ("<!DOCTYPE html><style>.Foo{display:none}</style><p class=foo>a<p class=Foo>b", "a"),
        ("<style>.Foo{display:none}</style><p class=foo>a<p>b", "b"),  # without a document type case does not count
        ("<div style='visibility:hidden'>a<b style='visibility:visible'>b</b>c</div>d", "b\nd"),
        ("<object data=x><p>fallback</object>", "fallback"),
        ("<table><tr><form><td>a<td>b</form></table>", "a  b"),
        ("<table><form><tr><td>a<tr><td>b</form></table>", "a\nb"),
        ("x <textarea>\na\n b</textarea> y", "x a\n b y"),
        ("<listing>a\n  b</listing>", "a\n  b"),
        ("a <b", "a <b"),
        ("a <b <!-- c", "a <b"),
        ("<p title='it's>a", "a"),
        ('<p title="never closed>a</p>b', "a\n\nb"),
    ],
)
def test_visible_text_is_kept(page, text):
    assert H.render(page) == text


def test_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "<p>a", "x"), (3, "<p>b", "x"), (3, "<p>b", "x")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string").selectExpr("*", "text as k", "text as t", "text as `a.b`")
    got = sorted(H.extract(pages).collect(), key=str)
    assert sorted([(r["page_id"], r["text"]) for r in got], key=str) == sorted([(1, None), (2, ""), (None, "a"), (3, "b"), (3, "b")], key=str)
    assert H.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page, text",
    [
        ("so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds", "so x=2 holds"),
        ("<math><semantics><mi>x</mi><annotation encoding='application/x-tex'>no</annotation></semantics></math>y", "xy"),
        ("<math><semantics><mi>x</mi><annotation-xml><ci>x</ci></annotation-xml></semantics></math>", "x"),
        ("<svg><title>no</title><desc>no</desc><defs><text>no</text></defs><metadata>no</metadata><text>A</text><text x='1'>B</text></svg>", "A\nB"),
        ("a<svg><defs/><path d='M0'/><text>b</text></svg>c", "a\nb\nc"),  # self-closing
        ("<svg><title/><text>b</text></svg>", "b"),
        ("<svg><foreignObject><p>in</p></foreignObject></svg>", "in"),
        ("<svg><defs><path><p>out", "out"),  # a paragraph ends the drawing
        ("<svg hidden><text>no</text></svg><desc>yes</desc>", "yes"),
        ("<svg><style>.x{display:none}</style><text class=x>no</text><text>yes</text></svg>", "yes"),
        ("<table><tr><td><svg><text>in</text></svg><td>b</table>", "in  b"),
    ],
)
def test_formulas_and_drawings(page, text):
    assert H.render(page) == text
