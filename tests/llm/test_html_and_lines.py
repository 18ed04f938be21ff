"""HTML rendering on hand-made pages and against the standard parser's words; line dedup against plain counting."""

import re
import time
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urlsplit

import pytest

from sublens.llm import html_text, site_lines

SF = "/root/testdata/sf0.01"

CASES = [
    (None, ""), ("", ""), ("plain &amp; text", "plain & text"), ("a<b", "a<b"), ("1 < 2 > 0", "1 < 2 > 0"),
    ("<p>one<p>two</p>three", "one\n\ntwo\n\nthree"),
    ("<div>a</div><div>b <b>c</b>d</div>", "a\nb cd"),
    ("x<br>y<br><br>z", "x\ny\n\nz"),
    ("<head><title>t</title><style>p{}</style></head><body>v<script>if (a</b>c) '<p>'</script>w", "vw"),
    ("<p hidden>no</p><p style='display: none'>no</p><span style=\"visibility:hidden\">no</span><p>yes", "yes"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n  - c\n- d\n\ne"),
    ("<ol start=9><li>x</li><li>y</li></ol>", "9. x\n10. y"),
    ("<ol><li>x<ul><li>in</ul></li><li>y</ol>", "1. x\n   - in\n2. y"),
    ("<table><tr><th>Name<th>N<tr><td>long name<td>1<tr><td colspan=2>both</table>", "Name       N\nlong name  1\nboth"),
    ("<table><caption>C</caption><tr><td>a</td><td>bb</td></tr><tr><td>ccc</td><td>d</td></tr></table>z", "C\na    bb\nccc  d\n\nz"),
    ("<pre>  a\n   b</pre>c", "  a\n   b\n\nc"), ("<!-- no <p> -->yes<!-- open", "yes"), ("a <i> b </i> c\n d", "a b c d"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\nd\nu"), ("<p>a<table><tr><td>b</table>c", "a\n\nb\n\nc"), ("<h1>H</h1>t", "H\n\nt"),
    ("<p title='a > b'>x</p><img alt=\"y\"><input value=z>", "x"), ("<template><p>no</template>yes<noscript>no</noscript>", "yes"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_layout(page, text):
    assert html_text.page_text(page) == text


TABLES_AND_HIDING = [
    ("<table><td>x</td></table>", "x"), ("<table><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"),
    ("<table><tr><td>a</td></tr><td>x</table>", "a\nx"), ("<table><tbody><tr><td>a</tr><th>x</table>", "a\nx"),
    ("<table><colgroup><col><tr><td>a</table>", "a"), ("<table><colgroup><col><tbody><tr><td>a</table>", "a"),
    ("<table><colgroup><td>a</table>", "a"), ("<table><colgroup><colgroup><thead><td>a</table>", "a"),
    ("<table><caption>C<td>a</table>", "C\na"), ("<table><tr><caption>C</caption><td>a</table>", "C\na"),
    ("<table><colgroup>loose<tr><td>a</table>", "loose\na"), ("<table><form><td>a</td></form></table>", "a"),
    ("<table title='colspan=2'><tr><td title=' colspan=2'>a<td>b<tr><td>cc<td>d</table>", "a   b\ncc  d"),
    ("<p title='the hidden valley'>yes", "yes"), ("<p alt=\"x hidden\">yes", "yes"), ("<p class='a hidden b'>yes", "yes"),
    ("<p data-x='display:none'>yes", "yes"), ("<p data-hidden=1 class=hidden>yes", "yes"), ("<p title=\"style='display:none'\">yes", "yes"),
    ("<p style='--display: none; background: url(x;display:none)'>yes", "yes"), ("<p style='display:none;display:block'>yes", "yes"),
    ("<p HIDDEN>no</p><p hidden=''>no</p><p class=a hidden/>no</p>yes", "yes"), ("<p a='1'hidden>no</p>yes", "yes"),
    ("<p style='color:red;DISPLAY : None !important;display:block'>no</p><p style=display:none>no</p>yes", "yes"),
    ("<p style='visibility:hi/**/; visibility: hidden'>no</p><p style='display&#58;none'>no</p>yes", "yes"),
    ("<ol title=' start=5'><li>x</ol>", "1. x"),
]


@pytest.mark.parametrize("page,text", TABLES_AND_HIDING)
def test_implied_rows_and_hiding_attributes(page, text):
    assert html_text.page_text(page) == text


def test_deep_and_long_pages():
    assert html_text.page_text("<div>" * 20_000 + "x") == "x"
    assert html_text.page_text("<ul><li>" * 300 + "x").endswith("- x")
    assert len(html_text.page_text("<p>word</p>" * 50_000).split()) == 50_000
    html_text.page_text("<a href=\"" * 3000)


class Words(HTMLParser):
    def __init__(self):
        super().__init__()
        self.skip, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "title")
        self.out.append(" " if tag not in ("b", "a") else "")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "title")
        self.out.append(" " if tag not in ("b", "a") else "")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)


def test_whole_table_has_the_words_of_the_standard_parser(spark):
    from sublens.llm.queries import op2_html
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op2_html(spark, SF).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        w = Words()
        w.feed(pages[r["page_id"]])
        w.close()
        text = re.sub(r"(?m)^ *- ", "", r["text"])
        assert text.split() == "".join(w.out).split()
        assert r["n_chars"] == len(r["text"])


def test_html_edge_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "<p>a", "y"), (1, "<p>a", "y"), (None, "", None)], "page_id int, html string, text string")
    out = html_text.extract(df)
    assert out.columns == ["page_id", "text"]
    assert sorted((str(r[0]), r[1]) for r in out.collect()) == [("1", ""), ("1", "a"), ("1", "a"), ("None", "")]
    assert html_text.extract(df.limit(0)).count() == 0


def plain_lines(rows, ratio=0.3, least=2):
    def host(u):
        return (urlsplit(u or "").hostname or "") if "://" in (u or "") else ""
    distinct = {(i, host(u), t or "") for i, u, t in rows}
    pages, seen = Counter(h for _, h, _ in distinct), Counter()
    for _, h, t in distinct:
        seen.update({(h, x.strip(" ")) for x in t.split("\n")} - {(h, "")})
    bad = {k for k, n in seen.items() if n >= least and n > ratio * pages[k[0]]}
    out = []
    for i, u, t in rows:
        ls = (t or "").split("\n")
        stay = [x for x in ls if (host(u), x.strip(" ")) not in bad]
        full = [x for x in ls if x.strip(" ")]
        out.append((i, host(u), len(full), len(ls) - len(stay), "\n".join(stay) if any(x.strip(" ") for x in stay) else ""))
    return sorted(out, key=str)


def got_lines(df):
    return sorted((tuple(r) for r in site_lines.drop_lines(df).collect()), key=str)


def test_line_dedup_on_the_whole_table(spark):
    pages = html_text.extract(spark.read.parquet(f"{SF}/pages.parquet"))
    want = plain_lines([(r["page_id"], r["url"], r["text"]) for r in pages.collect()])
    assert got_lines(pages) == want
    assert sum(w[3] for w in want) > 20


def test_line_dedup_edge_rows(spark):
    rows = [(i, f"http://H.example:80/{i}", f"nav\n\nown {i}\n  nav ") for i in range(8)]
    rows += [(1, None, "nav"), (2, "no host", None), (3, "https://u@few.example?x", "nav\nnav"), (None, "http://h.example/n", "nav\n"),
             (None, "http://h.example/n", "nav\n"), (5, "http://h.example/q", ""), (6, "http://h.example/l", "word\n" * 30_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id int, url string, text string, host string")
    assert got_lines(df) == plain_lines(rows)
    assert got_lines(df.limit(0)) == []


@pytest.mark.parametrize("page,want", [
    ("<b>x<p>y</b>z</p>w", "x\n\nyz\n\nw"),
    ("<b hidden>x<p>y</b>z</p>w", "zw"),
    ('<div style="visibility:hidden">a<span style="visibility:visible">b</span>c</div>', "b"),
    ("<table><tr><td rowspan=2>a<td>bb<td>c<tr><td>d<td>e<tr><td>f<td>g<td>h</table>", "a  bb  c\n   d   e\nf  g   h"),
    ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tbody><tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
    ("<ol reversed><li>a<li>b<li value=9>c<li>d</ol>", "4. a\n3. b\n9. c\n8. d"),
])
def test_inline_ends_visibility_and_spans(page, want):
    assert html_text.page_text(page) == want


def test_time_is_linear_in_stray_tags():
    for page in ("<b>" * 100_000 + "</i>" * 100_000, "<i>" * 100_000 + "<hr>" * 100_000):
        start = time.process_time()
        html_text.page_text(page)
        assert time.process_time() - start < 20


def test_lines_of_small_hosts_are_judged(spark):
    pages = spark.createDataFrame(
        [(i, "http://a.b/x", f"menu\nown {i}") for i in range(3)] + [(7, "http://c.d", "alone")], "page_id long, url string, text string")
    got = {r["page_id"]: r["text"] for r in site_lines.drop_lines(pages).collect()}
    assert got == {0: "own 0", 1: "own 1", 2: "own 2", 7: "alone"}
