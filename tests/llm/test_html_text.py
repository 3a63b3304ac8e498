import html as escapes
import re

import pytest

from amberline.llm import html_text
from amberline.llm.common import table

SHAPE = "page_id long, url string, html string"

CASES = {
    "<p>a  b\n c</p>": "a b c",
    "<p>a<b>b</b>c<p>d": "abc d",
    "<div>a<br>b</div>c": "a b c",
    "<p>x &amp; y &lt;b&gt; &eacute; &#233; &nbsp;z": "x & y <b> é é z",
    "<nav>menu</nav><p>text</p><footer>end</footer>": "text",
    "<script>var a='</p><p>';</script><style>p{}</style>ok": "ok",
    "<article><h1>T</h1><p>one</p><div class='share-bar'>share</div><p>two</p></article><p>outside</p>": "T one two",
    "<main><p>in</p></main><p>out</p>": "in",
    "<div role=main><p>in</p></div><p>out</p>": "in",
    "<article>a</article><article>b</article><article class=comment>c</article>": "a b",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "a b c d",
    "<table><tr><td>a<td>b<tr><th>c</table>": "a b c",
    "<div id=\"cookie-notice\">we use</div><p title='a>b'>text</p>": "text",
    "<p hidden>no</p><div aria-hidden=true>no</div>yes": "yes",
    "<!-- <p>no</p> --><p>yes</p><!-- open": "yes",
    "text <a href='x'": "text",
    "a < b and 3 > 2": "a < b and 3 > 2",
    "<article><p>cut of": "cut of",
    "<form><p>f</p></form><select><option>o</select><p>t": "t",
    "<pre>a\n  b</pre>": "a b",
    "": "",
    "<p></p> \n": "",
    "<title>t</title><body><p>b</body>": "b",
    "</div></p>a</span>": "a",
    "<![CDATA[x]]><p>y": "y",
}


# Classes of large parts and of the text itself, page headers, forms around pages.
KEPT = {
    "<body class='no-sidebar single-post'><article><p>Hello there</p></article>": "Hello there",
    "<article class='post has-comments'><p>Hello there</p></article>": "Hello there",
    "<body class='ad'><p>Hello there</p>": "Hello there",
    "<div id='alert-level-study'><p>Hello there</p></div><p>more</p>": "Hello there more",
    "<article><p>a</p><section class='related-work'><p>Earlier papers</p></section></article>": "a Earlier papers",
    "<div class='sidebar'><article><p>Hello</p></article><p>no</p></div>": "Hello",
    "<form id='aspnetForm'><nav>menu</nav><p>The whole page stands in a form</p></form>": "The whole page stands in a form",
    "<form><main><p>text</p></main></form>": "text",
    "<div class='widget'><p>All of the text of this page</p></div><p>x</p>": "All of the text of this page x",
    "<body><header><h1>Site name</h1></header><p>Hello there you</p>": "Hello there you",
    "<div class='site-header'>Site name</div><p>Hello there you</p>": "Hello there you",
    "<article><header><h1>Title</h1></header><p>Hello</p></article>": "Title Hello",
    "<article><p>Hi.</p><section id='comments'><p>A long comment of a reader, and one more.</p></section></article>": "Hi.",
    "<p>Hi there.</p><div class='comment-list'><p>A long comment of a reader, and one more.</p></div>": "Hi there.",
    "<p>Hello there you</p><div class='left-sidebar'>no</div><div class='ad-slot-3'>no</div><div class='share_buttons'>no</div><div class='main-nav'>no</div>": "Hello there you",
    "<p>Hello there you</p><div class='without-sidebar'>yes</div><div class='shared-memory'>yes</div><div class='social-science'>yes</div>": "Hello there you yes yes yes",
}


@pytest.mark.parametrize("source", KEPT)
def test_classes_and_headers(source):
    assert html_text.extract(source) == KEPT[source]


@pytest.mark.parametrize("unit", ["<ul>", "<h1>", "<i></b>", "</i>", "<ul><li>", "<p><table><h1>", "<div></p>"])
def test_closing_takes_constant_time(unit):
    import time

    started = time.process_time()
    html_text.parse("<p><i>" + unit * 100_000 + "x")
    assert time.process_time() - started < 15


@pytest.mark.parametrize("page", ["<body>{}</body>", "<article><div>{}</div></article>", "<article><div><div>{}</div></div></article>"])
def test_near_copies_are_no_template(spark, page):
    shared = "".join(f"<div>Paragraph {k} stands on every edition of this text.</div>" for k in range(4))
    rows = [(i, "http://h.example/x", page.replace("{}", f"{shared}<div>Edition {i} only.</div>")) for i in range(12)]
    got = {r.page_id: r.text for r in html_text.extract_pages(frame(spark, rows)).collect()}
    whole = " ".join(f"Paragraph {k} stands on every edition of this text." for k in range(4))
    assert got == {i: f"{whole} Edition {i} only." for i in range(12)}


@pytest.mark.parametrize("source", CASES)
def test_text(source):
    assert html_text.extract(source) == CASES[source]


def test_deep_and_long():
    assert html_text.extract("<div>" * 5000 + "x" + "</div>" * 5000) == "x"
    root = html_text.parse("<div>" * 5000 + "x")
    assert len(html_text.mark(root, html_text.contents(root))) == 5000
    assert len(html_text.extract("<p>word</p>" * 50_000)) == 50_000 * 5 - 1


def frame(spark, rows):
    return spark.createDataFrame(rows, SHAPE).coalesce(2)


def test_templates_go_per_host(spark):
    box = "<div><span>About this site</span> and its team</div>"
    rows = [(i, f"http://big.example/{i}", f"{box}<p>Text of page {i}</p>") for i in range(30)]
    rows += [(100 + i, f"http://small{i}.example/", f"{box}<p>Other {i}</p>") for i in range(30)]
    got = {r.page_id: r.text for r in html_text.extract_pages(frame(spark, rows)).collect()}
    assert got[3] == "Text of page 3"
    assert got[103] == "About this site and its team Other 3"


def test_articles_keep_quoted_passages(spark):
    rows = [(i, "http://h.example/x", f"<article><p>One passage that all quote.</p><section><i>Join our list</i></section><p>Page {i}</p></article>") for i in range(20)]
    assert {r.page_id: r.text for r in html_text.extract_pages(frame(spark, rows)).collect()} == {i: f"One passage that all quote. Page {i}" for i in range(20)}


BODY = "<h2>Head</h2><p>The first of the paragraphs.</p><p>The second one.</p>"


@pytest.mark.parametrize("page", [f"<body>{BODY}</body>", f"<article>{BODY}</article>", f"<article><div class=body>{BODY}</div></article>", f"<body><table><tr><td>{BODY}</table></body>", f"<body><div>{BODY}</div></body>"])
def test_copies_of_a_page_are_no_template(spark, page):
    rows = [(i, f"http://h.example/{i}", f"<head><title>{i}</title></head>{page}<footer>{i}</footer>") for i in range(20)]
    rows += [(20 + i % 2, "http://h.example/", page) for i in range(4)]  # repeated rows
    out = html_text.extract_pages(frame(spark, rows)).collect()
    assert len(out) == 24 and {r.text for r in out} == {"Head The first of the paragraphs. The second one."}


def test_copies_lose_the_template_of_their_host(spark):
    box = "<div><span>About this site</span> and its team</div>"
    rows = [(i, f"http://h.example/{i}", f"<body>{box}{BODY}</body>") for i in range(20)]
    rows += [(100 + i, f"http://h.example/{i}", f"<body>{box}<p>Text of page {i}</p></body>") for i in range(9)]
    got = {r.page_id: r.text for r in html_text.extract_pages(frame(spark, rows)).collect()}
    assert {got[i] for i in range(20)} == {"Head The first of the paragraphs. The second one."}
    assert [got[100 + i] for i in range(9)] == [f"Text of page {i}" for i in range(9)]


@pytest.mark.parametrize("page", ["<article><h1>{}</h1><div class=body>%s</div></article>", "<body><h1>{}</h1><div>%s</div></body>"])
def test_most_of_a_page_is_no_template(spark, page):
    rows = [(i, "http://h.example/x", page.replace("{}", str(i)) % BODY) for i in range(20)]
    got = {r.page_id: r.text for r in html_text.extract_pages(frame(spark, rows)).collect()}
    assert got == {i: f"{i} Head The first of the paragraphs. The second one." for i in range(20)}


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "http://a/", "<p>x</p>"), (None, "http://a/", "<p>x</p>"), (3, "no url", ""), (3, "no url", ""), (4, "HTTP://User@A:80/", "<p>é</p>")]
    out = html_text.extract_pages(frame(spark, rows).selectExpr("*", "'x' AS host", "'x' AS page", "'x' AS marks", "'x' AS text", "'x' AS n")).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in out) == [(0, "x", 1), (0, "x", 1), (1, "", 0), (3, "", 0), (3, "", 0), (4, "é", 1)]
    assert html_text.extract_pages(frame(spark, [])).count() == 0


def test_table_against_its_articles(spark, data):
    pages = {r.page_id: r for r in table(spark, data, "pages").collect()}
    got = {r.page_id: r for r in html_text.extract_pages(table(spark, data, "pages")).collect()}
    for page_id, page in pages.items():
        body = re.search(r"<article>(.*?)(</article>|$)", page.html, re.S)[1]
        blocks = (re.sub(r"\s+", " ", escapes.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>|<br>", body))
        want = " ".join(b for b in blocks if b)
        assert (got[page_id].url, got[page_id].text, got[page_id].n_chars) == (page.url, want, len(want))


def test_equal_attributes_are_judged_once(monkeypatch):
    judged = []
    real = html_text._is_other
    monkeypatch.setattr(html_text, "_is_other", lambda attributes: judged.append(attributes) or real(attributes))
    long = f' class="story" data-x="{"y" * html_text.SHORT}"'
    source = '<div class="seen-once-here"><p>Some text.</p></div><div class="related-posts">Other.</div>' * 3 + f"<div{long}>More.</div>" * 2
    assert html_text.extract(source) == "Some text. Some text. Some text. More. More."
    assert judged.count(' class="seen-once-here"') == 1
    assert judged.count(long) == 2  # long ones are not kept
