import pytest

from reviewcraft.llm import html_template as ht

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{{}}</style>
<script>var t="</p><article>no</article>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/{n}">Menu {n}</a></li></ul></nav>
<!-- <article>hidden</article> --><div class="cookie-notice">We use cookies</div>
<div class="ad">Buy {n}</div><article><h2>Head {n}</h2><p>First  {n}
 &lt;para&gt; &amp; more<p><b>Second {n}<br>line {n}<p>Third {n}</b> end</p>
<form><input name=q>Search</form><aside>Side {n}</aside><span>Share this</span>
<section class="comments"><p>Reader {n}</p></section></article>
<footer>&copy; site</footer></body></html>"""
TEXT = "Head {n}\n\nFirst {n} <para> & more\n\nSecond {n} line {n}\n\nThird {n} end"
SCHEMA = "page_id long, url string, html string"


def pages(n, host="a.example.com"):
    return [(i, f"https://{host}/p/{i}", PAGE.format(n=i)) for i in range(n)]


def texts(spark, rows):
    found = ht.extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    return {r["page_id"]: r["text"] for r in found}


def test_main_text(spark):
    assert texts(spark, pages(12)) == {i: TEXT.format(n=i) for i in range(12)}


def test_template_texts_need_support(spark):
    # "Share this" is template text only where many pages show it.
    assert texts(spark, pages(2))[1] == TEXT.format(n=1) + "\n\nShare this"


def test_copies_of_one_page_are_not_all_template(spark):
    rows = [(i, "https://copies.example/x", PAGE.format(n=1)) for i in range(20)]
    assert set(texts(spark, rows).values()) == {TEXT.format(n=1) + "\n\nShare this"}


def test_odd_pages(spark):
    rows = [
        (1, "http://x.example/a", None),
        (2, None, ""),
        (3, "no url", "plain text only"),
        (4, "http://x.example/b", "<article>cut <b>off &am"),
        (5, "http://x.example/c", "<div><p>a<p>b</div><nav>menu</nav>tail"),
        (6, "http://x.example/d", "<article>one</article><p>between</p><article>two</article>"),
        (7, "http://x.example/e", "<p>a < b &#x41;&nbsp;c</p></p></div><main>in</main>"),
        (7, "http://x.example/e", "<p>a < b &#x41;&nbsp;c</p></p></div><main>in</main>"),
        (None, "http://x.example/f", "<script>only"),
        (8, "http://x.example/g", "<p>" + "long " * 50000 + "</p>"),
    ]
    found = texts(spark, rows)
    assert found[1] == found[2] == found[None] == ""
    assert found[3] == "plain text only" and found[4] == "cut off &am"
    assert found[5] == "a\n\nb\n\ntail" and found[7] == "in"
    assert found[6] == "one\n\ntwo" and len(found[8]) == 5 * 50000 - 1


def test_classes_are_tokens_with_equal_vectors(spark):
    rows = spark.createDataFrame(
        [(i, "h", bytes(PAGE.format(n=i), "utf-8")) for i in range(10)], "row long, host string, _html binary"
    )
    [host] = ht.host_templates(rows).collect()
    once = [c for c in host["classes"] if c["once"]]
    assert len(once) == 1
    template = ht.Template([c.asDict() for c in host["classes"]])
    article = ht.Token("o", "article", "", "").key
    close = ht.Token("c", "article", "", "").key
    assert article in template.skeleton and template.classes[article] == template.classes[close]
    assert ht.Token("o", "p", "", "").key not in template.skeleton


@pytest.mark.parametrize("name", ["text", "n_chars", "host", "_classes"])
def test_clashing_columns(spark, name):
    rows = spark.createDataFrame([(1, "u", "<p>x", "y")], f"{SCHEMA}, {name} string")
    [row] = ht.extract_main_text(rows).collect()
    assert row["text"] == "x" and row["n_chars"] == 1


def test_empty(spark):
    assert ht.extract_main_text(spark.createDataFrame([], SCHEMA)).count() == 0


NEUTRAL = """<html><body><div class="w"><div class="k1"><a href="/{n}">Way {n}</a> <a href="/b{n}">Other {n}</a></div>
<div class="k2">Buy {n}</div><h1>Head {n}</h1><div class="k3"><p>{story}</p><p>End {n}</p></div>
<div class="k4"><p>Reader {n}</p></div></div></body></html>"""


def test_slots_with_neutral_names(spark):
    story = [" ".join(f"word{i}x{k}" for k in range(40)) for i in range(6)]
    rows = [(i, f"https://n.example/{i}", NEUTRAL.format(n=i, story=story[i])) for i in range(6)]
    assert texts(spark, rows) == {i: f"Head {i}\n\n{story[i]}\n\nEnd {i}" for i in range(6)}


def test_tags_out_of_order_or_nesting_leave_their_class(spark):
    a, b = '<i class="a">x</i>', '<i class="b">y</i>'
    bodies = [f"<div class=c>{a}{b}{'<em class=d>'}</div><s class=e>z</s>", f"<s class=e>z</s><div class=c>{b}{a}{'<em class=d>'}</div>"]
    rows = [(i, "h", bytes(bodies[i % 2], "utf-8")) for i in range(8)]
    df = spark.createDataFrame(rows, "row long, host string, _html binary")
    [host] = ht.host_templates(df).collect()
    template = ht.Template([c.asDict() for c in host["classes"]])
    assert ht.Token("o", "em", "d", "").key not in template.classes
    assert ht.Token("o", "i", "a", "").key not in template.skeleton
    assert ht.class_order(ht.tokens_of("<b><i></i></b><b><i></i></b>"), {}) == {}


@pytest.mark.parametrize("n", [4, 12])
def test_odd_pages_of_a_host_leave_its_template(spark, n):
    odd = [(100, "https://a.example.com/n", None), (101, "https://a.example.com/e", "")]
    odd += [(102, "https://a.example.com/c", PAGE.format(n=7)[:150])]
    found = texts(spark, pages(n) + odd)
    assert [found[i] for i in range(n)] == [TEXT.format(n=i) for i in range(n)]
    assert found[100] == found[101] == ""


@pytest.mark.parametrize(
    "page",
    [
        "<html class='js responsive'><body class='single has-sidebar'><p>in</p></body></html>",
        "<body class='header-fixed search'><article class='post comments-open'>in</article></body>",
        "<div class='side-by-side'><p>in</p></div>",
        "<div class='widget'><article>in</article></div>",
        "<article>in</article><div class='related'><article>other</article></div>",
        "<p>in</p><div class='site-nav'>no</div><div id='comment-list'>no</div><div class='x ad_2'>no</div>",
        "<p>in</p><aside><article>other</article></aside>",
    ],
)
def test_marks_of_outer_elements_are_no_boilerplate(page):
    assert ht.main_text(page, ht.Template([])) == "in"


def test_all_main_elements_of_the_skeleton(spark):
    page = "<body><article id='intro'><p>one {0}</p></article><article id='story'><p>two {0}</p></article></body>"
    rows = [(i, "https://two.example/", page.format(i)) for i in range(5)]
    assert texts(spark, rows) == {i: f"one {i}\n\ntwo {i}" for i in range(5)}


def test_shared_headings_and_paragraphs_are_article_text(spark):
    page = (
        "<body><article><h2>Background</h2><p>{0}</p><p>As told before.</p><span>Share this</span>"
        "<ul><li>One</li></ul></article></body>"
    )
    story = [" ".join(f"word{i}x{k}" for k in range(20)) for i in range(9)]
    rows = [(i, "https://same.example/", page.format(story[i])) for i in range(9)]
    assert texts(spark, rows) == {
        i: f"Background\n\n{story[i]}\n\nAs told before.\n\nOne" for i in range(9)
    }


def plain_text(page):
    """The article of a page of the table by plain means: between its tags, block by block."""
    import html
    import re

    article = re.search(r"<article>(.*?)</article>", page, re.S)
    body = article.group(1) if article else ""
    body = re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1>", "", body, flags=re.S)
    body = re.sub(r"<br\s*/?>", " ", body)
    blocks = re.split(r"</?(?:p|h[1-6]|ul|ol|li|div|section|blockquote|pre|table|tr|td)\b[^>]*>", body)
    blocks = (html.unescape(re.sub(r"<[^>]+>", "", b)) for b in blocks)
    blocks = (re.sub(r"\s+", " ", b).strip() for b in blocks)
    return "\n\n".join(b for b in blocks if b)


def test_articles_of_the_table_against_plain_means(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = ht.extract_main_text(pages.select("page_id", "url", "html")).collect()
    simple = [r for r in found if r["html"] and r["html"].count("<article>") == 1
              and not any(x in r["html"] for x in ("<aside", "<form", "comment"))]
    assert len(simple) > 100
    wrong = [r["page_id"] for r in simple if r["text"] != plain_text(r["html"])]
    assert wrong == []
