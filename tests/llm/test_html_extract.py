"""HTML extraction: exact marginals, unseen templates, parsing rules, the given pages."""

import html
import re
from itertools import product

import pytest

from airwave.llm.common import table
from airwave.llm.html_extract import (LEAF_EVIDENCE, Model, Page, extract, labelled_sample, labels_of, train)

PLAIN = Model({})


def test_marginals_equal_enumeration():
    page = Page("<body><nav><a href=x>Home</a></nav><article><h1>T</h1><p>Some text here.</p></article></body>")
    n = len(page.kind)
    own = []
    for i in range(n):
        w = sum(PLAIN.odds.get(f, 0.0) for f in page.features[i])
        if page.text[i] is not None:
            low, high = LEAF_EVIDENCE["linked" if "l2" in page.features[i] else "plain"]
            w = max(low, min(high, w))
        own.append((1.0, 2.718281828459045 ** w))
    total, ones = 0.0, [0.0] * n
    for states in product((0, 1), repeat=n):
        weight = PLAIN.root[states[0]]
        for i, x in enumerate(states):
            weight *= own[i][x]
            if i:
                weight *= PLAIN.moves[page.kind[i]][states[page.parent[i]]][x]
        total += weight
        for i, x in enumerate(states):
            ones[i] += weight * x
    assert PLAIN.marginals(page) == pytest.approx([x / total for x in ones])


TEMPLATE = """<!doctype html><html><head><title>T</title><style>p{a:b}</style></head><body>
<header><p>Site name</p></header><div class="cookie-notice"><p>We use cookies, please accept them all.</p></div>
<div id="main"><div class="post-content"><h2>Head &amp; line</h2><p>First <a href="x">linked</a> par&#97;graph,
 with  text.<p>Second&nbsp;paragraph is prose, too.<br>After a break.<ul><li>item one</li><li>item two</li></ul>
<blockquote>Quoted words.</blockquote><script>var t="</p><p>no";</script><!-- <p>no</p> --></div>
<div class="ad banner"><p>Buy this very good thing now.</p></div>
<aside><p>Related reading for you.</p></aside></div>
<form><label>Mail</label><p>Subscribe to our letter.</p><textarea>no</textarea><select><option>no</select></form>
<section id="comments"><h3>Comments</h3><div class="comment"><p>A reader says it was a wonderful article.</p></div>
</section><footer>&copy; 2020</footer></body></html>"""
WANTED = ("Head & line First linked paragraph, with text. Second paragraph is prose, too. After a break. item one "
          "item two Quoted words.")


def test_unseen_template(spark):
    sf = "/root/testdata/sf0.01"
    trained = train(labelled_sample(table(spark, sf, "pages"), table(spark, sf, "documents")))
    assert trained.extract(TEMPLATE) == WANTED
    assert PLAIN.extract(TEMPLATE) == WANTED


def test_parsing_rules():
    def blocks(source):
        return [t for t in Page(source).text if t is not None]
    assert blocks("<p>a<b>b</b>c<p>d") == ["abc", "d"]
    assert blocks("x<br>y<br/>z") == ["x", "y", "z"]
    assert blocks("<div>a</p>b</span>c</div>") == ["a", "bc"] or blocks("<div>a</p>b</span>c</div>") == ["abc"]
    assert blocks("<li>1<li>2<ul><li>3</ul>4") == ["1", "2", "3", "4"]
    assert blocks('<p title="a>b">c</p><SCRIPT>x</Script >y') == ["c", "y"]
    assert blocks("a < b &lt; c &amp;amp; &#x41; &nope;") == ["a < b < c &amp; A &nope;"]
    assert blocks("<!-- open <p>x") == [] and blocks("<style>p{}") == [] and blocks("<p") == ["<p"]


def test_labels_need_the_whole_text():
    page = Page("<ul><li>The</li></ul><article><h1>The cat</h1><p>The cat sat.</p><p>On a mat.</p></article>")
    assert [t for t, x in zip(page.text, labels_of(page, "The cat sat.\nOn a mat.")) if t and x] == [
        "The cat", "The cat sat.", "On a mat."]
    assert labels_of(page, "The dog sat.") is None


def test_given_pages_exactly(spark):
    sf = "/root/testdata/sf0.01"
    pages = table(spark, sf, "pages")
    model = train(labelled_sample(pages, table(spark, sf, "documents")))
    got = {r["row"]["page_id"]: (r["text"], r["n_chars"]) for r in extract(pages, model).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        text = re.sub(r"<[^>]+>", "", re.sub(r"<(/?p|br|/?h1)>", " ", article))
        text = " ".join(html.unescape(text).split())
        assert got[r["page_id"]] == (text, len(text))


def test_awkward_rows(spark):
    schema = "page_id long, url string, html string, text string, row string"
    long = "<article>" + "<p>Some words stand here.</p>" * 20_000 + "</article>"
    deep = "<div>" * 3000 + "<article><p>Deep words.</p></article>"
    rows = [(1, None, None), (None, "u", ""), (2, "u", "no tags at all."), (3, "u", long), (3, "u", long),
            (4, "u", deep), (5, "u", "<nav><a href=x>only</a></nav>")]
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], schema)
    got = sorted(((r["row"]["page_id"] or 0, r["n_chars"], r["text"][:12]) for r in extract(df, PLAIN).collect()))
    n = 23 * 20_000 - 1
    assert got == [(0, 0, ""), (1, 0, ""), (2, 15, "no tags at a"), (3, n, "Some words s"), (3, n, "Some words s"),
                   (4, 11, "Deep words."), (5, 0, "")]
    assert extract(df.where("false"), PLAIN).count() == 0
    none = labelled_sample(df.select("page_id", "url", "html"), spark.createDataFrame([], "doc_id long, text string"))
    assert train(none).extract(TEMPLATE) == WANTED
