"""Main text of pages: the reader, the random field, and whole tables against the template they were written by."""

import html
import itertools
import math
import re

import numpy as np
import pytest

from ledgerlens.llm import html_extract as X
from ledgerlens.llm.html_blocks import blocks_of, clean, features_of, path_features, same_home
from ledgerlens.llm.html_layouts import labelled_pages


def texts(page):
    return [clean(b.text) for b in blocks_of(page)]


@pytest.mark.parametrize("page, want", [
    ("<p>a<p>b<div>c</div>d", ["a", "b", "c", "d"]),
    ("<p><b>one<br><p>two</b> three</p></article>four", ["one", "two three", "four"]),
    ("<ul><li>x<li>y <i>z</i></ul><table><tr><td>1<td>2<tr><td>3</table>", ["x", "y z", "1", "2", "3"]),
    ("a &amp; b &lt;c&gt; &eacute;&#233;&#xe9; &am &nbsp; d", ["a & b <c> ééé &am d"]),
    ("<script>var t='</p>';</script><style>p{}</style>x<!-- y -->z<noscript><div>q</noscript>w", ["xzw"]),
    ("<head><title>t</title><p>body text", ["body text"]),
    ("<p>a < b and c</p>", ["a < b and c"]),
    ("  \n<div> \t </div>", []),
    ("", []),
    ("plain \x00text\r\nover  lines", ["plain \x00text over lines"]),
    ("<a href=1>x<p>y<a href=2>z</a></p>", ["x", "yz"]),
    ("<p hidden>a</p><template>b</template><svg><text>c</text></svg>d<svg>", ["a", "d"]),
])
def test_blocks(page, want):
    assert texts(page) == want


def test_path_home_and_links():
    one, two, three = blocks_of("<div class='Post-Body x1'><p>a <a>link</a></p><p>b</p></div><p style='display: none'>c</p>")
    assert one.path == (("div", ("post", "body")), ("p", ())) and (one.linked, two.linked) == (4, 0)
    assert one.home == two.home != three.home and same_home([one, two, three]) == [False, True, False]
    assert "named hidden" in path_features(three.path) and {"own p", "in div", "inner body"} <= features_of([one])[0]


def test_deep_and_open_pages():
    deep = "<div>" * 20_000 + "x" + "<b>" * 20_000 + "y" + "</div>" * 5_000 + "<p>z" * 20_000
    got = texts(deep)
    assert got[0] == "xy" and got[1:] == ["z"] * 20_000


def brute(score, same, start, step):
    """(log of the sum over all labellings, best labelling) of one page."""
    total = {}
    for y in itertools.product((0, 1), repeat=len(score)):
        s = start[y[0]] + sum(v for v, label in zip(score, y) if label)
        total[y] = s + sum(step[same[t]][y[t - 1]][y[t]] for t in range(1, len(y)))
    return math.log(sum(map(math.exp, total.values()))), total


def field(seed=0):
    rng = np.random.default_rng(seed)
    size = np.array([6, 4, 4, 1])
    score, same = rng.standard_normal((4, 6)), rng.integers(0, 2, (4, 6))
    label = rng.integers(0, 2, (4, 6)) * (np.arange(6) < size[:, None])
    return score, label, same, size, rng.standard_normal(2), rng.standard_normal((2, 2, 2))


def test_likelihood_sums_over_all_labellings():
    score, label, same, size, start, step = field()
    want = 0.0
    for i, n in enumerate(size):
        z, total = brute(score[i, :n], same[i, :n], start, step)
        want += total[tuple(label[i, :n])] - z
        assert tuple(X.viterbi(score[i, :n], [bool(x) for x in same[i, :n]], start, step)) == max(total, key=total.get)
    got, d_score, d_start, d_step = X.likelihood(score, label, same, size, start, step)
    assert got == pytest.approx(want)
    for array, grad in ((score, d_score), (start, d_start), (step, d_step)):
        for at in np.ndindex(array.shape):
            old, value = array[at], []
            for move in (1e-5, -1e-5):
                array[at] = old + move
                value.append(X.likelihood(score, label, same, size, start, step)[0])
            array[at] = old
            assert grad[at] == pytest.approx((value[0] - value[1]) / 2e-5, abs=1e-6)


def test_held_out_layouts():
    """Layouts that training did not see."""
    work, bad, all_ = X.Extractor(X.default_model()), 0, 0
    for page in labelled_pages(150, seed=5):
        blocks = blocks_of(page)
        bad += sum(k != (b.label == "1") for b, k in zip(blocks, work.labels(blocks)))
        all_ += len(blocks)
    assert all_ > 2000 and bad <= 0.02 * all_


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>x()</script></head><body class="home">
<div class="cookie-consent">We use cookies to make this site work. <button>Accept</button></div>
<header class="site-header"><a href="/">Example News</a><nav><ul><li><a href="/a">World</a><li><a href="/b">Sport</a></ul></nav>
<form action="/s"><input name="q"><button>Search</button></form></header>
<main><article><h1>Rivers &amp; lakes</h1><p>The first paragraph tells, at some length, what
happened by the river yesterday.</p><p>Short one.</p><div class="ad-slot">Buy our boats today!</div>
<h2>Why it matters</h2><p>Another paragraph with a <a href="/x">link</a> in it, and an end.</p><ul><li>First point of the list.</li>
<li>Second point of it.</li></ul><p>Last words.</p>
<div class="share-buttons"><a href="#">Share</a> <a href="#">Print</a></div></article>
<section class="comments"><h3>2 comments</h3><div class="comment"><b>Ann</b><p>I was there and saw it all, it was quite a sight.</p></div>
<div class="comment"><b>Bob</b><p>Nice article.</p></div></section></main>
<aside class="sidebar"><h3>Related</h3><ul><li><a href="/1">Boats of the north</a><li><a href="/2">Lakes</a></ul></aside>
<footer>&copy; 2024 Example News. All rights reserved. <a href="/p">Privacy</a></footer></body></html>"""


def test_handmade_page():
    got = X.Extractor(X.default_model()).main_text(PAGE)
    assert got.split("\n\n") == ["Rivers & lakes", "The first paragraph tells, at some length, what happened by the river yesterday.",
                                 "Short one.", "Why it matters", "Another paragraph with a link in it, and an end.",
                                 "First point of the list.", "Second point of it.", "Last words."]


def by_template(page):
    """The test tables' pages have one article element without parts of other kinds."""
    m = re.search(r"<article>(.*?)</article>", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", m.group(1)) if m else []
    return "\n\n".join(x for x in (clean(html.unescape(re.sub(r"</?b>", "", p.replace("<br>", " ")))) for p in parts) if x)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_whole_table(spark, sf):
    from ledgerlens.llm.queries import QUERIES

    pages = {r.page_id: r for r in spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").collect()}
    got = QUERIES["op11_crf_main_text"](spark, f"/root/testdata/{sf}").collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == by_template(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_odd_pages(spark):
    long = "<nav><a>Home</a></nav><article><h1>Title</h1>" + "".join(f"<p>Paragraph {i} is here, with words.</p>" for i in range(20_000)) + "</article>"
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (3, "", ""), (None, "v", "<body><article><h1>One</h1><p>Only this stands here.</p></article>"),
            (4, "w", long), (5, "x", "<nav><a>Home</a></nav>"), (7, "z", "<article><p>Only this stands here, all alone.</p></article>"), (6, "y", "<p>" + "word " * 200_000 + "</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' as text", "7 as id", "8 as n_chars")
    got = X.extract_main_text(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    by = {}
    for r in got.collect():
        by.setdefault(r.page_id, []).append(r)
        assert r.n_chars == len(r.text)
    assert len(by[1]) == 2 and by[1][0] == by[1][1] and by[1][0].text.startswith("Rivers & lakes")
    assert [by[k][0].text for k in (2, 3, 5)] == ["", "", ""]
    assert by[None][0].text == "One\n\nOnly this stands here."
    assert by[7][0].text == "Only this stands here, all alone."
    assert by[4][0].text.count("\n\n") == 20_000 and len(by[6][0].text) == 999_999
    assert X.extract_main_text(df.limit(0)).count() == 0


def test_own_labels(spark):
    """A caller's labelled pages decide, here against the usual roles."""
    pages = [f"<div class='keepers' data-main='1'><p>{'a ' * n}</p></div><article data-main='0'><p>{'b ' * n}</p></article>" for n in range(3, 40)]
    model = X.fit(pages)
    df = spark.createDataFrame([(1, "u", "<article><p>b b b b b</p></article><div class='keepers'><p>a a a a a</p></div>")], "page_id int, url string, html string")
    row, = X.extract_main_text(df, model=model).collect()
    assert row.text == "a a a a a" and X.extract_main_text(df, model=model).schema["page_id"].dataType.simpleString() == "int"
