"""Main text of pages: hand-written layouts, given pages against their own markup, and the field against trying all labelings."""

import html
import itertools
import os
import re

import numpy as np
import pytest

from terraloom.llm import html_extract, html_pages
from terraloom.llm.html_blocks import leaf_blocks

PAGES = "/root/testdata/sf0.01/pages.parquet"

LAYOUTS = {
    "blog": (
        """<html><head><title>T</title></head><body class="home"><header class="site-header"><a href="/">My blog</a><p>All about things</p>
        <nav class="main-menu"><ul><li><a href="/">Home</a><li><a href="/a">About</a></ul></nav></header>
        <div id="cookie-notice">We use cookies to improve this site. <button>OK</button></div>
        <div class="wrap"><main><article class="post"><h1 class="entry-title">A  walk &amp; a talk</h1>
        <div class="entry-content"><p>We went out early.<p>It rained,<br>then stopped.<div class="ad-slot">Buy boots now, they are very good boots.</div>
        <ul><li>Boots<li>Hat</ul><blockquote>Never again, said <i>everyone</i>.</blockquote></div>
        <form class="newsletter"><p>Get our news every week by mail.</p><input><button>Subscribe</button></form></article>
        <section id="comments"><h3>2 comments</h3><article class="comment"><p>What a lovely text, I have enjoyed it a lot.</p></article>
        <article class="comment"><p>So did I. We should go there, too.</p></article></section></main>
        <aside class="sidebar"><h3>Popular</h3><ul><li><a href=x>Ten hats</a></ul></aside></div>
        <footer>&copy; 2020 My blog</footer><script>if (a < b) document.write("<p>no</p>")</script></body></html>""",
        "A walk & a talk\nWe went out early.\nIt rained, then stopped.\nBoots\nHat\nNever again, said everyone.",
    ),
    "divs": (
        """<div id="page"><div id="header"><div class="logo">News</div><div class="tagline">Every day anew.</div></div>
        <div class="breadcrumb"><a href=/>News</a> » <a href=/x>World</a></div>
        <div id="content"><h1>Storm passes</h1><p>The storm that came on Sunday has passed.</p><p>No harm was done.</p>
        <table><tr><td>Wind</td><td>90 km/h</td></tr></table></div>
        <div id="sidebar"><h2>More news</h2><p>Read what else happened on Sunday in our town.</p></div>
        <div class="comments"><p>I was there and I saw it all happen.</p></div><div id="footer"><p>Imprint. All rights reserved.</p></div></div>""",
        "Storm passes\nThe storm that came on Sunday has passed.\nNo harm was done.\nWind\n90 km/h",
    ),
    "broken": (
        """<BODY><NAV><A HREF=x>one</A> <A HREF=y>two</A></NAV><!-- <p>gone</p> --><ARTICLE><H2>Half</H2><P>First part &lt;here&gt;<P>Second
        &nbsp; part<STYLE>p {}</STYLE><FOOTER>&copy; me""",
        "Half\nFirst part <here>\nSecond part",
    ),
    "nothing": ("<nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav><footer>&copy; 2021</footer>", ""),
}


@pytest.mark.parametrize("name", LAYOUTS)
def test_layouts(name):
    page, want = LAYOUTS[name]
    assert html_extract.main_text(page, html_extract.default_model()) == want


def test_generated_pages_not_learned_from():
    wrong = total = 0
    for seed in range(50_000, 50_200):
        blocks, labels = html_extract.labelled_blocks(html_pages.labelled_page(seed))
        got = html_extract.decode(blocks, html_extract.default_model())
        wrong, total = wrong + sum(a != b for a, b in zip(got, labels)), total + len(labels)
    assert total > 2000 and wrong < total / 200


def test_blocks():
    texts = [t for t, _ in leaf_blocks("a<b>b</b> c<p>d<br>e<p>f<script>'</p>'</script>g<ul><li>h<li>i</ul>j < k &amp; l<!--x--><table><tr><td>m<td>n</table><template><p>o</template>")]
    assert texts == ["ab c", "d e", "f", "g", "h", "i", "j < k & l", "m", "n"]


def test_likelihood_and_viterbi_against_all_labelings():
    rng = np.random.default_rng(2)
    lengths = np.array([1, 4, 6])
    emit = np.zeros((3, 6, 2))
    emit[..., 1] = rng.normal(size=(3, 6))
    start, step, stop = rng.normal(size=2), rng.normal(size=(2, 2)), rng.normal(size=2)
    total, one, pair = html_extract.likelihood(emit, lengths, start, step, stop)
    for p, n in enumerate(lengths):
        def score(labels):
            return start[labels[0]] + stop[labels[-1]] + sum(emit[p, t, y] for t, y in enumerate(labels)) + sum(step[a, b] for a, b in zip(labels, labels[1:]))

        every = {labels: score(labels) for labels in itertools.product((0, 1), repeat=int(n))}
        whole = np.log(sum(np.exp(v) for v in every.values()))
        assert np.isclose(total[p], whole)
        for t in range(n):
            assert np.isclose(one[p, t, 1], sum(np.exp(v - whole) for labels, v in every.items() if labels[t]))
        for t in range(n - 1):
            assert np.isclose(pair[p, t, 0, 1], sum(np.exp(v - whole) for labels, v in every.items() if labels[t : t + 2] == (0, 1)))
        model = html_extract.Model({f"f{t}": emit[p, t, 1] for t in range(n)}, tuple(start), tuple(map(tuple, step)), tuple(stop))
        assert tuple(html_extract.decode([[f"f{t}"] for t in range(n)], model)) == max(every, key=every.get)


def test_train_on_a_table_of_labelled_pages(spark):
    pages = [html_pages.labelled_page(seed) for seed in range(60)]
    rows = [(page.replace(html_pages.MARK, ""), html_extract.labelled_blocks(page)[1]) for page in pages]
    model = html_extract.train(spark.createDataFrame([*rows, (None, None), ("<p>x", [1, 0, 1])], "html string, labels array<int>"))
    blocks, labels = html_extract.labelled_blocks(pages[0])
    assert html_extract.decode(blocks, model) == labels
    assert html_extract.decode(blocks, html_extract.fit([])) is not None


@pytest.mark.skipif(not os.path.exists(PAGES), reason="shared tables are not here")
def test_given_pages_against_their_markup(spark):
    for row in html_extract.extract(spark.read.parquet(PAGES)).collect():
        article = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<br>|</?b>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert row.text == "\n".join(x for x in parts if x)


def test_odd_rows(spark):
    long = "<article>" + "<p>Wort für Wort.</p>" * 20_000 + "</article>"
    rows = [(1, None, "u"), (2, "", None), (None, "   ", "u"), (3, long, "u"), (4, "no tags at all, but text.", "u"), (4, "no tags at all, but text.", "u"), (5, "<<<>>&&#x;<p", "u")]
    df = spark.createDataFrame(rows, "page_id bigint, html string, url string").selectExpr("*", "'own' AS text", "7 AS score")
    got = html_extract.extract(df).collect()
    assert sorted((r.page_id or 0, r.score) for r in got) == [(0, 7), (1, 7), (2, 7), (3, 7), (4, 7), (4, 7), (5, 7)]
    by_id = {r.page_id: r for r in got}
    assert by_id[1].text == by_id[2].text == by_id[None].text == "" and by_id[1].n_chars == 0
    assert by_id[3].text == "\n".join(["Wort für Wort."] * 20_000) and by_id[3].n_chars == len(by_id[3].text)
    assert html_extract.extract(df.where("false")).count() == 0
