"""Main text: the parser, the pass over the tree, whole pages in layouts the trees have not seen, edge cases."""

import itertools
import os

import numpy as np
import pytest

from riskmart.llm import html_extract as H

PARAGRAPHS = [f"Paragraph {i}, with some words in it, and then some more of them." for i in range(40)]


@pytest.fixture(scope="module")
def trees():
    page = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    return H.fit_pages([f"<body><nav><a>Home</a><a>News</a></nav><article><h1>Head</h1>{page}</article><footer>Imprint</footer></body>"])


def text(page, trees):
    nodes = H.parse(page)
    return H.text_of(nodes, H.settled(nodes, H.rated([nodes], trees)[0]))


def test_blocks():
    nodes = H.parse("<div>a <b>b</b>&amp;c<p>d<br>e<p>f &#233;<!-- x > y --><script>if (a < b) {}</script></div> g <li>h<li>i")
    assert H.text_of(nodes, np.ones(len(nodes), bool)) == "a b&c\nd e\nf é\ng\nh\ni"


def whole(page):
    nodes = H.parse(page)
    return H.text_of(nodes, np.ones(len(nodes), bool))


def test_unseen_elements_vanish_with_what_is_in_them():
    for unseen in ("<button>Go <b>on</b></button>", "<button><div><p>Go</p></div></button>", "<select><option>x<option selected>y</select>",
                   "<svg viewBox='0 0 1 1'><title>x</title><svg><g><path d='m'/><text>x</text></g></svg><use/>x<a>y</a></svg>", "<svg/>",
                   "<math><mi>x</mi></math>", "<canvas>no <a href=#>canvas</a></canvas>", "<video src=v><track><p>no video</p></video>",
                   "<audio>no audio</audio>", "<object><object>x</object>y</object>", "<datalist><option>x</option></datalist>",
                   "<template><template>x</template><p>y</p></template>", "<svg><foreignObject><div>x</div></foreignObject>y</svg>",
                   "<option>x<option>y</option>", "<button>x<button>y</button>", "<video><img><br>x</video>", "<svg><script>a < b</script>x</svg>"):
        assert whole(f"<div><p>a {unseen} b <i>c</i></p>d</div> e") == "a b c\nd\ne", unseen
        assert whole(f"<p>a{unseen}<a href=#>b</a> c") == "a b c", unseen
    assert whole("a <textarea><b>x</textarea> b <iframe>x</iframe>c") == "a b c"
    assert whole("<head><title>x</title><meta>\n<p>a") == whole("<head><title>x</title>a") == "a"
    assert whole("<html><head><title>x</title><style>y</style></head><body>a") == whole("<head><link><body>a</body>") == "a"
    assert whole("<div><button>x</div><p>a") == whole("<div><svg><g></div><p>a") == whole("<svg><g><p>a") == "a"
    links = H.parse("<a>b<svg><a>x</a></svg>c</a>d")[0].inside
    assert [x for x in links if x != " "] == [("a", "b"), ("a", "c"), "d"]


def test_unseen_elements_in_the_article(trees):
    body = "".join(f"<p>{p}<button>Copy</button></p><select><option>One, and more</option><option>Two</option></select>"
                   f"<svg><title>Icon</title><text>Drawn, with words</text></svg>" for p in PARAGRAPHS[:6])
    page = f"<body><nav><a href=/>Home</a></nav><article><h1>Head</h1>{body}<video>No video, sorry about that.</video></article></body>"
    assert text(page, trees) == "Head\n" + "\n".join(PARAGRAPHS[:6])


def test_bad_markup_loses_no_text():
    """What browsers make of quotes, comments and unfinished tags."""
    assert whole("<p data-x=don't>First words.</p><p>Second, isn't it.</p><p>Third.</p>") == "First words.\nSecond, isn't it.\nThird."
    assert whole("<p title=\"it's 5\" wide\">First.</p><p class=\"a\">Second.</p>") == "First.\nSecond."
    assert whole('<p class="a>Second words.</p>') == "Second words."
    assert whole("<p>a</p><!-- x --!><p>b</p>") == whole("<p>a</p><!--><p>b</p>") == whole("<p>a</p><!---><p>b</p>") == "a\nb"
    assert whole("<p>a</p><!-- x -- > <p>y</p> --><p>b</p>") == whole("<p>a</p><!-- x\n--><p>b</p>") == "a\nb"
    assert whole("a<!-- never closed <p>b") == whole("a<p b='c") == whole("a<div") == "a"
    assert whole("<p/>a</><b / c=d/e =f ==g>b</b x='>'>c</p>") == "abc"
    assert whole("2 < 3 & 4 <5 <<b>x</b>") == "2 < 3 & 4 <5 <x"
    assert whole("<?php x ?><!doctype html><![CDATA[x]]>a</3>b") == "ab"
    assert whole("<script>if (a<b && c=='x) </scripty> '</script >a<style><!-- </style>b<script>c") == "ab"
    assert H.parse("<div ID='a>b' class = x\tdata-y checked id=z>t")[1].attributes == {"id": "a>b", "class": "x", "data-y": "", "checked": ""}


def test_long_bad_markup_in_linear_time():
    import time
    for piece in ('<a b="c ', "<a b='", "<!-- ", "<p x=", "</", "<![", "<b / / ", "<script>", '"<i q=\'"'):
        page = piece * ((1 << 20) // len(piece))
        start = time.process_time()
        H.parse(page)
        assert time.process_time() - start < 6, piece


def test_very_many_siblings():
    nodes = H.parse("<ul>" + "<li>x" * 20000 + "<p>y</p></ul>")
    same = H.described(nodes)[:, H.NUMBERS.index("same")]
    assert sorted(set(same.tolist())) == [1.0, 20000.0]


def test_sample_does_not_depend_on_order(spark):
    rows = [(None if i % 3 else 5, f"<article><p>{PARAGRAPHS[i % 40]} {i % 70}</p></article>") for i in range(500)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    one, two = (H.fit(p, limit=30) for p in (pages, pages.repartition(5)))
    assert all((a == b).all() for a, b in zip(one.leaf, two.leaf))


def test_settled_is_the_best_choice():
    nodes = H.parse("<div><p>a</p><section><p>b</p><p>c</p></section></div><div><p>d</p></div>")
    n = len(nodes)
    rng = np.random.default_rng(1)
    for _ in range(40):
        odds = rng.normal(size=n) * 3
        free = [k for k in itertools.product([0, 1], repeat=n) if all(x.parent < 0 or k[i] <= k[x.parent] for i, x in enumerate(nodes))]
        best = max(free, key=lambda k: np.dot(k, np.clip(odds, -8, 8)))
        assert H.settled(nodes, odds).astype(int).tolist() == list(best)


def test_layouts(trees):
    body = "".join(f"<p>{p}</p>" for p in PARAGRAPHS[:6])
    want = "Head\n" + "\n".join(PARAGRAPHS[:6])
    junk = "<nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav>"
    for page in (f"<body>{junk}<article><h1>Head</h1>{body}</article><footer>&copy; me</footer></body>",
                 f"<body>{junk}<main><h1>Head</h1>{body}<section class=comments><p>Nice one, thanks a lot!</p></section></main></body>",
                 f"<body><div class='cookie-notice'>We use cookies, accept?</div><div id=content><h1>Head</h1>{body}</div><div class=sidebar><p>Other things, elsewhere.</p></div></body>",
                 f"<body>{junk}<article><h1>Head</h1>{body}<form>Subscribe <input></form><div class=ad>Buy this, now!</div></article>"):
        assert text(page, trees) == want


def test_edges(spark, trees):
    rows = [(1, None), (2, ""), (3, "<<<>>"), (None, "<article><p>Some words here, and more.</p>"), (4, "<div>" * 3000), (5, "<p>" + "word " * 60000)]
    pages = spark.createDataFrame([(i, h, "u", 1) for i, h in rows], "page_id long, html string, url string, TEXT int")
    got = {r.page_id: r.text for r in H.extract(pages, trees, keep=["page_id", "url"]).collect()}
    assert got[1] == got[2] == "" and got[None] == "Some words here, and more." and len(got) == 6
    assert H.extract(pages.limit(0), trees).collect() == []
    assert isinstance(H.fit(pages.limit(0)), H.Boosted)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="driver tables are not here")
def test_table(spark):
    import html
    import re
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = H.extract(pages, H.fit(pages), keep=["html"]).collect()
    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)
