"""Main text of pages: blocks, gradients, held-out layouts, and the given pages by a plain reading of their article."""

import html
import os
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.llm import htmltext
from voxloom.llm.htmlblocks import Reader
from voxloom.llm.htmllayouts import MARKS, draw

SF = "/root/testdata/sf0.01"
READER = Reader()


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(0)
    vocab = ["".join(rng.choice(list("aeioulnrst"), int(rng.integers(2, 9)))) for _ in range(400)]
    pages = [re.sub(f"[{MARKS[0]}{MARKS[1]}]", "", draw(rng, list(rng.choice(vocab, 3000)))) for _ in range(60)]
    return htmltext.fit(*htmltext.lessons(pages))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", []),
        ("x", ["x"]),
        (" \n\t", []),
        ("<p>a<b>b</b>c<p>d &amp;amp; <i>x</i><br>y<div>z<script>'</p>'</script>w</div></b>t < 5 <!-- c --> u", ["abc", "d &amp; x y", "zw", "t < 5 u"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<TABLE><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<svg/>a<svg><text>no</text></svg>b<noscript>n</noscript><template>t</template>", ["ab"]),
        ('a<a href="x>y" title=\'<p>\'>link</a>&nbsp;&#65; &lt;b&gt;', ["alink A <b>"]),
        ("a<a href='x", ["a"]),
        ("<title>t</title><p>a</span>b</p>", ["ab"]),
        ("<![CDATA[x]]><?php y ?>z", ["z"]),
        ("p<!-- <p>no</p>", ["p"]),
        ("é 東京 🙂<h1>ü</h1>", ["é 東京 🙂", "ü"]),
    ],
)
def test_blocks(page, want):
    assert [x.text for x in READER.leaves(page)] == want


def test_hostile_pages_are_linear():
    n = 200_000
    for page in ("<" * n, "<b>" * n + "</i>" * n, "<p>a" * n, '<a ="' * n, "<a " * n + 'x=">"', "<p><table><td>" + "<b>" * n + "<div>" * n, "&" * n, "<script>" * n, "<!--" * n, "</" * n, "<" + "a" * n + "=" * n + ">", "<li><b>" * n):
        began = time.process_time()
        READER.leaves(page)
        assert time.process_time() - began < 20, page[:20]


def test_gradients():
    rng = np.random.default_rng(1)
    pages = [htmltext.Page(READER.leaves(re.sub(f"[{MARKS[0]}{MARKS[1]}]", "", draw(rng, [f"w{i}" for i in range(80)]))), {}) for _ in range(3)]
    labels = [(rng.random(q.blocks) < 0.5).astype(np.float64) for q in pages]
    p = {k: x.astype(np.float64) + rng.normal(0, 0.1, x.shape) for k, x in htmltext.start().items()}
    weights = np.array([1.0, 0.0, 0.5])
    _, grad = htmltext.gradients(p, pages, labels, weights)
    for name in p:
        touched = np.argwhere(np.abs(grad[name]) > 1e-4)
        for at in map(tuple, touched[rng.integers(0, len(touched), 3)]):
            step, old = 1e-3, p[name][at]
            p[name][at] = old + step
            up, _ = htmltext.gradients(p, pages, labels, weights)
            p[name][at] = old - step
            down, _ = htmltext.gradients(p, pages, labels, weights)
            p[name][at] = old
            assert abs((up - down) / (2 * step) - grad[name][at]) < 2e-3 + 0.05 * abs(grad[name][at]), name


def test_stretches_hand_on_their_states(model, monkeypatch):
    pages = [htmltext.Page(READER.leaves("<p>a b c<div class=ad>d</div>" * n), {}) for n in (40, 7, 1)]
    whole = htmltext.probabilities(model, pages)
    monkeypatch.setattr(htmltext, "STRETCH", 9)
    for a, b in zip(whole, htmltext.probabilities(model, pages), strict=True):
        assert np.allclose(a, b, atol=1e-5)


def test_held_out_layouts(model):
    pages, labels = htmltext.lessons([], 300, seed=77)
    wrong = sum(int(((q >= htmltext.MAIN) != (lab > 0.5)).sum()) for q, lab in zip(htmltext.probabilities(model, pages), labels, strict=True))
    assert wrong < 0.03 * sum(q.blocks for q in pages)


PROSE = "The council met on Tuesday evening to discuss the new bridge. Several residents spoke against the plan, and the mayor promised a further review of its costs."
LAYOUTS = [
    f'<body><header class="site-header"><div class="logo">Town Times</div></header><nav class="main-nav"><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav><div class="cookie-notice"><p>We use cookies to improve your experience.</p><button>OK</button></div><div class="post-content"><h1>Bridge plan</h1><p>{PROSE}</p><p>{PROSE}</p></div><section id="comments"><h3>2 comments</h3><div class="comment"><p>I think this is a bad idea and a waste of money, the mayor should know better.</p></div><form><label>Name</label><button>Send</button></form></section><footer>© 2024 Town Times</footer></body>',
    f"<body><div id=top><a href=/>Start</a> | <a href=/a>About</a></div><div id=sidebar><h3>Popular</h3><ul><li><a href=1>One story</a><li><a href=2>Another story</a></ul></div><main><h1>Bridge plan</h1><p>{PROSE}<p>{PROSE}<div class='ad'>Buy now and save</div><p>{PROSE}</main><aside><p>Subscribe to our newsletter today.</p></aside><footer><p>All rights reserved.</p></footer>",
]


@pytest.mark.parametrize("page", LAYOUTS)
def test_other_layouts(model, page):
    (got,) = htmltext.extract(model, [page], READER, {})
    n = page.count(PROSE)
    assert got == " ".join(["Bridge plan", *[PROSE] * n])


def test_edges(spark, model):
    rows = [(1, None), (2, ""), (3, LAYOUTS[0]), (3, LAYOUTS[0]), (None, LAYOUTS[1]), (4, "<nav><a href=x>Home</a></nav>"), (5, "<main>" + f"<p>{PROSE}</p>" * 20_000 + "</main>")]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumns({"text": F.lit(1), "_main": F.lit("kept")}).repartition(2)
    got = htmltext.main_text(pages, model)
    assert got.columns == ["page_id", "html", "_main", "text", "n_chars"]
    by = {}
    for r in got.collect():
        by.setdefault(r.page_id, []).append(r)
        assert r.n_chars == len(r.text) and r._main == "kept"
    assert by[1][0].text == by[2][0].text == "" and by[3][0].text == by[3][1].text and by[None][0].text.count(PROSE) == 3
    assert by[5][0].text == " ".join([PROSE] * 20_000)
    none = pages.limit(0)
    assert htmltext.main_text(none, htmltext.train(none)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables aren't here")
def test_given_pages(spark):
    def article(page):
        inside = page[page.index("<article>") + 9 : page.index("</article>")]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inside))
        return " ".join(b for b in blocks if b)

    want = [(r.page_id, r.url, article(r.html), len(article(r.html))) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert sorted(map(tuple, htmltext.op13_htmltext(spark, SF).collect())) == sorted(want)
