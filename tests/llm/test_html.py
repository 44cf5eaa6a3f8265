"""Main-text extraction: held-out layouts, real pages, broken markup."""

import re
from html import unescape

import numpy as np

from rarebird.llm import html_crf
from rarebird.llm.html_pages import labelled_pages


def test_held_out_layouts():
    model = html_crf.default_model()
    wrong = total = 0
    for html, content in labelled_pages(120, seed=99):
        blocks = html_crf.blocks_of(html)
        labels = model.decode([html_crf.features(b, k, len(blocks)) for k, b in enumerate(blocks)])
        total += len(blocks)
        wrong += sum((b.text in content) != on for b, on in zip(blocks, labels, strict=True))
    assert wrong < 0.01 * total


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(2)
    for _ in range(50):
        n = int(rng.integers(1, 7))
        model = html_crf.Crf(rng.normal(size=1 << html_crf.BITS), rng.normal(size=(2, 2)))
        page = [[int(x) for x in rng.integers(0, 1 << html_crf.BITS, 3)] for _ in range(n)]
        e = model.emissions(page)
        value = lambda y: sum(e[t] * y[t] for t in range(n)) + sum(model.moves[y[t - 1], y[t]] for t in range(1, n))
        best = max(([int(b) for b in f"{k:0{n}b}"] for k in range(1 << n)), key=value)
        assert model.decode(page) == [bool(x) for x in best]


def test_pages_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}

    def article(h):  # the generator's own region, read plainly
        pieces = re.split(r"</?(?:p|h1)>", h[h.index("<article>") + 9 : h.index("</article>")])
        lines = (" ".join(unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in pieces)
        return "\n".join(x for x in lines if x)

    rows = html_crf.extract(pages).collect()
    assert len(rows) == len(html)
    assert sum(r.text == article(html[r.page_id]) for r in rows) >= 0.99 * len(rows)
    assert all(r.n_chars == len(r.text) for r in rows)


def test_markup():
    text = lambda h: [b.text for b in html_crf.blocks_of(h)]
    assert text("") == [] and text("plain &amp; simple\n text") == ["plain & simple text"]
    assert text("<p>a<p>b<b>c</b>d<br>e") == ["a", "bcd e"]
    assert text('<p title="x>y">a</p><!-- <p>no</p> --><script>"<p>no</p>"</script><style>p{}</style>b') == ["a", "b"]
    assert text("<ul><li>one<li>two</ul></div>three<script>never closed <p>x") == ["one", "two", "three"]
    assert text("<p>one <script>var a = '<p>';</script> two</p>") == ["one two"]
    assert text("<p>H<custom-x>e</custom-x>llo<picture><source srcset=a><img src=b></picture> you") == ["Hello you"]
    assert text("<p>E = <math><mi>m</mi><mi>c</mi></math> <svg><title>no</title><text>two</text></svg>") == ["E = mc two"]
    assert text("<p>a<noscript> b</noscript><object data=x> c</object><button>Buy <b>now</b></button> d<button> e") == ["a b c d e"]
    assert text("<P>&lt;p&gt; &#233;&nbsp;&copy</P> 1 < 2 <") == ["<p> é ©", "1 < 2 <"]


def test_edges(spark):
    df = spark.createDataFrame([(1, "u", None, 9), (1, "u", None, 9), (None, None, "", 9), (3, "v", "<article>" + "<p>A text, and more.</p>" * 5000 + "</article>", 9)],
                               "page_id bigint, url string, html string, text int")
    rows = html_crf.extract(df).collect()
    assert [r.n_chars for r in rows[:3]] == [0, 0, 0] and rows[3].text.count("\n") == 4999
    assert html_crf.extract(df.where("false")).count() == 0
