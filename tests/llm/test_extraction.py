import html
import random
import re

import numpy as np
import pytest
from util import SF001

from sparkprep.llm import extraction as X
from sparkprep.llm import queries


def expected(page):
    """Main text of the driver's pages, by their markup."""
    body = re.search(r"<article>(.*)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", body)
    parts = [" ".join(html.unescape(re.sub(r"</?b>", "", q.replace("<br>", " "))).split()) for q in parts]
    return "\n".join(p for p in parts if p)


def test_driver_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()}
    got = queries.op5_html_extraction(spark, SF001).collect()
    assert len(got) == len(pages)
    right = [r.text == expected(pages[r.page_id].html) and r.url == pages[r.page_id].url and r.n_chars == len(r.text) for r in got]
    assert np.mean(right) == 1


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return X.train_extractor(pages)


def test_other_layouts_held_out(pages, model):
    rows = [X.parse(r.html) for r in pages.orderBy("page_id").limit(120).collect()]
    extra = [b.text for blocks in rows for b in blocks]
    rng = random.Random(99)
    total = right = 0
    for blocks in rows:
        made, labels = X.training_page([b.text for b, y in zip(blocks, X.weak_labels(blocks)) if y], extra, rng)
        total += len(labels)
        right += sum(a == b for a, b in zip(model.decode(made), labels))
    assert right >= 0.98 * total


def test_odd_pages(spark, model):
    page = ("<html><body><nav><ul><li><a href=/a>Home page</a></li><li><a href=/b>News of the day</a></li></ul></nav><article><h1>The&nbsp;title &amp; more</h1><p>One  of\nthe long sentences "
            "that a page has, with &lt;b&gt; and &eacute;, and <b>bold</b> words.</p><p>Another paragraph that is also long enough to be read.<p>A third one, unclosed, with more words in it.</article>"
            "<footer>&copy; 2024 Someone</footer></body></html>")
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p"), (5, "u", "<<<>>> </b></p> <script>x"), (None, "u", page), (1, "u", page), (6, "u", page.replace("<p>One", "<p>" + "Word. " * 30000)),
            (7, "u", "<!-- <p>no</p>"), (8, "u", "<a href='" + "x" * 50000), (9, "u", "<b>" * 20000 + "deep")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars", "'z' as other")
    got = X.extract_text(df, model)
    out = got.collect()
    assert len(out) == len(rows) and "other" in got.columns and all(r.n_chars == len(r.text) for r in out)
    first = next(r.text for r in out if r.page_id == 1)
    assert first.split("\n") == ["The title & more", "One of the long sentences that a page has, with <b> and é, and bold words.",
                                 "Another paragraph that is also long enough to be read.", "A third one, unclosed, with more words in it."]
    assert {r.text for r in out if r.page_id in (2, 3, 7)} == {""}
    assert X.extract_text(df.limit(0), model).count() == 0
    blank = X.train_extractor(df.limit(0))
    assert X.extract_text(df, blank).count() == len(rows)


@pytest.mark.parametrize("page, texts", [
    ("<p>before <math><mi>x</mi><mo>=</mo><mn>2</mn></math> after</p>", ["before x=2 after"]),
    ("<p>a <svg><path d='m/'/>icon</svg> b</p><p>c", ["a icon b", "c"]),
    ("<p>a</p><svg><g><p>rest</p><p>more</p>", ["a", "rest", "more"]),
    ("<math><mi>x</mi><p>after", ["x", "after"]),
    ("<xmp><b>1 &lt; 2</b></xmp><p>x</p>", ["<b>1 &lt; 2</b>", "x"]),
    ("<xmp>open", ["open"]),
    ("<p>a<script src='a.js'/>var x=1;</script>b</p>", ["a b"]),
    ("<svg><style/><text>A</text><text>B</text></svg><p>z", ["A B", "z"]),
    ("<svg><foreignObject><p>in</p><p>two</p></foreignObject></svg>", ["in", "two"]),
])
def test_nothing_else_is_dropped(page, texts):
    assert [b.text for b in X.parse(page)] == texts


def test_slashes_close_no_html_element():
    inside, link = X.parse("<section data-u=/foo/>t</section><a href=/x/>link</a>")
    assert inside.tags == ("section",) and link.linked == 4


def test_shares_are_of_whole_blocks():
    late, plain = X.parse(f"<p>{'word ' * 60}{'7' * 900}</p>"), X.parse(f"<p>{'word ' * 60}{'x' * 900}</p>")
    assert X.features(late) != X.features(plain)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    blocks = X.parse("".join(f"<p>word {'x' * i}</p>" for i in range(8)))
    m = X.CRF(rng.normal(size=(X.DIMS, 2)), rng.normal(size=(2, 2)), rng.normal(size=2), rng.normal(size=2))
    f = X.features(blocks)

    def score(path):
        return m.first[path[0]] + m.final[path[-1]] + sum(m.emit[x, s].sum() for x, s in zip(f, path)) + sum(m.step[a, b] for a, b in zip(path, path[1:]))

    every = [[(i >> k) & 1 for k in range(8)] for i in range(256)]
    assert score(m.decode(blocks)) == pytest.approx(max(map(score, every)))
