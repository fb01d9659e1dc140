import time

import pytest

from veloframe.llm import html_extract as H
from veloframe.llm import html_training as T
from veloframe.llm.queries import op8_html_extraction


@pytest.fixture(scope="module")
def model():
    return H.fit(T.labelled_pages())


def test_marginals_equal_enumeration(model):
    import itertools
    import math

    page = H.Page('<div class="x"><p>a b</p><ul><li>c</ul></div><footer>d</footer>')
    every = range(len(page.tags))
    nodes, kinds = [H.features(page, i) for i in every], [H.edge_kind(page, i) for i in every]
    odds, joint = model.infer(page.parents, nodes, kinds)
    total, ones, pairs = 0.0, [0.0] * len(nodes), [[0.0] * 4 for _ in nodes]
    for y in itertools.product((0, 1), repeat=len(nodes)):
        w = math.exp(sum(y[i] * sum(model.weights.get(f, 0.0) for f in nodes[i]) for i in every)
                     + sum(model.edges[kinds[i]][y[page.parents[i]]][y[i]] for i in every if i))
        total += w
        for i in every:
            ones[i] += w * y[i]
            if i:
                pairs[i][2 * y[page.parents[i]] + y[i]] += w
    for i in every:
        assert 1 / (1 + math.exp(-odds[i])) == pytest.approx(ones[i] / total)
        if i:
            assert joint[i] == pytest.approx([p / total for p in pairs[i]])


def test_held_out_pages(model):
    right = n = 0
    for html in T.labelled_pages(60, seed=77):
        page = H.Page(html)
        labels = [1]
        for i in range(1, len(page.tags)):
            labels.append(labels[page.parents[i]] if page.labels[i] is None else int(page.labels[i] == "1"))
        for (node, _), (_, odds) in zip(page.texts, model.content(html), strict=True):
            right += (odds > 0) == labels[node]
            n += 1
    assert right / n > 0.98


def test_blocks_entities_and_unclosed_tags(model):
    html = ('<!DOCTYPE html><html><head><title>T &amp x</title><style>p{}</style><script>var t="</p>";</script></head>'
            '<body><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy this now please.</div>'
            "<article><h1>A &amp; B &am</h1><p><b>First  \n part.<br><p>Sec<i>ond</i> &quot;one&quot; &#233;&copy.</p>"
            "<p>   </p><p>Third paragraph of it.</p></article><footer>&copy; 2020 site</footer>")
    assert model.main_text(html) == 'A & B &am First part. Sec ond "one" é©. Third paragraph of it.'.replace(
        "Sec ond", "Second")


def test_other_parts_are_left_out(model):
    for part in ("<header><p>Site name here</p></header>", "<aside><p>Some side words here, many of them.</p></aside>",
                 '<div class="cookie-notice"><p>We use cookies, as all do.</p></div>',
                 "<form><label>Name</label><input><button>Send</button></form>",
                 '<section class="comments"><div class="comment"><p>I liked this text a lot, it is good.</p></div></section>',
                 '<div class="sidebar"><p>Other things to read about here.</p></div>'):
        html = f"<html><body>{part}<article><h1>Title</h1><p>Main words of the page, as they are.</p></article>{part}</body>"
        assert model.main_text(html) == "Title Main words of the page, as they are.", part


def test_odd_pages(model):
    assert model.main_text("<p>" * 3000 + "x" + "<div>" * 3000) in ("x", "")
    deep = "<div>" * 20_000 + "deep words" + "</div>" * 20_000
    assert model.main_text(deep) in ("deep words", "")
    assert model.main_text("<![CDATA[ x <!ELEMENT a> <? y > </b></p> <script>never ends <p>z") is not None


def test_query_on_odd_rows(spark, folder):
    rows = [(1, "u", None, "c"), (2, None, "", "c"), (None, "u", "<article><p>Words of the article, all of them.</p></article>", "c"),
            (4, "u", "<article><p>Words of the article, all of them.</p></article>", "c"),
            (4, "u", "<article><p>Words of the article, all of them.</p></article>", "c"),
            (5, "u", "<article>" + "<p>Many words stand in here, again.</p>" * 5000 + "</article>", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = [(r["page_id"], r["n_chars"], r["text"]) for r in op8_html_extraction(spark, folder(pages=pages)).collect()]
    words, many = "Words of the article, all of them.", "Many words stand in here, again."
    long_ = " ".join([many] * 5000)
    want = [(1, 0, ""), (2, 0, ""), (None, len(words), words), *[(4, len(words), words)] * 2, (5, len(long_), long_)]
    assert sorted(out, key=str) == sorted(want, key=str)


def test_empty_table(spark, folder):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert op8_html_extraction(spark, folder(pages=pages)).count() == 0


def test_deep_pages_in_linear_time(model):
    seen = []
    for n in (2000, 16000):
        begin = time.process_time()
        H.Page("<p><button>" + "<div><b>" * n + "text")
        seen.append(time.process_time() - begin)
    assert seen[1] < 20 * seen[0] + 0.5


def test_cache_is_bounded():
    for k in range(H.CACHED + 100):
        H._features("div", f"id{k}", 1, 0)
    assert H._features.cache_info().currsize <= H.CACHED
