import html
import random
import re

import numpy as np

from skyledger.llm import boosting, pages
from tests.llm import odd


def frame(spark, rows):
    return spark.createDataFrame([(i, f"u{i}", h, "x", 3) for i, h in rows], "page_id long, url string, html string, text string, n_chars int")


def expected(source):
    """The article's blocks of the fixture's simple layout."""
    article = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    parts = re.split(r"</?(?:p|h1|div|ul|li)[^>]*>", article.replace("<br>", " "))
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
    return "\n".join(b for b in blocks if b)


def test_fixture_articles_come_out_whole(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    sources = {r.page_id: r.html for r in docs.collect()}
    found = pages.extract(docs).collect()
    assert {r.page_id: r.text for r in found} == {i: expected(h) for i, h in sources.items()}
    assert all(r.n_chars == len(r.text) for r in found)


def test_held_out_layouts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    trees = pages.fit(docs)
    good = kept = wanted = 0
    for seed in range(40):
        draw = random.Random(1000 + seed)
        main = [("h1", odd.prose(seed, 6))] + [("p", odd.prose(seed + 100 * i, draw.randint(25, 90)) + ".") for i in range(1, 7)]
        source, places = pages.laid_out(main, [odd.prose(seed + 7, 60)], 5000 + seed)
        got = set(pages.texts([source], trees)[0].split("\n"))
        want = {text for _, text in main}
        good += sum(len(t) for t in got & want)
        kept += sum(map(len, got))
        wanted += sum(map(len, want))
    assert good / wanted > 0.9 and good / kept > 0.9


def test_parts_of_other_kinds_are_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    body = [odd.prose(i, 60) + "." for i in range(5)]
    page = (
        "<html><head><title>T</title><script>var a='<p>no</p>'</script></head><body><header><a href=/>Home</a></header>"
        "<nav><ul><li><a href=/a>Menu one</a></li><li><a href=/b>Menu two</a></li></ul></nav>"
        f"<article><h1>{odd.prose(9, 5)}</h1><p>{body[0]}<p>{body[1]}</p><!-- note <p>x</p> -->"
        f"<aside class=related><p>Read more here</p></aside><p>{body[2]}</p>"
        f"<form><label>Mail</label><input></form><p>{body[3]}</p></article>"
        f"<section id=comments><h3>Comments</h3><div class=comment><p>{body[4]}</p></div></section>"
        "<div class='cookie-notice'>We use cookies.</div><footer>&copy; 2024</footer></body></html>"
    )
    text = pages.texts([page], pages.fit(docs))[0]
    assert text == "\n".join([odd.prose(9, 5), *body[:4]])


def test_odd_pages(spark):
    rows = [(1, None), (2, ""), (3, "no markup &amp; text"), (4, "<p>open <b>bold<script>never ends"), (5, "<!-- open"),
            (6, "<" * 2000 + "a" * 2000), (7, "<div>" * 3000 + "deep"), (7, "<div>" * 3000 + "deep"), (None, "<p>x")]
    found = pages.extract(frame(spark, rows)).collect()
    assert sorted(str(r.page_id) for r in found) == sorted(str(i) for i, _ in rows)
    assert all(r.text is not None and r.n_chars == len(r.text) for r in found)
    assert {r.page_id: r.text for r in found}[2] == ""
    assert pages.extract(frame(spark, [])).count() == 0


def test_blocks_of_a_page():
    page = pages.Page("<div>a&nbsp; b<p>c <i>d</i>e<br>f<ul><li>g<li>h</ul>i</div>j<td>k")
    assert [t for t in page.text if t is not None] == ["a b", "c de f", "g", "h", "i", "j", "k"]


def test_unclosed_hidden_elements_do_not_cut_the_page():
    runs = lambda source: [t for t in pages.Page(source).text if t is not None]
    for tag in sorted(pages.HIDDEN):
        assert runs(f"<div>a<{tag}>x</div><p>b</p>") == ["a", "b"], tag
        assert runs(f"<body>a<{tag} class=y>x<article><p>b</p><{tag}>x</{tag}> c</article>") == ["a", "b", "c"], tag
        assert runs(f"<div>a<{tag}><p>x</p><div>y</div>z</{tag}> b</div>c") == ["a b", "c"], tag
        assert runs(f"<div>a<{tag}>x<p>y</div>b</{tag}>c") == ["a", "bc"], tag
        assert runs(f"<div>a<{tag}/> b<{tag}>x<{tag}>y</{tag}>z</{tag}> c</div>") == ["a b c"], tag
        assert runs(f"<p>a<{tag}><script>'</{tag}>'</script>x</{tag}></p><p>b") == ["a", "b"], tag
    assert runs("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>") == ["so x=2 holds"]
    assert runs("<p>a<textarea>b<p>c") == ["a"]


def test_main_text_below_an_unclosed_button(spark):
    trees = pages.fit(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))
    body = [odd.prose(i, 60) + "." for i in range(4)]
    article = f"<article><h1>{odd.prose(9, 5)}</h1>{''.join(f'<p>{b}</p>' for b in body)}</article></body></html>"
    for tag in ("button", "svg", "select"):
        page = f"<html><body><nav><ul><li><{tag}>Menu<li><a href=/a>One</a></ul></nav>{article}"
        assert pages.texts([page], trees)[0] == "\n".join([odd.prose(9, 5), *body])


def test_decoding_keeps_no_node_without_its_ancestors():
    page = pages.Page("<div><p>a</p><p>b</p></div><div><p>c</p></div>")
    odds = np.array([0, 2, 3, 3, -3, -3, -9, 1, 1], float)
    assert page.decoded(odds) == "a" and page.decoded(-np.ones(9)) == ""


def test_trees_learn_a_rule():
    draw = np.random.default_rng(0)
    x = draw.random((2000, 5)).astype(np.float32)
    y = ((x[:, 1] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    model = boosting.fit(x[:1500], y[:1500])
    assert ((model.predict(x[1500:]) > 0) == y[1500:]).mean() > 0.95
