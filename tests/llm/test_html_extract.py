"""Tree sums against enumeration, parsing, held-out layouts, the pages table."""
import html
import itertools
import re
import time

import numpy as np

from ledgerlake.llm import html_extract as X
from tests.conftest import SMOKE


def test_sum_product_matches_enumeration():
    rng = np.random.default_rng(2)
    model = X.TreeModel()
    model.w, model.pair = rng.normal(size=X.N_FEATURES), rng.normal(size=(2, 2, 2))
    parent = np.array([-1, 0, 0, 1, 1, 4, -1, 6])
    depth = np.array([0, 1, 1, 2, 2, 3, 0, 1])
    block = np.array([0, 0, 1, 1, 0, 1, 0, 1], dtype=bool)
    x = rng.normal(size=(8, X.N_FEATURES)) / 5
    single, pairs, log_z = model.sum_product(x, parent, depth, block)
    own = x @ model.w
    z, good, both = 0.0, np.zeros(8), np.zeros((8, 2, 2))
    for state in itertools.product((0, 1), repeat=8):
        s = sum(own[i] for i in range(8) if state[i]) + sum(model.pair[int(block[i]), state[parent[i]], state[i]] for i in range(8) if parent[i] >= 0)
        p = np.exp(s)
        z += p
        good += p * np.array(state)
        for i in range(8):
            if parent[i] >= 0:
                both[i, state[parent[i]], state[i]] += p
    assert np.allclose(np.exp(single[:, 1]), good / z)
    inner = parent >= 0
    assert np.allclose(np.exp(pairs[inner]), both[inner] / z)
    assert np.allclose(log_z[0] + log_z[6], np.log(z))


def blocks(src):
    return [t for t in X.parse(src).text if t is not None]


def test_parse():
    assert blocks(None) == blocks("") == blocks("<p></p>") == []
    assert blocks("<p>a &amp; b&nbsp;c &#233;&lt; <b>d</b>e<br>f\n\t g<p>h") == ["a & b c é< de f g", "h"]
    assert blocks("x<script>var a='</p>';</script>y<style>p{}</style><!-- <p>no --> z") == ["xy z"]
    assert blocks("<title>t</title><body><ul><li>a<li>b<ul><li>c</ul></ul>d") == ["a", "b", "c", "d"]
    assert blocks("<table><tr><td>1<td>2<tr><td>3</table>4 < 5 <3") == ["1", "2", "3", "4 < 5 <3"]
    assert blocks("<a title='x > y' href=\"p>q\">link</a></div> t</p>u") == ["link t", "u"]
    assert blocks("<p it's>fine</p><p>rest") == ["fine", "rest"]
    assert blocks("a<script>never closed <p>b") == ["a"]
    assert blocks("a<!-- never closed <p>b") == ["a"]
    assert blocks("a<p class='unclosed>b</p>c") == ["a", "b", "c"]
    assert blocks("before<p") == ["before"]
    assert blocks("<select><option>o</select><button>b</button>t") == ["t"]


def test_parse_is_linear():
    import time

    for piece in ("<a x='", "<", "<p ", "<!--", "<b><i><p>", "<div>", "&amp", "<script>", "</p>", "<a href=\""):
        began = time.time()
        X.parse(piece * 30_000)
        X.parse("<div>" * 30_000 + piece * 30_000 + "</x>" * 30_000)
        assert time.time() - began < 20, piece


def test_held_out_layouts():
    words = "some plain words of text to lay out pages with and many others beside them été straße".split()
    model = X.trained([])
    rng = np.random.default_rng(987)
    pages, labels = [], []
    for _ in range(150):
        p = X.parse(X.labelled_page(rng, words))
        labels += [int(t.startswith(X.CONTENT)) for t in p.text if t is not None]
        p.text = [t if t is None else t[1:].strip() for t in p.text]
        pages.append(p)
    f = X.features(pages)
    got = (model.sum_product(*f)[0][:, 1] > np.log(0.5))[f[3]]
    assert (got == np.array(labels)).mean() > 0.97


def article(src):
    """The article's blocks by plain splitting: true for the pages of the test data."""
    inner = src.split("<article>")[1].split("</article>")[0]
    parts = [" ".join(html.unescape(re.sub(r"</?b>", "", x).replace("<br>", " ")).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(x for x in parts if x)


def test_query(spark):
    src = {r.page_id: r for r in X.table(spark, SMOKE, "pages").collect()}
    got = X.op3_html_extract(spark, SMOKE).collect()
    assert len(got) == len(src)
    right = [r.text == article(src[r.page_id].html) for r in got]
    assert np.mean(right) > 0.98
    assert all(r.n_chars == len(r.text) and r.url == src[r.page_id].url for r in got)


def test_edges(spark, tmp_path):
    deep = "<div>" * 3000 + "<p>" + "long words here. " * 5000
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>This is the text of one page, with some words.</p></article><nav><a>Home</a></nav>"), (4, "u", deep), (5, "u", "no tags, only some words"), (5, "u", "no tags, only some words")]
    spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string").write.parquet(f"{tmp_path}/pages.parquet")
    got = X.op3_html_extract(spark, str(tmp_path)).collect()
    assert len(got) == 6
    by = {r.page_id: r for r in got}
    assert by[1].text == by[2].text == "" and by[1].n_chars == 0
    assert by[None].text == "This is the text of one page, with some words."
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/none/pages.parquet")
    assert X.op3_html_extract(spark, f"{tmp_path}/none").collect() == []


def test_omitted_end_tags_of_hidden_elements():
    assert blocks("<html><head><title>T</title><body><article><p>Hi</p>") == ["Hi"]
    assert blocks("<head><title>T</title><meta charset=x><p>Hi<p>you") == ["Hi", "you"]
    assert blocks("<head><title>T</title> Hi <b>you</b><head><p>there") == ["Hi you", "there"]
    assert blocks("<head><template><p>no</template><link rel=x></head><body>yes") == ["yes"]
    assert blocks("<head><br>Hi") == ["Hi"]
    for t in X.ENDS:
        assert blocks(f"<div>a<{t}>no<p>b</p><p>c</p></div>d") == ["a", "b", "c", "d"], t
        assert blocks(f"<div>a<{t}>no<div>no</div></{t.upper()}><p>b</p></div>") == ["a", "b"], t
    assert blocks("<div>a<button>no<p>b</p><button>no</button><p>c") == ["a", "b", "c"]
    assert blocks("<object>no<object><p>no</p></object></object><p>b") == ["b"]
    began = time.time()
    for piece in ("<button><div>", "<button><div></button>", "<svg><p>", "<svg><div></div>", "<head>x", "<object><div>"):
        X.parse(piece * 30_000)
        X.parse(piece * 30_000 + "</button></svg></object>")
    assert time.time() - began < 60
