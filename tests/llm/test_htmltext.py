import html
import re

import numpy as np
import pytest

from listweave.llm import htmltext as X


def texts(page):
    return [b.text for b in X.leaves(page)]


@pytest.mark.parametrize("page,want", [
    ("", []), ("plain", ["plain"]), ("<p>a<b>b</b> c<p>d", ["ab c", "d"]), ("<script>x<p>y</script><p>z", ["z"]), ("<!-- <p>x --><p>&lt;y&gt;&nbsp;&amp;\n z", ["<y> & z"]),
    ("<ul><li>a<li>b</ul>", ["a", "b"]), ("<p title='a>b'>c</p>", ["c"]), ("a < b and c > d", ["a < b and c > d"]), ("<div>a<!-- open", ["a"]), ("<td>x<td>y", ["x", "y"]),
    ("<title>t</title><style>s", []), ("<p>a<br>b", ["a", "b"]),
    ("<p>Value is <math><mi>x</mi><mo>=</mo><msup><mn>2</mn><mn>3</mn></msup></math> and", ["Value is x=23 and"]), ("<p>see <object data=f><b>this</b></object>.</p>", ["see this."]),
    ("<script src=a.js/>var x=1;</script><p>y", ["y"]), ("<script src=a.js/>var x=1;", []), ("<p>a<svg/>b", ["ab"]), ("<p>a<svg><text>x</text></svg>b", ["ab"]), ("<p>a</ x>b<?php z?>c<!doctype>d", ["abcd"]),
    ("<p>a<math><semantics><mi>x</mi><annotation>\\x</annotation></semantics></math>", ["ax"]), ("<p>a<b title=\"x>c</b> d", ["ac d"]), ("<p>a<b title='x>y'>c</b><i title=\"p'>q\">d", ["acd"]), ("<p>a<b", ["a"]),
    ("<p>a<p>b</section></p>c", ["a", "b", "c"]), ("<div>a</div></div></p><div>b", ["a", "b"]),
])
def test_leaves(page, want):
    assert texts(page) == want


def test_paths_close_as_browsers_close():
    blocks = X.leaves("<article><p><b>a<br><p>b</article><footer>c</footer>")
    assert ["<article" in str(b.path) for b in blocks] == [True, True, False]


@pytest.mark.parametrize("piece", ["<a ", "<div>", "<p>x", "<", "</p>", "<svg>", '<a "', '"><a "', "<b title='", "<!--", "</script ", "<script>", "<foo>y", "<x><p>", "<li>", "&", "&#", "<td><table>z"])
def test_time_is_linear(piece):
    """Two megabytes of what makes some parsers look again and again; the second is no slower than the first."""
    import time

    seconds = []
    for size in (1_000_000, 2_000_000):
        page = "<p><body>" + piece * (size // len(piece)) + ">"
        began = time.perf_counter()
        X.leaves(page)
        seconds.append(time.perf_counter() - began)
    assert seconds[1] < 10 and seconds[1] < 4 * seconds[0] + 0.5


def test_deep_blocks_keep_their_ends():
    blocks = X.leaves("<article>" + "<div>a" * 500)
    assert len(blocks) == 500 and blocks[-1].depth == 501 and len(blocks[-1].path) == 2 * X.PATH_ENDS and "article" in blocks[-1].path[0][0]


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = X.Network(5, 4, 1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask = X.padded([rng.normal(size=(n, 5)).astype(np.float32) for n in (3, 6, 1)])
    y = rng.random(mask.shape) < 0.5
    _, grads = net.gradients(x, mask, y)
    for name in ("xf", "hf", "cf", "xb", "hb", "cb", "o", "ob"):
        flat = net.p[name].ravel()
        for i in rng.choice(flat.size, min(6, flat.size), replace=False):
            old, eps = flat[i], 1e-3
            flat[i] = old + eps
            up = net.gradients(x, mask, y)[0]
            flat[i] = old - eps
            down = net.gradients(x, mask, y)[0]
            flat[i] = old
            assert grads[name].ravel()[i] == pytest.approx((up - down) / (2 * eps), abs=2e-3)


def test_padding_does_not_matter():
    net = X.Network(X.PATH_DIMS + X.WORD_DIMS + X.MEASURES, 8, 2)
    pages = [np.random.default_rng(i).normal(size=(n, X.PATH_DIMS + X.WORD_DIMS + X.MEASURES)).astype(np.float32) for i, n in enumerate((1, 7, 0, 30))]
    together = X.label(net, pages)
    for p, got in zip(pages, together):
        assert np.allclose(got, X.label(net, [p])[0], atol=1e-5)


def test_made_up_pages_it_has_not_seen():
    net, maker = X.trained(), X.PageMaker(12345)
    right = total = 0
    for _ in range(150):
        x, y = X.training_page(maker)
        if len(y):
            right += int(((X.label(net, [x])[0] >= 0.5) == y).sum())
            total += len(y)
    assert right / total > 0.985


def test_pages_of_the_tables(spark):
    import glob

    folder = "/root/testdata/sf0.01/pages.parquet"
    if not glob.glob(folder):
        pytest.skip("no test tables")
    got = X.extract(spark.read.parquet(folder)).toPandas().set_index("page_id")
    for r in spark.read.parquet(folder).collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<(?:p|/p|br|h1|/h1)>", " ", inner).replace("<b>", "").replace("</b>", "")).split())
        assert got.loc[r.page_id].text == want and got.loc[r.page_id].n_chars == len(want)


def test_other_layouts():
    body = "".join(f"<p>{'Some sentence of the story goes on here, and on. ' * 3}</p>" for _ in range(5))
    page = f"""<body><div class="cookie-notice"><p>We use cookies here.</p></div><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav>
      <main><article><h1>Story</h1>{body}</article></main><aside class="sidebar"><h3>Related</h3><ul><li><a href=/x>Other story</a></li></ul></aside>
      <section id="comments"><div class="comment"><p>Nice one, thanks a lot.</p></div></section><form><label>Mail</label></form><footer>(c) me</footer>"""
    text = X.main_texts(X.trained(), [page])[0]
    assert text.startswith("Story Some sentence") and not re.search("cookies|Home|Related|Nice one|Mail|\\(c\\)|Site", text)


def test_edge_cases(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (3, "u", "<" * 5000), (3, "u", "<article>" + "<p>word word word.</p>" * 4000 + "</article>"), (3, "u", "<p>x")]
    got = X.extract(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")).collect()
    assert len(got) == 6 and all(r.n_chars == len(r.text) for r in got) and [r.text for r in got if r.page_id in (1, 2)] == ["", ""]
    assert X.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
