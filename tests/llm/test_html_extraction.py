import itertools
import math

from pyspark.sql import functions as F

from captionloom.llm import html_extraction as hx
from captionloom.llm.html_pages import labelled_pages


def test_marginals_against_all_assignments():
    nodes = [hx.Node("#page", -1, ["a"]), hx.Node("div", 0, ["b"]), hx.Node("#", 1, ["c"]), hx.Node("#", 1, ["a", "b"]), hx.Node("p", 0, ["c"]), hx.Node("#", 4, ["b"])]
    model = hx.Model({"a": 0.7, "b": -1.1, "c": 0.4}, {"text": [0.3, -0.6, 1.2], "element": [-0.5, 0.2, 0.9]})
    weight, single, joint = 0.0, [0.0] * 6, [[0.0] * 3 for _ in range(6)]
    for y in itertools.product((0, 1), repeat=6):
        e = sum(y[k] * sum(model.unary[f] for f in n.features) for k, n in enumerate(nodes))
        for k, n in enumerate(nodes[1:], 1):
            state = (y[n.parent], y[k])
            if state != (0, 0):
                e += model.pairs["text" if n.tag == "#" else "element"][[(0, 1), (1, 0), (1, 1)].index(state)]
        w = math.exp(e)
        weight += w
        for k in range(6):
            single[k] += w * y[k]
            if k:
                for j, s in enumerate(((0, 1), (1, 0), (1, 1))):
                    joint[k][j] += w * ((y[nodes[k].parent], y[k]) == s)
    got, pair = model.marginals(nodes)
    for k in range(6):
        assert abs(got[k] - single[k] / weight) < 1e-9
        if k:
            assert all(abs(pair[k][j] - joint[k][j] / weight) < 1e-9 for j in range(3))


def test_held_out_pages():
    model, runs, wrong = hx.default_model(), 0, 0
    for page in labelled_pages(120, seed=77):
        nodes, _ = hx.tree(page)
        wanted, got = hx._targets(nodes), model.marginals(nodes)[0]
        for k, node in enumerate(nodes):
            if node.tag == "#":
                runs += 1
                wrong += (got[k] >= 0.5) != bool(wanted[k])
    assert wrong < 0.01 * runs


def test_blocks_entities_and_spaces():
    page = "<body><nav><a href=x>Menu</a></nav><article><h1>T &amp; U</h1><p><b>One\n  two.<br>three &eacute;&#33;<br><p>Four <i>five</i>.<script>var a='<p>no</p>'</script><!-- no --></p><ul><li>a<li>b</ul></article><footer>&copy; no</footer>"
    assert hx.default_model().extract(page) == "T & U\n\nOne two. three é!\n\nFour five.\n\na\n\nb"


def test_a_full_page():
    page = """<html><head><title>no</title></head><body><header><div class="logo">Site name</div><nav><ul><li><a href="/">Home</a></li></ul></nav></header>
    <div class="cookie-banner">We use cookies. Accept them please.</div>
    <main><article><h1>A title</h1><p>First paragraph of the text, with some words.</p><div class="ad">Buy this thing now.</div>
    <p>Er.</p><form><label>Name</label><input></form><blockquote>Quoted words.</blockquote></article>
    <section id="comments"><h3>Comments</h3><div class="comment"><p>A reader says a long sentence, with many words, about all of it.</p></div></section></main>
    <aside class="sidebar"><h3>Related</h3><ul><li><a href="/a">Another one</a></li></ul></aside><footer><p>&copy; 2020 Site. All rights reserved.</p></footer></body></html>"""
    assert hx.default_model().extract(page) == "A title\n\nFirst paragraph of the text, with some words.\n\nEr.\n\nQuoted words."


def test_edges(spark):
    long = "<article>" + "<p>Some words here.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, "u", ""), (3, "u", "<div class='x' <p"), (4, "u", "<script>never closed <p>x</p>"), (5, "u", long), (5, "u", long), (6, "u", "<p>" * 500 + "<" * 500 + '"' * 501), (7, "u", "</p></div>&amp <td>x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("TEXT", F.lit("old"))
    got = {r.page_id: r["text_"] for r in hx.extract(df).collect()}
    assert got[1] == got[2] == got[4] == "" and got[5].count("Some words here.") == 20_000
    assert all(isinstance(t, str) for t in got.values())
    assert hx.extract(df.limit(0)).count() == 0


def test_query(spark):
    from captionloom.llm.queries import op1_html_extraction

    rows = op1_html_extraction(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 50 and all(r.n_chars == len(r.text) > 0 for r in rows)
    assert not any("track(" in r.text or "&amp;" in r.text or "©" in r.text for r in rows)
