import pytest

from llm.helpers import ODD
from vecspark.llm import html_text as H
from vecspark.llm.boosting import fit
from vecspark.llm.dom import parse

import numpy as np

PARAGRAPH = "The main text of this page is rather long and says many things about a subject, number {}."


def page(i, content="article", ad='<div class="ad">Buy {} now</div>'):
    body = "".join(f"<p>{PARAGRAPH.format(i * 10 + k)}</p>" for k in range(3 + i % 4))
    return (f"<!DOCTYPE html><html><head><title>T {i}</title><script>var t='</p>';</script></head><body><nav><ul><li><a href='/a'>Home</a></li>"
            f"<li><a href='/b'>News {i}</a></li></ul></nav>{ad.format(i)}<{content}><h1>Title {i}</h1>{body}</{content.split()[0]}>"
            f"<footer>&copy; {i} &middot; Someone</footer></body></html>")


def want(i):
    return f"Title {i} " + " ".join(PARAGRAPH.format(i * 10 + k) for k in range(3 + i % 4))


@pytest.fixture(scope="module")
def model():
    return H.train([page(i) for i in range(60)])


def test_main_text_of_the_kind_trained_on(model):
    assert H.main_texts([page(i) for i in range(100, 130)], model) == [want(i) for i in range(100, 130)]


def test_other_names_and_furniture(model):
    extra = ('<header class="top"><p>Site name</p></header><div class="cookie-notice">We use cookies</div>')
    tail = ('<aside class="sidebar"><a href="/x">See also</a></aside><section id="comments"><div class="comment"><p>'
            "I do not agree with any of it, said a reader.</p></div></section><form><label>Mail</label></form>")
    pages = [page(i, 'div class="post-content"').replace("<body>", "<body>" + extra).replace("<footer>", tail + "<footer>")
             for i in range(200, 210)]
    assert H.main_texts(pages, model) == [want(i) for i in range(200, 210)]


def test_decoding_never_keeps_inside_a_dropped_node(model):
    for i in range(20):
        nodes, _ = parse(page(i))
        kept = H.decode(nodes, np.random.default_rng(i).normal(0, 3, len(nodes)))
        assert all(kept[n.parent] for j, n in enumerate(nodes) if j and kept[j])


def test_decoding_is_the_likeliest_consistent_labelling():
    nodes, _ = parse("<body><div>aaaa<p>bb</p><p>c</p></div><ul><li>dd</li></ul></body>")
    margin = np.random.default_rng(5).normal(0, 2, len(nodes))
    weight = np.array([np.log1p(x.chars) if x.chars else 0.05 for x in nodes])

    def score(kept):
        return sum(-np.logaddexp(0, -m if k else m) * w for m, k, w in zip(margin, kept, weight))

    best = max((tuple(bool(b >> i & 1) for i in range(len(nodes))) for b in range(1, 2 ** len(nodes), 2)),
               key=lambda k: score(k) if all(k[n.parent] for i, n in enumerate(nodes) if i and k[i]) else -np.inf)
    assert tuple(H.decode(nodes, margin)) == best


def test_markup_rules():
    runs = lambda h: [w for _, w in parse(h)[1]]
    assert runs("<p>a&amp;b &lt;c&gt;<p>d<br>e<b>f</b>g") == ["a&b <c>", "d efg"]
    assert runs("<p>x<!-- no --> y</p><style>p{}</style><script>if(a<b)c()</script>z") == ["x y", "z"]
    assert runs("<ul><li>a<li>b<ul><li>c</ul></ul>d") == ["a", "b", "c", "d"]
    assert runs("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert runs("unclosed <a href='x'") == ["unclosed"]
    assert runs("1 < 2 and 3 > 2") == ["1 < 2 and 3 > 2"]


def test_controls_and_graphics_end_with_their_parent():
    runs = lambda h: [w for _, w in parse(h)[1]]
    options = "<datalist id=d><option value=a><option value=b>B</datalist>"
    assert runs(f"<body>{options}<article><p>text</article><select><option>x</option></select>") == ["text"]
    assert runs("<form><select><option>a<option>b</select>c</form><p>d") == ["c", "d"]
    for tag in ("button", "svg", "object", "audio", "video", "canvas", "option", "select", "datalist", "template"):
        assert runs(f"<header>a<{tag} class=x>no</header><article><p>text</article>") == ["a", "text"], tag
        assert runs(f"<body><{tag} class=x>no<article><p>text</article><p>more<{tag}>no</{tag}>") == ["text", "more"], tag
        assert runs(f"<p>a<{tag}>no <b>no</b></{tag}>b<p>c") == ["a b", "c"], tag
        assert runs(f"<ul><li>a<{tag}>no<li>b</ul>") == ["a", "b"], tag
        if tag != "svg":
            assert runs(f"<div><{tag}><div><p>no</div></{tag}>a</div>") == ["a"], tag
    assert runs("<div>a<button><svg><title>no</title><path d=x>no</button>b</div>") == ["a b"]
    assert runs("<div>a<svg><foreignObject><div>no</div></foreignObject><text>no</text></svg>b</div>") == ["a b"]
    assert runs("<p>a<svg viewBox='0'/>b") == ["ab"]
    assert runs("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds") == ["so x=2 holds"]


def test_article_after_unclosed_controls(model):
    options = "<datalist id=s><option value=a><option value=b></datalist>"
    for junk in (f"<header><form><input list=s>{options}</form></header>", "<header><button>Menu</header>", "<header><svg><path d=m></header>"):
        assert H.main_texts([page(7).replace("<nav>", junk + "<nav>")], model) == [want(7)]


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (2000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = fit(x[:1500], y[:1500])
    assert ((model.margin(x[1500:]) > 0) == (y[1500:] > 0)).mean() > 0.95


def test_query_shape_and_odd_rows(spark):
    rows = [(i, "u", h, "t", 1) for i, h in enumerate([*ODD, page(1), page(1), "<p>" + "long word " * 30_000 + "</p>"])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, row int")
    got = {r["row"]["page_id"]: r["text"] for r in H.extract(pages).collect()}
    assert len(got) == len(rows) and got[0] == "" and got[1] == ""
    assert got[len(ODD)] == got[len(ODD) + 1] == want(1)
    assert all(v is not None for v in got.values())
    assert H.extract(pages.limit(0)).count() == 0


def test_an_unclosed_noscript_and_stray_end_tags(spark):
    from time import process_time

    from vecspark.llm.dom import parse
    assert [t for _, t in parse("<p>one</p><noscript><img src=x><p>two</p>")[1]] == ["one", "two"]
    start = process_time()
    nodes, runs = parse("<div>" * 20_000 + "text" + "</section>" * 20_000)
    assert len(nodes) == 20_001 and len(runs) == 1 and process_time() - start < 5


def test_pages_that_are_all_long_still_train(spark, monkeypatch):
    monkeypatch.setattr(H, "MOST_SAMPLE_CHARS", 50)
    body = "".join(f"<p>{prose_of(i)}</p>" for i in range(6))
    page = f"<html><body><nav><a href=/>Home</a> menu</nav><article>{body}</article><footer>foot</footer></body></html>"
    got = H.extract(spark.createDataFrame([(1, page)], "page_id bigint, html string")).first()["text"]
    assert got == " ".join(prose_of(i) for i in range(6))


def prose_of(i):
    return " ".join(f"word{(i * 31 + j * 7) % 97}" for j in range(40)) + "."
