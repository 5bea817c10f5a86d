import itertools
import math
import random

import pytest

from sparkgate.llm import html_extract as H
from tests.conftest import SF_SMALL

LONG = ("This held-out paragraph is about the weather in the hills, with rain on Monday, sun on Tuesday "
        "and some wind after that, so that everybody found something to talk about. It has no links.")


@pytest.fixture(scope="module")
def model():
    return H.train()


def test_marginals_equal_enumeration(model):
    """Sum-product against the sum over all labellings of a small page."""
    page = H.read("<body><div class='menu'><a href=x>a b c</a></div><div><p>" + LONG + "</p><p>x</p></div></body>")
    node = [sum(w.get(x, 0.0) for w, x in zip(model.weights, look)) for look in H.looks(page)]
    node[0] = model.root
    n = len(node)
    mass = [[0.0, 0.0] for _ in range(n)]
    for labels in itertools.product((0, 1), repeat=n):
        p = math.exp(sum(node[v] for v in range(n) if labels[v]))
        for v in range(1, n):
            p *= model.follow[labels[page.parent[v]]][labels[v]]
        for v in range(n):
            mass[v][labels[v]] += p
    for v, belief in enumerate(model.beliefs(page)):
        assert belief == pytest.approx(math.log(mass[v][1] / mass[v][0]), abs=1e-9)


def test_held_out_page(model):
    html = f"""<html><head><title>No</title><style>p{{}}</style></head><body><header class="site-header"><a href="/">x</a>
    <p>Menu words</p></header><div class="cookie-consent"><p>{LONG}</p></div><div class="content-main"><h1>Head &amp;
    line</h1><p>{LONG}<br>Next&nbsp;line<p>Un<b>closed</b> one<script>var t="</p>";</script><div class="sponsored-box">
    <p>Buy</p></div><ul><li>First of the items<li>Second of the items</ul></div><div id="comment-list"><p>{LONG}</p></div>
    <aside><p>{LONG}</p></aside><form><p>Name</p></form><footer>&copy; all</footer></body>"""
    assert model.main_text(html) == (f"Head & line {LONG} Next line Unclosed one First of the items "
                                     "Second of the items")


def test_odd_pages(model):
    assert model.main_text("") == "" and model.main_text("   ") == ""
    assert model.main_text("<div>" * 20_000 + "x") in ("", "x")
    assert model.main_text("<article><p>" + "word " * 200_000) == ("word " * 200_000).strip()
    for html in ("<", "<p", "</p></div>", "<!-- x", "&#xFFFFFF; &bogus;", "<![CDATA[x]]>", "<a" * 500):
        model.main_text(html)
    rnd = random.Random(1)
    for _ in range(200):
        model.main_text("".join(rnd.choice(["<p>", "</div>", "<td>", "x ", "<li", ">", "<head>", "&lt;", "</ul>"])
                                for _ in range(60)))


@pytest.mark.parametrize("before", [
    "<header><svg>" + "<path d='M0 0'/>" * 300 + "</svg></header>",
    "<form><select>" + "<option>Land" * 250 + "</select></form>",
    "<form><p><select>" + "<optgroup label=x><option>Land" * 250 + "</select></p></form>",
    "<aside><math>" + "<mi>x" * 300 + "</math></aside>",
    "<aside>" + "<my-icon>" * 300 + "</aside>", "<aside>" + "<my-icon/>" * 300 + "</aside>", "<svg/>"])
def test_many_open_elements_before_the_article(model, before):
    assert model.main_text(f"<body>{before}<article><p>{LONG}</p></article></body>") == LONG


def test_self_closed_and_implied_ends():
    page = H.read("<div><svg><g/><g/></svg><select><option>a<option>b<optgroup><option>c<optgroup></select><x-y/>t</div>")
    up = [page.tag[p] for p in page.parent[1:]]
    assert list(zip(page.tag[1:], up)) == [
        ("div", "#page"), ("svg", "div"), ("g", "svg"), ("g", "svg"), ("select", "div"), ("option", "select"),
        ("option", "select"), ("optgroup", "select"), ("option", "optgroup"), ("optgroup", "select"), ("x-y", "div")]
    assert page.texts == [(1, ["t"])]


def test_rows(spark, model):
    rows = [(1, "u", "<article><p>" + LONG + "</p></article>", "x"), (1, "u", None, "x"), (None, None, "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((str(r.page_id), str(r.url), r.text, r.n_chars) for r in H.extract(pages, model).collect()))
    assert got == [("1", "u", "", 0), ("1", "u", LONG, len(LONG)), ("None", "None", "", 0)]
    assert H.extract(pages.limit(0), model).collect() == []


def test_query_gives_the_whole_articles(spark):
    import html as entities
    import re
    from sparkgate.llm.queries import op3_html
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = op3_html(spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        bare = re.sub(r"</?(p|h1|br)>", " ", re.sub(r"</?b>", "", article))
        assert r.text == " ".join(entities.unescape(bare).split())
