from collections import Counter

import pytest

from wordspace.llm import html_text as H

SCHEMA = "page_id long, url string, html string, text string"
PAGE = """<!DOCTYPE html><html><head><title>T words here</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/">Home page</a></li></ul></nav><!-- a > b --><div class="ad">Buy this now</div>
<article><h1>Caf&eacute; &amp; co</h1><p><b>First  para\ngraph<br>goes on<p>Second &#8212; one.</p><aside>Side note words</aside>
<form><input><label>Mail us</label></form><div class="cookie-notice">We use cookies</div><p>Third</p></article>
<section id="comments"><p>Nice article, thanks a lot for this</p></section><footer>&copy; 2024 all of us</footer></body></html>"""
TEXT = "Café & co\nFirst para graph goes on\nSecond — one.\nThird"


def learned():
    inside, outside = Counter(), Counter()
    H.count_kinds(PAGE, inside, outside)
    return H.weights(inside, outside)


def test_article_without_the_rest():
    assert H.main_text(PAGE, learned()) == TEXT


def test_weights_have_signs():
    w = learned()
    assert w["word"] > 0 and all(v < 0 for k, v in w.items() if k not in ("word", "link"))
    assert H.weights({}, {}) == {}


def test_odd_pages():
    for page in ("", "<", "<p", "<p class='x", "<!-- never closed", "<script>never closed", "</p></div>", "<nav>menu only</nav>", "&#0;&#xD800;"):
        H.main_text(page, {})
    assert H.main_text("just words", {}) == "just words"
    assert H.main_text("<div>a b c d e f g h i j k l m n</div>" * 3, {"word": 1.0, "div": -0.1}).count("\n") == 2


def test_best_region_is_brute_force_best():
    page = "<div>a b</div><p>c d e f g h i</p><p>j k l m n o p q</p><hr><hr><span>r</span>"
    w = {"word": 1.0, "div": -3.0, "p": -1.0, "hr": -2.0, "span": -1.0}
    seq = list(H.units(page))
    score = [len(t.split()) if k == "word" else w.get(k, H.TAG) for k, t, _, _ in seq]
    best = max(sum(score[i:j]) for i in range(len(score)) for j in range(i, len(score) + 1))
    kept = H.main_text(page, w)
    assert kept == "c d e f g h i\nj k l m n o p q" and best == sum(len(x.split()) for x in kept.split("\n")) - 2


def test_query_rows(ready):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (1, "u", PAGE, "x"), (None, "u", "<p>" + "long words " * 50_000, "x")]
    pages = ready.createDataFrame(rows, SCHEMA)
    got = H.extract(pages, H.fit_weights(pages)).collect()
    assert len(got) == 5
    by = {r.page_id: r for r in got}
    assert by[1].text == TEXT and by[1].n_chars == len(TEXT) and by[2].text == "" and by[3].n_chars == 0
    assert by[None].n_chars == len("long words " * 50_000) - 1
    empty = ready.createDataFrame([], SCHEMA)
    assert H.extract(empty, H.fit_weights(empty)).count() == 0


def test_article_is_not_left_out_with_its_surroundings():
    body = "<h1>Title here</h1><p>First part of the text.</p><p>Second part of the text.</p>"
    text = "Title here\nFirst part of the text.\nSecond part of the text."
    nav, notes = "<nav>Home page</nav>", '<section id="comments"><article><p>Nice one</p></article></section>'
    for start, end in [
        ('<div class="layout no-sidebar">', "</div>"), ('<div class="container has-sidebar"><article>', "</article></div>"), ("<form>" + nav + "<main>", "</main></form>"),
        ('<form><div class="content">', "</div>" + nav + "</form>"), ('<div class="sidebar"><article>', "</article></div>"), ('<article data-x="1"><div data-hidden="false" data-title="hidden costs">', "</div></article>"),
        (nav + "<article>", "</article>" + notes), ("<head><title>t</title>", ""), (nav + '<article><div class="cookie-notice ad-box">Buy</div>', "</article>" + notes),
        ('<article><div title="class=ad role=menu">', "</div></article>"),
    ]:
        assert H.main_text(start + body + end, {"word": 1.0} | {t: -0.01 for t in ("div", "p", "h1", "article", "main", "form", "nav", "section", "head", "title")}) == text, start


def test_anchors_are_no_names():
    parts = '<h2 id="related-work">Related work</h2><p id="reply">A reply.</p><section id="search"><p>How to search.</p></section><div class="article-header"><h1>Head line</h1></div>'
    w = {"word": 1.0} | {t: -0.01 for t in ("div", "p", "h1", "h2", "article", "section")}
    assert H.main_text(f"<article>{parts}<p>End of it.</p></article>", w) == "Related work\nA reply.\nHow to search.\nHead line\nEnd of it."
    out = '<div hidden>a</div><div class="site-footer">b</div><div id=comments>c</div><div role="navigation">d</div><p class="x ad">e</p><div STYLE="display: none">f</div>'
    assert H.main_text(f"<article>Some words here{out}</article>", w) == "Some words here"


HARSH = {"word": 1.0, "link": 1.0, "li": -11.0, "a": -11.0, "div": -11.0, "td": -11.0, "tr": -11.0, "p": -1.0, "ul": -11.0, "table": -11.0}


@pytest.mark.parametrize("middle", [
    "<ul>" + "".join(f"<li><a href='#'>two words{k}</a></li>" for k in range(10)) + "</ul>",
    "<table>" + "".join(f"<tr><td>a{k}</td><td>b{k}</td></tr>" for k in range(10)) + "</table>",
    "<div>" * 10 + "deep" + "</div>" * 10,
])
def test_a_marked_article_is_whole(middle):
    first, last = " ".join(f"first{k}" for k in range(30)), " ".join(f"last{k}" for k in range(25))
    page = f"<body><div class='menu'><a>menu</a></div><p>before it</p><article><h1>Head</h1><p>{first}</p>{middle}<p>{last}</p></article><footer>foot</footer></body>"
    got = H.main_text(page, HARSH).split("\n")
    assert got[0] in ("Head", "before it") and first in got and got[-1] == last and "foot" not in got and "menu" not in got
    assert {"two words9", "b9", "deep"} & set(got)


@pytest.mark.parametrize("pattern", ["<a ", "<a b='", "<div>", "<div></p>", "<p>", "<!--", "<b x=\"'>", "<td><tr>", "</", "<![CDATA["])
def test_malformed_pages_take_linear_time(pattern):
    import time

    began = time.process_time()
    H.main_text(pattern * (2_000_000 // len(pattern)), {})
    assert time.process_time() - began < 10
