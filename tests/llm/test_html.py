import html
import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from flowlens.llm.html_text import best_region, fit_weights, main_text, main_texts, weigh


@pytest.fixture(scope="module")
def weights(pages):
    return fit_weights(pages)


def article_of(page):
    """The marked article of a test page: its blocks, split at p and h1 tags."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1].replace("<br>", " ")
    blocks = re.split(r"</?(?:p|h1)>", inner)
    texts = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def test_query_finds_the_articles(spark, sf_dir, pages):
    expected = {r.page_id: article_of(r.html) for r in pages.collect()}
    found = entry.queries()["op10_html_text"](spark, sf_dir).collect()
    assert {r.page_id: r.text for r in found} == expected
    assert all(r.n_chars == len(r.text) for r in found)


PLAIN = """<html><head><title>No title</title><style>p{}</style></head><body>
<header><h1>Site name</h1><a href=/>Home</a></header>
<div id="mainMenu" class="nav-bar"><a href=a>Alpha</a><a href=b>Beta</a></div>
<div class="cookie-consent"><p>We use cookies to improve this site for everyone.</p></div>
<div class="post has-sidebar"><h2>Heading &amp; more</h2>
<p>The first   paragraph has <b>bold</b> words&nbsp;and an <a href=x>inline link</a>.<p>The second one is
not closed &lt;here&gt; and has a<br>break.<script>if (a < b) { var t = "</p>"; }</script>
<div class="ad-slot">Buy this now, a very good offer.</div>
<ul><li>first item<li>second item</ul>
<form><label>Your mail</label><input></form>
<blockquote>A quotation of some words.</blockquote></div>
<aside><p>Other stories that you may like to read today.</p></aside>
<section id="comments"><p>I think that this is a very good story indeed, thank you.</p></section>
<footer><p>All rights reserved by the owner of this site.</p></footer></body></html>"""
EXPECTED = """Heading & more
The first paragraph has bold words and an inline link.
The second one is not closed <here> and has a break.
first item
second item
A quotation of some words."""


def test_page_without_article(weights):
    assert main_text(PLAIN, weights) == EXPECTED
    assert main_text(PLAIN, {}) == EXPECTED


@pytest.mark.parametrize("page,text", [
    ("", ""), ("<p></p>", ""), ("only words", "only words"), ("a < b and <c", "a < b and"),
    ("<!-- never closed <p>text", ""), ("<p>x &#233;&eacute;&bogus;</p>", "x éé&bogus;"),
    ("<script>never closed <p>text</p>", ""), ("<P CLASS='a'>Upper</P>", "Upper"),
    ("<article><header><h1>T</h1></header><p>" + "w " * 30 + "</p></article>", "T\n" + "w " * 29 + "w"),
    ("<body><div hidden>no</div><p>yes it is here</p></body>", "yes it is here"),
])
def test_small_pages(page, text, weights):
    assert main_text(page, weights) == text


def test_long_and_deep_pages(weights):
    body = "".join(f"<p>paragraph {i} of the text</p>" for i in range(20_000))
    assert main_text(f"<article>{body}</article>", weights).count("\n") == 19_999
    assert main_text("<div>" * 5000 + "deep words here" + "</div>" * 5000, weights) == "deep words here"
    many_quotes = "".join(f"<a href='{i}\"' title=\"it's\">word</a> " for i in range(20_000))
    assert main_text(many_quotes, {}) != "x"
    main_text("<" * 50_000 + '<a b="' * 5000, weights)


WORDS = ("river stone window letter garden silver morning paper market winter harbour candle "
         "question journey village music bridge corner season travel").split()


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join(pick.choices(WORDS, k=n)).capitalize() + "."


@pytest.mark.parametrize("page", [
    '<p class="social-science">{}</p>', '<div class="share-price"><p>{}</p></div>',
    '<body><div class="related-work">{}</div></body>', '<div id=notice><p>{}</p></div>',
    '<div class="comments"><p>{}</p></div>', '<p title="hidden">{}</p>',
    '<div data-role="navigation">{}</div>'])
def test_names_never_cost_the_only_text(page, weights):
    for w in (weights, {}):
        assert main_text(page.format(prose(1, 30)), w) == prose(1, 30)


def test_names_leave_out_boilerplate_beside_the_text(weights):
    text = "\n".join(prose(i, 40) for i in range(3))
    body = "".join(f"<p>{line}</p>" for line in text.split("\n"))
    for name in ("ad-slot", "cookie-consent", "relatedPosts", "share", "newsletter-signup",
                 "comments", "site-footer-links", "promo42"):
        page = f'<div id="x">{body}<div class="{name}"><p>{prose(9, 25)}</p></div></div>'
        for w in (weights, {}):
            assert main_text(page, w) == text


def test_comments_longer_than_the_article_are_left_out(weights):
    page = (f"<div><p>{prose(1, 40)}</p></div><section id=comments>"
            + "".join(f"<p>{prose(i, 50)}</p>" for i in range(3)) + "</section>")
    for w in (weights, {}):
        assert main_text(page, w) == prose(1, 40)


def test_all_articles_of_a_page(weights):
    page = (f"<body><nav><a href=/>Home</a></nav><article><h2>One</h2><p>{prose(1, 80)}</p></article>"
            f"<div class=ad>{prose(5, 6)}</div><article><p>{prose(2, 12)}</p></article>"
            f"<aside><article>{prose(3, 30)}</article></aside></body>")
    for w in (weights, {}):
        assert main_text(page, w) == f"One\n{prose(1, 80)}\n{prose(2, 12)}"


def test_depth_and_long_attributes(weights):
    deep = "<div>" * 1000 + f"<p>{prose(1, 40)}</p><footer><p>{prose(2, 20)}</p></footer>" + "</div>" * 1000
    long = f'<p data-x="{"a > b " * 2000}">{prose(3, 40)}</p><p title=\'{"x" * 10_000}>\'>{prose(4, 20)}</p>'
    open_quote = f'<p title="never closed>{prose(5, 30)}</p><p>{prose(6, 30)}</p>'
    for w in (weights, {}):
        assert main_text(deep, w) == prose(1, 40)
        assert main_text(long, w) == f"{prose(3, 40)}\n{prose(4, 20)}"
        assert main_text(open_quote, w) == f"{prose(5, 30)}\n{prose(6, 30)}"
    assert main_text("<div>" * 200_000 + "deep words here", weights) == "deep words here"


def test_given_pages_without_their_marks(pages, weights):
    """The weights are fitted on marked pages; then no page has a mark."""
    for r in pages.collect():
        bare = re.sub(r"<(/?)(?:article|main)\b", r"<\1div", r.html)
        assert main_text(bare, weights) == article_of(r.html)


def layouts():
    """Twenty unmarked page layouts, as (page, article text)."""
    menu = "".join(f"<li><a href=/{w}>{w}</a></li>" for w in WORDS[:8])
    notice = f"<p>{prose(90, 15)}</p>"
    shells = [
        '<ul class="menu">{menu}</ul><div class="content">{body}</div><div id="footer">{notice}</div>',
        '<div id=header><ul>{menu}</ul></div><div id=main>{body}</div><div class="footer-text">{notice}</div>',
        '<table><tr><td class="sidebar"><ul>{menu}</ul></td><td>{body}</td></tr></table>',
        '<nav>{menu}</nav><section>{body}</section><section class="comments">{notice}</section>',
        '<div class="cookie-banner">{notice}</div><div class="page"><div class="text">{body}</div></div>',
    ]
    bodies = [
        lambda b: "".join(f"<p>{x}</p>" for x in b),
        lambda b: f"<h1>{b[0]}</h1>" + "".join(f"<div>{x}</div>" for x in b[1:]),
        lambda b: "".join(f"<p>{x}" for x in b[:-1]) + f"<blockquote>{b[-1]}</blockquote>",
        lambda b: f"<p>{b[0]}</p><ul>" + "".join(f"<li>{x}</li>" for x in b[1:]) + "</ul>",
    ]
    for i, shell in enumerate(shells):
        for j, build in enumerate(bodies):
            blocks = [prose(100 * i + 10 * j + n, 14 + 9 * n) for n in range(4)]
            yield (f"<html><body>{shell.format(menu=menu, notice=notice, body=build(blocks))}"
                   "</body></html>", "\n".join(blocks))


def test_unmarked_layouts(weights):
    for w in (weights, {}):
        exact = [main_text(page, w) == text for page, text in layouts()]
        assert len(exact) == 20 and sum(exact) == 20


def test_best_region():
    assert best_region([-1, 2, -1, 3, -5, 3]) == (1, 3)
    assert best_region([-1, -2]) == (0, -1) and best_region([]) == (0, -1)
    assert best_region([1, -1, 1]) == (0, 0)


def test_weights_signs(weights):
    assert weights and all(w < 0 for k, w in weights.items() if k.startswith("tag"))
    assert weights["word p"] > 0 > weights["word outside"]
    assert weigh({}) == {}


def test_odd_rows(spark):
    rows = spark.createDataFrame(
        [(1, None, None), (None, "u", ""), (2, "u", "<p>some words</p>"), (2, "u", "<p>some words</p>")],
        "page_id bigint, url string, html string")
    found = main_texts(rows).collect()
    assert sorted((str(r.page_id), r.text) for r in found) == [
        ("1", ""), ("2", "some words"), ("2", "some words"), ("None", "")]
    assert main_texts(rows.limit(0)).collect() == []
    clash = rows.withColumns({c: F.lit(1) for c in ("text", "n", "kind", "inside", "pages")})
    assert [tuple(r) for r in main_texts(clash).collect()] == [tuple(r) for r in found]
