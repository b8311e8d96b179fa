"""Main text of pages: made pages whose text is known, and the given ones against their article."""

from __future__ import annotations

import html as entities
import re

import pytest
from pyspark.sql import functions as F

from batchload.llm import html
from batchload.llm.queries import QUERIES

LONG = "The town is on the river and it was for the people of the valley that they made a bridge of stone."
NOISE = """<header><a href="/">Home</a> The site of the town and of the people in the valley</header>
<nav><ul><li><a href="/a">News</a></li><li><a href="/b">Sport</a></li></ul></nav>
<div class="cookie-banner">We use cookies for the site and it is good for all of the users of it and us.</div>"""
TAIL = """<div id="comments"><p>I like the article and it is good for the people of the town, and so on it is.</p></div>
<aside>More of the news that is on the site and in the paper</aside><form>Your name <input><button>Send</button></form>
<footer>&copy; 2020 The Paper, all of the rights are reserved in the world</footer>
<script>var x = "<p>The script of the page is not a text</p>";</script><style>p { margin: 0 }</style>"""


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title></head><body>{body}</body></html>"


@pytest.mark.parametrize("open_,close", [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post-content">', "</div>"), ("<div>", "</div>")])
def test_parts_of_a_page(open_, close):
    article = f"{open_}<h1>Title of the day</h1><p>{LONG}</p><p>Short.</p><p>{LONG} <a href=x>link</a> end &amp; &lt;tag&gt;</p>{close}"
    expected = f"Title of the day {LONG} Short. {LONG} link end & <tag>"
    assert html.main_text(page(NOISE + article + TAIL)) == expected


def test_inside_an_article():
    inner = '<section class="comments-area"><p>{0}</p></section><div class="ad">{0}</div><form>{0}</form>'.format(LONG)
    inner += '<div class="newsletter signup">{0}</div><div class="related-posts"><a href=x>{0}</a></div>'.format(LONG)
    inner += f'<p hidden>{LONG}</p><p style="display: none">{LONG}</p><footer>{LONG}</footer><aside>{LONG}</aside>'
    assert html.main_text(page(f"<article><p>{LONG}</p>{inner}<p>End.</p></article>")) == f"{LONG} End."


def test_short_articles_are_whole():
    assert html.main_text(page("<article><h1>A.</h1><p><b>A.<br><p>B.</p></article><footer>f</footer>")) == "A. A. B."


def test_white_space_and_references():
    body = f"<article><p>  {LONG}\n\t x&nbsp;y a<b>b</b>c<br>d &#233; &amp;amp; 1 < 2 &amp b </p></article>"
    assert html.main_text(page(body)) == f"{LONG} x y abc d é &amp; 1 < 2 & b"


JAPANESE = "東京は日本の首都であり、世界でも有数の大都市である。政治、経済、文化の中心として発展してきた。"
RUSSIAN = "Москва является столицей России и крупнейшим городом страны. Она расположена на реке."


@pytest.fixture(scope="module")
def given(spark):
    return [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("html").collect()]


@pytest.fixture(scope="module")
def stops(spark):
    return html.stop_words(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"), "html")


def article_of(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    return " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())


@pytest.mark.parametrize("text", [JAPANESE, RUSSIAN, LONG])
def test_languages_without_stop_words(stops, text):
    body = f"<nav><a href=x>m</a></nav><p>{text}</p><p>{text}</p><footer>f</footer>"
    assert html.main_text(page(body), stops) == html.main_text(page(body)) == f"{text} {text}"


@pytest.mark.parametrize("name", ['class="social-history"', 'id="promotion-rules"', 'class="related-work"', 'id="shareholders-notice-period"', 'class="commentary"', 'class="cookies-recipe"'])
def test_furniture_words_beside_others_are_hints(stops, name):
    body = f"<article><p>{LONG}</p><div {name}><p>{LONG}</p><p>A short one.</p></div></article>"
    assert html.main_text(page(body), stops) == f"{LONG} {LONG} A short one."
    linked = body.replace("A short one.", "<a href=x>Share this</a>")
    assert html.main_text(page(linked), stops) == f"{LONG} {LONG}"


@pytest.mark.parametrize("name", ["comments-area", "relatedPosts", "ad", "user-comments-by-anna", "cookie-banner", "article__share", "ad-leaderboard", "cookie-law-info", "promo story-promo", "site-footer-copyright"])
def test_names_of_furniture(stops, name):
    body = f'<article><p>{LONG}</p><div class="{name}"><p>{LONG}</p></div><p>End.</p></article>'
    assert html.main_text(page(body), stops) == f"{LONG} End."


def test_density_decides_outside_articles(stops):
    """Two blocks of the same length without links, amid prose: the one without stop words goes."""
    sparse = "Berlin Paris Madrid Lisbon Vienna Prague Warsaw Dublin Athens Oslo Helsinki Copenhagen Tallinn Riga"
    body = f"<div><p>{LONG}</p><p>{sparse}</p><p>{LONG}</p></div>"
    assert html.main_text(page(body), stops) == f"{LONG} {LONG}"
    assert html.main_text(page(f"<article>{body}</article>"), stops) == f"{LONG} {sparse} {LONG}"


def test_stop_words_are_counted_over_all_pages(spark, stops, given):
    counts, total = {}, html.PRIOR_WORDS
    for p in given:
        if html.language(p) == "de":
            for word in html.WORDS.findall(html.NO_TEXT.sub(" ", p).lower()):
                if html.script(word[0]) == "LATIN":
                    counts[word] = counts.get(word, 0) + 1
                    total += 1
    frequent = {word: n / total for word, n in counts.items() if n >= total * html.FREQUENT}
    words, share = stops["de LATIN"]
    assert words == set(frequent) and share == pytest.approx(sum(frequent.values()))
    assert {"der", "und", "die"} <= words and {"the", "and"} <= stops["en LATIN"][0]
    odd = spark.createDataFrame([(None, "x"), ("", "x"), ("<p>", "x")], "html string, word string")
    assert html.stop_words(odd, "html") == html.stop_words(odd.limit(0), "html") == {}


def test_given_pages_without_article_marks(given, stops):
    """With their mark every article is whole; without it 94 in 100 are (the words are made up)."""
    assert all(html.main_text(p, stops) == article_of(p) for p in given)
    same = sum(html.main_text(re.sub(r"</?article>", "", p), stops) == article_of(p) for p in given)
    assert same >= 0.94 * len(given)


def test_layout_words_are_no_chrome():
    body = f'<div class="content with-sidebar no-comments"><p>{LONG}</p></div>'
    assert html.main_text(page(body)) == LONG


@pytest.mark.parametrize(
    "text",
    ["", "<", "<p", "<!--", "<!-- x", "<script>", "<a href='", "</p></div>", "<p>" * 500, "&", "&#x110000;", "<3 a", "<é>"],
)
def test_broken_pages(text):
    assert isinstance(html.main_text(text), str)
    assert html.main_text(page(f"<article><p>{LONG}</p></article>") + text).startswith(LONG)


def test_second_pass():
    G, B, U = html.GOOD, html.BAD, html.UNSURE
    none, no = [False] * 5, [False] * 5
    assert html.second_pass([U, G, U, U, B], none, no, B) == [G, G, G, B, B]
    assert html.second_pass([U, U, U, U, U], none, no, B) == [B] * 5
    assert html.second_pass([G, U, B, U, G], none, no, B) == [G, G, B, B, G]
    assert html.second_pass([G, U, B, U, G], none, [True] * 5, B) == [G, B, B, G, G]
    assert html.second_pass([B, U, B, U, G], [True, False, True, False, False], no, B) == [B, G, B, G, G]


def test_query(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    for r in QUERIES["op5_html_text"](spark, "/root/testdata/sf0.001").collect():
        text = article_of(pages[r["page_id"]])
        assert r["text"] == text and r["n_chars"] == len(text)


def test_odd_rows(spark):
    long_page = page(f"<article>{f'<p>{LONG}</p>' * 5000}</article>")
    rows = [(1, None, None), (2, "u", ""), (None, "u", page(f"<p>{LONG}</p>")), (4, "u", long_page), (4, "u", long_page)]
    pages = spark.createDataFrame([(*r, "x", "x") for r in rows], "page_id long, url string, html string, text string, n string")
    got = pages.select("page_id", html.extract(F.col("html")).alias("t")).collect()
    assert [(r["page_id"], r["t"]) for r in got] == [
        (1, ""), (2, ""), (None, LONG), (4, " ".join([LONG] * 5000)), (4, " ".join([LONG] * 5000)),
    ]
    assert pages.limit(0).select(html.extract(F.col("html"))).count() == 0
