"""What an article's page holds beside its text, element by element."""

import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm import html_extract

LEAKS = [
    "<button>Like</button>", "<select><option>one</option><option>two</option></select>", "<option>alone</option>", "<label>Your name</label>",
    '<p class="advertisement">Buy now</p>', '<p class="cookie-notice">We use cookies</p>', '<p role="navigation">Back</p>', "<p hidden>secret</p>",
    '<p style="display: none">gone</p>', '<span class="share">Share this</span>', '<h2 class="comments-title">12 comments</h2>',
    '<article class="comment"><p>a reader</p></article>', '<div class="shareButtons">a b</div>', '<a class="btn-share" href="/x">tweet</a>',
    '<section id="related-posts"><p>more</p></section>', '<div aria-hidden="true">x</div>', "<button>open <b>label</b> <button>inner</button></button>",
    '<p class="promo">unclosed promo',
]
KEPT = [
    ('<div class="social-history"><p>The strike of 1911</p></div>', "The strike of 1911"), ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p>", "Let x=2 be"),
    ('<p class="notice-of-war">Declared</p>', "Declared"), ('<p class="lead post-1">First</p>', "First"), ('<span class="sidebar-free">kept</span>', "kept"),
    ("<header><h1>Head line</h1></header>", "Head line"), ('<div class="ad-hoc-committee">met</div>', "met"),
    ("<p>before <button>unclosed</p><p>after</p>", "before\nafter"), ('<p>a <span class="share">b</p><p>c</p>', "a\nc"),
]
LONG = "Long words of the article stand here. " * 5


def text(inside):
    return html_extract.extract_text(f"<html><body><nav>menu</nav><article><p>{LONG}</p>{inside}<p>End of it.</p></article><footer>foot</footer></body></html>", None)


@pytest.mark.parametrize("leak", LEAKS)
def test_is_left_out(leak):
    assert text(leak) == f"{LONG.strip()}\nEnd of it."


@pytest.mark.parametrize("source, want", KEPT)
def test_is_kept(source, want):
    assert text(source) == f"{LONG.strip()}\n{want}\nEnd of it."


def test_many_unclosed_elements_take_linear_time():
    started = time.perf_counter()
    assert text("<span class=share>x" * 40_000 + "</span>").startswith(LONG.strip())
    assert text("<button>x" * 40_000).startswith(LONG.strip())
    assert time.perf_counter() - started < 20


def test_clashing_columns_and_ties(spark):
    rows = [(1, "h", f"<div class='a'><p>{LONG}</p></div>", 1, 2), (2, "h", f"<div class='b'><p>{LONG}</p></div>", 1, 2), (3, None, None, 1, 2), (1, "h", "", 1, 2)]
    pages = spark.createDataFrame(rows, "page_id long, host string, html string, _winner_path int, _host int")
    got = html_extract.extract(pages, "host")
    assert got.columns == [*pages.columns, "text"]
    assert sorted(r["text"] for r in got.collect()) == ["", "", LONG.strip(), LONG.strip()]
    again = sorted(map(tuple, html_extract.extract(pages.orderBy(F.desc("page_id")), "host").collect()), key=str)
    assert again == sorted(map(tuple, got.collect()), key=str)
    with pytest.raises(ValueError, match="text"):
        html_extract.extract(got, "host")
    assert html_extract.extract(pages.limit(0), "host").count() == 0
