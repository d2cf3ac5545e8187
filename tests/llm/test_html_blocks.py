"""Wrappers, marks and line blocks of pages."""

import re

import pytest
from pyspark.sql import functions as F

from docloom.llm import html_text

SF = "/root/testdata/sf0.001"
BODY = "<h1>Title</h1><p>" + "words of the body " * 20 + "</p><p>more of it, and a <a href=x>link</a>.</p>"
TEXT = "Title " + ("words of the body " * 20).strip() + " more of it, and a link."


@pytest.mark.parametrize("open_", ['<div class="content no-sidebar">', '<div id="page" class="site has-banner">', '<div class="elementor-widget">', '<div class="sidebar-content">', '<form method=post>', '<div class="widget"><div class="menu">', "<noscript>"])
def test_wrappers_of_the_whole_text(open_):
    close = "".join(f"</{n}>" for n in reversed(re.findall(r"<(\w+)", open_)))
    around = '<nav><a href=x>a menu</a></nav><div class="ad">buy this</div>{}<div class="comments"><p>' + "a reader says " * 90 + "</p></div><footer>f</footer>"
    assert html_text.main_text(around.format(open_ + BODY + close)) == TEXT
    assert html_text.main_text(around.format(f"{open_}<article>{BODY}</article>{close}")) == TEXT


@pytest.mark.parametrize("part, want", [
    ('<div class="post-header"><h2>sub</h2></div>', " sub"), ('<div class="header">sub</div>', " sub"), ('<p class="related-work">of others</p>', " of others"), ("<p>so <math><mi>x</mi></math> is</p>", " so x is"),
    ("<noscript>turn scripts on</noscript>", ""), ('<div class="cookie-banner">we use</div>', ""), ('<ul class="socialShare"><li>tell</li></ul>', ""), ('<div id="post-comments">no</div>', ""),
    ('<span class="ad">buy</span>', ""), ("<form><label>name</label></form>", ""), ("<p hidden>no</p>", "")])
def test_parts_within_an_article(part, want):
    assert html_text.main_text(f"<article>{BODY}{part}<p>the end</p></article>") == f"{TEXT}{want} the end"
    assert html_text.main_text(f"<article>{part}{BODY}</article>") == f"{want} {TEXT}".strip()


def test_links_count_nothing_outside_of_articles():
    menu = "".join(f"<div>{k}: <a href=x>{'go to that page ' * 9}</a></div>" for k in range(20))
    assert html_text.main_text(f"{menu}<header>h</header><div>{BODY}</div>") == TEXT


def test_the_threshold_decides_on_the_given_pages(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").filter(F.col("html").isNotNull()).collect()]
    texts = [html_text.main_text(p) for p in pages]
    low, high = ([html_text.main_text(p, s) for p in pages] for s in (1, 10**9))
    assert sum(a != b for a, b in zip(texts, low)) >= 0.9 * len(pages)
    assert all(set(a.split()) <= set(b.split()) for a, b in zip(texts, low)) and all(x for x in high)
    bare = [html_text.main_text(re.sub(r'\s(?:class|id|role)="[^"]*"', "", p)) for p in pages]
    assert sum(a == b for a, b in zip(texts, bare)) >= 0.95 * len(pages)


def test_marks_nest_and_break_like_their_elements():
    long = "an advert in many words " * 120
    assert html_text.main_text(f'<div class="ad"><p>{long}</p></div><nav>n</nav><article>{BODY}</article>') == f"{long.strip()} {TEXT}"
    assert html_text.main_text(f'<div class="page"><div class="menu"><div class="ad">x</div>y</div>{BODY}</div>') == TEXT
    assert html_text.main_text('<div class="ad">' * 50_000 + "x") == ""
    assert html_text.main_text('<div class="ad">buy</div>') == "" and html_text.main_text("<p>short") == "short"
