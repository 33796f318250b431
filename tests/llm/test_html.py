"""Main text of pages without article or main, odd attributes, and long malformed markup."""

import html
import re
import time

import pytest

from lakeforge.llm import html_text as H

PARA = "The quick brown fox, it is said, jumps over the lazy dog; and so on it goes, for a while longer than that, until the end."
TEXT = "\n".join([PARA] * 4)
ARTICLE = "".join(f"<p>{PARA}</p>" for _ in range(4))


def page(inside):
    return (
        "<html><head><title>t</title></head><body><nav><a href=x>Home</a></nav><div id=menu><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></div>"
        f"{inside}<div class='ad'>Buy now, cheap.</div><div class='cookie-banner'>We use cookies, and more. Agree?</div><div class='comments'><p>{PARA}</p></div>"
        "<footer>(c) us</footer></body></html>"
    )


@pytest.mark.parametrize("around", [
    '<div style="overflow:hidden">', '<div title="hidden costs">', '<div data-role="search">', "<div data-hidden=1 aria-hidden=false>", '<div class="content has-sidebar">',
    '<div class="post single-header">', '<div class="no-comments">', "<div>", "<section>", "<table><tr><td>", '<div title="a > b">', "<div CLASS='Entry'>", '<div id="main"><div class="inner">',
])
def test_what_other_attributes_say_does_not_drop_an_article(around):
    assert H.extract(page(around + ARTICLE)) == TEXT


@pytest.mark.parametrize("around", ["<div hidden>", "<div HIDDEN=''>", '<div aria-hidden="true">', "<div role=navigation>", "<div class='x sidebar'>", "<div id=comment-list>", "<div class=site-header>", "<aside>", "<header>"])
def test_boilerplate_beside_an_article_goes(around):
    assert H.extract(page(f"<div>{ARTICLE}</div>{around}<p>{PARA}</p></div>")) == TEXT


def test_sections_all_stay_with_headings_lists_and_captions():
    inside = (
        f"<div><h1>Title</h1><section><h2>One</h2>{ARTICLE}</section><section><h2>Two</h2><p>{PARA}</p><ul><li>first item</li><li>second <a href=x>item</a></li></ul>"
        f"<table><caption>A table</caption><tr><td>cell</td></tr></table></section></div>"
    )
    assert H.extract(page(inside)) == f"One\n{TEXT}\nTwo\n{PARA}\nfirst item\nsecond item\nA table\ncell"
    assert H.extract(page(f"<article><h1>Title</h1>{inside}</article>")).startswith("Title\nTitle\nOne\n")


def test_blocks_of_low_ratio_paths_go_though_no_name_lists_them():
    inside = f"<div class='story'>{ARTICLE}<div class='tools'>Print this page</div><div class='tags'><a href=x>fox</a> <a href=y>dog</a></div></div><div class='x'>Top stories</div>"
    assert H.extract(page(inside)) == TEXT


def test_a_name_alone_does_not_take_a_whole_page():
    assert H.extract(page(f"<div class='widget'>{ARTICLE}{ARTICLE}{ARTICLE}</div>")) == "\n".join([TEXT] * 3)


def test_pages_whose_articles_are_divisions(spark):
    """All pages of the table with article written as div: no tag names the content."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    wrong = 0
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]+>", "", x))).strip() for x in re.split(r"</?(?:p|h1)>", inner))
        bare = r.html.replace("<article>", "<div class='post'>").replace("</article>", "</div>")
        wrong += H.extract(bare) != "\n".join(p for p in parts if p)
    assert wrong <= 0.02 * len(rows)


@pytest.mark.parametrize("unit", ["<a ", '<a "', "<div>", "</b></i></x>", "<div class='comment'>", "<p", "<!--", "<li><a href=x>y</a>", "<a href='", "<div><p>x", "<header>", "<ul><li>", "< ", "&amp"])
def test_malformed_markup_takes_linear_time(unit):
    start = time.time()
    H.extract(unit * (1_000_000 // len(unit)))
    assert time.time() - start < 6
    H.extract(unit * 1000 + ">" + unit * 1000)


def test_attributes():
    made = H.attributes(""" class="a B" id=x data-class='no' hidden title="class='y' > z" CLASS=second alt="a=b" =junk 'stray' "" """)
    assert made["class"] == "a b" and made["id"] == "x" and made["data-class"] == "no" and made["hidden"] == "" and made["title"] == "class='y' > z" and made["alt"] == "a=b"
