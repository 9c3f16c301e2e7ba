"""Main text of pages without telling names, inside layout wrappers, and of hostile pages."""

import re
import time

import pyarrow.parquet as pq
import pytest

from conftest import SF01
from txrisk.llm import html_text as h

PAGES = [r["html"] for r in pq.read_table(f"{SF01}/pages.parquet").to_pylist()]
LINE = "The mill by the river was built of stone and has stood there for longer than anyone can tell."


@pytest.fixture(scope="module")
def tree():
    return h.trained()


def _characters(pages, tree):
    return sum(len(b) for p in pages for b in h.main_blocks(p, tree))


def test_tree_splits_on_density_and_on_neighbours(tree):
    used = {f for f in tree.feature if f >= 0}
    assert 4 in used, "the block's own link density"
    assert used & {0, 2, 3, 5}, "word count or link density of a neighbour"


def test_articles_without_an_article_tag_are_kept(tree):
    plain = [re.sub("(</?)article", r"\1div", p) for p in PAGES]
    whole, kept = _characters(PAGES, tree), _characters(plain, tree)
    assert 0.98 * whole <= kept <= 1.02 * whole


@pytest.mark.parametrize("name", ["layout has-sidebar", "page-header-fixed", "site widget", "nav-open"])
def test_a_layout_wrapper_says_nothing(tree, name):
    for article in ("article", "div"):
        pages = [re.sub("(</?)article", rf"\1{article}", p) for p in PAGES[:50]]
        around = [p.replace("<body>", f"<body><div class='{name}'>").replace("</body>", "</div></body>") for p in pages]
        inside = [p.replace("<article>", f"<div class='{name}'><{article}>").replace("</article>", f"</{article}></div>") for p in PAGES[:50]]
        for wrapped in (around, inside):
            assert [h.main_blocks(p, tree) for p in wrapped] == [h.main_blocks(p, tree) for p in pages]


def test_an_articles_own_head_is_kept_and_a_sites_is_not(tree):
    page = (f"<body><div class='site-header'>Example press</div><div class='article-header'><h1>The mill</h1></div><p>{LINE}</p><p>{LINE}</p>"
            f"<div class='entry-comments'><p>{LINE}</p></div><div class='sidebar'><p>{LINE}</p></div></body>")
    assert h.main_blocks(page, tree) == ["The mill", LINE, LINE]


def test_comments_longer_than_the_article_stay_out(tree):
    page = f"<article><h1>Mill</h1><p>{LINE}</p></article><div class='comments'>" + f"<p>{LINE}</p>" * 40 + "</div>"
    assert h.main_blocks(page, tree) == ["Mill", LINE]
    form = f"<form action='/'><article><p>{LINE}</p></article><p>Your name and all of your {LINE}</p></form>"
    assert LINE in h.main_blocks(form, tree)


def test_quotes(tree):
    for attrs in ("title=it's", "title=\"a > b\"", "title='a \" > b'", "data-x = \"<p>\"", "a=b'c\"d"):
        assert h.main_blocks(f"<article><p {attrs}>Don't say \"so\".</p></article>", tree) == ["Don't say \"so\"."]
    assert h.main_blocks(f"<article><p>{LINE}</p><p title=\"no end>{LINE}</p></article>", tree)[0] == LINE


@pytest.mark.parametrize("page", ["<a " * 350_000, '<a "' * 260_000, "<div>" * 90_000 + "</x2>" * 90_000, '<a "x>" ' * 130_000,
                                  "<!" * 500_000, "<button>" * 120_000, "<object>" * 120_000 + "</object>", "<a =" * 250_000,
                                  "<!-- " * 200_000, "<a" * 500_000, '<a b="' * 150_000, "</a>" * 250_000],
                         ids=range(12))
def test_a_megabyte_of_broken_markup_takes_time_in_proportion(tree, page):
    start = time.perf_counter()
    h.main_blocks(page[:len(page) // 10], tree)
    tenth = time.perf_counter() - start
    h.main_blocks(page, tree)
    assert time.perf_counter() - start - tenth < 30 * tenth + 1.0
