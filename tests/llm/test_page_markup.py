"""op5: tags as browsers read them, names of parts, deep and long pages, the region against all intervals."""

from __future__ import annotations

import random
import time

import pytest

from beaconlake.llm import html_regions

WEIGHTS = {"text": 1.0, "": -0.1}
ARTICLE = "The first sentence of a story that goes on for a while and more."


@pytest.mark.parametrize("tag", [
    "<p title=it's>", "<p title='it\"s'>", '<p title="a > b">', "<p data-x=a\"b'c>", "<p title = 'x>y' hidden-x>", "<p ' \">", "<p =\"x\">", "<p a=b/c>",
])
def test_quotes_in_tags(tag):
    assert html_regions.extract(f"<article>{tag}{ARTICLE}</p></article>", WEIGHTS) == ARTICLE


def test_a_quote_that_never_ends_ends_with_its_tag():
    assert html_regions.extract(f'<article><p><a href="x>{ARTICLE}</a></p></article>', WEIGHTS) == ARTICLE
    assert html_regions.extract(f"<article><p title='x>{ARTICLE}</p></article>", WEIGHTS) == ARTICLE


@pytest.mark.parametrize("tag", [
    "<div class='share-price'>", "<section id='search-history'>", "<div class='comments-table'>", "<div class='form-follows-function'>",
    "<div class='related-work'>", "<p id=notice-period>",
])
def test_names_that_only_hold_a_part_word_are_text(tag):
    name = tag[1:].split(" ")[0]
    page = f"<article><p>{ARTICLE}</p>{tag}{ARTICLE}</{name}></article>"
    assert html_regions.extract(page, WEIGHTS) == f"{ARTICLE}\n{ARTICLE}"


@pytest.mark.parametrize("tag", ["share-buttons", "ad", "ad-slot", "cookie-notice", "related-posts", "sidebar left", "comment-list", "x newsletter-box"])
def test_names_of_parts_are_beside(tag):
    assert html_regions.extract(f"<article><p>{ARTICLE}</p><div class='{tag}'>{ARTICLE}</div></article>", WEIGHTS) == ARTICLE


@pytest.mark.parametrize("n", [60, 70, 81, 200])
def test_links_outside_do_not_outweigh_the_article(n):
    article = " ".join(f"word{i}" for i in range(80))
    links = "".join(f"<li><a href=x>link{i}</a></li>" for i in range(n))
    page = f"<div class=sidebar><article><p>{article}</p></article></div><ul>{links}</ul>"
    assert html_regions.extract(page, WEIGHTS) == article


def test_deep_and_long_pages_take_linear_time():
    def seconds(page):
        start = time.process_time()
        html_regions.extract(page, WEIGHTS)
        return time.process_time() - start

    shapes = (
        lambda n: "<div>" * n + "</span>" * n + ARTICLE, lambda n: "<span>" * n + f"<p>{ARTICLE}</p>" * (n // 10),
        lambda n: "<ul><li>x" * n, lambda n: "<p title='" * n, lambda n: "<b><p>x" * n + "</b>" * n,
    )
    for shape in shapes:
        assert seconds(shape(40_000)) < 8


def test_unknown_tags_are_one_kind():
    kinds = html_regions.kinds(html_regions.tokens(f"<x-1><x-2><p>{ARTICLE}</p></x-2></x-1>"))
    assert kinds == ["other", "other", "p", "text", "p", "other", "other"]


def test_the_region_has_the_largest_sum_of_all_intervals():
    random_ = random.Random(3)
    for n in range(30):
        scores = [random_.choice([-3, -1, -0.5, 0, 1, 2]) for _ in range(n)]
        start, end = html_regions.best_region(scores)
        sums = [sum(scores[i:j]) for i in range(n) for j in range(i, n + 1)]
        assert sum(scores[start:end]) == max([0, *sums])
