"""op5: class and id words on layout wrappers, and learnt weights of such words."""

from __future__ import annotations

import pytest

from beaconlake.llm import html_regions

WEIGHTS = {"text": 1.0, "": -0.1}
ARTICLE = "The first sentence of a story that goes on for a while and more."
TEASER = "Read another story now"


@pytest.mark.parametrize("outer", ['class="has-sidebar"', 'class="page with-comments"', 'id="menu-open"', 'class="header-form"', 'class="sidebar"'])
@pytest.mark.parametrize("inner", ["article", "main"])
def test_a_layout_wrapper_does_not_hide_the_article(outer, inner):
    page = f'<body><div {outer}><nav>a b c</nav><{inner}><p>{ARTICLE}</p></{inner}></div><footer>x y</footer></body>'
    assert html_regions.extract(page, WEIGHTS) == ARTICLE


def test_parts_stay_beside():
    teasers = f'<div class="related"><article><p>{TEASER}</p></article></div>'
    for page in (
        f"<main><p>{ARTICLE}</p></main>{teasers}", f"<div><p>{ARTICLE}</p>{teasers}</div>",
        f'<article><p>{ARTICLE}</p><div class="share-buttons">{TEASER}</div></article>',
        f'<article><p>{ARTICLE}</p></article><div class="comments"><article class="comment">{ARTICLE} {ARTICLE} {ARTICLE}</article></div>',
        f"<p>{ARTICLE}</p><aside><article>{ARTICLE} {ARTICLE} {ARTICLE}</article></aside>",
        f'<p>{ARTICLE}</p><div hidden class="widget"><main>{ARTICLE} {ARTICLE}</main></div>',
    ):
        assert html_regions.extract(page, WEIGHTS) == ARTICLE, page


def test_the_learnt_weight_of_a_class_word_decides():
    page = f'<div class="menu">{TEASER}</div><div class="widget"><p>{ARTICLE}</p></div>'
    assert html_regions.extract(page, WEIGHTS) == ""
    learnt = html_regions.learn_weights(html_regions.count_kinds(page, ARTICLE))
    assert learnt["beside:widget"] > 0 > learnt["beside:menu"]
    assert html_regions.extract(page, learnt) == ARTICLE
