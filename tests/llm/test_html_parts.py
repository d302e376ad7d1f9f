"""Pages with icons and formulas, and with names that only look like furniture."""

import pytest

from plantlens.llm import html_template


def text_of(page, main=(), fixed=()):
    return html_template.main_text(page, frozenset(main), frozenset(fixed))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>a<svg class='i'/>b<p>c", "a b c"),
        ("<p>a<svg/>b<svg><text>no</text></svg>c", "a b c"),
        ("<p>a<math/>b<p>c", "ab c"),
        ("<article>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</article>", "so x=2 holds"),
    ],
)
def test_icons_and_formulas(page, text):
    assert text_of(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div class='elementor-widget elementor-widget-text-editor'><p>body</div>", "body"),
        ("<div class='page no-sidebar'>a<div class='content has-sidebar'>b</div></div>", "a b"),
        ("<div>a<div class=related-work>b</div></div>", "a b"),
        ("<article><h1>t</h1><div class='widget'><p>whole long body</div></article>", "t whole long body"),
        ("<div class=widget>story text<div class=share>x</div></div>", "story text"),
        ("<p>long story<div class='site-footer'>f</div><div id=sidebar>s</div>", "long story"),
    ],
)
def test_names_are_weak_evidence(page, text):
    assert text_of(page) == text
