"""Hosts with several layouts, copied articles without article elements, hidden text and media."""

import pytest

from plantlens.llm import html_template

PAGES = "page_id long, url string, html string"


def story(i, n=30):
    return " ".join(f"w{(i * 37 + k * 11) % 1009}" for k in range(n))


def first(i, body):
    return (
        "<body><div class=a><div class=m1><p>Home Products Contact</p></div>"
        f"<p>{body}</p><p>more {story(i + 500, 5)}</p><div class=e1><p>All rights reserved by Acme</p></div></div></body>"
    )


def second(i):
    items = "".join(f"<li>{story(i + k, 6)}</li>" for k in range(1 + i % 3))
    return f"<body><section class=b><h4 class=t>Latest</h4><ul>{items}</ul></section></body>"


@pytest.fixture
def pages(spark):
    rows = [(i, "http://h/x", first(i, story(i))) for i in range(20)]
    rows += [(100 + i, "http://h/x", second(i)) for i in range(20)]
    copied = story(777, 80)
    rows += [
        (200 + i, "http://g/x", f"<body><div class=c><h2>one title</h2><p>{copied}</p></div><i>{i}</i></body>") for i in range(6)
    ]
    rows += [(300 + i, "http://g/x", f"<body><b>{story(i)}</b></body>") for i in range(6)]
    return spark.createDataFrame(rows, PAGES)


@pytest.mark.parametrize("bound", [html_template.BROADCAST_BYTES, -1])
def test_each_layout_has_its_template(pages, monkeypatch, bound):
    monkeypatch.setattr(html_template, "BROADCAST_BYTES", bound)
    found = {r.page_id: r.text for r in html_template.extract(pages).collect()}
    assert len(found) == pages.count()
    for i in range(20):
        assert found[i] == f"{story(i)} more {story(i + 500, 5)}"
        assert found[100 + i] == " ".join(story(i + k, 6) for k in range(1 + i % 3))
    for i in range(6):
        assert found[200 + i] == f"one title {story(777, 80)} {i}"
        assert found[300 + i] == story(i)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p>a</p><p hidden>b</p><p aria-hidden=true>c</p>", "a b c"),
        ("<p>a</p><video><p>b</p></video><object>c</object><canvas>d</canvas><audio>e</audio>", "a b c d e"),
        ("<p>a long story</p><dialog>close</dialog>", "a long story"),
        ("<dialog><p>a long story</dialog>", "a long story"),
    ],
)
def test_only_what_is_listed_goes(page, text):
    found = html_template.main_text(page, frozenset(), frozenset())
    assert found.split() == text.split()
