"""Main text of pages written by hand, not by the grammar that the field learns from."""

import pytest

from countcast.llm import pages

TITLE = "The river in winter"
FIRST = "The first paragraph tells a long story about rivers, and it goes on for a while."
LAST = "Its last paragraph ends the story, which the town has told ever since."


@pytest.fixture(scope="module")
def model():
    return pages.Field.train(pages.labelled_pages())


def page(inside: str) -> str:
    return (f"<html><head><title>x</title></head><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav>"
            f"<article><h1>{TITLE}</h1><p>{FIRST}</p>{inside}<p>{LAST}</p></article><footer>&copy; The Town Paper</footer></body></html>")


@pytest.mark.parametrize("aside", [
    '<div class="comments"><p>I think this is a great article, thanks for it.</p></div>',
    '<section id="comments"><h3>Comments</h3><p>Nice one. I read it twice!</p></section>',
    '<div class="comment">So true.</div>',
    '<div class="reader-comments"><p>Reader: I do not agree with it.</p></div>',
    "<noscript>Please enable scripts.</noscript>",
    "<svg viewBox='0 0 1 1'><text>Label</text></svg>",
    '<p style="color: red; display : none">Hidden words are here.</p>',
    "<div style='visibility:hidden'><p>Hidden words</p></div>",
    "<p hidden>Hidden.</p>",
    "<script>if (a > b) { document.write('<p>no</p>') }</script>",
    "<style>p > a { color: red }</style><!-- <p>not this</p> -->",
])
def test_asides_within_an_article_go(model, aside):
    assert pages.main_text(page(aside), model) == f"{TITLE}\n{FIRST}\n{LAST}"


@pytest.mark.parametrize("attributes", ['title="x > y" data-a=1', "title='hidden words'", 'data-hidden="no"', 'title="a hidden b"', "title='it > \"that\"'", 'title=x"y'])
def test_attributes_leave_no_trace(model, attributes):
    kept = "Shown and kept &amp; read as a sentence of the article."
    assert pages.main_text(page(f"<p {attributes}>{kept}</p>"), model) == f"{TITLE}\n{FIRST}\n{kept.replace('&amp;', '&')}\n{LAST}"


def test_pages_cut_off_anywhere_are_read(model):
    """No prefix of a page fails, and markup never turns into text once its tag is closed."""
    whole = page('<p title="a > b" hidden>x</p><noscript>y</noscript>')
    for end in range(0, len(whole), 7):
        assert "noscript>" not in pages.main_text(whole[:end] + ">", model)
    assert pages.main_text(None, model) == pages.main_text("", model) == ""
