"""Pages whose head has no end tag."""

import pytest

from strataload.llm.htmltext import outline, parse

HEAD = "<!doctype html><html><head><meta charset=utf-8><title>Title</title><style>p {}</style>\n"


@pytest.mark.parametrize(
    "body",
    [
        "<body><article><p>First words.<p>Second words.</article></body></html>",
        "<article><p>First words.</p><p>Second words.</p></article>",
        "<p>First words.<p>Second words.",
        "First words.<p>Second words.",
        "</head><body><p>First words.</p><p>Second words.</p></body>",
    ],
)
def test_text_behind_an_open_head(body):
    assert [text for _, text in outline(parse(HEAD + body)).pieces] == ["First words.", "Second words."]


def test_text_alone_behind_an_open_head():
    assert [text for _, text in outline(parse(HEAD + "Only words.")).pieces] == ["Only words."]
