"""Main text that must not be lost."""

import json

from brandtrack.llm import wrapper_extract as we


def post(i):
    words = f"word{i} " * 200
    return (
        f"<body><div class=post><h1>Title {i}</h1><div class=lead>Lead {i}</div>"
        f"<div class=body><p>{words}</p></div><div class=more>More {i}</div></div></body>"
    )


def test_title_lead_and_closing_part_stay():
    wrapper = we.induce([post(i) for i in range(8)])
    assert len(json.loads(wrapper)["slots"]) == 1
    words = " ".join(["word9"] * 200)
    assert we.extract(post(9), wrapper) == f"Title 9\nLead 9\n{words}\nMore 9"


def test_a_page_of_another_layout_keeps_what_lies_outside_the_container():
    wrapper = we.induce([post(i) for i in range(8)])
    other = "<body><div class=post><p>small</p></div><div class=story><p>long</p></div></body>"
    assert we.extract(other, wrapper) == "small\nlong"
    mixed = "<body><p>lead</p><article><p>a</p></article><p>end</p></body>"
    assert we.extract(mixed, None) == "lead\na\nend"
