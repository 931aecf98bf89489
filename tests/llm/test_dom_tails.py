"""No page tail is lost behind an element without an end."""

import pytest

from brandtrack.llm import wrapper_extract as we
from brandtrack.llm.dom import BESIDE, OUTER, tidy


@pytest.mark.parametrize("tag", sorted(BESIDE))
def test_unclosed_elements_beside_the_text_lose_nothing_after_them(tag):
    assert we.extract(f"<body><{tag}><div class=post><p>text</p></div>tail", None) == "text\ntail"
    later = f"<body><{tag}>a<p>text</p><{tag} title='</{tag}>'>b</{tag}><p>tail</p>"
    assert we.extract(later, None) == "a\ntext\ntail"
    assert we.extract(f"<p>x <{tag}>b<{tag}>c</{tag}></{tag.upper()} > y</p>z", None) == "x y\nz"
    if tag in OUTER:
        inner = f"<{tag}><style>p{{}}</{tag}><p>text</p><{tag}><script>x</{tag}><style>q{{}}</style>tail"
        assert we.extract(inner, None) == "text\ntail"
        return
    assert we.extract(f"<p>x <{tag}>b<script>'</{tag}>'</script>c<!--</{tag}>--></{tag}> y</p>", None) == "x y"


def test_raw_text_ends_at_its_end_tag_whatever_comes_before():
    page = "<p>İİİİ a</p><script>x('</p>')</SCRIPT >bcdef<p>g</p><textarea><p>no</textarea>h<style>u{}"
    assert we.extract(page, None) == "İİİİ a\nbcdef\ng\nh"
    assert we.extract("<p>İİİİİİ</p><button>b</button>text", None) == "İİİİİİ\ntext"


def test_formulas_are_text():
    assert tidy(we.extract("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>", None)) == "so x=2 holds"


def test_many_unclosed_elements_are_read_once():
    assert we.extract("<p>a" + "<button>b" * 30000, None) == "a" + "".join(" b" for _ in range(30000))
