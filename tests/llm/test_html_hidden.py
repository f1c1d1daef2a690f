"""Hidden elements end where they do in browsers, and hide nothing else."""

import pytest

from tests.llm.test_html_extract import model  # noqa: F401
from tidewash.llm import html_extract as h


def texts(page):
    return [b[0] for b in h.blocks(page)]


@pytest.mark.parametrize("page,want", [
    ("<html><head><title>t</title><meta charset=x><body><p>a</p></body></html>", ["a"]),
    ("<html><head><title>t</title><style>p{}</style><p>a<p>b", ["a", "b"]),
    ("<head><title>t</title><body>a", ["a"]),
    ("<head><link rel=x>a<p>b", ["a", "b"]),
    ("<head><template><p>no</p></template><noscript><img src=x></noscript><title>t</title></head><p>a", ["a"]),
    ("<head><script>var a='<p>no'</script> \n <body><div>a<head>b</div>", ["ab"]),
])
def test_head_without_end_tag(page, want):
    assert texts(page) == want


@pytest.mark.parametrize("page,want", [
    ("<article><p>a</p><svg viewBox='0 0 1 1'/><p>b</p>c</article>", ["a", "b", "c"]),
    ("<p>a<svg/>b</p>", ["ab"]),
    ("<p>a<svg><title>no</title><path d=x /><g><text>no</text></g></svg>b</p>", ["ab"]),
    ("<div>a<svg><path d=x><p>b</p></div>", ["a", "b"]),
    ("<div>a<svg><foreignObject><p>no</p></foreignObject><text>no</text></svg>b</div>", ["a", "b"]),
    ("<div>a<svg><style/><script/></svg>b</div>", ["ab"]),
])
def test_svg(page, want):
    assert texts(page) == want


def test_formulas_are_text():
    formula = "<math><semantics><mrow><mi>x</mi><mspace width=1em /><mo>=</mo><mn>2</mn></mrow><annotation>no</annotation></semantics></math>"
    assert texts(f"<p>Let {formula} be.</p><p>Next <math/>one.</p>") == ["Let x=2 be.", "Next one."]


def test_all_words_of_a_class_are_names():
    utility = " ".join(f"{a}{b}" for a in "abcde" for b in ("x", "y", "z"))
    found = h.blocks(f"<div class='{utility} comments'><p>a</p></div>")
    assert found[0][2][0][1][-1] == "comments" and len(found[0][2][0][1]) == 16
    plain = h.features(h.blocks(f"<div class='{utility}'><p>a</p></div>"))[0]
    assert h._slot("name=comments") in h.features(found)[0] and h._slot("name=comments") not in plain


def test_main_text_of_such_pages(model):  # noqa: F811
    page = ("<html><head><title>t</title><body><nav><a href=x>Home</a></nav><article><p>First long paragraph of the story, with"
            " words.</p><svg class=icon/><p>Second one, with <math><mi>x</mi></math> in it.</p></article><footer>c 2020</footer>")
    assert h.extract_text(model, page) == "First long paragraph of the story, with words.\nSecond one, with x in it."
