import pytest

from shiftledger.llm import html_crf

FIRST = "The first ships came in before dawn, and the crews waited for hours on the pier,{} as nobody had told them where to go."
SECOND = "Later that morning the weather changed, and the wind drove the boats together. Nobody was hurt, but two masts broke."
PAGE = (
    "<html><head><title>T</title></head><body><nav><a href='/'>Home</a></nav><article><h1>The long night</h1>"
    f"<p>{FIRST}</p><p>{SECOND}</p></article><footer>Copyright 2020 | Imprint</footer></body></html>"
)


@pytest.mark.parametrize(
    "tag",
    ["<svg viewBox='0 0 1 1'/>", "<svg a='b>c' />", "<svg-icon name=x></svg-icon>", "<select-box></select-box>",
     "<object data=x>", "<select>", "<template>", "<noscript>", "<iframe src=x>", "<svg><path d=''/>"],
)
def test_article_goes_on_behind_a_tag_without_end(tag):
    text = " ".join(html_crf.main_text(PAGE.replace("{}", tag), html_crf.trained_field()).split())
    assert text == f"The long night {FIRST} {SECOND}".replace("{}", "")


@pytest.mark.parametrize("tag", ["script", "style", "textarea", "title"])
def test_raw_text_runs_to_the_end(tag):
    assert [b.text for b in html_crf.leaf_blocks(f"<p>a</p><{tag} x>b<p>c")] == ["a"]
    assert [b.text for b in html_crf.leaf_blocks(f"<p>a<{tag}>b</{tag} ><{tag}>b</{tag}-x>c</{tag}>d")] == ["ad"]


@pytest.mark.parametrize("tag", ["svg", "select", "object", "noscript", "template", "iframe"])
def test_content_up_to_the_end_tag_is_left_out(tag):
    assert [b.text for b in html_crf.leaf_blocks(f"<p>a<{tag} x='>'>b<p>c</{tag}\n>d<{tag}>e")] == ["ade"]
