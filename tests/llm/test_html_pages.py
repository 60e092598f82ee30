"""Damaged, deep and odd pages, and blocks against an independent walk over well-formed ones."""

import time
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiftledger.llm import html_crf
from shiftledger.llm.labelled_pages import labelled_pages

DAMAGED = {
    "cut off in a tag": "<p>Hello</p><div " + " ".join(f'a{i}="{i}"' for i in range(10_000)),
    "no tag ever ends": "<a " * 330_000,
    "deep": "<div>x" * 50_000,
    "deep, all different": "".join(f'<div class="c{i}">x' for i in range(30_000)),
    "end tags of nothing": "<div>x" * 30_000 + "</i></p></section>" * 30_000,
    "open inline tags": "<i><p>" + "<b>x" * 60_000 + "</i>" * 60_000,
    "skipped without end": "<p>a" + "<svg>b</svg " * 40_000,
    "quotes without partner": "<a x=\"'>" * 60_000 + "<b y='" + "<u>z" * 30_000,
    "comments": "<!-- " * 150_000,
    "declarations": "<! " * 150_000,
    "attributes": "<div " + "class " * 100_000 + "hidden" + " " * 100_000 + ">x",
}


@pytest.mark.parametrize("name", list(DAMAGED))
def test_time_grows_with_the_length(name):
    field, page = html_crf.trained_field(), DAMAGED[name]
    began = time.process_time()
    html_crf.main_text(page, field)
    # some microseconds a character, against seconds at a few hundred characters before
    assert time.process_time() - began < 0.5 + 2e-5 * len(page)


def test_what_a_cut_off_page_keeps():
    def texts(page):
        return [b.text for b in html_crf.leaf_blocks(page)]

    assert texts("<p>Hello</p><p>more <a href='x") == ["Hello", "more"]
    assert texts('<p title="a > b">Hello</p><p class="x>in a tag') == ["Hello", "in a tag"]
    assert texts("<p>1 < 2 and <3 </ p> <") == ["1 < 2 and <3 </ p> <"]
    assert texts("<p>a<!-- never closed <p>b") == ["a"]


class _Walk(HTMLParser):
    """Text between tags of block level, and the open tags around it, by the library's parser."""

    def __init__(self):
        super().__init__()
        self.open, self.text, self.found, self.raw = [], [], [], 0

    def flush(self):
        text = " ".join("".join(self.text).split())
        if text:
            self.found.append((text, [t for t in self.open if t not in html_crf._INLINE]))
        self.text = []

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text.append(" ")
            return
        if tag not in html_crf._INLINE and tag not in ("img", "input"):
            self.flush()
            # pages leave paragraphs and list items open, as HTML allows
            around = [t for t in self.open if t not in html_crf._INLINE][-1:]
            if around == ["p"] or around == [tag] == ["li"]:
                self.handle_endtag(around[0])
        if tag not in html_crf._VOID:
            self.raw += tag in html_crf._SKIPPED
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag not in html_crf._INLINE:
            self.flush()
        self.raw -= tag in html_crf._SKIPPED
        while tag in self.open and self.open.pop() != tag:
            pass

    def handle_data(self, data):
        if not self.raw:
            self.text.append(data)


def path_of(node):
    tags = []
    while node:
        tags.append(node.tag)
        node = node.parent
    return tags[::-1]


def test_blocks_against_another_parser():
    for page, _ in labelled_pages(60, seed=91):
        walk = _Walk()
        walk.feed(page)
        walk.close()
        walk.flush()
        found = html_crf.leaf_blocks(page)
        assert [b.text for b in found] == [t for t, _ in walk.found]
        assert [path_of(b.node) for b in found] == [p for _, p in walk.found]


def test_scores_are_sums_of_features():
    field = html_crf.trained_field()
    pages = [p for p, _ in labelled_pages(20, seed=4)] + ["<div class=a><div class=a>x</div>y<b>z", "plain", "<td>x<tr>y"]
    for page in pages:
        blocks = html_crf.leaf_blocks(page)
        assert np.allclose(field.scores(blocks), field.unary(html_crf.features_of(blocks)))


def test_ancestors_count_once():
    inner = html_crf.leaf_blocks("<div class=menu><div class=menu><p class=menu>x</p></div></div>")[0].node
    features = html_crf._path_features(inner)
    assert len(features) == len(set(features)) == 3


def test_odd_tables(spark):
    kind = "page_id long, html string, text string, url string"
    page = "<article><h1>A title</h1><p>One sentence here, and another one. It goes on for a while, as they do.</p></article>"
    rows = [(1, page, "t", None), (1, page, "t", None), (None, page, None, "u"), (2, None, None, None), (3, "x" * 300_000, "", "")]
    df = spark.createDataFrame(rows, kind)
    found = df.select("page_id", html_crf.main_text_column(F.col("html")).alias("main")).collect()
    want = {1: html_crf.main_text(page, html_crf.trained_field()), 2: "", 3: html_crf.main_text(rows[4][1], html_crf.trained_field())}
    assert all(r.main == want[r.page_id or 1] for r in found) and len(found) == 5
    assert df.where("false").select(html_crf.main_text_column(F.col("html"))).count() == 0
