"""Tags, attributes and lists as a parser reads them, and pages of any length."""

import time
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagesmith.functions import html as H
from pagesmith.operators.cards import project_cards


class Links(HTMLParser):
    """Text up to the next link tag, and target, of every link with a target."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.open = [], False

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            first = next((v for k, v in attrs if k == "href"), None)
            self.open = bool(first)
            if self.open:
                self.found.append(["", first])

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        self.open = self.open and tag != "a"

    def handle_data(self, data):
        if self.open:
            self.found[-1][0] += data


def read(spark, pages, expression):
    """The expression's value of every page."""
    rows = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    return [r.v for r in rows.select("page_id", expression.alias("v")).orderBy("page_id").collect()]


_TEXT = st.text("ab é😀.,;", max_size=6)
_VALUE = st.one_of(
    st.text("x/é> '=", min_size=1, max_size=6).map(lambda v: f'"{v}"'),
    st.text('x/é> "=', min_size=1, max_size=6).map(lambda v: f"'{v}'"),
    st.text("xyz/é-.", min_size=1, max_size=6).filter(lambda v: not v.endswith("/")),
)
_NAME = st.sampled_from(["href", "HREF", "title", "class", "data-href", "id"])
_ATTRS = st.lists(st.one_of(st.builds(lambda n, e, v: f" {n}{e}{v}", _NAME, st.sampled_from(["=", " = "]), _VALUE), st.just(" hidden")), max_size=4)
_TAG = st.builds(lambda n, a: f"<{n}{''.join(a)}>", st.sampled_from(["a", "A", "b", "div", "abbr", "p"]), _ATTRS)
_PAGE = st.lists(st.one_of(_TEXT, _TAG, st.sampled_from(["</a>", "</A >", "</b>", "</div>", "<br/>"])), max_size=12).map("".join)


@settings(max_examples=8, deadline=None)
@given(pages=st.lists(_PAGE, min_size=60, max_size=60))
def test_links_like_a_parser(spark, pages):
    want = []
    for page in pages:
        parser = Links()
        parser.feed(page)
        parser.close()
        want.append([(name.strip(), url.strip()) for name, url in parser.found if url.strip()])
    got = [[(link.name, link.url) for link in row] for row in read(spark, pages, H.links(F.col("html")))]
    assert got == want


def test_attributes(spark):
    card = '<div class=card data-a="1>2" title=\'say "hi"\' href=/x?y=1 lone id = "q"><a href=\'/z\'>t</a></div>'
    page = f'<p title="x>y class=card">no</p>{card}'
    assert read(spark, [page], H.find_element(F.col("html"), "div", "card")) == [card.removesuffix("</div>")]
    values = {"data-a": "1>2", "title": 'say "hi"', "href": "/x?y=1", "id": "q", "class": "card", "lone": None, "y": None}
    for name, value in values.items():
        assert read(spark, [card], H.attribute(F.col("html"), name)) == [value]
    assert read(spark, [card], H.text_content(F.col("html"))) == ["t"]
    assert read(spark, ["<b>1 < 2</b> <c d='>'>x"], H.text_content(F.col("html"))) == ["1 < 2 x"]


@pytest.mark.parametrize("page, want", [
    ("<a href='/x'>x</a> <a href=/y>y</a>", "[x](/x) [y](/y)"),
    ("<a title='a>b' href=\"/z\">z</a>", "[z](/z)"),
    ("<p title='a>b'>one</p><p>two</p>", "one\n\ntwo"),
    ("<img alt='c>d' src=i.png><img src='j.png'>", "![c>d](i.png)![](j.png)"),
    ("<ul><li>a<ul><li>b</li><li>c<ol><li>d</li><li>e</li></ol></li></ul></li><li>f</li></ul>",
     "* a\n    * b\n    * c\n      1. d\n      2. e\n  * f"),
    ("<ol><li>a<ol><li>b</li></ol></li><li>c</li></ol><ul><li>d</li></ul>", "1. a\n    1. b\n  2. c\n\n  * d"),
    ("<li>x</li></ul><ol><li>y", "* x\n\n  1. y"),
])
def test_markdown(spark, page, want):
    assert read(spark, [page], H.to_markdown(F.col("html"))) == [want]


def test_long_and_unclosed_pages(spark):
    """Link texts that change between planes, unclosed tags and many attributes: no crash, and in good time."""
    mixed = "a😀" * 100_000
    pages = [f"<a href='/x'>{mixed}</a>", f"<a {'q=1 ' * 50_000} href=/y>t</a>", "<a href='/z'>" + "<b>" * 100_000]
    got = read(spark, pages, H.links(F.col("html")))
    assert [[(len(link.name), link.url) for link in row] for row in got] == [[(200_000, "/x")], [(1, "/y")], [(0, "/z")]]
    card = f'<div class="ProjectCover-root-X6u"><a href="/p">{mixed}<b class="Title-title-lpJ">t</b></a></div>'
    cards = project_cards(spark.createDataFrame([(1, "u", card)], "page_id int, url string, html string")).collect()
    assert [(c.title, c.url) for c in cards] == [("t", "/p")]
    unclosed = "<header>" + "x" * 100
    began = time.time()
    assert read(spark, [unclosed * 2000], H.clean_html(F.col("html"))) == [unclosed * 2000]
    assert time.time() - began < 3
    nested = "<header>" * 50 + "x" + "</header>" * 50 + "<p>y</p>" + "<header>z"
    assert read(spark, [nested], H.clean_html(F.col("html"))) == ["<p>y</p><header>z"]
