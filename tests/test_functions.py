"""Golden cases of the expressions."""

import html as stdlib_html

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagesmith.functions import html as H
from pagesmith.functions import replies as R
from pagesmith.functions import text as X
from pagesmith.functions import urls as U

L = F.lit


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_text(spark):
    assert value(spark, X.strip_urls(L("see [x](https://a.b/c?d=1#top), and http://q~r end"))) == "see [x](#top), and ~r end"
    assert value(spark, X.clean_price(L(" ₹1,299.00 "))) == "1299.00"
    assert value(spark, X.default_fill(X.clean_price(L(None).cast("string")))) == "N/A"
    assert tuple(value(spark, X.stats_extract(L("a1 2K 3.5M")))) == ("1", "2K")
    assert value(spark, X.stats_numbers(L("a1 2K 3.5M"))) == ["1", "2K", "3", "5M"]
    assert tuple(value(spark, X.stats_extract(L("")))) == ("0", "0")
    assert value(spark, X.preview(L("hello"))) == "hello..."
    assert value(spark, X.column_label(L("it's_x-y 4foo"))) == "it's x-y 4foo".title()
    assert value(spark, X.keyword_match(L("100% Off"), "0% o")) is True
    assert value(spark, X.threshold_label(L(50))) == "PASS"


def test_whitespace_is_pythons(spark):
    spaces = "".join(chr(i) for i in range(0x3100) if chr(i).isspace())
    assert set(X.WHITESPACE) == set(spaces)
    assert value(spark, X.strip_ws(L(spaces + "a b" + spaces))) == "a b"


@pytest.mark.parametrize(
    "url, reason",
    [("", "empty"), ("foo bar", "bad_format"), ("http://a", "bad_format"), ("ftp://a.example.com/x", "bad_scheme"),
     ("HTTP://a.com", "bad_scheme"), ("https://shop.example.com:80/a?b=1#c", ""), ("http://10.0.0.1/x", "")],
)
def test_validate_url(spark, url, reason):
    assert tuple(value(spark, U.validate_url(L(url)))) == (reason == "", reason)


def test_urls(spark):
    from urllib.parse import quote, urljoin

    for text in ("50% off/é~* x", "a+b&c=d", "plain"):
        assert value(spark, U.url_quote(L(text))) == quote(text)
    for base in ("https://a.b/c/d?e#f", "https://a.b", "http://a.b/"):
        for href in ("x", "/x?y", "//h/x", "#z", "?q=1", "https://o/p", "mailto:a@b"):
            assert value(spark, U.absolute_url(L(base), L(href))) == urljoin(base, href)
    assert value(spark, U.url_page_number(L("http://h/store/x?page=3&keyword=y"))) == "3"
    assert value(spark, U.url_page_number(L("http://h/store/x"))) == "http://h/store/x"


def test_nested_elements(spark):
    page = "<a>1<header x=1>a<header>b</header>c</header>2<HEADER>z</HEADER>3</a><footer>q</footer>"
    assert value(spark, H.clean_html(L(page))) == "<a>123</a>"
    card = '<div class="a card"><div>x<div>y</div></div><p>in</p></div><p>out</p><div class="card b">last'
    assert value(spark, H.find_elements(L(card), "div", "card")) == [
        '<div class="a card"><div>x<div>y</div></div><p>in</p>', '<div class="card b">last'
    ]
    assert value(spark, H.find_element(L(card), None, "car")) is None
    assert value(spark, H.attribute(L("<img a=1 data-src='/x?a=1&amp;b=2'>"), "data-src")) == "/x?a=1&b=2"


def test_large_page(spark):
    page = ("<header>" + "x" * 1_000_000 + "<b></b></header>y") * 2
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(H.to_markdown(F.col("html"))).first()[0] == "yy"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["&amp;", "lt;", "&lt;", "#39;", "&#39;", "&#x1F600;", "&", ";", "é", "&copy;", "&nope;"]), max_size=8))
def test_entities_like_a_parser(spark, parts):
    text = "".join(parts)
    expected = stdlib_html.unescape(text.replace("&nope;", "\0")).replace("\0", "&nope;")
    assert value(spark, H.decode_entities(L(text))) == expected


def test_markdown(spark):
    page = (
        "<html><head><title>t</title></head><body><header>h</header><h2>T &amp; x</h2><p>a <b>b</b> <em>c</em><br>d</p>"
        '<ul><li><a class="k" href="/x">X</a></li><li>2</li></ul><img alt="i" src="/i.png">'
        "<ol><li>a</li><li>b</li></ol><table><tr><td>1</td><td>2</td></tr></table><script>var a='<p>';</script><footer>f</footer></body></html>"
    )
    expected = "## T & x\n\na **b** _c_  \nd\n\n  * [X](/x)\n  * 2\n\n![i](/i.png)\n\n  1. a\n  2. b\n\n1 | 2"
    assert value(spark, H.to_markdown(L(page))) == expected


def test_replies(spark):
    fields = ["a", "b c"]
    cases = {
        '{"listings":[{"a":"1"},{"a":2,"z":1}]}': ("ok", 2),
        '{"listings":[{"Price":"1"': ("invalid", 0),
        "not json": ("invalid", 0),
        "[1]": ("no_object", 0),
        "3": ("no_object", 0),
        '{"x":1}': ("ok", 0),
    }
    for reply, (status, n) in cases.items():
        got = value(spark, R.parse_reply(L(reply), fields))
        assert (got["status"], len(got["listings"])) == (status, n), reply
    cut = '{"listings":[{"a":"1"},{"a":"2"},{"a":'
    assert value(spark, R.repair_reply(L(cut))) == '{"listings":[{"a":"1"},{"a":"2"}]}'
    assert value(spark, R.repair_reply(L(cut), True)) == '{"listings":[{"a":"1"}]}'
    assert value(spark, R.repair_reply(L('{"listings":[{"a"'))) == '{"listings":[{"a"'
    kept = value(spark, R.fill_map(F.create_map(L("z"), L("1")), fields))
    assert kept == {"a": "", "b c": "", "z": "1"}
    assert R.listing_schema(["Product Name", "tags"], arrays=["tags"]).simpleString().endswith("tags:array<string>>")
    with pytest.raises(ValueError):
        R.listing_schema([])


def test_hosts_of_urls(spark):
    from pagesmith.functions.urls import validate_url

    cases = {"http://255.1.0.9/": True, "http://999.999.999.999/": False, "http://256.1.1.1": False, "https://[::1]:80/x": True,
             "http://a.xn--p1ai/": True, "http://a.b-/": False}
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r.u: r.ok for r in df.select("u", validate_url(F.col("u")).ok.alias("ok")).collect()} == cases


def test_named_references(spark):
    from pagesmith.functions.html import decode_entities

    df = spark.createDataFrame([("&eacute;&frac12;&szlig;&apos;&nope; &amp;lt; &Eacute; & &#233;",)], "t string")
    assert df.select(decode_entities(F.col("t")).alias("t")).first().t == "é½ß'&nope; &lt; É & é"
