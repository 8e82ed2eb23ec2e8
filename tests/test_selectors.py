"""The page helper: selector forms and broken markup."""

import re
import time

import pytest

from mentionflow.operators import selectors
from mentionflow.operators.selectors import PageReader, parse_selector

READ = PageReader().items


@pytest.mark.parametrize(
    "selector, html, count",
    [
        ("article.item", '<article class="x item y"><article class=items></article></article>', 1),
        ("a[href*='/read/']", '<a href="/read/1">x</a><a href="/x">y</a><a>z</a>', 1),
        ("h3 a[href*='/b/']", '<h3><b><a href="/b/1">x</a></b></h3><a href="/b/2">y</a>', 1),
        ('article[data-testid="tweet"]', '<ARTICLE DATA-TESTID="tweet"></ARTICLE><article data-testid="tweets">', 1),
        ("time[datetime]", "<time>a</time><time datetime>b</time>", 1),
    ],
)
def test_item_selectors(selector, html, count):
    assert len(READ(html, selector, ["::text"])) == count


def test_near_and_deep_text():
    html = '<div class="t">a <b>b</b> c<i></i></div>'
    assert READ(html, "div", ["div.t::text", ".t ::text", "::text", "b::text"]) == [
        [["a ", " c"], ["a ", "b", " c"], ["a ", "b", " c"], ["b"]]
    ]


def test_item_itself_can_be_the_match():
    assert READ('<a href="/x" title="T">t<img href="/y"></a>', "a", ["::attr(href)", "::attr(title)", "a[href]::text"]) == [
        [["/x", "/y"], ["T"], ["t"]]
    ]


def test_fields_do_not_look_above_the_item():
    assert READ("<h3><a>x</a></h3>", "a", ["h3 a::text"]) == [[[]]]


def test_nested_items_come_in_document_order():
    html = '<div id="1">a<div id="2">b</div>c</div>'
    assert READ(html, "div", ["::attr(id)", "::text"]) == [[["1", "2"], ["a", "b", "c"]], [["2"], ["b"]]]


def test_character_references_and_comments():
    html = "<p title='a&amp;b&#39;'>x &lt;<!-- <p>no</p> -->y&nbsp;</p>"
    assert READ(html, "p", ["::text", "::attr(title)"]) == [[["x <y\xa0"], ["a&b'"]]]


def test_text_only_elements_hide_their_markup():
    html = "<div><script>var a='</p><a>'; &amp;</script><style>a{}</style><title>t &amp; <b></title><a>x</a></div>"
    assert len(READ(html, "a", ["::text"])) == 1
    assert READ(html, "script", ["::text"]) == [[["var a='</p><a>'; &amp;"]]]
    assert READ(html, "title", ["::text"]) == [[["t & <b>"]]]


@pytest.mark.parametrize(
    "html, found",
    [
        ("<a href='x>one</a>", []),
        ("<a href=it's>one</a><b title='z'>", [["one"]]),
        ("<a>one<a>two", [["one"], ["two"]]),
        ("<p>x<a>one</p>y</a>", [["one"]]),
        ("1 < 2 <a>3 < 4</a>", [["3 < 4"]]),
        ("<a", []),
        ("", []),
        ("<!-- <a>x</a>", []),
        ("<!DOCTYPE html><?xml x?><a>one</a></b></a>", [["one"]]),
        ("<a\nhref = \"x\"\n>one</a >", [["one"]]),
    ],
)
def test_broken_markup(html, found):
    assert [[text for text in item[0]] for item in READ(html, "a", ["::text"])] == found


@pytest.mark.parametrize("piece", ["<a ", '<a href="', "<a b='x", "<", "<!--", "</a", "<!", '<a ="', "<script>", "<b>"])
def test_bad_pages_take_linear_time(piece):
    start = time.time()
    READ(piece * 100_000 + "</i>" * 1000, "a", ["::text", "::attr(href)"])
    assert time.time() - start < 10


@pytest.mark.parametrize("selector", ["", "a:hover", "a > b", "a, b", "[x", "a::attr()", "b!", "#id", "*", "a[b^='c']"])
def test_unsupported_selectors_are_errors(selector):
    with pytest.raises(ValueError):
        parse_selector(selector)


def test_given_pages_against_a_pattern(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    for page in pages:
        want = re.findall(r'<a href="([^"]*)">([^<]*)</a>', page["html"])
        got = READ(page["html"], "nav li a", ["::attr(href)", "::text"])
        assert [(item[0][0], item[1][0]) for item in got] == want


def test_repeated_start_tags_are_read_once(monkeypatch):
    """Plain tags come from what is kept by their text, with the values that the standard parser gives for them."""
    parts = ['<div class="ad x">', "</div>", '<a href="/1" HREF="/2">', "</a>", "<li/>", "<br>", '<a href="&amp;1">', "<a b>", "text", "<title>a<a href=x>", "</title>", '<A Class="ad"\n>', "</DIV>", '<a href="un']
    pages = ["".join(parts[(at * step + step) % len(parts)] for at in range(9)) for step in range(1, 200)]
    rules = [(".ad", ["a::attr(href)", "::text", " ::text"]), ("a", ["::attr(href)", "::text"])]

    def read():
        reader = selectors.PageReader()
        found = [reader.items(page, item, fields) for page in pages for item, fields in rules]
        return reader, found

    calls = []
    ends = selectors._Rule.ends
    monkeypatch.setattr(selectors._Rule, "ends", lambda self, tag, attrs: calls.append(tag) or ends(self, tag, attrs))
    reader, kept = read()
    repeated = len(calls)
    never = selectors.re.compile(r"(?!)")
    monkeypatch.setattr(selectors, "_PLAIN_START", never)
    monkeypatch.setattr(selectors, "_PLAIN_END", never)
    _, plain = read()
    assert kept == plain and any(kept)
    assert repeated < (len(calls) - repeated) / 2
    monkeypatch.undo()
    monkeypatch.setattr(selectors, "KEPT_TAGS", 2)
    reader, few = read()
    assert few == kept and all(len(rule.kept) <= 2 for rule in reader._rules.values())
