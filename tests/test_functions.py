"""Column functions against hand-made rows and plain Python."""

import itertools
import re
from datetime import datetime
from urllib.parse import urljoin

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mentionflow.functions import metadata, times, trigrams
from mentionflow.functions import text as tx
from mentionflow.functions.links import host_of, host_suffixes, resolve_link
from mentionflow.session import local_rows


def values(spark, inputs, function, ddl="c string"):
    frame = spark.createDataFrame([(at, value) for at, value in enumerate(inputs)], f"n int, {ddl}")
    return [row[0] for row in frame.select("n", function(F.col("c")).alias("r")).orderBy("n").select("r").collect()]


def test_trim_takes_the_white_space_python_takes(spark):
    inputs = ["\t a  ", " x　", " \x1cq\x85", "", " \n ", "a b", "​z"]
    assert values(spark, inputs, tx.trimmed) == [text.strip() for text in inputs]
    assert set(tx.WHITESPACE) == {chr(code) for code in range(0x110000) if chr(code).isspace()}


def test_keyword_list_keeps_order_and_drops_blanks(spark):
    assert values(spark, [" b, a ,,\t, c d"], tx.keyword_list) == [["b", "a", "c d"]]


def test_title_key_counts_code_points(spark):
    title = "é" * 50 + "😀" * 30
    assert values(spark, [title], tx.title_key) == [title[:60]]


def test_fallback_for_null_and_empty(spark):
    assert values(spark, [None, "", "a"], lambda c: tx.or_else(c, F.lit("f"))) == ["f", "f", "a"]


def test_text_parts_are_joined(spark):
    frame = spark.createDataFrame([([" a", "\n", "b\t", "", "c d "],)], "c array<string>")
    assert frame.select(tx.joined_text(F.col("c"))).first()[0] == "a b c d"


def test_status_id(spark):
    want = {
        "/u/status/": "", "/u/status/12": "12", "/u/status/12/": "12", "/u/status///12": "12", "/u/status/12/photo/1": "12",
        "/u/status/12?s=1": "12", "/u/status/12/?s=1": "12", "/u/status/ab": "", "/u/status/12ab": "", "/u/status/?7": "",
        "/u/status/1/status/2": "", "/u/status//12//": "12", "/u/status/-1": "", "https://x.com/u/status/34": "34",
        "https://x.com/u/status/34/photo/2": "34", "/u/12": "", "": "",
    }
    assert values(spark, list(want), tx.status_id) == list(want.values())


def test_author_and_status_links_take_the_first_that_fits(spark):
    rows = [
        (["/", "https://x.com/a", "/u/status/1", "/u", "/v"],),
        (["/u/status/ab", "/u/status/5?s=1", "/u/status/6"],),
        ([],),
    ]
    frame = spark.createDataFrame(rows, "c array<string>")
    got = frame.select(tx.author_handle(F.col("c")), tx.status_link(F.col("c"))).collect()
    assert [tuple(row) for row in got] == [("u", "/u/status/1"), ("", "/u/status/5?s=1"), ("", None)]


def test_links_are_put_on_the_social_host(spark):
    got = values(spark, ["/u/status/1/photo/1", "https://y.org/1"], tx.on_social_host)
    assert got == ["https://x.com/u/status/1/photo/1", "https://y.org/1"]


def test_metadata_keys_of_any_form_and_exact_numbers(spark):
    raws = ['{"it\'s":1}', '{"a\\"b\'c":2}', '{"id":1800000000000000001}', '{"id":1800000000000000002}', '{"id":0.5}', '{"id":1e30}']
    frame = spark.createDataFrame(list(enumerate(raws)), "n int, raw string")

    def found(pattern):
        return [row["n"] for row in frame.filter(metadata.contains(F.col("raw"), pattern)).orderBy("n").collect()]

    assert found({"it's": 1}) == [0] and found({"a\"b'c": 2}) == [1]
    assert found({"id": 1800000000000000001}) == [2] and found({"id": 1800000000000000002}) == [3]
    assert found({"id": 0.5}) == [4] and found({"id": 1e30}) == [5]
    assert values(spark, raws[:1], lambda c: metadata.value(c, "it's", "int")) == [1]


def test_record_id_keeps_keys_apart(spark):
    frame = spark.createDataFrame([("a:b", "c"), ("a", "b:c")], "s string, p string")
    ids = [row[0] for row in frame.select(tx.record_id(F.col("s"), F.col("p"))).collect()]
    assert len(set(ids)) == 2


# ---- links ----

BASES = ["https://h.org", "http://h.org/", "https://h.org/a/b", "http://h.org/a/b/?q=1#f", "https://h.org/a//b/c.html"]
LINKS = [
    "/a", "//h2.org/a", "//h2.org", "a", "../a", "../../../a", "./a", ".", "..", "?q", "#f", "?q=1#f", "https://o.org/x",
    "HTTP://O.org", "", "/a/../b", "/a/./b/", "a//b", "/a//b", "mailto:x@y", "javascript:void(0)", "a/b/../../c/",
    "/..//a", "x?y=../z", "#", "?", "a:b", "1:b", "  /lead", "/é/ü?ö#ä", "x/..", "/x/.", "/.hidden", "a..b", "//", "///a",
]


def test_links_resolve_like_the_standard_library(spark):
    pairs = list(itertools.product(BASES, LINKS))
    frame = spark.createDataFrame([(n, *pair) for n, pair in enumerate(pairs)], "n int, b string, l string")
    got = [row[0] for row in frame.orderBy("n").select(resolve_link(F.col("b"), F.col("l"))).collect()]
    want = [urljoin(base, link) if link else "" for base, link in pairs]
    wrong = [(pair, left, right) for pair, left, right in zip(pairs, got, want) if left != right]
    assert not wrong


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="ab./?#:-é", max_size=12), min_size=200, max_size=200))
def test_any_link_resolves_like_the_standard_library(spark, links):
    base = "https://h.org/a/b/c?d=1"
    frame = spark.createDataFrame([(n, link) for n, link in enumerate(links)], "n int, l string")
    got = [row[0] for row in frame.orderBy("n").select(resolve_link(F.lit(base), F.col("l"))).collect()]
    want = [urljoin(base, link) if link else "" for link in links]
    assert got == want


def test_hosts(spark):
    urls = ["https://News.Example.com:80/x", "http://u:p@h.org/", "no url", "https://h.org?x"]
    assert values(spark, urls, host_of) == ["news.example.com", "h.org", "", "h.org"]
    assert values(spark, ["a.b.c"], host_suffixes) == [["a.b.c", "b.c", "c"]]


# ---- times ----


def test_time_forms(spark):
    inputs = [
        "", None, "2026-04-16T01:02:03.000Z", "2026-04-16T03:02:03+02:00", "2026-04-16 01:02:03+00:00",
        "Thu Apr 16 01:02:03 +0000 2026", " 2026-04-16T01:02:03Z ", "junk", "12:30", "2024", "Thu Apr 99", "2026-99-01",
    ]
    moment = datetime(2026, 4, 16, 1, 2, 3)
    want = [None, None, moment, moment, moment, moment, moment] + [None] * 5
    assert values(spark, inputs, lambda c: times.utc_wall_time(times.parsed_time(c))) == want


def test_utc_day_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
        got = values(spark, ["2026-04-15T23:30:00Z"], lambda c: times.utc_day(times.parsed_time(c)))
        text = values(spark, ["2026-04-15T23:30:00Z"], lambda c: times.iso_text(times.parsed_time(c)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["20260415"]
    assert text == ["2026-04-15T23:30:00.000000+00:00"]


# ---- trigrams ----


def python_trigrams(text):
    words = [f"  {word} " for word in re.split(r"[\W_]+", text.lower()) if word]
    return {word[at : at + 3] for word in words for at in range(len(word) - 2)}


def test_trigram_similarity_of_the_documented_pair(spark):
    frame = spark.createDataFrame([("word",)], "t string")
    found = trigrams.search_similar(frame, "t", "two words", 0.3).first()
    assert round(found["similarity"], 6) == 0.363636


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab cdé-_1 ", max_size=30), min_size=100, max_size=100))
def test_similarity_search_finds_what_brute_force_finds(spark, texts):
    phrase, wanted = "abc de1", python_trigrams("abc de1")
    frame = spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "n int, t string")
    got = {row["n"]: round(row["similarity"], 9) for row in trigrams.search_similar(frame, "t", phrase, 0.2).collect()}
    want = {}
    for n, text in enumerate(texts):
        have = python_trigrams(text)
        score = len(have & wanted) / len(have | wanted)
        if score >= 0.2:
            want[n] = round(score, 9)
    assert got == want


def test_containing_search_takes_the_phrase_literally(spark):
    frame = spark.createDataFrame([("50% OFF",), ("500 off",), ("a_b",), ("axb",), ("c\\d",)], "t string")

    def found(phrase):
        return [row[0] for row in trigrams.search_containing(frame, "t", phrase).collect()]

    assert found("50% off") == ["50% OFF"]
    assert found("a_b") == ["a_b"]
    assert found("C\\d") == ["c\\d"]


# ---- metadata ----


@pytest.mark.parametrize(
    "pattern, hits",
    [
        ({"k": 69}, {0, 4}),
        ({"k": "69"}, {1}),
        ({"k": True}, {2}),
        ({"o": {"a": 1}}, {3}),
        ({"o": {"a": 1, "b": 3}}, set()),
        ({"l": [2]}, {3}),
        ({"l": [2, 9]}, set()),
        ({"n": None}, {5}),
        ({}, {0, 1, 2, 3, 4, 5, 6}),
        ({"s": 'q"é'}, {6}),
    ],
)
def test_metadata_containment(spark, pattern, hits):
    raws = [
        '{"k": 69}', '{"k": "69"}', '{"k": true}', '{"o": {"a": 1, "b": 2}, "l": [1, 2, 3]}', '{"x": 1, "k": 69.0}',
        '{"n": null}', '{"s": "q\\"é"}', "not json", None, "[1]",
    ]
    frame = spark.createDataFrame([(n, raw) for n, raw in enumerate(raws)], "n int, raw string")
    got = {row["n"] for row in frame.filter(metadata.contains(F.col("raw"), pattern)).collect()}
    assert got == hits


def test_metadata_keys_and_values(spark):
    raws = ['{"k": 5, "n": null}', "{}", "oops", None]
    assert values(spark, raws, lambda c: metadata.has_key(c, "n")) == [True, False, False, False]
    assert values(spark, raws, lambda c: metadata.value(c, "k", "int")) == [5, None, None, None]


def test_local_rows(spark):
    rows = local_rows(spark, [{"a": "x'\"é", "b": 1}, {"a": None, "b": 2}], "a string,b int").collect()
    assert [tuple(row) for row in rows] == [("x'\"é", 1), (None, 2)]
