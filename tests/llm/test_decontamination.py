"""Benchmark decontamination against plain search of every window."""

import random
import re

import pytest
from helpers import AWKWARD, LOWER, documents
from pyspark.sql import functions as F

from mentionflow.llm import decontamination


def split(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def plain(text, items, window):
    words, hit, named = split(text), set(), set()
    for item, content in items:
        own = split(content)
        size = min(window, len(own))
        windows = {tuple(own[at : at + size]) for at in range(len(own) - size + 1)} if own else set()
        for at in range(len(words) - size + 1):
            if tuple(words[at : at + size]) in windows:
                hit |= set(range(at, at + size))
                named |= {str(item)} if item is not None else set()
    return len(words), len(hit), sorted(named)


def random_case(seed):
    draw = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdef"
    text = lambda most: " ".join(draw.choice(letters) for _ in range(draw.randint(0, most)))
    items = [(at, text(draw.choice([3, 12, 30]))) for at in range(12)]
    docs = [text(60) for _ in range(30)]
    docs += [docs[0] + ", " + items[0][1] + "; " + items[1][1].upper(), items[2][1], items[3][1] + " zz " + items[4][1]]
    return items, docs


@pytest.mark.parametrize("seed", range(6))
def test_automaton_finds_all_windows(seed):
    items, docs = random_case(seed)
    for window in (2, 4, 10):
        automaton = decontamination.Automaton(window)
        sequences = [(str(item), decontamination.words_of(text.encode())) for item, text in items]
        for _, words in sequences:
            automaton.add(words)
        for item, words in sequences:
            automaton.name(words, item)
        matcher = decontamination.Matcher(automaton.packed())
        for text in docs:
            named = set()
            words = decontamination.words_of(text.encode())
            spans = matcher.match(words, [], named)
            assert (len(words), sum(stop - start for start, stop in spans), sorted(named)) == plain(text, items, window)


@pytest.mark.parametrize("shard_words", [decontamination.SHARD_WORDS, 40])
def test_documents(spark, shard_words):
    passage = " ".join(f"w{at}" for at in range(70))
    items = [
        (1, passage), (2, "Shared line of, TEXT"), (3, None), (4, ""), (5, "ÄÖÜ"), (6, passage.upper()), (6, passage), (None, "word word"), (7, "..."),
        (8, " ".join(f"w{at}" for at in range(30, 41))), (10, "a short"),
    ]
    rows = [
        *AWKWARD, (20, "x " + passage + " y"), (21, " ".join(f"w{at}" for at in range(25, 36))), (22, "w1 w2 w3 w4 w5 w6 w7 w8 w9"), (23, passage + " " + passage),
        (24, "lead. " + ", ".join(f"W{at}" for at in range(10)) + " tail " * 30 + " É"),
    ]
    docs = documents(spark, rows).withColumn("row", F.lit(1)).withColumn("items", F.lit("mine")).withColumn("n_words", F.lit(0))
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("size", F.lit("x"))
    found = decontamination.find_contamination(docs, benchmark, shard_words=shard_words)
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "row", "n_words", "n_hit", "spans", "items"]
    key = lambda row: str(row)
    got = sorted([(row.doc_id, row.row, row.n_words, row.n_hit, row["items"]) for row in found.collect()], key=key)
    assert got == sorted([(doc_id, 1, *plain(text, items, 10)) for doc_id, text in rows], key=key)
    cleaned = {row.doc_id: row for row in decontamination.decontaminate(docs, benchmark, shard_words=shard_words).collect()}
    assert 20 not in cleaned and 23 not in cleaned and cleaned[24].text == "lead. " + " tail " * 30 + " É" and cleaned[24].n_removed == 10
    assert cleaned[22].text == "w1 w2 w3 w4 w5 w6 w7 w8 w9" and cleaned[22].n_removed == 0 and cleaned[22]["items"] == "mine"
    assert 4 not in cleaned
    whole = decontamination.decontaminate(docs.filter("doc_id = 4"), benchmark, max_coverage=1.1, min_span=3, shard_words=shard_words).first()
    assert whole.text == "A short line here\n ß shared umlauts line" and whole.n_removed == 5
    assert 1 in cleaned and cleaned[1].text is None


def test_empty_tables(spark):
    docs, benchmark = documents(spark, AWKWARD), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontamination.find_contamination(docs.limit(0), benchmark).count() == 0
    none = decontamination.find_contamination(docs, benchmark.limit(0)).collect()
    assert len(none) == len(AWKWARD) and not any(row.n_hit or row["items"] for row in none)
    only = decontamination.decontaminate(docs.select("text"), benchmark)
    assert only.columns == ["text", "n_removed"] and only.count() == len(AWKWARD)
