"""Keyword matching: case-insensitive substring tests, no join and no shuffle.

A short list is spelled out, one compiled `contains` per keyword. A long list becomes an Aho-Corasick automaton, built
once per task, that finds all keywords in one pass over a text: the cost follows the text and its hits, not the length
of the list. Only the lower-cased text goes to Python, in Arrow batches, and only list positions come back; both ways
give the same rows. The search is declared nondeterministic, which it is not: Spark would otherwise copy it into a filter
below the unfolding, and every task would run it twice, in two Python workers with an automaton each.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Up to this many keywords the tests are spelled out; the automaton is the faster way beyond.
INLINE_KEYWORDS = 32


def clean_keywords(keywords: Sequence[str]) -> list[str]:
    """Trimmed keywords in their order without blank ones. An empty list is an error."""
    cleaned = [word.strip() for word in keywords if word.strip()]
    if not cleaned:
        raise ValueError("at least one keyword is needed")
    return cleaned


def _hit(order: int, keyword: str) -> Column:
    return F.struct(F.lit(order).alias("keyword_ord"), F.lit(keyword).alias("keyword"))


def _forms(keyword: str, tagged: bool) -> list[str]:
    """What a keyword is looked for as: itself, and as a hashtag where posts are tagged."""
    word = keyword.lower()
    return [word, "#" + "".join(word.split())] if tagged and len(word.split()) > 1 else [word]


def _tests(folded: Column, keywords: Sequence[str], tagged: bool) -> list[Column]:
    tests = []
    for at, word in enumerate(keywords):
        found = [F.contains(folded, F.lit(form)) for form in _forms(word, tagged)]
        tests.append(F.when(reduce(Column.__or__, found), _hit(at, word)))
    return tests


def automaton_search(forms: Sequence[Sequence[str]], first: bool = False) -> Callable[[Column], Column]:
    """A function of a text column to the sorted list positions that have a form in the text, or just the first one."""

    @F.arrow_udf("array<int>")
    def search(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ahocorasick

        at_form = defaultdict(list)
        for at, own in enumerate(forms):
            for form in own:
                at_form[form].append(at)
        automaton = ahocorasick.Automaton()
        for form, places in at_form.items():
            automaton.add_word(form, (places[0], tuple(places)))
        automaton.make_automaton()
        for batch in texts:
            found, offsets = [], [0]
            for text in batch:
                hits = {places for _, places in automaton.iter(text.as_py())} if text.is_valid else ()
                if first:
                    found += [min(hits)[0]] if hits else []
                else:
                    found += sorted({at for _, places in hits for at in places})
                offsets.append(len(found))
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found, pa.int32()))

    return search.asNondeterministic()


def _searched(posts: DataFrame, keywords: Sequence[str], tagged: bool, first: bool) -> DataFrame:
    """Rows with `_folded` get `_found`, their hits among a long list."""
    search = automaton_search([_forms(word, tagged) for word in keywords], first)
    listed = F.from_json(F.lit(json.dumps(list(keywords), ensure_ascii=False)), "array<string>")
    named = F.transform("_places", lambda at: F.struct(at.alias("keyword_ord"), F.get(listed, at).alias("keyword")))
    return posts.withColumn("_places", search(F.col("_folded"))).withColumn("_found", named)


def _with_hits(posts: DataFrame, text: str, keywords: Sequence[str], tagged: bool = False, first: bool = False) -> DataFrame:
    """Rows with `_found`: the list positions and keywords in a text, or just the first one.

    The lower-cased text is a column of its own, so it is computed once per row and not once per keyword.
    """
    folded = posts.withColumn("_folded", F.lower(F.col(text)))
    if len(keywords) > INLINE_KEYWORDS:
        return _searched(folded, keywords, tagged, first)
    tests = _tests(F.col("_folded"), keywords, tagged)
    return folded.withColumn("_found", F.array_compact(F.array(F.coalesce(*tests)) if first else F.array(*tests)))


def match_first(posts: DataFrame, text: str, keywords: Sequence[str], tagged: bool = False) -> DataFrame:
    """Keep rows that have a keyword; add the first one in list order as `keyword_ord`, `keyword`.

    With `tagged` a keyword of several words is also found as a hashtag. Unfolding an array of no or one hit drops the
    other rows without a filter that would evaluate the tests a second time.
    """
    words = clean_keywords(keywords)
    kept = [name for name in posts.columns if name not in ("keyword", "keyword_ord")]
    return _with_hits(posts, text, words, tagged, first=True).select(*kept, F.inline("_found"))


def with_first_keyword(posts: DataFrame, text: str, keywords: Sequence[str]) -> DataFrame:
    """Like `match_first`, but rows without a keyword stay, with nulls."""
    words = clean_keywords(keywords)
    kept = [name for name in posts.columns if name not in ("keyword", "keyword_ord")]
    return _with_hits(posts, text, words, first=True).select(*kept, F.inline_outer("_found"))


def match_all(posts: DataFrame, text: str, keywords: Sequence[str]) -> DataFrame:
    """One row per row and keyword it has, as if every keyword were searched on its own.

    The pairs come from exploding a row's own hits, so only pairs that match ever exist.
    """
    words = clean_keywords(keywords)
    kept = [name for name in posts.columns if name not in ("keyword", "keyword_ord")]
    return _with_hits(posts, text, words).select(*kept, F.inline("_found"))
