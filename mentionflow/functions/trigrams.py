"""Trigram similarity between texts and one search phrase.

Text is lower-cased and cut into words of letters and digits; each word gets two spaces before and one after, and
the distinct three-character pieces are the text's trigrams. Similarity is shared trigrams over all trigrams.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionflow.operators.filters import keep_where

_NOT_WORD = r"[^\p{L}\p{N}]+"


def _phrase_trigrams(phrase: str) -> list[str]:
    words = [word for word in re.split(r"[\W_]+", phrase.lower()) if word]
    padded = [f"  {word} " for word in words]
    return sorted({text[at : at + 3] for text in padded for at in range(len(text) - 2)})


def trigrams(text: Column) -> Column:
    """The distinct trigrams of a text, whole."""
    words = F.array_distinct(F.filter(F.split(F.lower(text), _NOT_WORD), lambda word: word != ""))
    pieces = F.transform(
        words,
        lambda word: F.transform(
            F.sequence(F.lit(1), F.length(word) + 1),
            lambda at: F.substr(F.concat(F.lit("  "), word, F.lit(" ")), at, F.lit(3)),
        ),
    )
    return F.array_distinct(F.flatten(pieces))


def padded_words(text: Column) -> Column:
    """The text's words with the blanks around them that trigrams are cut from.

    Between two padded words stand three spaces, so no piece across words looks like a trigram of a word.
    """
    return F.concat(F.lit("  "), F.regexp_replace(F.lower(text), _NOT_WORD, "   "), F.lit(" "))


def search_similar(df: DataFrame, column: str, phrase: str, threshold: float) -> DataFrame:
    """Rows whose text is at least `threshold` similar to the phrase, with `similarity`.

    The union of both trigram sets is never smaller than the phrase's own set, so shared / phrase size bounds the
    similarity from above. The shared ones are found by substring tests on the padded text, and the bound drops nearly
    all rows before any text's own trigram set is built. Texts are taken whole.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    wanted = _phrase_trigrams(phrase)
    if not wanted:
        return df.withColumn("similarity", F.lit(0.0)).filter(F.lit(False))
    tests = [F.contains(F.col("_padded"), F.lit(piece)).cast("int") for piece in wanted]
    shared = F.col("_shared")
    similarity = shared / (F.size(trigrams(F.col(column))) + F.lit(len(wanted)) - shared)
    counted = df.withColumn("_padded", padded_words(F.col(column))).withColumn("_shared", sum(tests[1:], tests[0]))
    likely = keep_where(counted, shared >= F.lit(threshold * len(wanted) - 1e-9))
    graded = keep_where(likely.withColumn("similarity", similarity), F.col("similarity") >= F.lit(threshold))
    return graded.drop("_padded", "_shared")


def search_containing(df: DataFrame, column: str, phrase: str) -> DataFrame:
    """Rows whose text has the phrase as it stands, in any letter case."""
    escaped = re.sub(r"([\\%_])", r"\\\1", phrase)
    return df.filter(F.col(column).ilike(f"%{escaped}%"))
