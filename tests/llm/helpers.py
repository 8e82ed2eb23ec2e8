"""Small tables with awkward rows, and plain versions of what the operators compute."""

from __future__ import annotations

import random

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, count: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdefghijklmnoprstuvw") for _ in range(draw.randint(3, 8))) for _ in range(count)]


def documents(spark, texts: dict[int | None, str | None] | list[tuple]):
    rows = list(texts.items()) if isinstance(texts, dict) else texts
    return spark.createDataFrame([(doc_id, text, None, None, None) for doc_id, text in rows], DOCUMENTS)


AWKWARD = [
    (1, None),
    (2, ""),
    (3, "\n\n"),
    (4, "A short line here\nshared line of text\nÄÖÜ ß shared umlauts line"),
    (5, "shared LINE of text  \n\tÄÖÜ ß shared umlauts line\r\nown"),
    (5, "shared LINE of text  \n\tÄÖÜ ß shared umlauts line\r\nown"),
    (6, "x" * 50_000 + " " + "word " * 20_000),
    (7, "𝒳 emoji 😀 <|endoftext|> \x85 \x1c ½ end"),
    (None, "shared line of text\nwithout an id"),
    (8, " ".join(words(1, 300))),
    (9, " ".join(words(1, 300)) + " tail"),
    (10, " ".join(words(2, 300))),
]


def roots(count: int, linked) -> list[int]:
    """For each of `count` items the smallest item it is linked to, directly or not."""
    parent = list(range(count))

    def find(at):
        while parent[at] != at:
            at = parent[at]
        return at

    for one in range(count):
        for other in range(one + 1, count):
            if linked(one, other):
                a, b = find(one), find(other)
                parent[max(a, b)] = min(a, b)
    return [find(at) for at in range(count)]
