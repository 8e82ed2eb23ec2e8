"""Byte-level BPE: encoding by a segment tree over adjacent pair ranks, and decoding.

A text is cut into words by the vocabulary's pattern. The bytes of a word are the leaves of a segment tree whose entries
are `rank << 32 | position` of the pair that starts there; the root is therefore the leftmost lowest-rank merge. A merge
changes at most three leaves, each in logarithmic time, and the loop ends when the root names no pair. Words repeat, so
each worker remembers the ids of a bounded number of them.

Results: null text counts as empty; an empty text has no ids; the text of an added token (`<|endoftext|>`) becomes its
id, as the library does without further options. Very long words cost n log n. Rows are independent: repeated rows give
repeated results, extra columns are carried by `encode_column` alone.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

#: Words that one worker remembers; beyond that it forgets all and starts anew.
WORDS_KEPT = 600_000
#: Code points up to here belong to the same classes in every Unicode version in use.
_SETTLED = 0x557
_NO_PAIR = 1 << 62


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, by the published rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(byte): byte for byte in plain} | {chr(256 + at): byte for at, byte in enumerate(others)}


def _class(*majors: str) -> str:
    """The code points of some general categories, as the inside of a character class."""
    return "".join(re.escape(chr(c)) for c in range(_SETTLED + 1) if unicodedata.category(chr(c))[0] in majors)


def _word_pattern() -> re.Pattern:
    """The vocabulary's pattern for texts of settled code points, with classes spelled out for the standard `re`."""
    letter, digit, space = _class("L"), _class("N"), r"\t-\r \x85\xa0"
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


def merge_symbols(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply merges, lowest rank first and leftmost among equals, until no pair is left to merge.

    `merges` maps a pair of ids to its rank and the id of the joined symbol.
    """
    count = len(symbols)
    if count < 2:
        return symbols
    leaves = 1 << (count - 1).bit_length()
    tree = [_NO_PAIR] * (2 * leaves)
    ids = list(symbols)
    after = list(range(1, count + 1))
    before = list(range(-1, count - 1))
    for at in range(count - 1):
        found = merges.get((ids[at], ids[at + 1]))
        if found is not None:
            tree[leaves + at] = found[0] << 32 | at
    for node in range(leaves - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    while (root := tree[1]) != _NO_PAIR:
        at = root & 0xFFFFFFFF
        joined = after[at]
        following = after[joined]
        ids[at] = merges[ids[at], ids[joined]][1]
        ids[joined] = -1
        after[at] = following
        if following < count:
            before[following] = at
        previous = before[at]
        for start, end in ((joined, count), (at, following), (previous, at)):
            if start < 0:
                continue
            found = merges.get((ids[start], ids[end])) if end < count else None
            entry = _NO_PAIR if found is None else found[0] << 32 | start
            node = leaves + start
            if tree[node] == entry:
                continue
            tree[node] = entry
            node >>= 1
            while node:
                left, right = tree[2 * node], tree[2 * node + 1]
                smaller = left if left < right else right
                if tree[node] == smaller:
                    break
                tree[node] = smaller
                node >>= 1
    return [symbol for symbol in ids if symbol >= 0]


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = byte_letters()
        vocabulary = content["model"]["vocab"]
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in content["model"]["merges"]]
        self.merges = {
            (vocabulary[left], vocabulary[right]): (rank, vocabulary[left + right])
            for rank, (left, right) in enumerate(pairs)
        }
        self.byte_ids = [0] * 256
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocabulary[letter]
        added = {token["content"]: token["id"] for token in content.get("added_tokens", [])}
        self.pieces = {at: bytes(letters[c] for c in token) for token, at in vocabulary.items() if token not in added}
        self.pieces |= {at: token.encode() for token, at in added.items()}
        self.added = {token: str(at) for token, at in added.items()}
        self._added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self._words = _word_pattern()
        self._unsettled = re.compile(f"[{chr(_SETTLED + 1)}-\U0010ffff]")
        self._path = path
        self._library = None
        self._known: dict[str, str] = {}

    def words(self, text: str) -> list[str]:
        """Cut a text into words. Code points whose class differs between Unicode versions are left to the library."""
        if text.isascii() or not self._unsettled.search(text):
            return self._words.findall(text)
        return [text[start:end] for _, (start, end) in self.library().pre_tokenizer.pre_tokenize_str(text)]

    def library(self):
        """The vocabulary file in the tokenizers library, read once."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path)
        return self._library

    def word_ids(self, word: str) -> list[int]:
        byte_ids = self.byte_ids
        return merge_symbols([byte_ids[byte] for byte in word.encode()], self.merges)

    def _ids_text(self, text: str) -> list[str]:
        known = self._known
        parts = []
        for word in self.words(text):
            ids = known.get(word)
            if ids is None:
                if len(known) >= WORDS_KEPT:
                    known.clear()
                ids = ",".join(map(str, self.word_ids(word)))
                if len(word) < 64:
                    known[word] = ids
            parts.append(ids)
        return parts

    def encode_text(self, text: str | None) -> str:
        """The ids in decimal, joined by commas."""
        if not text:
            return ""
        if self._added is None or not self._added.search(text):
            return ",".join(self._ids_text(text))
        parts = []
        for at, part in enumerate(self._added.split(text)):
            parts += [self.added[part]] if at % 2 else self._ids_text(part)
        return ",".join(parts)

    def encode(self, text: str | None) -> list[int]:
        joined = self.encode_text(text)
        return list(map(int, joined.split(","))) if joined else []

    def decode(self, ids) -> str:
        """Bytes of the ids as text; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        pieces = self.pieces
        return b"".join([pieces.get(at, b"") for at in ids]).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, read once per worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_column(text: Column, vocabulary: str | None = None) -> Column:
    """Ids of a text column, `array<int>`."""
    path = vocabulary or default_vocabulary()

    @F.pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        own = codec(path)
        return pd.Series([own.encode(value) for value in texts])

    return encode(text)


def decode_column(ids: Column, vocabulary: str | None = None) -> Column:
    """Text of a column of ids."""
    path = vocabulary or default_vocabulary()

    @F.pandas_udf("string")
    def decode(arrays: pd.Series) -> pd.Series:
        own = codec(path)
        return pd.Series([own.decode(() if value is None else value) for value in arrays])

    return decode(ids)


def digests(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Encode every text, decode the ids, and return the digest of both directions per row.

    The ids of a row live only while the row is worked on; between Python and Spark go three short values per row.
    """
    path = vocabulary or default_vocabulary()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        by_decimal = {str(at): piece for at, piece in own.pieces.items()}
        for batch in batches:
            counted, forward, backward = [], [], []
            for text in batch.column(1):
                joined = own.encode_text(text.as_py())
                ids = joined.split(",") if joined else []
                back = b"".join([by_decimal[at] for at in ids]).decode("utf-8", "replace")
                counted.append(len(ids))
                forward.append(hashlib.sha256(joined.encode()).hexdigest())
                backward.append(hashlib.sha256(back.encode()).hexdigest())
            columns = [batch.column(0), pa.array(counted, pa.int64()), pa.array(forward, pa.string()), pa.array(backward, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of `documents` encoded and decoded."""
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
