"""Benchmark decontamination with generalised suffix automata of the test items.

The items' words are cut into segments that overlap by one word less than a window, so that every window lies whole in
one segment, and the segments are dealt into shards of at most `SHARD_WORDS` words. Each shard becomes one generalised
suffix automaton, built in a task; its size is bounded by the shard and so is what a pass broadcasts. A pass streams the
words of every document through one automaton: the state and the length of the longest match ending at each word are
carried along, and a word is hit where a match as long as a window, or a whole shorter item, ends. A benchmark of several
shards takes several passes in turn, each adding to the spans and items the ones before it found. Documents are never
shuffled, so neither a hot source nor many copies matter, and a text is held by one task one row at a time.

Results: null texts have no words; items without words have no window; items whose id is null hit words but are not
named; repeated items and repeated rows count as they stand, an item id counts once; an empty benchmark hits nothing; an
empty table gives no rows; the other columns are carried, those that share a name with a result column are replaced.
"""

from __future__ import annotations

import pickle
import re
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from mentionflow.session import staged

WINDOW = 10
#: Words of the items in one automaton: it has at most twice as many states, some 200 MB in a worker at the most.
SHARD_WORDS = 400_000
SEGMENT_WORDS = 50_000
#: A document loses its hit spans; one with at least this share of its words hit goes whole.
MAX_COVERAGE = 0.5
#: A word byte is a letter, a digit, or any byte of a character outside ASCII.
_WORD = rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
_TABLE = bytes(at if re.fullmatch(_WORD, bytes([at])) else 32 for at in bytes(range(256)).lower())
_FOUND = (
    T.StructType()
    .add("n_words", T.LongType())
    .add("spans", T.ArrayType(T.StructType().add("start", T.LongType()).add("stop", T.LongType())))
    .add("items", T.ArrayType(T.StringType()))
)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def words_of(text: bytes) -> list[bytes]:
    """The words of a text in UTF-8, A-Z lower-cased."""
    return text.translate(_TABLE).split()


class Automaton:
    """A generalised suffix automaton over word sequences, and the items whose windows its states stand for."""

    def __init__(self, window: int = WINDOW) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.edges: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.long_items: dict[int, set] = defaultdict(set)
        self.short_items: dict[int, dict[int, set]] = defaultdict(dict)

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.edges.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, before: int, word: int, after: int) -> int:
        """The state of the string that `word` ends after `before`: `after`, or a copy of it for the shorter strings."""
        if self.length[after] == self.length[before] + 1:
            return after
        copy = self._state(self.length[before] + 1, self.link[after], dict(self.edges[after]))
        self.link[after] = copy
        while before >= 0 and self.edges[before].get(word) == after:
            self.edges[before][word] = copy
            before = self.link[before]
        return copy

    def _extend(self, last: int, word: int) -> int:
        known = self.edges[last].get(word)
        if known is not None:
            return self._split(last, word, known)
        new = self._state(self.length[last] + 1, 0, {})
        before = last
        while before >= 0 and word not in self.edges[before]:
            self.edges[before][word] = new
            before = self.link[before]
        if before >= 0:
            self.link[new] = self._split(before, word, self.edges[before][word])
        return new

    def add(self, words: Sequence[bytes]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, self.vocabulary.setdefault(word, len(self.vocabulary)))

    def name(self, words: Sequence[bytes], item: str | None) -> None:
        """Note an item at the states of its windows, once all sequences are in."""
        state = 0
        for at, word in enumerate(words, 1):
            state = self.edges[state][self.vocabulary[word]]
            if at >= self.window:
                while self.length[self.link[state]] >= self.window:
                    state = self.link[state]
                self.long_items[state].add(item)
        if 0 < len(words) < self.window:
            self.short_items[state].setdefault(len(words), set()).add(item)

    def packed(self) -> bytes:
        """What matching needs: one flat table of steps, and per state where its windows and shorter items are named."""
        width = max(1, len(self.vocabulary))
        steps = {state * width + word: to for state, edges in enumerate(self.edges) for word, to in edges.items()}
        longest = [-1] * len(self.link)  # the state that stands for the last `window` words of a match
        shorter = [-1] * len(self.link)  # the nearest state up the links, itself included, at which a shorter item ends
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            up = self.link[state]
            if self.length[state] >= self.window:
                longest[state] = longest[up] if self.length[up] >= self.window else state
            shorter[state] = state if state in self.short_items else shorter[up]
        least = min([self.window, *(length for ends in self.short_items.values() for length in ends)])
        items = {state: sorted(filter(None, found)) for state, found in self.long_items.items()}
        ends = {state: [(length, sorted(filter(None, found))) for length, found in at.items()] for state, at in self.short_items.items()}
        return pickle.dumps((self.window, least, width, self.vocabulary, steps, self.link, self.length, longest, shorter, items, ends), protocol=5)


class Matcher:
    def __init__(self, packed: bytes) -> None:
        (self.window, self.least, self.width, self.vocabulary, self.steps, self.link, self.length, self.longest, self.shorter, self.items, self.ends) = pickle.loads(packed)

    def match(self, words: list[bytes], spans: list[list[int]], items: set) -> list[list[int]]:
        """Add what the automaton finds in a text to the spans and items found before."""
        steps, link, length, width, least, window = self.steps, self.link, self.length, self.width, self.least, self.window
        found: list[list[int]] = []
        states, shorter = set(), set()
        state = matched = 0
        for at, word in enumerate(map(self.vocabulary.get, words), 1):
            if word is None:
                state = matched = 0
                continue
            after = steps.get(state * width + word)
            while after is None and state:
                state = link[state]
                matched = length[state]
                after = steps.get(state * width + word)
            if after is None:
                continue
            state = after
            matched += 1
            if matched < least:
                continue
            if matched >= window:
                states.add(self.longest[state])
                _cover(found, at - window, at)
            end = self.shorter[state]
            while end >= 0:
                for size, _ in self.ends[end]:
                    if size <= matched:
                        shorter.add((end, size))
                        _cover(found, at - size, at)
                end = self.shorter[link[end]]
        for one in states:
            items.update(self.items[one])
        for one, size in shorter:
            items.update(next(names for length, names in self.ends[one] if length == size))
        if spans and found:
            both: list[list[int]] = []
            for start, stop in sorted(spans + found):
                if both and both[-1][1] >= start:
                    both[-1][1] = max(both[-1][1], stop)
                else:
                    both.append([start, stop])
            return both
        return spans or found


def _cover(spans: list[list[int]], start: int, stop: int) -> None:
    while spans and spans[-1][1] >= start:
        start = min(start, spans.pop()[0])
    spans.append([start, stop])


def _segments(benchmark: DataFrame, window: int, segment: int) -> DataFrame:
    """Item id, words joined by blanks, and their number: one row per stretch of an item."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py() or b"")
                for start in range(0, max(1, len(words) - window + 1), segment):
                    part = words[start : start + segment + window - 1]
                    if part:
                        rows.append((item, b" ".join(part), len(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[at] for row in rows], kind) for at, kind in enumerate((pa.string(), pa.binary(), pa.int64()))], ["item", "words", "size"]
            )

    return benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text")).mapInArrow(
        work, "item string, words binary, size long"
    )


def build_automata(benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, list[str]]:
    """A table of automata (`shard`, `packed`) in the shared folder, and the shards' names."""
    segments, _ = staged(_segments(benchmark, window, min(SEGMENT_WORDS, shard_words)).distinct(), "item-segments")
    total = segments.agg(F.sum("size")).first()[0] or 0
    bucket = F.pmod(F.xxhash64("item", "words"), F.lit(1 + total // (16 * shard_words)))
    running = Window.partitionBy("bucket").orderBy("item", "words").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(running), F.lit(0))
    dealt = segments.withColumn("bucket", bucket).withColumn("shard", F.concat_ws("-", "bucket", F.floor(before / shard_words)))

    def build(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        automaton = Automaton(window)
        texts = [bytes(words).split() for words in rows["words"]]
        for words in texts:
            automaton.add(words)
        for words, item in zip(texts, rows["item"]):
            automaton.name(words, item)
        return pd.DataFrame({"shard": [key[0]], "packed": [automaton.packed()]})

    built, _ = staged(dealt.select("shard", "item", "words").groupBy("shard").applyInPandas(build, "shard string, packed binary"), "automata")
    return built, [row["shard"] for row in built.select("shard").orderBy("shard").collect()]  # one short name per shard


def _pass(rows: DataFrame, matcher: Callable[[], Matcher | None], first: bool, keep_text: bool) -> DataFrame:
    """Match `text` of rows (`row`, `text`, and from the second pass on what was found) and add to what was found."""
    fields = [field for field in rows.schema.fields if field.name in ("row", "text")[: 1 + keep_text]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using = matcher()
        for batch in batches:
            counts, spans, items = [], [], []
            for at, text in enumerate(batch.column(1)):
                words = words_of(text.as_py() or b"")
                old = [] if first else [[span["start"], span["stop"]] for span in batch.column(3)[at].as_py()]
                named = set() if first else set(batch.column(4)[at].as_py())
                counts.append(len(words))
                new = using.match(words, old, named) if using else old
                spans.append([{"start": start, "stop": stop} for start, stop in new])
                items.append(sorted(named))
            columns = [*(batch.column(at) for at in range(1 + keep_text)), pa.array(counts, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, [*("row", "text")[: 1 + keep_text], "n_words", "spans", "items"])

    return rows.mapInArrow(work, T.StructType(fields + _FOUND.fields))


def _matched(documents: DataFrame, benchmark: DataFrame, window: int, shard_words: int, keep_text: bool) -> DataFrame:
    """`row` (the other columns as one struct, so that no name can clash), `text` if kept, and what was found."""
    spark = documents.sparkSession
    others = [F.col(f"`{name}`") for name in documents.columns if name != "text"]
    rows = documents.select(F.struct(*others or [F.lit(0).alias("none")]).alias("row"), F.col("text").cast("binary").alias("text"))
    built, shards = build_automata(benchmark, window, shard_words)
    if not shards:
        return _pass(rows, lambda: None, True, keep_text)
    for number, shard in enumerate(shards, 1):
        if number > 1:
            rows, _ = staged(rows, "matched")  # one automaton at a time in a worker
        packed = spark.sparkContext.broadcast(built.filter(F.col("shard") == shard).first()["packed"])  # bounded by the shard
        rows = _pass(rows, lambda packed=packed: Matcher(packed.value), number == 1, keep_text or number < len(shards))
    return rows


def _with_row(found: DataFrame, documents: DataFrame, results: dict) -> DataFrame:
    names = [name for name in documents.columns if name not in results or name == "text"]
    carried = [results["text"].alias("text") if name == "text" else F.col(f"row.`{name}`").alias(name) for name in names if name != "text" or "text" in results]
    return found.select(*carried, *(column.alias(name) for name, column in results.items() if name != "text"))


def _n_hit():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda done, span: done + span["stop"] - span["start"])


def find_contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per document, without its text: `n_words`, `n_hit`, the hit `spans` in words, and the sorted `items` hit."""
    found = _matched(documents, benchmark, window, shard_words, keep_text=False)
    return _with_row(found, documents, {"n_words": F.col("n_words"), "n_hit": _n_hit(), "spans": F.col("spans"), "items": F.col("items")})


def _without(text: bytes, spans: list[dict]) -> bytes:
    """A text without its hit spans, from the first byte of the first word to the last byte of the last one."""
    places = [match.span() for match in re.finditer(_WORD, text.translate(_TABLE))]
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : places[span["start"]][0]])
        at = places[span["stop"] - 1][1]
    return b"".join([*kept, text[at:]])


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE, min_span: int = 0, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """Documents without their hit spans of at least `min_span` words, and without those of `max_coverage` or more.

    `n_removed` is the number of words a document lost.
    """
    found = _matched(documents, benchmark, window, shard_words, keep_text=True)
    kept = found.filter((_n_hit() == 0) | (_n_hit() < F.lit(max_coverage) * F.col("n_words")))
    spans = F.filter("spans", lambda span: span["stop"] - span["start"] >= min_span)
    kept = kept.withColumn("spans", spans)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_without(text.as_py(), found.as_py()) if len(found) else text.as_py() for text, found in zip(batch.column(1), batch.column(3))]
            yield batch.set_column(1, "text", pa.array(texts, pa.binary()))

    cleaned = kept.mapInArrow(cut, kept.schema)
    return _with_row(cleaned, documents, {"text": F.col("text").cast("string"), "n_removed": _n_hit()})


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, hit words and hit items of every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_contamination(documents, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: Words of documents and items, windows of every length that occurs, and their places by joining on the joined words.
OP11_SQL = rf"""
WITH item_words AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(words), {WINDOW}) AS size,
           array_to_string(words[place : place + {WINDOW} - 1], ' ') AS text
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - {WINDOW} + 1, 1) + 1)) AS place FROM item_words WHERE len(words) > 0)
), texts AS (
    SELECT row_number() OVER () AS row_id, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), places AS (
    SELECT row_id, words, size, unnest(range(1, len(words) - size + 2)) AS place
    FROM texts, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size
), found AS (
    SELECT p.row_id, p.place, p.size, w.item_id
    FROM places p JOIN windows w ON w.size = p.size AND w.text = array_to_string(p.words[p.place : p.place + p.size - 1], ' ')
), hit AS (
    SELECT row_id, count(DISTINCT word) AS n_hit FROM (SELECT row_id, unnest(range(place, place + size)) AS word FROM found) GROUP BY row_id
), named AS (
    SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY row_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM texts LEFT JOIN hit USING (row_id) LEFT JOIN named USING (row_id)
"""
