"""Packing token pieces into training sequences by best-fit decreasing.

Documents are tokenised, closed with an end id and cut into windows; full windows stand alone. Best-fit decreasing
depends only on how many pieces there are of each length, so the driver places the *histogram* (one row per length,
at most the window's size) and not the pieces: a segment tree indexed by remaining capacity finds the tightest open
window, and equal pieces meeting equal windows are placed together. The outcome is a list of rank ranges per length,
whose size is bounded by the window and not by the corpus; each piece then finds its place by its rank among pieces of
its length. Ranks are counted in two levels, hash bucket and length, so no length gathers in one task.

Results: null and empty texts are one piece that holds the end id alone; a text of any length is cut; repeated rows are
packed as often as they occur; an empty table gives no rows; columns besides `length`, `sequence_id` and `offset` are
carried as they are (those two are replaced).
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mentionflow.llm.bpe import byte_letters, codec, default_vocabulary
from mentionflow.llm.text import carried, packed
from mentionflow.session import staged

WINDOW = 2048
END_ID = 1
_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long"
_PLACES = "length long, rank_from long, rank_to long, first_window long, each long, base long"

#: `tiktoken` keeps a stack of a blank run's length and gives up on some hundred thousand blanks; the slower library does not.
_LONG_BLANKS = 10_000

_encoders: dict = {}


def _ids(text: str, path: str) -> np.ndarray:
    """The ids of a text, an added token's text being its id."""
    if len(text) >= _LONG_BLANKS and re.search(rf"\s{{{_LONG_BLANKS}}}", text):
        return np.array(codec(path).library().encode(text, add_special_tokens=False).ids, "<u4")
    return _encoder(path).encode_to_numpy(text, allowed_special="all")


def _encoder(path: str):
    """The vocabulary in the rank form of `tiktoken`, which gives the same ids faster; built once per worker."""
    if path not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = byte_letters()
        special = {token["content"]: token["id"] for token in content.get("added_tokens", [])}
        vocabulary = content["model"]["vocab"].items()
        ranks = {bytes(letters[c] for c in token): at for token, at in vocabulary if token not in special}
        _encoders[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _encoders[path]


def cut_pieces(documents: DataFrame, window: int = WINDOW, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Tokenise and cut: one row per piece, `ids` as little-endian unsigned 32-bit numbers."""
    path = vocabulary or default_vocabulary()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, starts, lengths, parts, totals = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = np.append(_ids(text.as_py() or "", path), end_id).astype("<u4")
                for start in range(0, len(ids), window):
                    part = ids[start : start + window]
                    at.append(row)
                    starts.append(start)
                    lengths.append(len(part))
                    parts.append(part.tobytes())
                    totals.append(len(ids))
            columns = [
                batch.column(0).take(pa.array(at, pa.int32())),
                *(pa.array(values, kind) for values, kind in ((starts, pa.int64()), (lengths, pa.int64()), (parts, pa.binary()), (totals, pa.int64()))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids", "doc_tokens"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, _PIECES)


class _OpenWindows:
    """How many windows are open at each remaining capacity: a segment tree of sums over capacities."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.sums = [0] * (2 * self.leaves)
        self.runs: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def _add(self, capacity: int, count: int) -> None:
        node = self.leaves + capacity
        while node:
            self.sums[node] += count
            node >>= 1

    def put(self, capacity: int, first: int, count: int) -> None:
        if capacity and count:
            self.runs[capacity].append((first, count))
            self._add(capacity, count)

    def take(self, capacity: int) -> tuple[int, int]:
        first, count = self.runs[capacity].pop()
        self._add(capacity, -count)
        return first, count

    def tightest(self, length: int) -> int | None:
        """The smallest capacity of at least `length` at which a window is open."""
        node = self.leaves + length
        if self.sums[node]:
            return length
        while node > 1:
            if not node & 1 and self.sums[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.sums[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def plan_places(histogram: dict[int, int], window: int = WINDOW) -> list[dict[str, int]]:
    """Best-fit decreasing over counts of lengths.

    Each entry says: pieces of `length` with ranks `rank_from` up to `rank_to` go to windows from `first_window` on,
    `each` to a window, the first of a window at offset `base`. A window at the tightest capacity stays the tightest
    while it still holds a further piece of that length, so it takes as many as fit before the next one is asked.
    """
    opened, places, windows = _OpenWindows(window), [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            capacity = opened.tightest(length)
            if capacity is None:
                capacity = window
                first, count = windows, -(-left // (window // length))
                windows += count
            else:
                first, count = opened.take(capacity)
            each = capacity // length
            placed = min(left, count * each)
            full, rest = divmod(placed, each)
            places.append(
                {"length": length, "rank_from": rank, "rank_to": rank + placed, "first_window": first, "each": each, "base": window - capacity}
            )
            opened.put(capacity - each * length, first, full)
            if rest:
                opened.put(capacity - rest * length, first + full, 1)
            untouched = full + (rest > 0)
            opened.put(capacity, first + untouched, count - untouched)
            rank += placed
            left -= placed
    return places


def place(pieces: DataFrame, order: Sequence[str] = ("doc_id", "start"), window: int = WINDOW) -> DataFrame:
    """Give every piece its `sequence_id` and `offset`. `order` names columns that tell pieces apart."""
    spark = pieces.sparkSession
    kept, _ = staged(pieces.drop("sequence_id", "offset"), "pieces")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = kept.select(packed(kept), "length", F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in order]), F.lit(buckets)).alias("bucket"))
    counts, _ = staged(dealt.groupBy("length", "bucket").agg(F.count("*").alias("n")), "piece-counts")  # at most window x buckets rows
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row per length
    if not histogram:
        return kept.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("bucket", "length").orderBy(*[F.col(f"row.`{name}`") for name in order])
    ranked = dealt.withColumn("at", F.row_number().over(within) - 1).join(bases, ["length", "bucket"])
    ranked = ranked.select("row", "length", (F.col("before") + F.col("at")).alias("rank"))
    entries = plan_places(histogram, window)
    table = F.from_json(F.lit(json.dumps(entries)), f"array<struct<{_PLACES.replace(' ', ':').replace(',:', ',')}>>")
    places = spark.range(0, 1, 1, 1).select(F.inline(table)).withColumnRenamed("length", "of_length")
    found = ranked.join(
        F.broadcast(places),  # bounded by the window: some dozen ranges per length
        (F.col("length") == F.col("of_length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")),
    )
    at = F.col("rank") - F.col("rank_from")
    return found.select(
        *carried(kept),
        (F.col("first_window") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("base") + F.col("length") * F.pmod(at, F.col("each"))).cast("long").alias("offset"),
    )


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: the ids of each, in order of offset; a sequence is bounded by the window."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda done, piece: F.concat(done, piece["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))


def pack(documents: DataFrame, window: int = WINDOW, vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents with their place; ids travel as their checksum."""
    pieces = cut_pieces(documents, window, vocabulary).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(pieces, window=window)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of `documents` with its place."""
    placed = pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
