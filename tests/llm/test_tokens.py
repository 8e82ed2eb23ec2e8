"""BPE codec and packing against the library and exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import AWKWARD, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mentionflow.llm import bpe, packing


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


def test_codec_equals_the_library(library):
    own = bpe.codec(bpe.default_vocabulary())
    draw = random.Random(3)
    alphabet = [*map(chr, range(32, 127)), *"\t\n\r\x0b\x0c\x1c\x85\xa0éßñ½²٣՘漢字😀", " ", " ", "'s", "a", "b"]
    texts = [text or "" for _, text in AWKWARD] + ["".join(draw.choices(alphabet, k=draw.randint(1, 60))) for _ in range(500)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, text[:80]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert own.encode(None) == []


def test_merges_are_leftmost_and_lowest_first():
    merges = {(0, 0): (1, 2), (2, 0): (0, 3), (2, 2): (2, 4)}
    assert bpe.merge_symbols([0, 0, 0], merges) == [3]
    assert bpe.merge_symbols([0] * 5, merges) == [3, 2]
    assert bpe.merge_symbols([7], merges) == [7]
    assert bpe.merge_symbols([], merges) == []


def test_decode_of_cut_bytes_and_unknown_ids(library):
    own = bpe.codec(bpe.default_vocabulary())
    ids = own.encode("😀")
    assert own.decode(ids[:-1]) == library.decode(ids[:-1], skip_special_tokens=False)
    assert own.decode([10**9]) == ""


def test_columns_and_digests(spark, library):
    docs = documents(spark, AWKWARD)
    rows = bpe.digests(docs).collect()
    assert len(rows) == len(AWKWARD)
    want = sorted(
        (str(doc_id), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        for doc_id, text in AWKWARD
        for ids in [library.encode(text or "", add_special_tokens=False).ids]
    )
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want
    back = docs.select("text", bpe.decode_column(bpe.encode_column(docs.text)).alias("back")).collect()
    assert all((row.text or "") == row.back for row in back)
    assert bpe.digests(docs.limit(0)).count() == 0


def test_pieces_and_places(spark, library):
    docs = documents(spark, AWKWARD)
    pieces = packing.cut_pieces(docs, 64)
    placed = packing.place(pieces, ("doc_id", "start", "ids"), 64)
    rows = placed.collect()
    taken: dict[int, int] = {}
    for row in sorted(rows, key=lambda row: (row.sequence_id, row.offset)):
        assert row.offset == taken.get(row.sequence_id, 0)
        taken[row.sequence_id] = row.offset + row.length
    assert sorted(taken) == list(range(len(taken))) and max(taken.values()) <= 64
    want = sorted((str(doc_id), tuple(library.encode(text or "", add_special_tokens=False).ids + [1])) for doc_id, text in AWKWARD if doc_id not in (5,))
    by_id: dict = {}
    for row in sorted(rows, key=lambda row: row.start):
        by_id.setdefault(str(row.doc_id), []).extend(np.frombuffer(row.ids, "<u4").tolist())
    assert sorted((key, tuple(ids)) for key, ids in by_id.items() if key != "5") == want
    whole = {row.sequence_id: row for row in packing.sequences(placed).collect()}
    assert all(len(row.ids) == 4 * row.length == 4 * taken[at] for at, row in whole.items())
    assert packing.pack(docs.limit(0)).count() == 0
    packed = packing.pack(docs, 64).collect()
    assert sorted(zlib.crc32(row.ids) for row in rows) == sorted(row.ids_crc32 for row in packed)


LONG = [(1, " " * 1_100_000 + "x"), (2, "a\n" + "\n" * 1_100_000 + "x"), (3, "b" * 500_000), (4, "\t \u3000" * 300_000), (5, "x" + " " * 9_999 + "<|endoftext|>" + " " * 10_000)]


def test_long_runs_of_one_kind(spark, library):
    rows = packing.cut_pieces(documents(spark, LONG)).collect()
    for doc_id, text in LONG:
        parts = sorted((row.start, row.ids) for row in rows if row.doc_id == doc_id)
        ids = np.frombuffer(b"".join(ids for _, ids in parts), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids + [1]
    assert packing.pack(documents(spark, LONG)).agg({"length": "sum"}).first()[0] == sum(row.length for row in rows)


def test_place_carries_clashing_columns(spark):
    own = ["row", "bucket", "n", "before", "at", "of_length", "rank_from", "rank_to", "first_window", "each", "base"]
    pieces = spark.createDataFrame([(1, 3, "a", 9), (2, 5, "b", 9), (2, 5, "b", 9)], "doc_id long, length long, rank string, offset long")
    pieces = pieces.select("*", *[F.lit(name).alias(name) for name in own])
    rows = packing.place(pieces, ("doc_id",), 8).collect()
    assert {(row.doc_id, row["rank"]) for row in rows} == {(1, "a"), (2, "b")} and all(row[name] == name for row in rows for name in own)
    assert len({(row.sequence_id, row.offset) for row in rows}) == 3


@pytest.mark.parametrize("seed", range(4))
def test_plan_equals_best_fit_decreasing_piece_by_piece(seed):
    draw = random.Random(seed)
    window = 40
    lengths = [draw.randint(1, window) for _ in range(400)]
    free: list[int] = []
    for length in sorted(lengths, reverse=True):
        fitting = [space for space in free if space >= length]
        if fitting:
            free.remove(min(fitting))
            free.append(min(fitting) - length)
        else:
            free.append(window - length)
    histogram = {length: lengths.count(length) for length in set(lengths)}
    left: dict[int, int] = {}
    for entry in packing.plan_places(histogram, window):
        for rank in range(entry["rank_from"], entry["rank_to"]):
            at = entry["first_window"] + (rank - entry["rank_from"]) // entry["each"]
            left[at] = left.get(at, window) - entry["length"]
    assert sorted(left.values()) == sorted(free)
