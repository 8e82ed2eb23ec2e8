"""SimHash fingerprints and near-duplicates by pigeonhole blocks.

A fingerprint is cut into blocks; two that differ in at most `blocks - equal` bits agree in `equal` whole blocks, so each
choice of that many blocks is a key and close pairs share one. Equal fingerprints are one node from the start. The nodes
of a key meet in one sorted stretch of a partition, where Hamming distances are verified in vector operations and only
the links of a spanning forest leave it: copies never expand into pairs. A key with more nodes than `TILE` is dealt
into pairs of salted tiles, so that the work of one key spreads over tasks with bounded memory and no pair is lost.

Results: null and empty texts have fingerprint zero and link like any other; fewer words than a shingle make one
shingle; a null id takes part but names no component; repeated rows share a component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mentionflow.llm.components import components
from mentionflow.llm.text import carried, packed, whole
from mentionflow.session import staged

SEED = 42
#: Nodes of one key that are compared in one task; larger keys are dealt into pairs of tiles of about this size.
TILE = 4096


def _majority(hashes: np.ndarray) -> int:
    """The bits set in over half of some 64-bit hashes, as a signed number."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * counts > len(hashes)).astype(np.uint8), bitorder="little").view("<i8")[0])


def shingle_hashes(words: Sequence[bytes], size: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of `size` words joined by spaces; of the whole sequence if it is shorter."""
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = max(len(words) - size, 0)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: last + 1].tolist(), ends[min(size, len(words)) - 1 :].tolist())
    return np.array([digest(joined[start:end], seed) for start, end in spans], "<u8")


def fingerprint(text: str | None, size: int) -> int:
    """The 64-bit SimHash of a text over word shingles; words are parted by ASCII white space, A-Z lower-cased."""
    hashes = shingle_hashes((text or "").encode().lower().split(), size)
    return _majority(hashes) if len(hashes) else 0


def fingerprints(documents: DataFrame, size: int) -> DataFrame:
    """`doc_id`, `text_hash`, `code` of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = pa.array([fingerprint(text.as_py(), size) for text in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), codes], ["doc_id", "text_hash", "code"])

    source = documents.select(F.col("doc_id").cast("long"), F.xxhash64(whole(F.col("text"))).alias("text_hash"), "text")
    return source.mapInArrow(work, "doc_id long, text_hash long, code long")


def _masks(blocks: int, equal: int) -> list[int]:
    """For each choice of `equal` out of `blocks` nearly equal blocks of 64 bits, its mask as a signed number."""
    cuts = [64 * at // blocks for at in range(blocks + 1)]
    parts = [(1 << high) - (1 << low) for low, high in zip(cuts, cuts[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, equal)]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in masks]


def _forest(nodes: np.ndarray, groups: np.ndarray, codes: list[np.ndarray], limits: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the close pairs within stretches of equal group number.

    Rows `i` and `i + shift` are compared for growing `shift` until no group reaches that far.
    """
    count = len(nodes)
    root = np.arange(count)
    left, right = [], []

    def find(at: int) -> int:
        while root[at] != at:
            root[at] = root[root[at]]
            at = root[at]
        return at

    rows = np.arange(count)
    for shift in range(1, count):
        rows = rows[rows + shift < count]
        rows = rows[groups[rows] == groups[rows + shift]]
        if not len(rows):
            break
        near = rows
        for low, high, most in limits:
            bits = np.zeros(len(near), np.int64)
            for code in codes[low:high]:
                bits += np.bitwise_count(code[near] ^ code[near + shift])
            near = near[bits <= most]
        near = near[root[near] != root[near + shift]]
        for at in near.tolist():
            one, other = find(at), find(at + shift)
            if one != other:
                root[max(one, other)] = min(one, other)
                left.append(at)
                right.append(at + shift)
        while len(near) and (root[root] != root).any():
            root = root[root]
    return nodes[left], nodes[right]


def block_keys(code: str, blocks: int, equal: int) -> Column:
    """The keys of a fingerprint: each choice of `equal` blocks with the bits in them."""
    masks = _masks(blocks, equal)
    return F.array(*[F.struct(F.lit(at).alias("choice"), F.col(code).bitwiseAND(F.lit(mask)).alias("bits")) for at, mask in enumerate(masks)])


def link_close(nodes: DataFrame, keys: Column, tests: Sequence[tuple[Sequence[str], int]], tile: int = TILE) -> DataFrame:
    """Links `a`, `b` that connect all nodes which share a key and pass every test.

    `nodes` has a distinct long `node` and the 64-bit code columns of the tests; a test is a list of columns and the most
    bits in which they may differ together. `keys` is an array of structs of `choice` and `bits`.
    """
    names = [name for columns, _ in tests for name in columns]
    limits, at = [], 0
    for columns, most in tests:
        limits.append((at, at + len(columns), most))
        at += len(columns)
    dealt = nodes.select("node", *[F.col(name).alias(f"c{at}") for at, name in enumerate(names)], F.explode(keys).alias("k"))
    dealt = dealt.select("node", *[f"c{at}" for at in range(len(names))], "k.choice", "k.bits")
    full = nodes.select(F.explode(keys).alias("k")).groupBy("k.choice", "k.bits").agg(F.count("*").alias("n")).filter(F.col("n") > tile)
    full, _ = staged(full.select("choice", "bits", F.ceil(F.col("n") / tile).cast("int").alias("tiles")), "full-keys")
    dealt = dealt.join(full, ["choice", "bits"], "left")
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda u: F.least(own, u) * F.col("tiles") + F.greatest(own, u))
    dealt = dealt.withColumn("tile", F.explode(F.when(F.col("tiles").isNull(), F.array(F.lit(0))).otherwise(others))).drop("tiles")
    dealt = dealt.select("node", *[f"c{at}" for at in range(len(names))], "choice", "bits", "tile")
    sorted_keys = dealt.repartition("choice", "bits", "tile").sortWithinPartitions("choice", "bits", "tile")
    width = len(names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def links(columns: list[np.ndarray]) -> pa.RecordBatch:
            a, b = _forest(columns[0], columns[-1], [column.view(np.uint64) for column in columns[1 : 1 + width]], limits)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            columns = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            if not len(columns[0]):
                continue
            new = np.zeros(len(columns[0]), bool)
            for column in columns[1 + width :]:
                new[1:] |= column[1:] != column[:-1]
            cut = int(np.flatnonzero(new)[-1]) if new.any() else 0  # the last stretch may go on in the next batch
            held = [column[cut:] for column in columns]
            if cut:
                yield links([*(column[:cut] for column in columns[: 1 + width]), np.cumsum(new[:cut])])
        if held is not None:
            yield links([*held[: 1 + width], np.zeros(len(held[0]), np.int64)])

    return sorted_keys.mapInArrow(work, "a long, b long")


#: Contract: words of a shingle, and the most bits in which linked fingerprints differ. More blocks make keys longer.
WORDS, MAX_BITS, BLOCKS = 4, 4, 6


def _grouped(coded: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """`code`, `first` (the smallest id, then text hash, of the rows that have it) and `root`, the same for codes that links connect."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    distinct, _ = staged(coded.groupBy("code").agg(first), "codes")
    links = link_close(distinct.select(F.col("code").alias("node"), "code"), block_keys("code", blocks, blocks - max_bits), [(["code"], max_bits)])
    roots = components(links)
    return distinct.join(roots, distinct["code"] == roots["node"], "left").select("code", "first", F.coalesce("root", "code").alias("root"))


def near_duplicates(documents: DataFrame, size: int = WORDS, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """`doc_id`, `code` and `component_id`, the smallest id that fingerprints within `max_bits` lead to."""
    coded, _ = staged(fingerprints(documents, size), "fingerprints")
    labelled = _grouped(coded, max_bits, blocks)
    lowest = labelled.groupBy("root").agg(F.min("first.doc_id").alias("component_id"))
    named, _ = staged(labelled.join(lowest, "root").select("code", "component_id"), "named-codes")  # a hot code's rows can then be split
    return coded.join(named, "code").select("doc_id", "code", "component_id")


def keep_one(documents: DataFrame, size: int = WORDS, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """One document of each component of `near_duplicates`: the one with the smallest id; a null id counts as the largest.

    Of rows with the same id the text decides, by its hash; rows with the same id and text are one document.
    """
    coded, _ = staged(fingerprints(documents, size), "fingerprints")
    kept = _grouped(coded, max_bits, blocks).groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    rows = documents.select(packed(documents), F.col("doc_id").cast("long").alias("id"), F.xxhash64(whole(F.col("text"))).alias("text_hash"))
    chosen = rows.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash")), "left_semi")
    same = Window.partitionBy("id", "text_hash").orderBy("id")
    return chosen.withColumn("copy", F.row_number().over(same)).filter("copy = 1").select(*carried(documents))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")
