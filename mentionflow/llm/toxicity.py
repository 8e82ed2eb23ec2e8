"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

Learning looks at a bounded sample of labelled rows (`EXAMPLES`, a documented parameter): the words, word beginnings and
word endings that stand out in toxic examples become the vocabulary, their document frequencies the IDF, and the
examples an inverted index in blocks with the largest weight of each term per block. The index is bounded by the sample
and goes to the executors as a broadcast. A text is scored whole: the largest possible cosine per block is the query
times the block maxima; blocks are opened from the highest bound on until no other block can hold a nearer example than
the k found, so the k nearest are exact (ties to the earlier example). Votes are weighted by closeness and by how many
labelled rows an example stands for, which keeps the score a probability although classes are sampled at different rates.

Results: every text gets a score, null and empty ones and texts without any vocabulary term the share of toxic rows among
such examples; without any usable label all scores are 0; the label of a repeated labelled id is its largest; labels
other than 0 and 1 and null ids teach nothing; repeated documents are scored alike. The result has `doc_id`, `held_out`,
`score`, `predicted`, and the evidence: ids and cosines of the nearest examples.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Labelled rows of each class to learn from; above it rows are taken by the order of a hash.
EXAMPLES = 3000
FOLDS = 5
NEIGHBOURS = 15
VOCABULARY = 4000
#: Toxic examples that must hold a term.
LEAST_HELD = 3
#: Log-likelihood gain below which a term may stand out by chance among a million terms.
MIN_GAIN = 14.0
#: Word beginnings and endings of these lengths are terms besides whole words.
EDGES = (4, 5)
BLOCK = 256
WORDS_KEPT = 400_000
_WORD = re.compile(r"[^\W_]+")


def _words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def terms_of_word(word: str) -> list[str]:
    edges = [f"{word[:size]}-" for size in EDGES if len(word) > size]
    return [word, *edges, *(f"-{word[-size:]}" for size in EDGES if len(word) > size)]


def held_out(doc_id: Column) -> Column:
    """Whether a row may teach nothing: the checksum of its id is divisible by the number of folds."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


class Index:
    """Examples in blocks: for each term its postings, and its largest weight in each block."""

    def __init__(self, examples: list[tuple[int, str, int, float]]) -> None:
        """`examples`: id, text, label, and how many labelled rows it stands for."""
        self.ids = np.array([row[0] for row in examples], np.int64)
        self.toxic = np.array([row[2] for row in examples], float)
        self.stands_for = np.array([row[3] for row in examples], float)
        self.vocabulary, self.idf = self._choose([row[1] for row in examples])
        self.known: dict[str, tuple[int, ...]] = {}
        self.bare_words: set[str] = set()
        vectors = [self.vector(row[1]) for row in examples]
        bare = np.array([not len(terms) for terms, _ in vectors], bool)
        self.prior = self._share(bare) if len(examples) else 0.0
        blocks = -(-len(examples) // BLOCK)
        self.highest = np.zeros((len(self.vocabulary), blocks), np.float32)
        rows: list[list[tuple[int, int, float]]] = [[] for _ in range(blocks)]
        for at, (terms, weights) in enumerate(vectors):
            for term, weight in zip(terms.tolist(), weights.tolist()):
                block = at // BLOCK
                # rounded up, so that a bound in single precision stays a bound
                self.highest[term, block] = max(self.highest[term, block], np.nextafter(np.float32(weight), np.float32(2)))
                rows[block].append((term, at % BLOCK, weight))
        self.blocks = []
        for own in rows:
            own.sort()
            terms = np.array([row[0] for row in own], np.int64)
            starts = np.searchsorted(terms, np.arange(len(self.vocabulary) + 1))
            self.blocks.append((starts, np.array([row[1] for row in own], np.int64), np.array([row[2] for row in own])))

    def _share(self, chosen: np.ndarray) -> float:
        """The share of toxic rows among some examples, drawn towards all examples by one row."""
        if not self.stands_for.sum():
            return 0.0
        overall = float((self.toxic * self.stands_for).sum() / self.stands_for.sum())
        return float(((self.toxic * self.stands_for)[chosen].sum() + overall) / (self.stands_for[chosen].sum() + 1))

    def _choose(self, texts: list[str]) -> tuple[dict[str, int], np.ndarray]:
        """Terms more frequent among toxic examples, by the signed log-likelihood gain of their document frequencies.

        Copies of one text would lift its accidental words, so examples that share the smallest hash of their less
        common words count once, with the terms of all of them. Texts are read anew in each pass, and clean examples
        are counted for terms of several toxic ones only: the driver holds no word list of all examples.
        """
        held_by = Counter(word for text in texts for word in _words(text))
        common = max(3, len(texts) // 100)
        marks = [min((zlib.crc32(word.encode()) for word in _words(text) if held_by[word] <= common), default=-1) for text in texts]
        del held_by

        def counted(label: float, wanted: set[str] | None) -> tuple[Counter, int]:
            found, groups = Counter(), 0
            order = sorted((mark, at) for at, mark in enumerate(marks) if self.toxic[at] == label)
            for mark, members in groupby(order, key=lambda pair: pair[0]):
                sets = ({term for word in _words(texts[at]) for term in terms_of_word(word)} for _, at in members)
                for own in sets if mark < 0 else [set().union(*sets)]:
                    found.update(own if wanted is None else own & wanted)
                    groups += 1
            return found, groups

        toxic, n_toxic = counted(1.0, None)
        toxic = {term: held for term, held in toxic.items() if held >= LEAST_HELD}
        clean, n_clean = counted(0.0, set(toxic))
        n_toxic, n_clean = max(1, n_toxic), max(1, n_clean)
        total = n_toxic + n_clean
        gains = []
        for term, held in toxic.items():
            rate, other = held / n_toxic, clean[term] / n_clean
            if rate < 3 * other:
                continue
            mean = (held + clean[term]) / (n_toxic + n_clean)
            gains.append((held * math.log(rate / mean) + (clean[term] * math.log(other / mean) if other else 0.0), term, held + clean[term]))
        gains = [gain for gain in sorted(gains, key=lambda gain: (-gain[0], gain[1]))[:VOCABULARY] if gain[0] > MIN_GAIN]
        return {term: at for at, (_, term, _) in enumerate(gains)}, np.array([1 + math.log((1 + total) / (1 + held)) for _, _, held in gains])

    def _weigh(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        terms = np.array(sorted(counts), np.int64)
        weights = (1 + np.log(np.array([counts[term] for term in terms.tolist()], float))) * self.idf[terms] if len(terms) else np.zeros(0)
        norm = math.sqrt(float((weights * weights).sum()))
        return terms, weights / norm if norm else weights

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The unit TF-IDF vector of a whole text: term numbers and weights."""
        words = _WORD.findall((text or "").lower())
        found: Counter = Counter()
        for word in set(words).difference(self.bare_words):
            own = self.known.get(word)
            if own is None:
                own = tuple(at for term in terms_of_word(word) if (at := self.vocabulary.get(term)) is not None)
                if not own:
                    if len(self.bare_words) >= WORDS_KEPT:
                        self.bare_words.clear()
                    self.bare_words.add(word)
                    continue
                if len(self.known) >= WORDS_KEPT:
                    self.known.clear()
                self.known[word] = own
            times = words.count(word)
            for at in own:
                found[at] += times
        return self._weigh(found)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, most: int) -> list[tuple[float, int]]:
        """The `most` nearest examples with a positive cosine, as (cosine, number), nearest first."""
        bounds = weights @ self.highest[terms]
        best: list[tuple[float, int]] = []
        for block in np.argsort(-bounds, kind="stable").tolist():
            if bounds[block] <= 0 or (len(best) == most and bounds[block] * (1 + 1e-6) < -best[-1][0]):
                break
            starts, rows, values = self.blocks[block]
            sums = np.zeros(BLOCK)
            for term, weight in zip(terms.tolist(), weights.tolist()):
                low, high = starts[term], starts[term + 1]
                if high > low:
                    sums[rows[low:high]] += weight * values[low:high]  # an example stands once under a term
            near = np.flatnonzero(sums > 0)
            best = sorted(best + [(-float(sums[at]), block * BLOCK + at) for at in near.tolist()])[:most]
        return [(-low, at) for low, at in best]

    def score(self, text: str | None) -> tuple[float, list[tuple[float, int]]]:
        terms, weights = self.vector(text)
        if not len(terms):
            return self.prior, []
        near = self.nearest(terms, weights, NEIGHBOURS)
        votes = total = 0.0
        for cosine, at in near:
            weight = self.stands_for[at] / (1.05 - min(cosine, 1.0))
            votes += weight * self.toxic[at]
            total += weight
        overall = self.prior
        return (votes + overall) / (total + 1), near


def examples(documents: DataFrame, labels: DataFrame, most: int = EXAMPLES) -> list[tuple[int, str, int, float]]:
    """At most about `most` labelled rows of each class outside the held-out fold, in order of id."""
    usable = labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    usable = usable.filter(F.col("doc_id").isNotNull())
    counts = {row["toxic"]: row["n"] for row in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit("example"), F.col("doc_id")), F.lit(1 << 40)) / float(1 << 40)
    chosen = usable.filter(draw < F.coalesce(*[F.when(F.col("toxic") == label, F.lit(most / n)) for label, n in counts.items()], F.lit(0.0)))
    texts = documents.select(F.col("doc_id"), F.col("text")).join(F.broadcast(chosen), "doc_id")  # bounded by the sample
    rows = texts.groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).collect()
    taken = Counter(row["toxic"] for row in rows)
    ordered = sorted((row["doc_id"], row["text"], row["toxic"]) for row in rows)
    return [(doc_id, text, toxic, counts[toxic] / taken[toxic]) for doc_id, text, toxic in ordered]


def score_toxicity(documents: DataFrame, labels: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """The scores of all documents, with the evidence they rest on."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(Index(examples(documents, labels, most)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            scores, found, cosines = [], [], []
            for text in batch.column(1):
                score, near = index.score(text.as_py())
                scores.append(score)
                found.append([int(index.ids[at]) for _, at in near])
                cosines.append([cosine for cosine, _ in near])
            columns = [batch.column(0), pa.array(scores, pa.float64()), pa.array(found, pa.list_(pa.int64())), pa.array(cosines, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "evidence_ids", "evidence_cosines"])

    scored = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        work, "doc_id long, score double, evidence_ids array<long>, evidence_cosines array<double>"
    )
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence_ids", "evidence_cosines"
    )


def drop_toxic(documents: DataFrame, labels: DataFrame, most: int = EXAMPLES) -> DataFrame:
    """The documents whose score is below one half, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(Index(examples(documents, labels, most)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.names.index("text"))
            yield batch.filter(pa.array([index.score(text.as_py())[0] < 0.5 for text in texts], pa.bool_()))

    return documents.mapInArrow(work, documents.schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_toxicity(documents, labels).select("doc_id", "held_out", "score", "predicted")
