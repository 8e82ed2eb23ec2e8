"""From raw documents to packed training pieces: toxicity, line dedup, near-copy dedup, packing.

Each stage takes what its predecessor kept and returns the columns of `documents`; the last returns pieces with their
place in the packed sequences. `n_chars` follows the text where a stage changes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionflow.llm import line_dedup, packing, simhash, toxicity
from mentionflow.session import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not judged toxic; learnt from the labelled ones among them."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a document of a smaller id holds too."""
    kept = line_dedup.dedup_lines(docs)
    names = [F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars") if name == "n_chars" else F.col(f"`{name}`") for name in docs.columns]
    return kept.select(*names)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints few bits connect."""
    return simhash.keep_one(docs, size=simhash.WORDS, max_bits=simhash.MAX_BITS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in the packed sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("packing", pack),
]

#: Scores, fingerprints and token ids cannot be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
