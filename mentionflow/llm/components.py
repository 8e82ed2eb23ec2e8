"""Connected components of a link table, by alternating stars.

Each round hooks every node's larger neighbours, then its smaller ones, to the smallest node in its neighbourhood; after
some rounds, logarithmic in the longest path, every link leads straight to the smallest node of its component. A round
stores a minimum per node (combined before the shuffle) and joins it back to the links; as both sides are then plain
shuffles, adaptive execution splits the links of a hot node. No neighbourhood is collected. Rounds are cut by tables in
the shared folder, those of earlier rounds are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionflow.session import delete_path, staged


def _larger_first(links: DataFrame) -> DataFrame:
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return ordered.filter(F.col("a") != F.col("b")).distinct()


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """`node`, `root` for every node of the links `a`, `b` that is not the smallest of its component."""
    spark = links.sparkSession
    now, path = staged(_larger_first(links), "links")
    mark = _mark(now)
    for _ in range(rounds):
        if not mark[0]:
            break
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low, low_path = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "lowest")
        hooked = both.filter(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        hooked, hooked_path = staged(_larger_first(hooked), "hooked")
        small, small_path = staged(hooked.groupBy("a").agg(F.min("b").alias("low")), "smallest")
        moved = hooked.join(small, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        after, after_path = staged(_larger_first(moved.unionAll(small.select("a", F.col("low").alias("b")))), "links")
        for used in (path, low_path, hooked_path, small_path):
            delete_path(spark, used)  # `after` is written and needs none of them
        now, path = after, after_path
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components need more than {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
