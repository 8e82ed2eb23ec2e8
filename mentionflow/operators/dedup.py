"""First-wins duplicates, per-keyword caps, and rows the table already has."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionflow.schema import POST_KEY


def first_wins(posts: DataFrame, order: Sequence[Column | str], keys: Sequence[str] = POST_KEY) -> DataFrame:
    """Keep the first row of each key in the given order.

    The rank filter is a group limit for Spark: each map task keeps one row per key before the shuffle, so a key
    with very many copies reaches its reducer as one row per map task. `dropDuplicates` would keep any copy.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return posts.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def cap_per_keyword(
    posts: DataFrame,
    limit: int,
    order: Sequence[Column | str],
    keys: Sequence[str] = ("keyword",),
    salt_by: str = "post_id",
    rank: str | None = None,
) -> DataFrame:
    """Keep the first `limit` rows per keyword; `rank` names a column for the position.

    The rows are ranked in rounds: per keyword and salt over all reducers, then per keyword and group of salts, then
    per keyword. The first round spreads a hot keyword evenly; the others give no task more than the square root of the
    reducer count times the limit.
    """
    if limit < 1:
        raise ValueError("the cap must be a positive number")
    name = rank or "_rank"
    salts = max(2, int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    posts = posts.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)))
    for groups in (salts, math.isqrt(salts - 1) + 1):
        part = Window.partitionBy(*keys, F.pmod("_salt", F.lit(groups))).orderBy(*order)
        posts = posts.withColumn("_early", F.row_number().over(part)).filter(F.col("_early") <= limit)
    posts = posts.drop("_early", "_salt")
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = posts.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= limit)
    return ranked if rank else ranked.drop(name)


def not_stored(incoming: DataFrame, stored: DataFrame, keys: Sequence[str] = POST_KEY) -> DataFrame:
    """Incoming rows whose key is not stored yet. Only the key columns of the stored side are read."""
    return incoming.join(stored.select(*keys), list(keys), "left_anti")


def run_counters(posts: DataFrame) -> DataFrame:
    """One row: posts kept per source type, and duplicates skipped.

    A source has one type, so the type of any copy is that of the kept one. Both columns of the per-key aggregation
    are fixed-width, which keeps it a hash aggregation with map-side combine: copies of a hot post meet early.
    """
    kind = F.when(F.col("source_type") == "social", 0).when(F.col("source_type") == "web", 1).otherwise(2)
    per_key = posts.groupBy(*POST_KEY).agg(F.count("*").alias("copies"), F.min(kind).alias("kind"))
    return per_key.agg(
        F.count_if(F.col("kind") == 0).alias("social"),
        F.count_if(F.col("kind") == 1).alias("web"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
    )
