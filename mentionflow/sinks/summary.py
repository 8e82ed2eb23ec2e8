"""The sentiment summary kept up to date by small differences, without reading all posts again.

Every insert and every batch of scores appends what it changes, per keyword, source and scrape time: counts by label, the
sum and number of scores, with a minus for what a post counted before it was scored again. Adding the differences up, in
any order, gives `sentiment_summary` of the posts as they are.

A difference is written once under its batch's name, before the batch itself, and not computed again on a replay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionflow.operators.reports import last_scores, summary_columns
from mentionflow.schema import SCORE
from mentionflow.session import child_names, delete_path, path_exists, staged
from mentionflow.sinks.table import read_scores, read_table, write_scores

_GROUP = ("keyword", "source", "scraped_at")
_SUMS = ("total", "positive", "neutral", "negative", "scores", "score_sum")
_SUMMARY = "keyword string, source string, scraped_at timestamp, total bigint, positive bigint, neutral bigint, negative bigint, scores bigint, score_sum decimal(38,4)"


def summary_path(path: str) -> str:
    return f"{path.rstrip('/')}-summary"


def contributions(posts: DataFrame, sign: int) -> DataFrame:
    """What analyzed posts count for in the summary, times `sign`."""
    label = F.col("sentiment_label")

    def counted(test: Column) -> Column:
        return (F.count_if(test) * sign).cast("bigint")

    return posts.filter(label.isNotNull()).groupBy(*_GROUP).agg(
        counted(F.lit(True)).alias("total"),
        *[counted(label == name).alias(name) for name in ("positive", "neutral", "negative")],
        counted(F.col("sentiment_score").isNotNull()).alias("scores"),
        (F.coalesce(F.sum("sentiment_score"), F.lit(0)) * sign).cast("decimal(38,4)").alias("score_sum"),
    )


def _added(parts: DataFrame) -> DataFrame:
    sums = [F.sum(name).cast("decimal(38,4)" if name == "score_sum" else "bigint").alias(name) for name in _SUMS]
    changed = " OR ".join(f"{name} <> 0" for name in _SUMS)
    return parts.groupBy(*_GROUP).agg(*sums).filter(changed)


def _scored(posts: DataFrame, scores: DataFrame) -> DataFrame:
    """The grouping columns of posts with their last score; posts without one are left out."""
    return posts.select("id", *_GROUP).join(last_scores(scores), "id").select(*_GROUP, "_new.*")


def _append(parts: DataFrame, path: str, batch: str) -> None:
    folder = f"{summary_path(path)}/{batch}"
    if not path_exists(parts.sparkSession, f"{folder}/_SUCCESS"):
        # as many rows as groups, which may be as many as posts: files sized by adaptive execution, one where few are changed
        _added(parts).select(*_GROUP, *_SUMS).hint("rebalance").write.mode("overwrite").parquet(folder)


def count_inserted(rows: DataFrame, path: str, batch: str) -> None:
    """Add table rows that are about to be inserted; some of them may have been scored before they came."""
    _append(contributions(_scored(rows, read_scores(rows.sparkSession, path)), 1), path, f"insert-{batch}")


def add_scores(scores: DataFrame, path: str, batch: str) -> None:
    """Write a batch of scores and what it changes in the summary: read are the posts and scores of its ids alone."""
    spark = scores.sparkSession
    own, held = staged(scores.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in SCORE]), "scores")
    try:
        ids = own.select("id").distinct()
        stored = read_scores(spark, path).join(ids, "id", "left_semi")
        posts = read_table(spark, path).select("id", *_GROUP).join(ids, "id", "left_semi")
        now = contributions(_scored(posts, stored.unionByName(own)), 1)
        _append(now.unionByName(contributions(_scored(posts, stored), -1)), path, f"scores-{batch}")
        write_scores(own, path)
    finally:
        delete_path(spark, held)


def _parts(spark: SparkSession, path: str) -> list[str]:
    return [f"{summary_path(path)}/{name}" for name in child_names(spark, summary_path(path)) if path_exists(spark, f"{summary_path(path)}/{name}/_SUCCESS")]


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """The summary from the differences alone."""
    there = _parts(spark, path)
    parts = spark.read.schema(_SUMMARY).parquet(*there) if there else spark.createDataFrame([], _SUMMARY)
    groups = _added(parts).groupBy("keyword", "source").agg(
        *[F.sum(name).alias(name) for name in _SUMS], F.max(F.when(F.col("total") > 0, F.col("scraped_at"))).alias("last_scraped")
    )
    average = F.col("score_sum").cast("decimal(38,16)") / F.nullif(F.col("scores"), F.lit(0))
    return summary_columns(groups.filter("total > 0").withColumn("avg_score", average.cast("decimal(29,20)")))


def compact_summary(spark: SparkSession, path: str, batch: str) -> None:
    """One set of differences in place of all. Run it while nothing is inserted or scored."""
    there = _parts(spark, path)
    if there:
        _append(spark.read.schema(_SUMMARY).parquet(*there), path, f"compact-{batch}")
        for used in there:
            delete_path(spark, used)
