"""Questions asked of the stored posts."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mentionflow.functions import metadata
from mentionflow.functions.times import utc_date, utc_day
from mentionflow.session import local_rows

PENDING_COLUMNS = ("id", "source", "source_type", "keyword", "post_id", "text", "lang", "scraped_at")


def pending_analysis(posts: DataFrame, limit: int | None = None, scores: DataFrame | None = None) -> DataFrame:
    """Posts without a sentiment, oldest first. With a limit this is a top-k, without it a range-partitioned sort.

    Stored posts that carry no sentiment themselves may come with the `scores` kept apart, and are judged as
    `apply_scores` would: the texts then move once, in the sort, and are in no join, however many scores there are.
    """
    rows = posts.filter(F.col("sentiment_label").isNull()).select(*PENDING_COLUMNS)
    if scores is not None:
        rows = _without_score(rows, scores)
    rows = rows.orderBy("scraped_at", "id")
    return rows if limit is None else rows.limit(limit)


def _without_score(rows: DataFrame, scores: DataFrame) -> DataFrame:
    """Rows whose last score, if any, has no label. A mark without a text meets each scored row at its place in the order."""
    done = last_scores(scores).filter("_new.sentiment_label IS NOT NULL").select("id")
    marks = rows.select("id", "scraped_at").join(done, "id", "left_semi").withColumn("_done", F.lit(True))
    both = rows.withColumn("_done", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    place = Window.partitionBy("scraped_at", "id")
    judged = both.repartitionByRange("scraped_at", "id").withColumn("_done", F.max("_done").over(place))
    return judged.filter("NOT _done").drop("_done")


def latest_unanalyzed(posts: DataFrame, limit: int) -> DataFrame:
    newest = [F.col("scraped_at").desc(), F.col("id")]
    return posts.filter(F.col("sentiment_label").isNull()).select(*PENDING_COLUMNS).orderBy(*newest).limit(limit)


def sentiment_summary(posts: DataFrame) -> DataFrame:
    """Sentiment per keyword and source over the analyzed posts.

    A label outside the three known ones only counts in `total`. The average ignores null scores. Aggregation is
    partial before the shuffle, so a hot keyword or source costs one row per map task.
    """
    analyzed = posts.filter(F.col("sentiment_label").isNotNull())
    label = F.col("sentiment_label")
    counts = analyzed.groupBy("keyword", "source").agg(
        F.count("*").alias("total"),
        F.count_if(label == "positive").alias("positive"),
        F.count_if(label == "neutral").alias("neutral"),
        F.count_if(label == "negative").alias("negative"),
        F.avg(F.col("sentiment_score").cast("decimal(25,16)")).alias("avg_score"),
        F.max("scraped_at").alias("last_scraped"),
    )
    return summary_columns(counts)


def summary_columns(counts: DataFrame) -> DataFrame:
    """Counts per keyword and source in the columns and order of the summary."""
    share = F.round(F.col("positive").cast("decimal(20,0)") / F.nullif(F.col("total"), F.lit(0)) * 100, 1)
    return counts.select(
        "keyword", "source", "total", "positive", "neutral", "negative",
        share.cast("decimal(5,1)").alias("positive_pct"), "avg_score", "last_scraped",
    ).orderBy("keyword", "source")


def by_keyword_and_time(posts: DataFrame, keyword: str, start: Any, end: Any) -> DataFrame:
    """Posts of a keyword in a closed time range, newest first.

    On the stored table the dates of the range are also tested, so that only the directories in it are read. The
    dates carry one day of slack at both ends; the time test decides.
    """
    low, high = F.lit(start), F.lit(end)
    if isinstance(start, str):
        kind = posts.schema["scraped_at"].dataType.simpleString()
        low, high = low.cast(kind), high.cast(kind)
    rows = posts.filter((F.col("keyword") == keyword) & F.col("scraped_at").between(low, high))
    if "scraped_date" in posts.columns:
        rows = rows.filter(F.col("scraped_date").between(F.date_sub(utc_date(low), 1), F.date_add(utc_date(high), 1)))
    return rows.orderBy(F.col("scraped_at").desc(), "post_id")


def by_source(posts: DataFrame, source: str, limit: int | None = None) -> DataFrame:
    """Posts of a source, newest first. `source` is a directory of the stored table."""
    rows = posts.filter(F.col("source") == source).orderBy(F.col("scraped_at").desc(), "post_id")
    return rows if limit is None else rows.limit(limit)


def with_metadata(posts: DataFrame, pattern: dict) -> DataFrame:
    """Posts whose JSON metadata contains the pattern."""
    return posts.filter(metadata.contains(F.col("raw"), pattern))


def with_star_rating(posts: DataFrame, at_least: int, at_most: int = 5) -> DataFrame:
    rating = F.get_json_object("raw", "$.star_rating").try_cast("int")
    return posts.filter(rating.between(at_least, at_most))


def last_scores(scores: DataFrame) -> DataFrame:
    """`id` and the struct `_new` of its last score."""
    return scores.groupBy("id").agg(
        F.max_by(
            F.struct("sentiment_label", "sentiment_score", "analyzed_at"),
            F.struct("analyzed_at", "sentiment_label", "sentiment_score"),
        ).alias("_new")
    )


def apply_scores(posts: DataFrame, scores: DataFrame) -> DataFrame:
    """Posts with the sentiment of the scoring stage filled in; a post without a new score keeps what it had.

    A post scored more than once gets the last score. Scores are reduced per id before the join.
    """
    last = last_scores(scores)
    filled = {
        name: F.when(F.col("_new").isNotNull(), F.col(f"_new.{name}")).otherwise(F.col(name))
        for name in ("sentiment_label", "sentiment_score", "analyzed_at")
    }
    columns = [filled[name].alias(name) if name in filled else F.col(name) for name in posts.columns]
    return posts.join(last, "id", "left").select(*columns)


def rating_against_label(posts: DataFrame) -> DataFrame:
    """How often each star rating got each sentiment label."""
    rating = F.get_json_object("raw", "$.star_rating").try_cast("int")
    return (
        posts.filter(F.col("sentiment_label").isNotNull() & rating.isNotNull())
        .groupBy(rating.alias("star_rating"), "sentiment_label")
        .agg(F.count("*").alias("posts"))
    )


def source_yield(items: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Items found and matched per source; a listed source without items is reported with zeros.

    `keyword` is null on items that matched nothing. The counts are aggregated before they meet the list.
    """
    counts = items.groupBy("source").agg(F.count("*").alias("found"), F.count("keyword").alias("matched"))
    listed = local_rows(items.sparkSession, [{"source": name} for name in sources], "source string")
    found, matched = (F.coalesce(F.col(name), F.lit(0)) for name in ("found", "matched"))
    return listed.join(counts, "source", "left").select(
        "source", found.alias("found"), matched.alias("matched"), (matched == 0).alias("no_match")
    )


def daily_buckets(posts: DataFrame) -> DataFrame:
    """Posts per source and UTC day of ingest."""
    return posts.groupBy("source", utc_day(F.col("scraped_at")).alias("day")).agg(F.count("*").alias("posts"))


def register_views(posts: DataFrame) -> None:
    """The table and its two reporting views for use from SQL."""
    posts.createOrReplaceTempView("stored_posts")
    pending_analysis(posts).createOrReplaceTempView("pending_analysis")
    sentiment_summary(posts).createOrReplaceTempView("sentiment_summary")
