"""The stored posts as a Parquet table with one row per (source, post_id), and their scores as a table of their own.

One inserting writer at a time; scores may be written meanwhile.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionflow.functions.text import record_id
from mentionflow.functions.times import parsed_time, utc_date
from mentionflow.operators.dedup import not_stored
from mentionflow.operators.reports import apply_scores, last_scores
from mentionflow.schema import POST_KEY, SCORE, STORED_PARTITIONS, STORED_POST
from mentionflow.session import delete_path, path_exists, remembered, staged
from mentionflow.sinks.keys import add_keys, ensure_keys, in_table, pending_path, stored_among

#: Incoming keys are broadcast against the stored keys only below this measured size.
BROADCAST_KEY_BYTES = 64 * 1024 * 1024
#: Sources are listed for directory pruning only when a batch has at most this many.
PRUNE_SOURCES = 1000


def to_stored(posts: DataFrame) -> DataFrame:
    """Post records to table rows: typed times, derived id, defaults, no sentiment yet."""
    given = F.col("scraped_at").cast("string")
    unreadable = F.raise_error(F.lit("scraped_at is not a time")).cast("timestamp")
    scraped = F.when(given.isNull(), F.current_timestamp()).otherwise(F.coalesce(parsed_time(given), unreadable))
    values = {
        "id": record_id(F.col("source"), F.col("post_id")),
        "lang": F.coalesce("lang", F.lit("id")),
        "created_at": parsed_time(F.col("created_at")),
        "scraped_at": scraped,
        "raw": F.coalesce("raw", F.lit("{}")),
        "scraped_date": utc_date(scraped),
    }
    columns = []
    for field in STORED_POST:
        column = values.get(field.name)
        if column is None:
            column = F.col(field.name) if field.name in posts.columns else F.lit(None)
        columns.append(column.cast(field.dataType).alias(field.name))
    return posts.select(*columns)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The posts as they were inserted; empty when nothing ever was."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], STORED_POST)
    return spark.read.schema(STORED_POST).parquet(path)


def scores_path(path: str) -> str:
    return f"{path.rstrip('/')}-scores"


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """All scores of the posts; empty when none was written."""
    scored = scores_path(path)
    return spark.read.schema(SCORE).parquet(scored) if path_exists(spark, scored) else spark.createDataFrame([], SCORE)


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """The posts with the last score of each. Tests on source, date and keyword reach the table's scan."""
    posts, scored = read_table(spark, path), scores_path(path)
    if not path_exists(spark, scored):
        return posts
    return apply_scores(posts, spark.read.schema(SCORE).parquet(scored))


def create_table(spark: SparkSession, path: str) -> None:
    """Make an empty table unless there is one."""
    if not path_exists(spark, path):
        spark.createDataFrame([], STORED_POST).write.mode("ignore").partitionBy(*STORED_PARTITIONS).parquet(path)


def insert_posts(posts: DataFrame, path: str, batch: str | None = None) -> None:
    """Append the posts whose key the table does not have.

    `posts` must be free of duplicates and cheap to read twice (a staged table); a new table takes them in one reading. A batch replayed after a crash finds
    the rows that came through already there and adds the others; a replay after the end adds nothing.
    """
    name = batch or uuid.uuid4().hex
    commit_rows(pending_rows(posts, path, name), path, name)


def pending_rows(posts: DataFrame, path: str, batch: str) -> DataFrame:
    """The posts of a batch that the table does not have, stored under the batch's name until `commit_rows`.

    A replay of an unfinished batch gets the rows of its first attempt again, whatever of them came through.
    """
    spark, held = posts.sparkSession, pending_path(path, batch)
    create_table(spark, path)
    if not path_exists(spark, f"{held}/_SUCCESS"):
        ensure_keys(read_table(spark, path), path)
        found = stored_among(posts, path)
        fresh = posts if found is None else not_stored(posts, found)
        fresh.write.mode("overwrite").parquet(held)
    return spark.read.schema(posts.schema).parquet(held)


def commit_rows(rows: DataFrame, path: str, batch: str) -> None:
    """Append pending rows to the table and their keys to the keys.

    The rows of a first attempt are known to be new. A mark tells a replay that some of them may be there already.
    """
    spark, mark = rows.sparkSession, f"{pending_path(path, batch)}/_APPENDING"
    fresh = not_stored(rows, in_table(rows, read_table(spark, path))) if path_exists(spark, mark) else rows
    remembered(spark, mark, "")
    _append(to_stored(fresh), path)
    add_keys(rows, path, batch)
    delete_path(spark, pending_path(path, batch))


def fresh_rows(posts: DataFrame, stored: DataFrame) -> DataFrame:
    """The posts that are not among stored ones without keys of their own, by the cheapest way their size allows.

    `posts` are read several times and should be a staged table. Their sources limit which directories are read, and of
    those only the key columns; a small batch is broadcast, so the stored keys are not shuffled.
    """
    width = F.octet_length("source") + F.octet_length("post_id") + 32
    size = posts.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    sources = posts.select("source").distinct().limit(PRUNE_SOURCES + 1).collect()
    keys = stored.select(*POST_KEY)
    if len(sources) <= PRUNE_SOURCES:
        keys = keys.filter(F.col("source").isin([row["source"] for row in sources]))
    if size <= BROADCAST_KEY_BYTES:
        keys = keys.join(F.broadcast(posts.select(*POST_KEY)), list(POST_KEY), "left_semi")
    return not_stored(posts, keys)


def _append(rows: DataFrame, path: str) -> None:
    """Write table rows: output sized by adaptive execution per directory, so a hot source gets many files and a
    small one gets one; rows sorted inside a file so that keyword and time statistics skip row groups."""
    parts = [F.col(name) for name in STORED_PARTITIONS]
    ordered = rows.hint("rebalance", *parts).sortWithinPartitions(*STORED_PARTITIONS, "keyword", "scraped_at")
    ordered.write.mode("append").partitionBy(*STORED_PARTITIONS).parquet(path)


def write_scores(scores: DataFrame, path: str) -> None:
    """Add the scores of the sentiment stage to the score table next to the posts.

    Posts are not touched, so posts inserted meanwhile are safe, and the cost is that of the scores alone. A post
    scored again has several rows until `compact_scores` is run; readers take the last.
    """
    columns = [F.col(field.name).cast(field.dataType).alias(field.name) for field in SCORE]
    scores.select(*columns).write.mode("append").parquet(scores_path(path))


def compact_scores(spark: SparkSession, path: str) -> None:
    """Keep the last score of each post. Run it while nothing writes scores."""
    last = last_scores(spark.read.schema(SCORE).parquet(scores_path(path)))
    rows, held = staged(last.select("id", "_new.*").select(*SCORE.names), "scores")
    try:
        rows.write.mode("overwrite").parquet(scores_path(path))
    finally:
        delete_path(spark, held)
