"""Micro-batch ingest: the batch functions applied to newly landed files."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from mentionflow.schema import POST_KEY
from mentionflow.session import delete_path, remembered, staged
from mentionflow.sinks.fanout import Sinks, publish


def start_ingest(
    landed: DataFrame,
    to_posts: Callable[[DataFrame], DataFrame],
    sinks: Sinks,
    checkpoint: str,
    day: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Feed landed items to the sinks, batch by batch; all that is there and then stop, unless `every` is given.

    Duplicates inside a batch go by arrival, duplicates of earlier batches by the table's key, so nothing is lost to
    a watermark and no state grows. Batches are named by stream and number; the stream's name is kept with its
    checkpoint, so another stream into the same output never replaces its lines. A batch replayed after a failure
    overwrites its own files and inserts nothing twice; a post of an earlier batch adds no line.
    """
    spark = landed.sparkSession
    stream = remembered(spark, f"{checkpoint.rstrip('/')}/stream-name", uuid.uuid4().hex)

    def write(batch: DataFrame, number: int) -> None:
        posts, name = to_posts(batch), f"{stream}-{number:09d}"
        if not sinks.quarantine_dir:
            return publish(posts, sinks, name, day, new_lines_only=True)
        once, path = staged(posts, "micro-batch")  # read twice: for the faulty rows and for the others
        try:
            publish(once, sinks, name, day, new_lines_only=True)
        finally:
            delete_path(batch.sparkSession, path)

    writer = landed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def drop_seen(posts: DataFrame, delay: str, event_time: str = "scraped_at") -> DataFrame:
    """Streaming duplicates by key, with state kept for `delay`.

    Rows older than the watermark are dropped as well; where no row may be lost, rely on the table's key instead.
    """
    return posts.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(POST_KEY))


def unscored(posts: DataFrame, scores: DataFrame) -> DataFrame:
    """The work queue of the sentiment stage when scores live in a table of their own."""
    done = scores.filter("sentiment_label is not null").select("id")
    return posts.filter("sentiment_label is null").join(done, "id", "left_anti")
