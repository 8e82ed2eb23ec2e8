"""Keyed state over a restart, its time limit, and the summary added up from differences."""

import itertools
import time
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_sinks import posts

from mentionflow.operators.reports import sentiment_summary
from mentionflow.schema import SCORE
from mentionflow.session import child_names, landed_files
from mentionflow.sinks import summary
from mentionflow.sinks.table import insert_posts, read_posts, to_stored
from mentionflow.sources.landed import stream_landed
from mentionflow.streaming import first
from mentionflow.streaming.first import first_across_batches, rocksdb_state

ROW = "source string, post_id string, copy int"


@pytest.mark.parametrize("keep_ms, want", [(86_400_000, [("a", 1), ("b", 2), ("c", 5)]), (1, [("a", 1), ("a", 4), ("b", 2), ("b", 6), ("c", 5)])])
def test_first_of_a_key_over_a_restart(spark, tmp_path, keep_ms, want):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for number, rows in enumerate(([("s", "a", 3), ("s", "a", 1), ("s", "b", 2)], [("s", "b", 6), ("s", "a", 4), ("s", "c", 5)])):
        spark.createDataFrame(rows, ROW).repartition(2).write.parquet(f"{tmp_path}/in/{number}")
        stream = stream_landed(spark, f"{tmp_path}/in/*", spark.createDataFrame([], ROW).schema)
        with rocksdb_state(spark):
            writer = first_across_batches(stream, ["copy"], keep_ms).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/check")
            assert writer.trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination(120)
        time.sleep(0.05)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    assert sorted((row.post_id, row.copy) for row in spark.read.schema(ROW).parquet(f"{tmp_path}/out").collect()) == want


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_summary_after_any_order_of_inserts_and_scores(spark, tmp_path, order):
    path = str(tmp_path / "table")
    rows = posts(spark, [("a", str(n), "k" if n % 2 else "m", 0, n) for n in range(9)])
    ids = {row.post_id: row.id for row in to_stored(rows).collect()}
    start = datetime(2026, 2, 1)
    first = [(ids[str(n)], ("positive", "negative", "mixed")[n % 3], Decimal(n) / 10, start) for n in range(9)]
    again = [(ids["1"], None, None, start + timedelta(1)), (ids["3"], "neutral", None, start + timedelta(1)), (ids["8"], "positive", Decimal("0.5"), start - timedelta(1))]

    def insert():
        summary.count_inserted(to_stored(rows), path, "one")
        insert_posts(rows, path, "one")

    steps = [insert, lambda: summary.add_scores(spark.createDataFrame(first, SCORE), path, "first"), lambda: summary.add_scores(spark.createDataFrame(again, SCORE), path, "again")]
    for at in order:
        steps[at]()
    want = [tuple(row) for row in sentiment_summary(read_posts(spark, path)).collect()]
    for compacted in (False, True):
        if compacted:
            summary.compact_summary(spark, path, "x")
        got = summary.read_summary(spark, path).collect()
        plain = lambda found: [tuple(round(float(value), 8) if isinstance(value, Decimal) else value for value in row) for row in found]
        assert plain(got) == plain(want) and len(got) == 2


def test_differences_are_written_by_more_than_one_task(spark, tmp_path):
    """There may be as many groups as posts: one scrape time each."""
    path = str(tmp_path / "table")
    rows = posts(spark, [("a", str(n), "k", 0, n) for n in range(400)])
    summary.add_scores(to_stored(rows).select("id", F.lit("neutral").alias("sentiment_label"), F.lit(0.5).alias("sentiment_score"), F.current_timestamp().alias("analyzed_at")), path, "all")
    small = {f"spark.sql.adaptive.{name}": "1b" for name in ("advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize")}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        summary.count_inserted(to_stored(rows), path, "one")
    finally:
        for name in small:
            spark.conf.unset(name)
    assert sum(name.startswith("part-") for name in child_names(spark, f"{summary.summary_path(path)}/insert-one")) > 1
    assert [row.total for row in summary.read_summary(spark, path).collect()] == [400]


def test_keys_share_steps_and_odd_rows_keep_their_place(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(first, "KEY_GROUPS", 3)
    schema = "source string, post_id string, copy int, note string"
    rows = [("s", str(n), copy, "x\n'\"") for n in range(300) for copy in (2, 1)]
    rows += [("s", None, None, "late"), ("s", None, 5, "early"), ("s", "None", 6, None), (None, "s", 1, "a"), ("", "s", 1, "b")]
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/in")
    stream = stream_landed(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema)
    with rocksdb_state(spark):
        writer = first_across_batches(stream, ["copy"], 86_400_000).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/check")
        query = writer.trigger(availableNow=True).start(f"{tmp_path}/out")
        assert query.awaitTermination(120)
    assert sum(part["numRowsTotal"] for part in query.recentProgress[0]["stateOperators"]) <= 2 * 3  # the value and its end of life
    got = {tuple(row) for row in spark.read.schema(schema).parquet(f"{tmp_path}/out").collect()}
    assert got == {("s", str(n), 1, "x\n'\"") for n in range(300)} | {tuple(row) for row in rows[-4:]}


def test_landed_files_follow_the_size(spark, tmp_path, monkeypatch):
    spark.range(20_000).write.parquet(f"{tmp_path}/in")
    rows = spark.read.schema("id long").parquet(f"{tmp_path}/in")
    assert landed_files(rows, 3) == 3
    monkeypatch.setattr("mentionflow.session.LANDED_BYTES", 10_000)
    few, many = landed_files(rows, 3), landed_files(rows.union(rows), 3)
    assert few > 3 and few % 3 == 0 and 1.5 * few < many < 2.5 * few
