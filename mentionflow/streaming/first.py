"""First arrivals across micro-batches by keyed state, and posts that stayed unscored for too long, as streams."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from mentionflow.schema import POST_KEY

#: State on disk with incremental checkpoints. Operators with a time limit ask for batch after batch without data, and a
#: run over what is there would never end; expired keys go with the next batch that has data.
_KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep keyed state with a time limit in RocksDB."""
    before = {name: spark.conf.get(name) for name in _KEYED_STATE}
    for name, value in _KEYED_STATE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


#: Keys are kept by hash in so many groups, and a batch reads and writes the groups it has keys of, each in one step. A
#: step for every key would cost more than all else. The number is part of a stream's state and must not change.
KEY_GROUPS = 16_384


class _FirstOfKeys(StatefulProcessor):
    """Lets the first row of each key of a group through and remembers the keys for some time."""

    def __init__(self, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], keep_ms: int) -> None:
        self.keys, self.order, self.columns, self.keep_ms = list(keys), list(order), list(columns), keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType().add("seen", T.StringType()), self.keep_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        now, held = timerValues.getCurrentProcessingTimeInMs(), self.seen.get()
        seen = {at: own for at, own in (json.loads(held[0]) if held else {}).items() if int(at) + self.keep_ms > now}
        known = {name for own in seen.values() for name in own}
        first: dict[str, tuple] = {}
        for row in rows:  # one row of a key is held, however many copies a batch has
            name = repr([row[column] for column in self.keys])
            if name not in known:
                place = self._place(row)
                if name not in first or place < first[name][0]:
                    first[name] = place, row
        if first:
            seen[str(now)] = [*seen.get(str(now), []), *first]
            self.seen.update((json.dumps(seen),))
        result = Row(*self.columns)
        for _, row in first.values():
            yield result(*[row[column] for column in self.columns])

    def _place(self, row: Row) -> list[tuple]:
        """Where a row stands in the order: missing values last."""
        values = [row[name] for name in self.order]
        return [(True,) if value is None or value != value else (False, value) for value in values]

    def close(self) -> None:
        pass


def first_across_batches(posts: DataFrame, order: Sequence[str], keep_ms: int, keys: Sequence[str] = POST_KEY) -> DataFrame:
    """The first row of each key over all micro-batches: the first batch wins, within it the first in `order`.

    The keys are kept in state for `keep_ms` of processing time. There is no watermark, so no row is late and none is
    lost: a copy that comes after its key was forgotten passes again, and the key of the table it goes to decides.
    Start the stream within `rocksdb_state`.
    """
    grouped = posts.withColumn("_group", F.pmod(F.xxhash64(*keys), F.lit(KEY_GROUPS))).groupBy("_group")
    return grouped.transformWithState(_FirstOfKeys(keys, order, posts.columns, keep_ms), posts.schema, "Append", "ProcessingTime")


def unscored_after(posts: DataFrame, scores: DataFrame, delay: str) -> DataFrame:
    """Posts that got no score within `delay` of their scraping, each once, when that time is over for both streams.

    Both sides carry watermarks of `delay`: state is dropped behind them, and rows later than that no longer count, a
    late post being left to the table's own queue (`unscored`).
    """
    left = posts.withWatermark("scraped_at", delay)
    right = scores.filter("sentiment_label IS NOT NULL").select(F.col("id").alias("scored_id"), "analyzed_at").withWatermark("analyzed_at", delay)
    in_time = (F.col("analyzed_at") >= F.col("scraped_at")) & (F.col("analyzed_at") <= F.col("scraped_at") + F.expr(f"INTERVAL {delay}"))
    return left.join(right, (F.col("id") == F.col("scored_id")) & in_time, "left_outer").filter("scored_id IS NULL").select(*posts.columns)
