"""Every post to every sink."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from mentionflow.operators.dedup import first_wins
from mentionflow.operators.validity import rejected_rows, valid_rows
from mentionflow.session import delete_path, staged
from mentionflow.sinks.database import insert_database
from mentionflow.sinks.jsonl import write_jsonl
from mentionflow.sinks.table import commit_rows, pending_rows
from mentionflow.sources.posts import ARRIVAL_ORDER


@dataclass(frozen=True)
class Sinks:
    """Output targets. The files are always written, table, database and faulty rows only when named."""

    output_dir: str
    table_dir: str | None = None
    database: Mapping[str, str] | None = None
    quarantine_dir: str | None = None


def _unwatched(_: str, rows: DataFrame) -> DataFrame:
    return rows


def publish(
    posts: DataFrame,
    sinks: Sinks,
    batch: str,
    day: str | None = None,
    new_lines_only: bool = False,
    watch: Callable[[str, DataFrame], DataFrame] = _unwatched,
) -> None:
    """Deduplicate a batch of posts with arrival columns and write it to all sinks; faulty rows are set aside.

    The deduplicated batch is written once to the shared work folder and read from there by every sink, so the
    sources are not computed again, no sink sees other rows than the next, and a lost executor costs one re-read. With
    `new_lines_only` the lines get only posts the table does not have yet. These are found once and stored under the
    batch's name until both sinks have them, so a replay writes the same lines again or, after the end, none. `watch`
    may observe the rejected, the valid and the kept rows on their way.
    """
    spark = posts.sparkSession
    if sinks.quarantine_dir:
        watch("rejected", rejected_rows(posts)).write.mode("overwrite").json(f"{sinks.quarantine_dir}/batch={batch}")
    kept, path = staged(watch("kept", first_wins(watch("valid", valid_rows(posts)), ARRIVAL_ORDER)), "batch")
    try:
        fresh = pending_rows(kept, sinks.table_dir, batch) if sinks.table_dir else kept
        write_jsonl(fresh if new_lines_only else kept, sinks.output_dir, batch, day)
        if sinks.table_dir:
            commit_rows(fresh, sinks.table_dir, batch)
        if sinks.database:
            insert_database(kept, sinks.database)
    finally:
        delete_path(spark, path)
