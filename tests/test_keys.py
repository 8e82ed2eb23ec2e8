"""The keys of the table: what a lookup reads, crashes in the middle of an insert, and many small batches."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from test_sinks import ROWS, WANT, keys_of, posts

from mentionflow.session import child_names, path_exists
from mentionflow.sinks import fanout, keys, table
from mentionflow.sinks.fanout import Sinks, publish
from mentionflow.sinks.jsonl import read_jsonl


def numbered(spark, first, last):
    return spark.range(first, last).select(F.lit("a").alias("source"), F.concat(F.lit("post-"), F.col("id")).alias("post_id"))


def bytes_read(spark, action):
    def now():
        return spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file").getLong("bytesRead")

    before = now()
    result = action()
    return now() - before, result


def test_a_batch_reads_as_much_of_a_table_ten_times_as_large(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keys, "KEYS_PER_BUCKET", 2000)
    batch = numbered(spark, -2, 4)
    read = {}
    for size in (40_000, 400_000):
        path = str(tmp_path / f"table{size}")
        keys.ensure_keys(numbered(spark, 0, size), path)
        keys.compact_keys(spark, path)
        read[size], found = bytes_read(spark, lambda path=path: sorted(row["post_id"] for row in keys.stored_among(batch, path).collect()))
        assert found == sorted(f"post-{at}" for at in range(4))
        read[size, "all"] = sum(os.path.getsize(file) for file in glob.glob(f"{keys.keys_path(path)}/**/*.parquet", recursive=True))
    assert read[400_000, "all"] > 5 * read[40_000, "all"]
    assert read[400_000] < 1.2 * read[40_000] and read[400_000] < read[400_000, "all"] / 10


def test_new_keys_open_no_row_group(spark, tmp_path):
    path = str(tmp_path / "table")
    keys.ensure_keys(numbered(spark, 0, 50_000), path)
    few, found = bytes_read(spark, lambda: keys.stored_among(numbered(spark, 10**6, 10**6 + 20), path).collect())
    some, held = bytes_read(spark, lambda: keys.stored_among(numbered(spark, 0, 20), path).collect())
    assert not found and len(held) == 20 and few < some


@pytest.mark.parametrize("rows", [keys.LOOKUP_KEYS, keys.LOOKUP_KEYS + 1])
def test_lookups_up_to_the_limit_and_beyond(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    keys.ensure_keys(numbered(spark, 500, 3000), path)
    found = keys.stored_among(numbered(spark, 0, rows), path)
    assert sorted(row["post_id"] for row in found.collect()) == sorted(f"post-{at}" for at in range(500, rows))


@pytest.mark.parametrize("limit", [keys.LOOKUP_KEYS, 2])
def test_any_size_of_batch_gives_the_same_table(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(keys, "LOOKUP_KEYS", limit)
    monkeypatch.setattr(keys, "RECENT_FILES", 2)
    sinks = Sinks(str(tmp_path / "out"), str(tmp_path / "table"))
    for at in range(5):
        publish(posts(spark, [*ROWS, ("n", str(at), "k", 0, 0), ("n", str(at + 1), "k", 0, 0)]), sinks, f"b{at}", "20260101", new_lines_only=True)
    want = sorted([*WANT, *[("n", str(at), "k") for at in range(6)]])
    assert keys_of(table.read_posts(spark, sinks.table_dir)) == want == keys_of(read_jsonl(spark, sinks.output_dir))
    assert len(child_names(spark, f"{keys.keys_path(sinks.table_dir)}/recent")) <= 2
    keys.compact_keys(spark, sinks.table_dir)
    publish(posts(spark, ROWS), sinks, "later", "20260101", new_lines_only=True)
    assert keys_of(table.read_posts(spark, sinks.table_dir)) == want == keys_of(read_jsonl(spark, sinks.output_dir))


def test_a_table_without_keys_gets_them(spark, tmp_path):
    path = str(tmp_path / "table")
    table._append(table.to_stored(posts(spark, ROWS[1:4])), path)
    table.insert_posts(posts(spark, ROWS[1:]), path)
    assert keys_of(table.read_posts(spark, path)) == sorted([("a", "1", "m"), ("a", "2", "k"), ("b", "1", "k"), ("a:b", "1", "k")])


class Crash(Exception):
    pass


@pytest.mark.parametrize("same_batch", [True, False])
@pytest.mark.parametrize("at", ["lines", "half", "table", "keys"])
def test_a_crash_loses_and_repeats_nothing(spark, tmp_path, monkeypatch, at, same_batch):
    """A batch breaks off before the lines, in the middle of the table, before the keys, or before it is cleared up."""
    sinks = Sinks(str(tmp_path / "out"), str(tmp_path / "table"))
    publish(posts(spark, ROWS[:2]), sinks, "zero", "20260101", new_lines_only=True)

    def crash(*_, **__):
        raise Crash

    def half(rows, path, append=table._append):
        append(rows.filter("source = 'b'"), path)
        raise Crash

    with monkeypatch.context() as patch:
        target, name, broken = {"lines": (fanout, "write_jsonl", crash), "half": (table, "_append", half), "table": (table, "add_keys", crash), "keys": (table, "delete_path", crash)}[at]
        patch.setattr(target, name, broken)
        with pytest.raises(Crash):
            publish(posts(spark, ROWS), sinks, "one", "20260101", new_lines_only=True)
    publish(posts(spark, ROWS), sinks, "one" if same_batch else "two", "20260101", new_lines_only=True)
    assert keys_of(table.read_posts(spark, sinks.table_dir)) == WANT
    lines = keys_of(read_jsonl(spark, sinks.output_dir))
    assert set(lines) == set(WANT) and (lines == WANT or not same_batch)
    assert child_names(spark, f"{keys.keys_path(sinks.table_dir)}/pending") == []
    publish(posts(spark, ROWS), sinks, "three", "20260101", new_lines_only=True)
    assert keys_of(table.read_posts(spark, sinks.table_dir)) == WANT and keys_of(read_jsonl(spark, sinks.output_dir)) == lines
    assert not path_exists(spark, f"{sinks.output_dir}/for_source=c")
