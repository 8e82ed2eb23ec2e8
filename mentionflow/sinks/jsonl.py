"""Daily JSON lines: one directory per source and UTC day of the run."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentionflow.schema import POST
from mentionflow.session import remembered

#: Directory columns. `for_source` repeats the source, because the record itself must keep all its keys.
DIRECTORIES = ("for_source", "day", "batch")


def run_day() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d")


def write_jsonl(posts: DataFrame, out_dir: str, batch: str, day: str | None = None) -> None:
    """Add a batch of posts, all eleven keys per line, nulls included, `raw` as a JSON object.

    The day is that of the batch's first attempt, not of the record; it is noted next to the lines, so a replay after
    midnight keeps it. Writing a batch name again replaces that batch's directories and no others: new batches append,
    a replay repeats nothing. Names must differ between writers that share a directory.
    """
    day = remembered(posts.sparkSession, f"{out_dir.rstrip('/')}/_batches/{batch}", day or run_day())
    raw = F.coalesce(F.try_parse_json("raw"), F.col("raw").cast("variant"))
    columns = [raw.alias("raw") if name == "raw" else F.col(name) for name in POST.names]
    rows = posts.select(
        *columns, F.col("source").alias("for_source"), F.lit(day).alias("day"), F.lit(batch).alias("batch")
    )
    (
        rows.hint("rebalance", F.col("for_source"))
        .sortWithinPartitions(*DIRECTORIES)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy(*DIRECTORIES)
        .json(out_dir)
    )


def read_jsonl(spark: SparkSession, out_dir: str) -> DataFrame:
    """Read the lines back. Tests on `for_source`, `day` and `batch` skip directories."""
    folders = [T.StructField(name, T.StringType()) for name in DIRECTORIES]
    return spark.read.schema(T.StructType(list(POST) + folders)).json(out_dir)
