"""Session settings, the shared work folder, and size-aware helpers."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings the jobs are written for. Partition counts are left to the cluster and to adaptive execution.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
}

WORK_DIR_SETTING = "spark.checkpoint.dir"
_OWN_WORK_DIR = "spark.mentionflow.work.dir"


def build_session(app: str = "mentionflow", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for intermediate tables.

    Only a local session without that setting gets a folder of its own; on a cluster its absence is an error, since
    a folder of one machine would be lost with that machine.
    """
    root = spark.conf.get(WORK_DIR_SETTING, None) or spark.conf.get(_OWN_WORK_DIR, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{WORK_DIR_SETTING} must name a shared folder")
    root = tempfile.mkdtemp(prefix="mentionflow-")
    spark.conf.set(_OWN_WORK_DIR, root)
    return root


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the work folder that no other run uses."""
    return f"{work_dir(spark)}/mentionflow/{label}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _hadoop_path(spark, path)
    return files.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    files, target = _hadoop_path(spark, path)
    files.delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none when there is no such folder."""
    files, target = _hadoop_path(spark, path)
    return sorted(found.getPath().getName() for found in files.listStatus(target)) if files.exists(target) else []


def remembered(spark: SparkSession, path: str, value: str) -> str:
    """The value a small file holds; it is written with `value` if it does not exist yet."""
    files, target = _hadoop_path(spark, path)
    if not files.exists(target):
        out = files.create(target, False)
        out.writeUTF(value)
        out.close()
        return value
    source = files.open(target)
    try:
        return source.readUTF()
    finally:
        source.close()


def staged(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write a result to the work folder and read it back: later steps neither recompute it nor lose it."""
    path = new_path(df.sparkSession, label)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def local_rows(spark: SparkSession, rows: Sequence[dict], ddl: str) -> DataFrame:
    """A small driver-side list as a DataFrame made of constants, without a Python worker."""
    packed = F.from_json(F.lit(json.dumps(list(rows), ensure_ascii=False)), f"array<struct<{_struct_ddl(ddl)}>>")
    return spark.range(0, 1, 1, 1).select(F.inline(packed))


def _struct_ddl(ddl: str) -> str:
    return ",".join(":".join(part.split(None, 1)) for part in ddl.split(","))


#: Scans of at most this size are dealt out to all cores; larger ones are never moved.
SPREAD_BYTES = 256 * 1024 * 1024


def spread_scan(scan: DataFrame) -> DataFrame:
    """Give every core a share of a small scan that heavy per-row work follows.

    A file with few row groups would otherwise keep one core busy. The shuffle this adds is bounded by `SPREAD_BYTES`,
    whatever the cluster's size; scans that fill the cores with full-size splits are returned as they are.
    """
    spark = scan.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return scan.repartition(cores) if scan_bytes(scan) < min(cores * split, SPREAD_BYTES) else scan


def scan_bytes(df: DataFrame) -> int:
    """The size of the files a result is read from, each time they are read; nothing is run for it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(at).stats().sizeInBytes())) for at in range(leaves.size()))


#: Bytes of scanned files for each file that is landed, so that no task takes more however large the input is.
LANDED_BYTES = 32 * 1024 * 1024


def landed_files(df: DataFrame, least: int) -> int:
    """How many files to land a result in: `least`, or as many times more as its size asks for."""
    return least * max(1, -(-scan_bytes(df) // (least * LANDED_BYTES)))
