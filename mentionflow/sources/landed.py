"""Readers of landed data, in batch and as streams, always with a given layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_landed(spark: SparkSession, path: str | list[str], schema: T.StructType, file_format: str = "parquet") -> DataFrame:
    return spark.read.schema(schema).format(file_format).load(path)


def stream_landed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)
