"""Row rules of the stored table, which Spark does not enforce by itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionflow.functions.times import parsed_time
from mentionflow.schema import REQUIRED, SOURCE_TYPES


def problems() -> Column:
    """What is wrong with a row, as an array in column order; empty for a valid row."""
    tests = [F.when(F.col(name).isNull(), F.lit(f"{name} is null")) for name in REQUIRED]
    tests.append(F.when(F.col("source") == "", F.lit("source is empty")))  # it names a directory of the table
    known = F.col("source_type").isin(*SOURCE_TYPES)
    tests.append(F.when(~known, F.lit("source_type is not social or web")))
    time = F.col("scraped_at").cast("string")
    tests.append(F.when(time.isNotNull() & parsed_time(time).isNull(), F.lit("scraped_at is not a time")))
    return F.array_compact(F.array(*tests))


def _reasons(posts: DataFrame) -> Column:
    """The problems of a row, and what its source says went wrong with it (`problem`), where there is such a column."""
    return F.array_compact(F.concat(F.array("problem"), problems())) if "problem" in posts.columns else problems()


def with_problems(posts: DataFrame) -> DataFrame:
    return posts.withColumn("reason", _reasons(posts)).drop("problem")


def valid_rows(posts: DataFrame) -> DataFrame:
    return posts.filter(F.size(_reasons(posts)) == 0).drop("problem")


def rejected_rows(posts: DataFrame) -> DataFrame:
    return with_problems(posts).filter(F.size("reason") > 0)
