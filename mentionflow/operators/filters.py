"""Row tests on computed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """Keep rows that pass a test on computed columns, without computing those columns twice.

    A plain filter is pushed below the projection that defines its columns, and their expressions are then evaluated
    once per use in the filter and again in the projection. Exploding an array of no or one element filters the same
    rows inside the same compiled stage, but stays above the projection. Tests on stored columns should use `filter`,
    which reaches the scan.
    """
    flag = F.array_compact(F.array(F.when(condition, F.lit(True))))
    return df.select("*", F.explode(flag).alias("_keep")).drop("_keep")
