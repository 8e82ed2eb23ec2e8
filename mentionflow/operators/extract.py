"""HTML extraction as one Spark job: pages with their rule in, one row per item out."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentionflow.operators import selectors

# The page helper travels inside the task, so workers do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(selectors)

#: Rows handed back to the JVM at a time, so that one page with many items does not build one huge batch.
ROWS_PER_BATCH = 2048

_VALUES = pa.list_(pa.list_(pa.string()))


def extract_items(pages: DataFrame, item_selector: str, field_selectors: list[str]) -> DataFrame:
    """Apply the rule each page row carries and return its items.

    `item_selector` and `field_selectors` name columns that hold selectors. The result keeps the other columns and
    adds `item_ord` (document order), `values` (per field, everything it takes) and `error`. A page that has no item
    or cannot be read gives one row with a null `item_ord`, so page counts and error rates need no second pass. No
    shuffle: a page's items come out of the task that read the page.
    """
    hidden = {"html", item_selector, *field_selectors}
    kept = [name for name in pages.columns if name not in hidden]
    schema = T.StructType(
        [pages.schema[name] for name in kept]
        + [
            T.StructField("item_ord", T.IntegerType()),
            T.StructField("values", T.ArrayType(T.ArrayType(T.StringType()))),
            T.StructField("error", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = selectors.PageReader()
        for batch in batches:
            yield from _batch_items(reader, batch, kept, item_selector, field_selectors)

    return pages.mapInArrow(run, schema)


def _batch_items(reader, batch, kept, item_selector, field_selectors) -> Iterator[pa.RecordBatch]:
    origin: list[int] = []
    order: list[int | None] = []
    values: list[list[list[str]] | None] = []
    errors: list[str | None] = []

    def add(*cells) -> None:
        for column, cell in zip((origin, order, values, errors), cells):
            column.append(cell)

    def packed() -> pa.RecordBatch:
        rows = pa.array(origin, pa.int64())
        columns = [batch.column(name).take(rows) for name in kept]
        columns += [pa.array(order, pa.int32()), pa.array(values, _VALUES), pa.array(errors, pa.string())]
        result = pa.RecordBatch.from_arrays(columns, names=[*kept, "item_ord", "values", "error"])
        for column in (origin, order, values, errors):
            column.clear()
        return result

    html = batch.column("html")
    item = batch.column(item_selector)
    fields = [batch.column(name) for name in field_selectors]
    for row in range(batch.num_rows):
        items, error = _page_items(
            reader, html[row].as_py(), item[row].as_py(), [column[row].as_py() for column in fields]
        )
        if not items:
            add(row, None, None, error)
        for position, found in enumerate(items):
            add(row, position, found, None)
            if len(origin) >= ROWS_PER_BATCH:
                yield packed()
    if origin:
        yield packed()


def _page_items(reader, html, item_selector, field_selectors):
    if html is None:
        return [], "no content"
    try:
        return reader.items(html, item_selector, field_selectors), None
    except Exception as problem:  # one bad page or rule must not end the job
        return [], f"{type(problem).__name__}: {problem}"


def first_value(field: int):
    """Column: the first value of a field; empty when the field took nothing."""
    return F.coalesce(F.try_element_at(F.get("values", F.lit(field)), F.lit(1)), F.lit(""))


def all_values(field: int):
    return F.coalesce(F.get("values", F.lit(field)), F.array().cast("array<string>"))


def source_health(extracted: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Share of unreadable pages per source, and whether the source should be left out of the run.

    One pass with partial aggregation: the first item row or the marker row stands for its page.
    """
    page = F.coalesce(F.col("item_ord"), F.lit(0)) == 0
    return (
        extracted.filter(page)
        .groupBy("source")
        .agg(F.count("*").alias("pages"), F.count("error").alias("failed"))
        .withColumn("error_rate", F.col("failed") / F.col("pages"))
        .withColumn("is_open", F.col("error_rate") > F.lit(threshold))
    )
