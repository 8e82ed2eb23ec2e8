"""Optional database sink over JDBC; used only when a URL is configured."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionflow.operators.dedup import not_stored
from mentionflow.sinks.table import to_stored

# Fixed value: most connections of the pool.
MAX_CONNECTIONS = 10

DATABASE_COLUMNS = (
    "source", "source_type", "keyword", "post_id", "text", "url", "author", "created_at", "lang", "raw", "scraped_at",
)


def connection_options(url: str, table: str, **extra: str) -> dict[str, str]:
    """JDBC options: batched inserts over at most as many connections as the pool had."""
    options = {"url": url, "dbtable": table, "batchsize": "5000", "numPartitions": str(MAX_CONNECTIONS)}
    options.update(extra)
    return options


def key_predicates(parts: int = MAX_CONNECTIONS, bucket: str = "mod(abs(hashtext(post_id)::bigint), {parts})") -> list[str]:
    """Disjoint predicates that split a key scan of the database over several connections."""
    expression = bucket.format(parts=parts)
    return [f"{expression} = {part}" for part in range(parts)]


def read_database(spark: SparkSession, options: Mapping[str, str], predicates: list[str] | None = None) -> DataFrame:
    """The stored posts of the database, read over one connection per predicate. Column pruning reaches the database."""
    properties = {key: value for key, value in options.items() if key not in ("url", "dbtable", "numPartitions")}
    parts = predicates or key_predicates()
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=parts, properties=properties)


def insert_database(posts: DataFrame, options: Mapping[str, str], known: DataFrame | None = None) -> None:
    """Append the posts the database does not hold. `posts` must be free of duplicates.

    The database makes its own id and leaves the sentiment empty. For JSON and enum columns the URL of a PostgreSQL
    database needs `stringtype=unspecified`.
    """
    stored = known if known is not None else read_database(posts.sparkSession, options)
    rows = to_stored(not_stored(posts, stored)).select(*DATABASE_COLUMNS)
    rows.write.format("jdbc").options(**options).mode("append").save()
