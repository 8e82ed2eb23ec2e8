"""The keys of the stored posts, apart from the posts, so that an insert reads what its batch needs and no more.

Keys lie in hash buckets, sorted by a 64-bit hash with a Parquet Bloom filter on it. A batch of up to `LOOKUP_KEYS` keys
names its buckets and hashes to the scan: other buckets are not even listed, and row groups whose filter or statistics
exclude all hashes are skipped. Larger batches are joined with their buckets, by hash. Small batches add one file to `recent`,
which every lookup opens; after `RECENT_FILES` of them they are dealt into the buckets. `compact_keys` sizes the number
of buckets by the number of keys, so the bytes a batch reads depend on the batch and not on the table.

Consistency with the table, whose writes are not one step: the rows of a batch are first stored under its name in
`pending`, then appended to the table, then their keys are added, then `pending` is cleared. What a crash left there is
compared with the table itself before the next insert, so no stored row lacks its key and no key its row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionflow.schema import POST_KEY
from mentionflow.session import child_names, delete_path, path_exists, remembered

LOOKUP_KEYS = 1_000
RECENT_FILES = 32
KEYS_PER_BUCKET = 100_000
FIRST_BUCKETS = 16
_KEY = "source string, post_id string, key long"
#: Values of one list that reaches the scan as it is; a longer one would become a range.
_LISTED = 10


def keys_path(path: str) -> str:
    return f"{path.rstrip('/')}-keys"


def pending_path(path: str, batch: str) -> str:
    return f"{keys_path(path)}/pending/{batch}"


def _hash(source: str = "source", post_id: str = "post_id"):
    return F.xxhash64(source, post_id)


def _generation(spark: SparkSession, path: str) -> tuple[str, int, int] | None:
    """Folder, number and buckets of the newest finished generation of buckets."""
    found = []
    for name in child_names(spark, keys_path(path)):
        if name.startswith("generation-") and path_exists(spark, f"{keys_path(path)}/{name}/_READY"):
            number, buckets = map(int, name.split("-")[1:])
            found.append((number, buckets, f"{keys_path(path)}/{name}"))
    if not found:
        return None
    number, buckets, folder = max(found)
    return folder, number, buckets


def _with_filter(count: int) -> dict[str, str]:
    """Writer options for a Bloom filter on the hash for so many keys; a dictionary would take its place."""
    return {"parquet.bloom.filter.enabled#key": "true", "parquet.bloom.filter.expected.ndv#key": str(count), "parquet.enable.dictionary#key": "false"}


def _to_buckets(keys: DataFrame, folder: str, buckets: int) -> None:
    dealt = keys.withColumn("bucket", F.pmod("key", F.lit(buckets)).cast("int")).repartition("bucket").sortWithinPartitions("bucket", "key")
    dealt.write.mode("append").partitionBy("bucket").options(**_with_filter(KEYS_PER_BUCKET)).parquet(folder)


def _rebuild(keys: DataFrame, path: str, number: int, count: int) -> None:
    buckets = max(FIRST_BUCKETS, 1 << (max(1, count // KEYS_PER_BUCKET) - 1).bit_length())
    folder = f"{keys_path(path)}/generation-{number}-{buckets}"
    delete_path(keys.sparkSession, folder)  # an unfinished attempt
    _to_buckets(keys, folder, buckets)
    remembered(keys.sparkSession, f"{folder}/_READY", "")


def _read(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    there = [path for path in paths if path_exists(spark, path)]
    return spark.read.schema(_KEY).parquet(*there) if there else None


def _recent(path: str) -> str:
    return f"{keys_path(path)}/recent"


def _recent_files(spark: SparkSession, path: str) -> list[str]:
    return [f"{_recent(path)}/{name}" for name in child_names(spark, _recent(path)) if path_exists(spark, f"{_recent(path)}/{name}/_SUCCESS")]


def ensure_keys(table: DataFrame, path: str) -> None:
    """Make the keys of a table that has none yet, and clear up after inserts that did not finish."""
    spark = table.sparkSession
    if _generation(spark, path) is None:
        keys = table.select(*POST_KEY).distinct().withColumn("key", _hash())
        _rebuild(keys, path, 1, keys.count())
    for batch in child_names(spark, f"{keys_path(path)}/pending"):
        left = pending_path(path, batch)
        if path_exists(spark, f"{left}/_SUCCESS"):
            rows = spark.read.parquet(left)
            add_keys(in_table(rows, table), path, f"recovered-{batch}")
        delete_path(spark, left)


def in_table(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The keys of a batch that the table itself has, read from the key columns of the batch's sources."""
    sources = rows.select("source").distinct()
    return rows.select(*POST_KEY).join(table.select(*POST_KEY).join(sources, "source", "left_semi"), list(POST_KEY), "left_semi")


def add_keys(rows: DataFrame, path: str, batch: str) -> None:
    """Add the keys of a stored batch; a name used again adds nothing twice."""
    spark = rows.sparkSession
    keys = rows.select(*POST_KEY).withColumn("key", _hash())
    folder, _, buckets = _generation(spark, path)
    size = keys.limit(LOOKUP_KEYS + 1).count()
    if not size:
        return
    if size > LOOKUP_KEYS:
        return _to_buckets(keys, folder, buckets)
    own = f"{_recent(path)}/{batch}"
    delete_path(spark, own)
    keys.coalesce(1).sortWithinPartitions("key").write.options(**_with_filter(LOOKUP_KEYS)).parquet(own)
    files = _recent_files(spark, path)
    if len(files) > RECENT_FILES:
        _to_buckets(_read(spark, files), folder, buckets)
        for used in files:  # a crash before this leaves keys in both places, which changes nothing
            delete_path(spark, used)


def _any_of(hashes: list[int]) -> Column:
    """A test for some hashes in a form that reaches the scan: short lists, joined by a balanced tree of ORs."""
    tests = [F.col("key").isin(hashes[at : at + _LISTED]) for at in range(0, len(hashes), _LISTED)]
    while len(tests) > 1:
        tests = [reduce(Column.__or__, tests[at : at + 2]) for at in range(0, len(tests), 2)]
    return tests[0]


def stored_among(posts: DataFrame, path: str) -> DataFrame | None:
    """The stored keys that a batch of posts may have, a superset of those it has; none where nothing is stored.

    The driver gets the hashes of a batch of up to `LOOKUP_KEYS` keys, of a larger one the numbers of its buckets.
    """
    spark = posts.sparkSession
    folder, _, buckets = _generation(spark, path)
    recent = _recent_files(spark, path)
    if not recent and not any(name.startswith("bucket=") for name in child_names(spark, folder)):
        return None  # nothing is stored yet, so the batch is not read for its keys
    hashed = posts.select(_hash().alias("key"))
    hashes = [row["key"] for row in hashed.distinct().limit(LOOKUP_KEYS + 1).collect()]
    few = len(hashes) <= LOOKUP_KEYS
    wanted = {key % buckets for key in hashes} if few else {row["bucket"] for row in hashed.select(F.pmod("key", F.lit(buckets)).alias("bucket")).distinct().collect()}
    keys = _read(spark, [f"{folder}/bucket={bucket}" for bucket in sorted(wanted)] + recent)
    if keys is None or not hashes:
        return None
    return (keys.filter(_any_of(hashes)) if few else keys.join(hashed, "key", "left_semi")).select(*POST_KEY)


def compact_keys(spark: SparkSession, path: str) -> None:
    """One file set per bucket again, and as many buckets as the number of keys asks for. Run it while nothing inserts."""
    found = _generation(spark, path)
    if found is None:
        return
    folder, number, _ = found
    recent = _recent_files(spark, path)
    keys = _read(spark, [f"{folder}/{name}" for name in child_names(spark, folder) if name.startswith("bucket=")] + recent)
    if keys is None:
        return
    keys = keys.distinct()
    _rebuild(keys, path, number + 1, keys.count())
    for used in [folder, *recent]:
        delete_path(spark, used)
