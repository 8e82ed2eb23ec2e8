"""Approximate nearest neighbours by shifted space-filling curves.

Equal vectors are one node, which stands for the smallest ids among them; that is exact, as they are equally far from
everything. Every node is projected to a few dimensions, shifted, and given its place on a Hilbert curve, once per
ordering. A projection is scaled by its quantiles, read off a sample of `SAMPLE` nodes: a tight group gets as much of the
curve's side as it has members, and a vector far away no more than its share. Spark range-partitions the rows by (ordering, key), which fixes a rank per ordering without a global sort in one task. Ranks
are cut into blocks; a query goes to the blocks that its window of neighbouring ranks meets, and there the original
vectors are compared exactly. The best of all blocks and orderings are merged and ranked. A block has `BLOCK` rows
however many share a key, so repeated vectors never gather in one task.

The window is a share of all rows and at least `LEAST_WINDOW` rows: on vectors without low-dimensional structure a fixed
number of neighbours on a curve loses recall as the table grows. Where the structure allows, give a smaller share.

Results: vectors that are null, zero, of another length than most, or hold null or non-finite components take no part;
ties go to the smaller id; of repeated ids every row is a candidate but the query's own row; fewer candidates than asked
for are all returned; an empty table gives no rows. The result has its own four columns only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mentionflow.session import staged

ORDERINGS = 24
DIMENSIONS = 6
BITS = 10
WINDOW_SHARE = 0.025
LEAST_WINDOW = 256
BLOCK = 2048
#: Nodes the quantiles are read off, and how many quantiles; every node is indexed.
SAMPLE, QUANTILES = 20_000, 512
NEAREST = 10
QUERY_STEP = 100


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer cells (rows) with `bits` bits per dimension.

    Follows the published transform between axes and the transposed curve index, on all rows at once.
    """
    axes = [column.astype(np.uint64) for column in cells.T]
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for at, axis in enumerate(axes):
            set_ = (axis & bit) != 0
            swap = np.where(set_, np.uint64(0), (axes[0] ^ axis) & low)
            axes[0] = np.where(set_, axes[0] ^ low, axes[0] ^ swap)
            if at:
                axes[at] = axis ^ swap
    for at in range(1, len(axes)):
        axes[at] = axes[at] ^ axes[at - 1]
    flip = np.zeros(len(cells), np.uint64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((axes[-1] & np.uint64(1 << level)) != 0, np.uint64((1 << level) - 1), np.uint64(0))
    keys = np.zeros(len(cells), np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            keys = (keys << np.uint64(1)) | (((axis ^ flip) >> np.uint64(level)) & np.uint64(1))
    return keys.astype(np.int64)


def _projections(width: int, seed: int = 7) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each ordering a random orthonormal projection and a shift of the curve."""
    dims = min(DIMENSIONS, width)
    out = []
    for at in range(ORDERINGS):
        random = np.random.default_rng([seed, at])
        out.append((np.linalg.qr(random.normal(size=(width, dims)))[0], random.random(dims)))
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _flat(vectors: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Projected vectors; products that overflow count as the largest numbers."""
    with np.errstate(over="ignore", invalid="ignore"):
        return np.nan_to_num(vectors @ projection)


def _quantiles(sample: np.ndarray) -> list[np.ndarray]:
    """For each ordering the quantiles of its projected dimensions, as columns."""
    return [np.quantile(_flat(sample, projection), np.linspace(0, 1, QUANTILES), axis=0) for projection, _ in _projections(sample.shape[1])]


def _keyed(nodes: DataFrame, width: int, quantiles: list[np.ndarray]) -> DataFrame:
    """One row per node and ordering: ordering, key, node, whether it is asked for, vector."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        projections, shares = _projections(width), np.linspace(0, 1, QUANTILES)
        top = (1 << BITS) - 1
        for batch in batches:
            vectors = _matrix(batch.column(2), width)
            for at, (projection, shift) in enumerate(projections):
                flat = _flat(vectors, projection)
                flat = np.column_stack([np.interp(own, edges, shares) for own, edges in zip(flat.T, quantiles[at].T)])
                keys = hilbert_keys(((flat + shift) / 2 * top).astype(np.int64), BITS)  # half of the curve's side, shifted
                columns = [pa.array(np.full(len(keys), at, np.int32)), pa.array(keys), *batch.columns]
                yield pa.RecordBatch.from_arrays(columns, ["ordering", "key", "node", "asked", "vector"])

    return nodes.mapInArrow(work, "ordering int, key long, node long, asked boolean, vector array<double>")


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the partition and the position of each row among the partition's rows of its ordering."""
    part, seen = TaskContext.get().partitionId(), {}
    for batch in batches:
        orderings = batch.column(0).to_numpy()
        positions = np.empty(len(orderings), np.int64)
        for at in np.unique(orderings).tolist():
            own = np.flatnonzero(orderings == at)
            positions[own] = seen.get(at, 0) + np.arange(len(own))
            seen[at] = seen.get(at, 0) + len(own)
        columns = [batch.column(0), *batch.columns[2:], pa.array(np.full(len(orderings), part, np.int32)), pa.array(positions)]
        yield pa.RecordBatch.from_arrays(columns, ["ordering", "node", "asked", "vector", "part", "position"])


def _distances(vectors: np.ndarray, one: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt(((vectors - one) ** 2).sum(1))


def _nearest_in_block(most: int, window: int):
    def work(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(candidates):
            order = np.argsort(candidates["rank"].to_numpy())
            vectors = np.vstack(candidates["vector"].to_numpy())[order]
            ranks, nodes = candidates["rank"].to_numpy()[order], candidates["node"].to_numpy()[order]
            for query in queries.itertuples(index=False):
                near = slice(np.searchsorted(ranks, query.q_rank - window), np.searchsorted(ranks, query.q_rank + window, "right"))
                far = _distances(vectors[near], np.asarray(query.q_vector))
                own = nodes[near]
                best = np.arange(len(far))
                if len(far) > most:
                    best = np.flatnonzero(far <= np.partition(far, most - 1)[most - 1])  # ties with the last one stay
                out += [(query.q_node, own[at], far[at]) for at in best.tolist()]
        return pd.DataFrame(out, columns=["query_node", "node", "score"])

    return work


def nodes_of(usable: DataFrame, step: int, nearest: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors with their number (`node`, `asked`, `vector`), and up to `nearest + 1` of the members of each, by id."""
    distinct = usable.groupBy("vector").agg(F.min("row").alias("node"), F.max(F.col("vec_id") % step == 0).alias("asked"))
    distinct, _ = staged(distinct.select("node", "asked", "vector"), "vector-nodes")
    by_id = Window.partitionBy("vector").orderBy("vec_id", "row")
    first = usable.withColumn("place", F.row_number().over(by_id)).filter(F.col("place") <= nearest + 1)
    members, _ = staged(first.join(distinct.select("vector", "node"), "vector").select("node", "vec_id", "row"), "vector-members")
    return distinct, members


def search(vectors: DataFrame, step: int = QUERY_STEP, nearest: int = NEAREST, window_share: float = WINDOW_SHARE) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score` for every query whose id is divisible by `step`.

    `vectors` has `vec_id` and `embedding`, an array of numbers.
    """
    spark = vectors.sparkSession
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    usable = usable.filter(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0))
    usable, _ = staged(usable.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vector"), "vectors")
    most = usable.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = most["width"]
    usable = usable.filter(F.size("vector") == width)
    nodes, members = nodes_of(usable, step, nearest)
    count = nodes.count()
    window = max(LEAST_WINDOW, math.ceil(count * window_share))
    sample = nodes.select(F.xxhash64("node").alias("draw"), "vector").orderBy("draw").limit(SAMPLE).toArrow()  # bounded; a top-k
    quantiles = _quantiles(_matrix(sample.column("vector").combine_chunks(), width))

    keyed = _keyed(nodes, width, quantiles)
    parts = max(ORDERINGS, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = keyed.repartitionByRange(parts, "ordering", "key", "node").sortWithinPartitions("ordering", "key", "node")
    placed, _ = staged(
        ranged.mapInArrow(_positions, "ordering int, node long, asked boolean, vector array<double>, part int, position long"), "curve"
    )
    counts = placed.groupBy("ordering", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("ordering").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("ordering", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # at most one row per ordering and partition
    ranked = placed.join(F.broadcast(bases), ["ordering", "part"]).withColumn("rank", F.col("base") + F.col("position")).drop("part", "position", "base")
    last = F.floor((F.lit(count) - 1) / BLOCK)
    first_block = F.greatest(F.lit(0), F.floor((F.col("rank") - window) / BLOCK))
    last_block = F.least(last, F.floor((F.col("rank") + window) / BLOCK))
    queries = ranked.filter("asked").withColumn("block", F.explode(F.sequence(first_block, last_block)))
    queries = queries.select(*[F.col(name).alias(f"q_{name}") for name in queries.columns])
    blocks = ranked.withColumn("block", F.floor(F.col("rank") / BLOCK))
    found = (
        queries.groupBy("q_ordering", "q_block")
        .cogroup(blocks.groupBy("ordering", "block"))
        .applyInPandas(_nearest_in_block(nearest + 1, window), "query_node long, node long, score double")
    )
    once = found.groupBy("query_node", "node").agg(F.min("score").alias("score"))
    # nodes as near as the last of the nearest stay, so that their members are told apart by id
    near = Window.partitionBy("query_node").orderBy("score")
    near_nodes, _ = staged(once.withColumn("place", F.rank().over(near)).filter(F.col("place") <= nearest + 1).drop("place"), "near-nodes")
    asked = usable.filter(F.col("vec_id") % step == 0).join(nodes.filter("asked").select("vector", F.col("node").alias("query_node")), "vector")
    asked = asked.select("query_node", F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"))
    answers = near_nodes.join(members, "node").join(asked, "query_node").filter("row <> query_row")
    order = Window.partitionBy("query_row").orderBy("score", "vec_id", "row")
    best = answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest)
    return best.select("query_id", "rank", "vec_id", "score")


def op3_curve_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every hundredth vector of `embeddings`."""
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
