"""Embedding whitening by shifted CholeskyQR.

Entries become whole numbers, so sums and squared deviations are exact. The centred rows are never stored: every pass
reads the vectors, centres them and solves against the triangular factor found so far, and adds up the Gram matrix of
what comes out. A pass leaves one matrix per task, summed cell by cell in Spark, so the driver gets one `d` x `d` matrix
whatever the number of rows. Its Cholesky factor (of the matrix plus a small shift, which keeps it positive where
directions are nearly or fully dependent) is multiplied onto the factor found so far; passes go on until the rows are
orthonormal to rounding. Singular values and right singular vectors of the composed factor are those of the centred
rows, hence the standard deviations and the components of the covariance, at the accuracy of a QR of the rows and not
of their squared matrix. A last pass measures the covariance of what is returned.

Results: rows whose vector is null, or holds null or non-finite entries, take no part, nor do vectors of another length
than the commonest one (of two equally common lengths the longer); a null or repeated id is carried like any other, and
repeated rows weigh as often as they occur. Components of no variance are not returned, so there are fewer than asked
where there are fewer dimensions or the rows are dependent, and no rows where all vectors are equal or none is left.
Whole numbers saturate at 2^62; a squared deviation of more than 38 digits is null, in the registered query one that no
long can hold. Columns other than the id and the vector play no part.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
#: Two passes do for vectors without nearly dependent directions.
MAX_PASSES = 8
#: Singular values below this share of the largest are rounding of dependent directions.
LEAST_SHARE = 1e-12
_LARGEST = 1 << 62


def finite_vectors(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """`key` and `vector` of the rows that take part, entries as doubles."""
    rows = embeddings.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    whole = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    rows = rows.filter(F.col("vector").isNotNull() & whole)
    common = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return rows.filter(F.size("vector") == (common["size"] if common else 0))


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """The entries as whole numbers."""
    return np.clip(np.floor(SCALE * vectors), -float(_LARGEST), float(_LARGEST)).astype(np.int64) + OFFSET


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column(0), whole_numbers(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """How many vectors there are, and their exact sum per dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, whole in _matrices(batches):
            # in two halves of 32 bits, so that no sum of a batch overflows
            high, low = (whole >> 32).sum(0).tolist(), (whole & 0xFFFFFFFF).sum(0).tolist()
            columns = [list(range(len(high))), high, low, [len(whole)] * len(high)]
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], ["dim", "high", "low", "n"])

    parts = rows.mapInArrow(work, "dim long, high long, low long, n long").groupBy("dim")
    exact = [F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in ("high", "low")]
    found = sorted(parts.agg(*exact, F.sum("n").alias("n")).collect())  # one row per dimension
    return (found[0]["n"], [(int(row["high"]) << 32) + int(row["low"]) for row in found]) if found else (0, [])


class Centre:
    """Centred rows: the whole part of the mean is taken off exactly, the rest in double precision."""

    def __init__(self, count: int, sums: list[int]) -> None:
        self.count, self.sums = count, sums
        self.whole = np.array([total // count for total in sums], np.int64)
        self.rest = np.array([total % count / count for total in sums])

    def centred(self, whole: np.ndarray) -> np.ndarray:
        if whole.max() < 1 << 61 and whole.min() > -(1 << 61):  # such differences fit a long, as do the means
            return (whole - self.whole).astype(float) - self.rest
        return (whole.astype(float) - self.whole.astype(float)) - self.rest

    def deviations(self, whole: np.ndarray) -> list[int | None]:
        """The exact sum of (n*x - S)^2 over the dimensions of each row."""
        most = int(np.abs(self.centred(whole)).max() + 2) * self.count
        if most < 1 << 62 and most * most * whole.shape[1] < 1 << 62:
            rest = np.array([total % self.count for total in self.sums], np.int64)
            return ((self.count * (whole - self.whole) - rest) ** 2).sum(1).tolist()
        exact = ((self.count * whole.astype(object) - np.array(self.sums, object)) ** 2).sum(1)
        return [value if value < 10**38 else None for value in exact.tolist()]


def _gram(rows: DataFrame, project: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The Gram matrix of the projected rows: one matrix per task, added up cell by cell."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for _, whole in _matrices(batches):
            part = project(whole)
            total += part.T @ part
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total.tolist(), pa.list_(pa.float64()))], ["row", "cells"])

    parts = rows.mapInArrow(work, "row long, cells array<double>").select("row", F.posexplode("cells").alias("at", "cell"))
    gram = np.zeros((size, size))
    for row in parts.groupBy("row", "at").agg(F.sum("cell").alias("cell")).collect():  # size x size cells
        gram[row["row"], row["at"]] = row["cell"]
    return (gram + gram.T) / 2


def _factor(gram: np.ndarray) -> np.ndarray:
    """The upper triangular Cholesky factor of a Gram matrix, shifted where it is not safely positive."""
    size = len(gram)
    values = np.linalg.eigvalsh(gram)
    shift = 11 * size * (size + 1) * np.finfo(float).eps * float(values[-1])
    for step in (0, 1, 10, 100, 1000):
        if step or values[0] > shift:
            with contextlib.suppress(np.linalg.LinAlgError):
                return np.linalg.cholesky(gram + step * shift * np.eye(size)).T
    raise ArithmeticError("the Gram matrix has no Cholesky factor")


def factorise(rows: DataFrame, centre: Centre, max_passes: int = MAX_PASSES) -> tuple[np.ndarray, np.ndarray]:
    """The triangular factor R of the centred rows on some orthonormal axes, and those axes as columns.

    The axes are those of the vectors until directions turn out to be dependent; these are then left out, as solving
    against a factor that holds them would spoil the others.
    """
    axes = np.eye(len(centre.sums))
    found: np.ndarray | None = None
    before = math.inf
    for _ in range(max_passes):

        def project(whole: np.ndarray, factor=found, axes=axes) -> np.ndarray:
            part = centre.centred(whole) @ axes
            return part if factor is None else np.linalg.solve(factor.T, part.T).T

        gram = _gram(rows, project, axes.shape[1])
        if not gram.any():
            return gram, axes
        off = math.inf if found is None else np.abs(gram - np.eye(len(gram))).max()
        new = _factor(gram)
        found = new if found is None else new @ found
        if off < 1e-12 or off < 1e-8 and off > before / 2:
            break
        before = off
        _, singular, right = np.linalg.svd(found)
        if singular[-1] <= LEAST_SHARE * singular[0]:
            kept = right[singular > LEAST_SHARE * singular[0]].T
            found = np.linalg.qr(found @ kept, mode="r")
            axes = axes @ kept
    return found, axes


class Whitening:
    """A fitted whitening: the mean, the components and their variances."""

    def __init__(self, centre: Centre, factor: np.ndarray, axes: np.ndarray, most: int) -> None:
        _, singular, right = np.linalg.svd(factor)
        kept = [at for at in range(min(most, len(singular))) if singular[at] > LEAST_SHARE * singular[0]]
        self.centre = centre
        self.variances = singular[kept] ** 2 / centre.count
        self.explained = singular[kept] ** 2 / (singular**2).sum() if kept else np.zeros(0)
        self.components = right[kept] @ axes.T

    def apply(self, whole: np.ndarray) -> np.ndarray:
        return self.centre.centred(whole) @ self.components.T / np.sqrt(self.variances)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on all rows of `finite_vectors`; none if there are none."""
    count, sums = _sums(rows)
    if not count:
        return None
    centre = Centre(count, sums)
    return Whitening(centre, *factorise(rows, centre), components)


def identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """The largest entry by which the covariance of the whitened rows differs from the identity."""
    size = len(fitted.variances)
    return float(np.abs(_gram(rows, fitted.apply, size) / fitted.centre.count - np.eye(size)).max())


_RESULT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per vector and component; the covariance is fitted on all vectors that take part."""
    rows = finite_vectors(embeddings, vector, key)
    kind = rows.schema["key"].dataType.simpleString()
    fitted = fit(rows, components)
    size = len(fitted.variances) if fitted else 0
    if not size:
        return embeddings.sparkSession.createDataFrame([], f"`{key}` {kind}, {_RESULT}")
    error = identity_error(rows, fitted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.arange(1, size + 1, dtype=np.int32)
        for keys, whole in _matrices(batches):
            count = len(whole)
            columns = [
                keys.take(pa.array(np.repeat(np.arange(count), size))),
                pa.array(np.tile(numbers, count)),
                pa.array(np.full(count * size, fitted.centre.count)),
                pa.array(fitted.centre.deviations(whole), pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(count), size))),
                pa.array(fitted.apply(whole).ravel()),
                pa.array(np.tile(fitted.explained, count)),
                pa.array(np.full(count * size, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(work, f"`{key}` {kind}, {_RESULT}")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on the 32 leading components of all of them."""
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS long)"))
