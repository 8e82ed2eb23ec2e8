"""Whitening against eigenvectors of an exactly summed covariance."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mentionflow.llm import whitening


def plain(vectors, most=32):
    whole = [[math.floor(64 * c) + 1_000_000 for c in vector] for vector in vectors]
    count, size = len(whole), len(whole[0])
    sums = [sum(row[at] for row in whole) for at in range(size)]
    off = np.array([[count * row[at] - sums[at] for at in range(size)] for row in whole], object)
    deviations = (off**2).sum(1).tolist()
    centred = off.astype(float) / count
    values, axes = np.linalg.eigh((off.T @ off).astype(float) / count**3)
    order = np.argsort(-values)[:most]
    return deviations, centred, values[order], axes[:, order], values.sum()


def check(rows, vectors, most=32):
    """Rows by key, against the plain result; vectors by key."""
    keys = sorted(vectors)
    deviations, centred, values, axes, trace = plain([vectors[key] for key in keys], most)
    size = max(row.component for row in rows)
    got = {(row.vec_id, row.component): row for row in rows}
    assert len(got) == len(rows) == len(keys) * size
    white = np.array([[got[key, at].whitened for at in range(1, size + 1)] for key in keys])
    for at in range(size):
        want = centred @ axes[:, at] / np.sqrt(values[at])
        sign = np.sign(want @ white[:, at])
        assert np.allclose(white[:, at], sign * want, atol=1e-6)
        assert got[keys[0], at + 1].explained == pytest.approx(values[at] / trace, rel=1e-9)
    assert [got[key, 1].deviation for key in keys] == deviations
    assert {row.n for row in rows} == {len(keys)}
    off = np.abs(white.T @ white / len(keys) - np.eye(size)).max()
    assert {row.identity_error for row in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-8 and off < 1e-8
    return size


def test_query_on_small_tables(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    vectors = {row.vec_id: [float(c) for c in row.embedding] for row in table.collect()}
    assert check(whitening.op12_whitening(spark, "/root/testdata/sf0.001").collect(), vectors) == 32


def test_ill_conditioned_and_dependent(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(400, 6)) * np.array([1e6, 1e4, 100, 10, 1, 0.5])
    whole = np.floor(base * 64)
    # a dimension that repeats another one, one that is constant, one that is a sum
    full = np.column_stack([whole, whole[:, 0], np.full(400, 7), whole[:, 0] + whole[:, 1]]) / 64
    table = spark.createDataFrame([(at, row.tolist()) for at, row in enumerate(full)], "vec_id long, embedding array<double>")
    assert check(whitening.whiten(table).collect(), {at: row.tolist() for at, row in enumerate(full)}) == 6
    assert check(whitening.whiten(table, components=3).collect(), {at: row.tolist() for at, row in enumerate(full)}, 3) == 3


def test_awkward_rows(spark):
    draw = np.random.default_rng(5)
    good = {at: draw.normal(size=3).tolist() for at in range(40)}
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, math.nan, 0.0]), (103, [math.inf, 0.0, 0.0]), (104, [1.0, 2.0]), (105, [])]
    table = spark.createDataFrame([*good.items(), *bad], "vec_id long, embedding array<double>").withColumn("key", F.lit(1)).withColumn("n", F.lit("x"))
    assert check(whitening.whiten(table).collect(), good) == 3
    assert whitening.whiten(table.limit(0)).count() == 0 and whitening.whiten(table.filter("vec_id = 3")).count() == 0
    assert whitening.whiten(table.filter("vec_id >= 100")).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0])] * 5, "vec_id long, embedding array<double>")
    assert whitening.whiten(same).count() == 0
    twice = whitening.whiten(table.filter("vec_id < 2").unionAll(table.filter("vec_id < 2")).withColumn("vec_id", F.lit(None).cast("long")))
    rows = twice.collect()
    assert len(rows) == 4 and {row.vec_id for row in rows} == {None} and sorted(round(row.whitened, 9) for row in rows) == [-1, -1, 1, 1]


def test_large_numbers_stay_exact(spark):
    rows = [(1, [1e9, 3.0]), (2, [-1e9, 5.0]), (3, [5.0, 1e12])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    exact, *_ = plain([vector for _, vector in rows])
    assert {row.vec_id: row.deviation for row in got} == dict(zip((1, 2, 3), exact))
    far = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 4.0])], "vec_id long, embedding array<double>")
    assert {row.n for row in whitening.whiten(far).collect()} == {3}
