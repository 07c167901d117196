"""Encoded rows are written in short blocks, so that a task reads a bounded part of its file at a time."""

from __future__ import annotations

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from logsonde.functions import linear_models
from logsonde.functions.linear_models import Encoding, encode, fit_ridge, predict_test
from logsonde.functions.storage import materialize

ROWS = 30_000
READ_AT_ONCE = 10_000  # blocks: Spark's batch of rows for Python


@pytest.fixture(scope="module")
def rows(spark):
    """One partition, so one file, with more rows than are expanded at a time."""
    e = F.col("id")
    return spark.range(ROWS, numPartitions=1).select(
        (e % 5 == 0).alias("is_test"), (e % 97).cast("double").alias("x"), F.concat(F.lit("c"), e % 3).alias("c"), (2.0 * (e % 97) + e % 3).alias("v")
    )


def lengths(blocks):
    total = F.length("numbers") + F.length("codes") + F.length("targets")
    return blocks.agg(F.max(total), F.sum("n"), F.sum(F.length("targets") / 8)).first()


CASES = {
    "both": Encoding({"x": 48.0}, {"c": ["c0", "c1", "c2"]}, {"c": "c0"}),
    "numbers": Encoding({"x": 48.0}, {}, {}),
    "categories": Encoding({}, {"c": ["c0", "c1", "c2"]}, {"c": "c0"}),
}


@pytest.mark.parametrize("name", CASES)
def test_blocks_are_short_and_hold_all_rows(rows, name):
    encoding = CASES[name]
    blocks = encode(rows, encoding, ["v"])
    longest, n, targets = lengths(blocks)
    assert longest * READ_AT_ONCE <= 1 << 25, "a batch of blocks has to fit a small worker"
    assert (n, targets) == (ROWS, ROWS)
    at = np.array([i for i in range(ROWS) if i % 5])
    x = np.zeros((len(at), encoding.width + 1))
    x[:, -1] = 1
    if encoding.medians:
        x[:, 0] = at % 97 - 48.0
    if encoding.categories:
        x[np.arange(len(at)), len(encoding.medians) + at % 3] = 1
    y = 2.0 * (at % 97) + at % 3
    penalty = np.diag([1.0] * encoding.width + [0.0])
    want = np.linalg.solve(x.T @ x + penalty, x.T @ y)
    fit = fit_ridge(blocks, encoding, 0)
    np.testing.assert_allclose(fit.coefficients, want, rtol=1e-7, atol=1e-6)
    got = predict_test(blocks, encoding, ["v"], {}, {"v": fit})
    assert got.count() == ROWS // 5
    assert got.agg(F.sum("v")).first()[0] == sum(2.0 * (i % 97) + i % 3 for i in range(0, ROWS, 5))


def test_a_long_row_is_a_block_of_its_own(spark):
    names = [f"x{i}" for i in range(200)]
    df = spark.range(50, numPartitions=1).select((F.col("id") < 10).alias("is_test"), *[(F.col("id") * i).cast("double").alias(c) for i, c in enumerate(names)], F.col("id").alias("v"))
    blocks = encode(df, Encoding(dict.fromkeys(names, 0.0), {}, {}), ["v"])
    assert [r["n"] for r in blocks.collect()] == [1] * 50


def test_row_groups_are_small(rows, monkeypatch):
    monkeypatch.setattr(linear_models, "GROUP_BYTES", 1 << 14)
    blocks = encode(rows.withColumn("x", F.rand(3)), CASES["both"], ["v"])
    groups = [pq.ParquetFile(f.removeprefix("file:")).metadata.num_row_groups for f in blocks.inputFiles()]
    assert len(groups) == 1 and groups[0] > 3


def test_writer_options_change_no_rows(rows):
    plain = materialize(rows, "plain")
    small = materialize(rows, "small", options={"parquet.block.size": 1 << 14})
    assert plain.exceptAll(small).count() == small.exceptAll(plain).count() == 0
