"""Trends over chunk borders, quantile cells and fits, against plain versions."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logsonde.functions.quantiles import CELLS, cells_of, quantiles
from logsonde.operators import trends


def plain_trends(values, settings):
    """(smooth, increase, trend) of one system's buckets in order."""
    w, smooth = settings.smooth_window, []
    roll = np.median if settings.agg == "median" else np.mean
    for i in range(len(values)):
        smooth.append(float(roll(values[i - w + 1 : i + 1])) if i >= w - 1 else None)
    up = [i > 0 and smooth[i - 1] is not None and smooth[i] - smooth[i - 1] > settings.min_delta for i in range(len(values))]
    trend, i = [False] * len(values), 0
    while i < len(values):
        j = i
        while j < len(values) and up[j]:
            j += 1
        if j - i >= settings.min_run:
            trend[i:j] = [True] * (j - i)
        i = max(j, i + 1)
    return list(zip(smooth, up, trend, strict=True))


@pytest.mark.parametrize("agg", ["median", "mean"])
@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 1000])
def test_chunks_do_not_change_trends(spark, agg, chunk):
    settings = trends.TrendSettings(bucket_seconds=60, agg=agg, smooth_window=4, min_run=3)
    rng = random.Random(chunk)
    start, rows, wanted = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc), [], {}
    for system in ("a", "b", None):
        at, value, values = 0, 0.0, []
        for _ in range(60):
            at += rng.choice([1, 1, 1, 2, 9])  # buckets are missing
            value += rng.choice([-3.0, 1.0, 1.0, 1.0, 2.0])
            values.append(value)
            rows.append((system, start + dt.timedelta(minutes=at), value, False))
        wanted[system] = plain_trends(values, settings)
    buckets = spark.createDataFrame(rows, "SourceSystem string, bucket timestamp, metric_agg double, trend_truth boolean")
    found = trends.detect(buckets, settings, chunk_buckets=chunk).orderBy("bucket").collect()
    for system, expected in wanted.items():
        own = [r for r in found if r["SourceSystem"] == system]
        assert len(own) == len(expected)
        for r, (smooth, up, trend) in zip(own, expected, strict=True):
            assert (r["metric_smooth"] is None) == (smooth is None)
            assert smooth is None or abs(r["metric_smooth"] - smooth) < 1e-9
            assert (r["is_increase"], r["is_trend"]) == (up, trend)


def test_segments_are_joined_over_chunks_and_days(spark):
    rng = random.Random(5)
    rows = [("a", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i), i, 1.0, rng.random() < 0.5) for i in range(900)]
    df = spark.createDataFrame(rows, "SourceSystem string, Timestamp timestamp, EventSeq long, metric double, trend boolean")
    flags = [r[4] for r in rows]
    edges = sum(b and not a for a, b in zip([False, *flags[:-1]], flags, strict=True))
    got = trends.segments(df).first()
    assert (got["events"], got["trend_events"], got["segments"]) == (900, sum(flags), edges)


def test_cells_hold_equal_numbers_of_skewed_values(spark):
    # 99 % of the values lie in a thousandth of the range.
    values = [i * 1e-9 for i in range(19_800)] + [1e-3 + i for i in range(200)]
    counted = spark.createDataFrame([(0, v, 1) for v in values], "slot int, v double, n long")
    sizes = [r["count"] for r in cells_of(counted).groupBy("cell").count().collect()]
    assert sum(sizes) == len(values) and max(sizes) <= 2 / CELLS * len(values)
    skewed = spark.createDataFrame([(v,) for v in values], "x double")
    probs = [0.0, 0.1, 0.5, 0.989, 0.99, 0.995, 1.0]
    np.testing.assert_allclose(quantiles(skewed, ["x"], probs, accuracy=100).first()["x"], np.quantile(values, probs), rtol=1e-12)


def test_quantiles_of_ties_and_few_rows(spark):
    for values in ([1.0], [1.0, 2.0], [0.0] * 50 + [1.0], [float("-inf"), 0.0, float("inf")], [3.0, 3.0, 3.0]):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        got = quantiles(df, ["x"], [0.0, 0.25, 0.5, 1.0]).first()["x"]
        if np.isfinite(values).all():
            np.testing.assert_allclose(got, np.quantile(values, [0.0, 0.25, 0.5, 1.0]), rtol=1e-12)
        else:
            assert got == [float("-inf"), float("-inf"), 0.0, float("inf")]
    assert spark.range(3).select(F.lit(None).cast("double").alias("x")).transform(lambda d: quantiles(d, ["x"], [0.5])).first()["x"] == [None]
