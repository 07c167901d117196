"""Profile of an event table: counts, value distributions, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from logsonde.functions import histograms as H
from logsonde.functions.typing import to_number

DISTRIBUTION_COLUMNS = ["Priority", "EventCode", "SourceSystem", "Scenario"]
HISTOGRAM_COLUMNS = ["LatencyMs", "CpuUsage", "LocalQps", "DiskQueueLength"]
HISTOGRAM_BINS = 50


def counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: events, distinct transactions and distinct correlations (nulls not counted).

    Exact distinct counts shuffle every distinct id; `approximate` keeps a fixed-size sketch.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        F.count(F.lit(1)).alias("events_count"),
        distinct("TransactionId").alias("transactions_count"),
        distinct("CorrelationId").alias("correlations_count"),
    )


def distribution(df: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    """Rows per value, most frequent first (or in value order); null is no value."""
    out = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("events"))
    )
    return out.orderBy(column) if by_value else out.orderBy(F.desc("events"), column)


def distributions(df: DataFrame, columns: Sequence[str] = DISTRIBUTION_COLUMNS) -> DataFrame:
    """The distributions of several columns from one scan: (column, value, events)."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(cells))
        .filter("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy("column", F.desc("events"), "value")
    )


def histograms(
    df: DataFrame, columns: Sequence[str] = HISTOGRAM_COLUMNS, bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Equal-width histograms (metric, bin, bin_lo, bin_hi, events), empty bins included.

    One pass finds the bounds of all metrics and one pass counts all of them.
    """
    ends = H.bounds(df, columns)
    per_metric = ends.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("metric"),
                        F.col(f"{c}__lo").alias("lo"),
                        F.col(f"{c}__hi").alias("hi"),
                    )
                    for c in columns
                ]
            )
        )
    ).filter("lo IS NOT NULL")
    values = (
        df.select(*[to_number(c).alias(c) for c in columns])
        .crossJoin(F.broadcast(ends))
        .select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(c).alias("metric"),
                            H.bin_of(F.col(c), F.col(f"{c}__lo"), F.col(f"{c}__hi"), bins).alias("bin"),
                        )
                        for c in columns
                    ]
                )
            )
        )
        .filter("bin IS NOT NULL")
    )
    found = values.groupBy("metric", "bin").agg(F.count(F.lit(1)).alias("events"))
    frame = per_metric.select("metric", "lo", "hi", H.all_bins(bins).alias("bin"))
    return frame.join(found, ["metric", "bin"], "left").select(
        "metric",
        "bin",
        H.edge(F.col("bin"), F.col("lo"), F.col("hi"), bins).alias("bin_lo"),
        H.edge(F.col("bin") + 1, F.col("lo"), F.col("hi"), bins).alias("bin_hi"),
        F.coalesce("events", F.lit(0)).alias("events"),
    )
