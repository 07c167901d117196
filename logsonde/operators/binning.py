"""Bins of a metric compared over incident periods: variance, entropy and balance of the bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logsonde.functions import histograms as H
from logsonde.functions.typing import flag, to_number

METRIC = "LatencyMs"
BINS = 20
BASE = "no_spike"
PERIODS = ["no_spike", "spike", "failure", "trend"]


def edges(df: DataFrame, metric: str = METRIC, bins: int = BINS) -> DataFrame:
    """Shared edges over the whole table: (edge, value) with bins + 1 rows."""
    lo, hi = F.col(f"{metric}__lo"), F.col(f"{metric}__hi")
    return (
        H.bounds(df, [metric])
        .filter(lo.isNotNull())
        .select(lo, hi, F.explode(F.sequence(F.lit(0), F.lit(bins))).alias("edge"))
        .select("edge", H.edge(F.col("edge"), lo, hi, bins).alias("value"))
    )


def with_periods(df: DataFrame) -> DataFrame:
    """One row per event and period it belongs to. Periods overlap."""
    spike = flag(df, "SpikeWindow")
    names = [
        F.when(~spike, F.lit("no_spike")),
        F.when(spike, F.lit("spike")),
        F.when(flag(df, "FailureWindow"), F.lit("failure")),
        F.when(flag(df, "TrendWindow"), F.lit("trend")),
    ]
    return df.withColumn("period", F.explode(F.array_compact(F.array(*names))))


def period_histogram(df: DataFrame, metric: str = METRIC, bins: int = BINS) -> DataFrame:
    """Events per period and bin on the shared edges, empty bins as 0."""
    ends = H.bounds(df, [metric])
    lo, hi = F.col(f"{metric}__lo"), F.col(f"{metric}__hi")
    found = (
        with_periods(df)
        .select("period", to_number(metric).alias("v"))
        .crossJoin(F.broadcast(ends))
        .select("period", H.bin_of(F.col("v"), lo, hi, bins).alias("bin"))
        .filter("bin IS NOT NULL")
        .groupBy("period", "bin")
        .agg(F.count(F.lit(1)).alias("events"))
    )
    frame = ends.select(
        F.explode(F.array(*[F.lit(p) for p in PERIODS])).alias("period"), lo, hi
    ).select("*", H.all_bins(bins).alias("bin"))
    return frame.join(found, ["period", "bin"], "left").select(
        "period",
        "bin",
        H.edge(F.col("bin"), lo, hi, bins).alias("bin_lo"),
        H.edge(F.col("bin") + 1, lo, hi, bins).alias("bin_hi"),
        F.coalesce("events", F.lit(0)).alias("events"),
    )


def stats_of_histogram(histogram: DataFrame) -> DataFrame:
    """Statistics over the bin counts of each period of a histogram (period, bin, events)."""
    n = F.col("events")
    total = histogram.groupBy("period").agg(F.sum("events").alias("total"))
    share = n / F.col("total")
    infinity = F.lit(float("inf"))
    wide = (
        histogram.join(total, "period")
        .groupBy("period")
        .agg(
            F.sum(n).alias("events"),
            F.var_pop(n).alias("variance"),
            F.coalesce(-F.sum(F.when(n > 0, share * F.log2(share))), F.lit(0.0)).alias("entropy"),
            F.max(n).alias("largest"),
            F.min(F.when(n > 0, n)).alias("smallest"),
            F.percentile(n, F.lit(0.5)).alias("middle"),
        )
    )
    return wide.select(
        "period",
        "events",
        "variance",
        "entropy",
        F.coalesce(F.col("largest") / F.col("smallest"), infinity).alias("balance_max_min"),
        F.when(F.col("middle") > 0, F.col("largest") / F.col("middle"))
        .otherwise(infinity)
        .alias("balance_max_median"),
    )


def period_stats(df: DataFrame, metric: str = METRIC, bins: int = BINS) -> DataFrame:
    return stats_of_histogram(period_histogram(df, metric, bins))


def compare_stats(stats: DataFrame, base: str = BASE) -> DataFrame:
    """Every period against the base period: variance ratio and entropy difference."""
    # One row per period, so both sides are of fixed size.
    reference = stats.filter(F.col("period") == base).select(
        F.col("variance").alias("base_variance"), F.col("entropy").alias("base_entropy")
    )
    return (
        stats.filter(F.col("period") != base)
        .crossJoin(F.broadcast(reference))
        .select(
            "period",
            F.when(F.col("base_variance") > 0, F.col("variance") / F.col("base_variance"))
            .otherwise(F.lit(float("inf")))
            .alias("variance_ratio"),
            (F.col("entropy") - F.col("base_entropy")).alias("entropy_delta"),
        )
    )


def compare(df: DataFrame, metric: str = METRIC, bins: int = BINS) -> DataFrame:
    return compare_stats(period_stats(df, metric, bins))
