"""Failure candidates by an additive score, and how failures spread within a correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from logsonde.functions.scoring import confusion, with_scores
from logsonde.functions.storage import materialize
from logsonde.functions.time import bucket, bucket_start, event_order
from logsonde.functions.typing import (
    as_timestamp,
    first_existing,
    flag,
    pick_time_column,
    with_numbers,
)
from logsonde.schema import FAILURE_CODES

# Metrics of the score, standard deviations above the mean that make a threshold,
# and the score from which an event is a candidate.
METRICS = ["LatencyMs", "DiskQueueLength", "NetworkErrors", "CpuUsage", "Retries"]
SIGMAS = {"LatencyMs": 2, "DiskQueueLength": 3, "NetworkErrors": 3, "CpuUsage": 3}
CANDIDATE_SCORE = 6.5
QUIET_KINDS = ["Trace", "Audit", "Heartbeat"]
BAD_PRIORITIES = ["ERR", "ERROR", "CRIT", "CRITICAL"]
WINDOW_SECONDS = 300
BAD_SHARE = 0.10
# Windows that are broadcast at most, 16 bytes each.
BROADCAST_WINDOWS = 1_000_000


def thresholds(df: DataFrame) -> DataFrame:
    """One row `thr_<metric>`: mean + k population standard deviations, nulls taken as 0."""
    df = with_numbers(df, METRICS, 0)
    return df.agg(*[(F.avg(m) + k * F.stddev_pop(m)).alias(f"thr_{m}") for m, k in SIGMAS.items()])


def failure_share(df: DataFrame, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Events and share of failure codes per tumbling window."""
    time = pick_time_column(df)
    df = as_timestamp(df, time)
    number = bucket(df, time, seconds)
    return (
        df.filter(F.col(time).isNotNull())
        .groupBy(number.alias("window_no"), bucket_start(df, time, number, seconds).alias("window_start"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.avg(F.coalesce(F.col("EventCode").isin(FAILURE_CODES), F.lit(False)).cast("int")).alias("share"),
        )
    )


def bad_windows(df: DataFrame, seconds: int = WINDOW_SECONDS, share: float = BAD_SHARE) -> DataFrame:
    return failure_share(df, seconds).filter(F.col("share") >= share)


def with_failure_window(
    df: DataFrame, seconds: int = WINDOW_SECONDS, share: float = BAD_SHARE, replace: bool = False
) -> DataFrame:
    """`df` with `FailureWindow`: derived from the bad windows unless it is already there.

    Without a time column or a code the flag is false.
    """
    if "FailureWindow" in df.columns:
        if not replace:
            return df
        df = df.drop("FailureWindow")
    time = pick_time_column(df)
    if time is None or "EventCode" not in df.columns:
        return df.withColumn("FailureWindow", F.lit(False))
    df = as_timestamp(df, time)
    bad = materialize(bad_windows(df, seconds, share).select("window_no", F.lit(True).alias("bad")), "bad-windows")
    if bad.count() <= BROADCAST_WINDOWS:  # else the events are shuffled by window
        bad = F.broadcast(bad)
    return (
        df.withColumn("window_no", bucket(df, time, seconds))
        .join(bad, "window_no", "left")
        .withColumn("FailureWindow", F.coalesce("bad", F.lit(False)))
        .drop("window_no", "bad")
    )


def _steps(value: Column, *steps: tuple[Column, float]) -> Column:
    """The points of the first step that the value exceeds, else 0."""
    points = F.when(value > steps[0][0], F.lit(steps[0][1]))
    for limit, score in steps[1:]:
        points = points.when(value > limit, F.lit(score))
    return points.otherwise(F.lit(0.0))


def score(df: DataFrame, thr: DataFrame | None = None) -> DataFrame:
    """`df` with `FailureScore` and `FailureCandidate` (0/1)."""
    thr = thresholds(df) if thr is None else thr
    df = with_numbers(df, METRICS, 0)
    latency, disk, net, cpu, retries = (
        F.col(m) for m in ("LatencyMs", "DiskQueueLength", "NetworkErrors", "CpuUsage", "Retries")
    )
    t = {m: F.col(f"thr_{m}") for m in SIGMAS}
    points = (
        _steps(latency, (t["LatencyMs"] * 2, 4.0), (t["LatencyMs"] * 1.5, 2.0), (t["LatencyMs"], 1.0))
        + _steps(disk, (t["DiskQueueLength"] * 3, 1.5), (t["DiskQueueLength"], 1.0))
        + _steps(net, (t["NetworkErrors"], 0.5))
        + _steps(net, (F.lit(5), 0.5))
        + F.when(retries >= 3, 2.0).when(retries > 0, 1.0).otherwise(0.0)
        + F.when(cpu > 95, 1.0).when(cpu > t["CpuUsage"], 0.5).otherwise(0.0)
    )
    if "Priority" in df.columns:
        bad = F.upper(F.col("Priority").cast("string")).isin(BAD_PRIORITIES)
        points = points + F.when(bad, 4.0).otherwise(0.0)
    kind = first_existing(df, ["EventKind", "EventType", "Kind"])
    if kind is not None:
        points = F.when(F.col(kind).isin(QUIET_KINDS), 0.0).otherwise(points)
    return (
        df.crossJoin(F.broadcast(thr))
        .withColumn("FailureScore", points)
        .withColumn("FailureCandidate", (F.col("FailureScore") >= CANDIDATE_SCORE).cast("int"))
        .drop(*thr.columns)
    )


def candidate_count(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.coalesce(F.sum("FailureCandidate"), F.lit(0)).alias("candidates"),
        F.count(F.lit(1)).alias("events"),
    )


def confusions(scored: DataFrame) -> DataFrame:
    """Scores of the candidates against failure codes and against the failure window."""
    pred = F.col("FailureCandidate") == 1
    by_code = F.col("EventCode").isin(FAILURE_CODES) if "EventCode" in scored.columns else F.lit(False)
    counts = confusion(
        scored, {"code": (pred, by_code), "window": (pred, flag(scored, "FailureWindow"))}, "truth"
    )
    return with_scores(counts)


def _per_system(scored: DataFrame) -> DataFrame:
    """Events, candidates and first candidate for each (correlation, system).

    Everything later works on this table, which holds one row per system of a correlation however
    many events a correlation has.
    """
    order = event_order(scored, step=False)
    return (
        scored.filter("CorrelationId IS NOT NULL")
        .groupBy("CorrelationId", "SourceSystem")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum("FailureCandidate").alias("candidates"),
            F.min(F.when(F.col("FailureCandidate") == 1, order)).alias("first_at"),
        )
    )


def first_failures(scored: DataFrame) -> DataFrame:
    """System of the first candidate of every correlation that has one."""
    return (
        _per_system(scored)
        .filter("first_at IS NOT NULL")
        .groupBy("CorrelationId")
        .agg(F.min_by("SourceSystem", "first_at").alias("FirstFailSystem"))
    )


def propagation(scored: DataFrame) -> DataFrame:
    """First failing system against every system of the same correlations."""
    correlation = W.partitionBy("CorrelationId")
    first = F.min(
        F.when(F.col("first_at").isNotNull(), F.struct("first_at", "SourceSystem"))
    ).over(correlation)
    return (
        _per_system(scored)
        .withColumn("FirstFailSystem", first["SourceSystem"])
        .filter("FirstFailSystem IS NOT NULL AND SourceSystem IS NOT NULL")
        .groupBy("FirstFailSystem", "SourceSystem")
        .agg(F.sum("events").alias("Events"), F.sum("candidates").alias("Candidates"))
        .withColumn("CandidateRate", F.col("Candidates") / F.col("Events"))
        .orderBy("FirstFailSystem", F.desc("CandidateRate"), F.desc("Candidates"), "SourceSystem")
    )


def reconcile(scored: DataFrame, stats: DataFrame, thr: DataFrame | None = None) -> DataFrame:
    """One row: detected rate beside the rate of a ground-truth stats row, and the thresholds.

    `stats` has TotalEvents and FailureEvents; statistics per metric are passed through if present.
    """
    thr = thresholds(scored) if thr is None else thr
    extra = [m for m in METRICS if m in stats.columns]
    truth = stats.select(
        F.coalesce(F.col("TotalEvents"), F.lit(0)).alias("truth_events"),
        F.coalesce(F.col("FailureEvents"), F.lit(0)).alias("truth_failures"),
        *[F.col(m).alias(f"stats_{m}") for m in extra],
    )
    detected = candidate_count(scored).withColumn(
        "candidate_rate",
        F.when(F.col("events") > 0, F.col("candidates") / F.col("events")).otherwise(0.0),
    )
    known = (F.col("truth_events") > 0) & (F.col("truth_failures") > 0)
    return (
        detected.crossJoin(F.broadcast(thr))
        .crossJoin(F.broadcast(truth))
        .withColumn(
            "rate_difference",
            F.when(known, F.col("candidate_rate") - F.col("truth_failures") / F.col("truth_events")),
        )
    )
