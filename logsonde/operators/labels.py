"""Truth labels and counters of an event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from logsonde.functions.typing import flag
from logsonde.schema import ANOMALY_CODES, FAILURE_CODES, SPIKE_CODES

# From these on a metric is a spike.
SPIKE_LATENCY_MS = 300
SPIKE_CPU_PERCENT = 80.0
SPIKE_QPS = 75.0

# Fragment of a system's name and its role; the first match counts.
SYSTEM_ROLES = [
    ("auth", "Auth"),
    ("gateway", "Gateway"),
    ("order", "Order"),
    ("payment", "Payment"),
    ("notification", "Notification"),
    ("inventory", "Inventory"),
    ("report", "Reporting"),
]
OTHER_ROLE = "Generic"


def classify_codes(df: DataFrame, code: str = "EventCode") -> DataFrame:
    """The four classes of event codes in use, as booleans."""
    c = F.col(code).cast("int")
    return df.withColumns(
        {
            "is_5xx": c.between(500, 599),
            "is_failure_code": c.isin(FAILURE_CODES),
            "is_anomaly_code": c.isin(ANOMALY_CODES),
            "is_problem_code": c >= 500,
        }
    )


def mark_intervals(
    df: DataFrame, intervals: DataFrame, position: str, name: str, width: int = 1_000_000
) -> DataFrame:
    """`df` with the boolean `name`: `position` lies in one of the closed [start, end] intervals.

    Positions fall into blocks of `width`. In its block, a row is covered if the furthest end of the intervals that start
    at or before it reaches it; intervals from earlier blocks are carried in as one number. So an interval is one row
    whatever its length, and no row meets the intervals one by one.
    """
    starts = intervals.filter("start <= end").select(
        F.col("start").cast("double").alias("_at"), F.col("end").cast("double").alias("_end")
    )
    block = F.floor(F.col("_at") / width).alias("_block")
    starts = starts.select("*", block)
    rows = df.select("*", F.col(position).cast("double").alias("_at")).select("*", block)
    every = rows.withColumn("_end", F.lit(None).cast("double")).unionByName(
        starts.withColumn("_start", F.lit(True)), allowMissingColumns=True
    )
    order = W.partitionBy("_block").orderBy("_at", F.desc_nulls_last("_start"))
    own = F.max("_end").over(order.rowsBetween(W.unboundedPreceding, 0))
    carried = _carried(starts, rows)
    return (
        every.withColumn("_own", own)
        .filter("_start IS NULL")
        .join(carried, "_block", "left")
        .withColumn(name, F.coalesce(F.greatest("_own", "_reach") >= F.col("_at"), F.lit(False)))
        .select(*df.columns, name)
    )


def _carried(starts: DataFrame, rows: DataFrame, wide: int = 1024) -> DataFrame:
    """(_block, _reach): the furthest end of intervals that start in earlier blocks, for each block of `rows`.

    Running maxima in two steps, over the blocks of a group of `wide` and over the groups, so that no task orders all blocks.
    """
    group = F.floor(F.col("_block") / wide).alias("_group")
    blocks = (
        starts.select("_block", "_end")
        .unionByName(rows.select("_block", F.lit(None).cast("double").alias("_end")))
        .filter("_block IS NOT NULL")
        .groupBy("_block")
        .agg(F.max("_end").alias("_end"))
        .select("*", group)
    )
    before = W.orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    groups = blocks.groupBy("_group").agg(F.max("_end").alias("_end")).select(
        "_group", F.max("_end").over(before).alias("_far")
    )
    near = F.max("_end").over(W.partitionBy("_group").orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    return blocks.withColumn("_near", near).join(groups, "_group").select(
        "_block", F.greatest("_near", "_far").alias("_reach")
    )


def with_spike_labels(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "IsSpikeByLatency": F.col("LatencyMs") >= SPIKE_LATENCY_MS,
            "IsSpikeByCpu": F.col("CpuUsage") >= SPIKE_CPU_PERCENT,
            "IsSpikeByQps": F.col("LocalQps") >= SPIKE_QPS,
        }
    )


def system_role(name: Column | str) -> Column:
    text = F.lower(F.col(name) if isinstance(name, str) else name)
    role = F.when(text.contains(SYSTEM_ROLES[0][0]), SYSTEM_ROLES[0][1])
    for fragment, value in SYSTEM_ROLES[1:]:
        role = role.when(text.contains(fragment), value)
    return role.otherwise(OTHER_ROLE)


def counters(df: DataFrame) -> DataFrame:
    """One row of ground-truth counters.

    Spike and failure events are counted by code, so an event whose code an anomaly has replaced
    counts as an anomaly only.
    """
    code = F.col("EventCode")
    return df.agg(
        F.count(F.lit(1)).alias("TotalEvents"),
        F.count_if(code.isin(SPIKE_CODES)).alias("SpikeEvents"),
        F.count_if(code.isin(FAILURE_CODES)).alias("FailureEvents"),
        F.count_if(flag(df, "TrendWindow")).alias("TrendEvents"),
        F.count_if(F.col("IsAnomaly") == 1).alias("AnomalyEvents"),
        F.count_if(flag(df, "IsSpikeByLatency")).alias("SpikeByLatencyEvents"),
        F.count_if(flag(df, "IsSpikeByCpu")).alias("SpikeByCpuEvents"),
        F.count_if(flag(df, "IsSpikeByQps")).alias("SpikeByQpsEvents"),
    )
