"""Event order and time buckets, for TIMESTAMP and TIMESTAMP_NTZ alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from logsonde.functions.typing import parse_timestamp, pick_time_column

DAY_SECONDS = 86_400


def epoch_seconds(df: DataFrame, column: str) -> Column:
    """Whole seconds since 1970-01-01; null for a null time."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        c = F.col(column)
        return (
            F.unix_date(F.to_date(c)).cast("bigint") * DAY_SECONDS
            + F.hour(c) * 3600
            + F.minute(c) * 60
            + F.second(c)
        )
    return F.unix_seconds(column)


def from_epoch_seconds(df: DataFrame, column: str, seconds: Column) -> Column:
    """The inverse of `epoch_seconds`, with the type that `column` has in `df`."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return zero + F.make_dt_interval(secs=seconds)
    return F.timestamp_seconds(seconds)


def bucket(df: DataFrame, column: str, seconds: int) -> Column:
    """Number of the tumbling bucket of `seconds` that the time falls in.

    Buckets start at midnight, so only sizes that divide a day are accepted.
    """
    if seconds <= 0 or DAY_SECONDS % seconds:
        raise ValueError(f"bucket size must divide {DAY_SECONDS} seconds, got {seconds}")
    return F.floor(epoch_seconds(df, column) / seconds)


def bucket_start(df: DataFrame, column: str, number: Column, seconds: int) -> Column:
    return from_epoch_seconds(df, column, number * seconds)


def event_order(df: DataFrame, step: bool = True) -> Column:
    """A struct that sorts events by time, scenario step and sequence number, nulls last.

    The time is that of the picked time column. A frame with neither a time nor a sequence number has no order.
    """
    far_time, far_step = F.lit("9999-12-31 00:00:00"), F.lit(2**31 - 1)
    parts = []
    time = pick_time_column(df)
    if time is not None:
        kind = df.schema[time].dataType
        if not isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            kind, value = T.TimestampType(), parse_timestamp(time)
        else:
            value = F.col(time)
        parts.append(F.coalesce(value, far_time.cast(kind)).alias("time"))
    elif "EventSeq" not in df.columns:
        raise ValueError("events have neither a time column nor EventSeq, so no order")
    if step and "ScenarioStepIndex" in df.columns:
        parts.append(F.coalesce("ScenarioStepIndex", far_step).alias("step"))
    if "EventSeq" in df.columns:
        parts.append(F.col("EventSeq").alias("seq"))
    return F.struct(*parts)


def time_chunk(df: DataFrame, seconds: int = 600, untimed: int = 100_000) -> Column:
    """Number of the time chunk of an event; events without a time are in the last ones.

    Chunks cut a group that holds very many events into parts that keep the order of events. Events without
    a time are ordered by their sequence number alone, so they are cut by it, `untimed` numbers to a chunk.
    """
    time = pick_time_column(df)
    seq = F.floor(F.col("EventSeq") / untimed) if "EventSeq" in df.columns else F.lit(0)
    far = F.lit(2**62) + seq
    return far if time is None else F.coalesce(F.floor(epoch_seconds(df, time) / seconds), far)
