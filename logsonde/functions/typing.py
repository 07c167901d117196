"""Typing: numbers, times and flags that turn bad input into null or a default."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Names a time column may have, best first.
TIME_COLUMNS = ["Timestamp", "TimeStamp", "EventTime", "CreatedAt", "DateTime"]


def to_number(column: Column | str) -> Column:
    """Any value as DOUBLE; text that is no number, and NaN, become null."""
    c = F.col(column) if isinstance(column, str) else column
    number = c.try_cast("double")
    return F.when(~F.isnan(number), number)


def parse_timestamp(column: Column | str) -> Column:
    """ISO-8601 text (blank padded, with or without zone) as TIMESTAMP, bad text as null.

    Text without a zone is UTC, whatever the session's zone.
    """
    c = F.col(column) if isinstance(column, str) else column
    text = F.trim(c.cast("string"))
    zoned = text.rlike(r"(?i)[0-9](Z|UTC|GMT|[+-][0-9]{1,2}(:?[0-9]{2})?)$") & text.contains(":")
    dated = text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$")
    return F.try_to_timestamp(
        F.when(zoned, text).when(dated, F.concat(text, F.lit("T00:00:00Z"))).otherwise(F.concat(text, F.lit("Z")))
    )


def as_timestamp(df: DataFrame, column: str) -> DataFrame:
    """`df` with `column` as a timestamp; columns that already are one stay as they are."""
    if isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df
    return df.withColumn(column, parse_timestamp(column))


def flag(df: DataFrame, name: str) -> Column:
    """Boolean column `name` with null and a missing column as false."""
    if name not in df.columns:
        return F.lit(False)
    return F.coalesce(F.col(name).cast("boolean"), F.lit(False))


def first_existing(df: DataFrame, names: Sequence[str]) -> str | None:
    """The first of `names` that is a column of `df`."""
    return next((n for n in names if n in df.columns), None)


def pick_time_column(df: DataFrame) -> str | None:
    return first_existing(df, TIME_COLUMNS)


def with_numbers(df: DataFrame, names: Sequence[str], default: float | None = None) -> DataFrame:
    """Coerce `names` to DOUBLE. With a default, nulls and missing columns take it."""
    new = {}
    for n in names:
        if n in df.columns:
            c = to_number(n)
            new[n] = c if default is None else F.coalesce(c, F.lit(float(default)))
        elif default is not None:
            new[n] = F.lit(float(default))
    return df.withColumns(new) if new else df


def with_date_parts(df: DataFrame, column: str = "Timestamp") -> DataFrame:
    """Hour of day and day of week with Monday as 0, in UTC; a TIMESTAMP_NTZ is taken as UTC."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        hour, day = F.hour(c), F.weekday(c)
    else:  # 1970-01-01 was a Thursday
        seconds = F.unix_seconds(c)
        hour = F.pmod(F.floor(seconds / 3600), F.lit(24)).cast("int")
        day = F.pmod(F.floor(seconds / 86400) + 3, F.lit(7)).cast("int")
    return df.withColumns({"TimestampHour": hour, "TimestampDayOfWeek": day})


def ratio(numerator: Column, denominator: Column, otherwise: float = 0.0) -> Column:
    """numerator / denominator, or `otherwise` when the denominator is not positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(float(otherwise)))
