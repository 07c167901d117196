"""Trends: a metric in time buckets, smoothed, and runs of increases.

All systems are analysed at once, with the system as a key. After the events are reduced to
buckets, the windows run over one row per bucket and system.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window as W, functions as F

from logsonde.functions.quantiles import grouped_median
from logsonde.functions.scoring import confusion_counts, with_scores
from logsonde.functions.time import DAY_SECONDS, bucket, bucket_start, epoch_seconds, event_order
from logsonde.functions.typing import as_timestamp, flag, to_number

SYSTEM = "SourceSystem"


@dataclass(frozen=True)
class TrendSettings:
    """The defaults of the analysis."""

    metric: str = "LatencyMs"
    bucket_seconds: int = 60
    agg: str = "median"
    smooth_window: int = 5
    min_run: int = 5
    min_delta: float = 0.0


# The settings of the pipeline run.
PIPELINE_SETTINGS = TrendSettings(bucket_seconds=120, smooth_window=7, min_run=7)
PIPELINE_SYSTEM = "OrderService"
#: Bucket lengths of a chunk: windows order the buckets of one system and chunk, and hand on what crosses a border.
CHUNK_BUCKETS = 1024


def prepare(df: DataFrame, settings: TrendSettings, system: str | None = None) -> DataFrame:
    """Only the needed columns: system, time, order, metric and trend flag, with a valid time."""
    if SYSTEM not in df.columns:
        df = df.withColumn(SYSTEM, F.lit(system))
    elif system is not None:
        df = df.filter(F.col(SYSTEM) == system)
    df = as_timestamp(df, "Timestamp").filter("Timestamp IS NOT NULL")
    value = to_number(settings.metric) if settings.metric in df.columns else F.lit(None).cast("double")
    keep = ["Timestamp"] + (["EventSeq"] if "EventSeq" in df.columns else [])
    return df.select(SYSTEM, *keep, value.alias("metric"), flag(df, "TrendWindow").alias("trend"))


def bucketize(prepared: DataFrame, settings: TrendSettings) -> DataFrame:
    """(system, bucket, metric_agg, trend_truth); buckets without the metric are dropped."""
    number = bucket(prepared, "Timestamp", settings.bucket_seconds)
    rows = prepared.withColumn("bucket_no", number)
    keys = [SYSTEM, "bucket_no"]
    if settings.agg == "median":
        out = grouped_median(rows, keys, "metric", "metric_agg", any_of=["trend"])
    elif settings.agg == "mean":
        out = rows.groupBy(*keys).agg(F.avg("metric").alias("metric_agg"), F.bool_or("trend").alias("trend"))
    else:
        raise ValueError("agg must be 'median' or 'mean'")
    return out.filter("metric_agg IS NOT NULL").select(
        SYSTEM,
        bucket_start(prepared, "Timestamp", F.col("bucket_no"), settings.bucket_seconds).alias("bucket"),
        "metric_agg",
        F.col("trend").alias("trend_truth"),
    )


def _chunked(buckets: DataFrame, settings: TrendSettings, chunk_buckets: int) -> DataFrame:
    """Buckets with `chunk`: so many bucket lengths of time, the same for all systems."""
    seconds = settings.bucket_seconds * chunk_buckets
    return buckets.withColumn("chunk", F.floor(epoch_seconds(buckets, "bucket") / seconds))


def _with_halo(chunked: DataFrame, n: int) -> DataFrame:
    """The buckets, and for each chunk copies (`is_halo`) of the n buckets before its first, from as many chunks as that takes.

    Each chunk hands on its last n buckets. A system's chunks, not its buckets, are ordered together; every chunk has a bucket, so
    n chunks hold n.
    """
    row = F.struct("bucket", "metric_agg")
    lasts = chunked.groupBy(SYSTEM, "chunk").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    lasts = lasts.select(SYSTEM, "chunk", F.slice("rows", -F.least(F.size("rows"), F.lit(n)), F.lit(n)).alias("rows"))
    before = W.partitionBy(SYSTEM).orderBy("chunk").rowsBetween(-n, -1)
    carried = lasts.withColumn("rows", F.flatten(F.collect_list("rows").over(before)))
    carried = carried.filter(F.size("rows") > 0)
    carried = carried.select(SYSTEM, "chunk", F.inline(F.slice("rows", -F.least(F.size("rows"), F.lit(n)), F.lit(n))))
    halo = carried.withColumn("is_halo", F.lit(True))
    return chunked.withColumn("is_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)


def smooth(buckets: DataFrame, settings: TrendSettings, chunk_buckets: int = CHUNK_BUCKETS) -> DataFrame:
    """Rolling median or mean over the last `smooth_window` buckets, null until that many exist."""
    return _smoothed(buckets, settings, chunk_buckets).drop("chunk", "step")


def _smoothed(buckets: DataFrame, settings: TrendSettings, chunk_buckets: int) -> DataFrame:
    """Adds `chunk`, `metric_smooth` and `step`, its change from the bucket before; all windows are of one chunk."""
    rows = _with_halo(_chunked(buckets, settings, chunk_buckets), settings.smooth_window)
    order = W.partitionBy(SYSTEM, "chunk").orderBy("bucket")
    frame = order.rowsBetween(1 - settings.smooth_window, 0)
    rolled = F.percentile("metric_agg", F.lit(0.5)) if settings.agg == "median" else F.avg("metric_agg")
    rows = rows.withColumn(
        "metric_smooth",
        F.when(F.row_number().over(order) >= settings.smooth_window, rolled.over(frame)),
    )
    rows = rows.withColumn("step", F.col("metric_smooth") - F.lag("metric_smooth").over(order))
    return rows.filter("NOT is_halo").drop("is_halo")


def detect(buckets: DataFrame, settings: TrendSettings, chunk_buckets: int = CHUNK_BUCKETS) -> DataFrame:
    """Adds `metric_smooth`, `is_increase` and `is_trend` (in a run of at least `min_run`).

    Runs are counted within chunks; one that touches a chunk's border is lengthened by what its neighbours hold of it.
    """
    chunk = W.partitionBy(SYSTEM, "chunk")
    order = chunk.orderBy("bucket")
    df = _smoothed(buckets, settings, chunk_buckets)
    df = df.withColumn("is_increase", F.coalesce(F.col("step") > settings.min_delta, F.lit(False))).drop("step")
    changed = F.col("is_increase") != F.lag("is_increase", 1, False).over(order)
    df = df.withColumn("changed", changed.cast("int"))
    df = df.withColumn("run", F.sum("changed").over(order.rowsBetween(W.unboundedPreceding, 0)))
    df = df.withColumns(
        {
            "length": F.count_if("is_increase").over(W.partitionBy(SYSTEM, "chunk", "run")),
            "last_run": F.max("run").over(chunk),
        }
    )
    # A chunk that begins with an increase begins run 1; without a change it is one run.
    at_start, at_end = F.col("run") <= 1, F.col("run") == F.col("last_run")
    borders = df.groupBy(SYSTEM, "chunk").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_increase").alias("up"),
        F.count_if(F.col("is_increase") & (F.col("run") == 1)).alias("first_run"),
        F.min_by("is_increase", "bucket").alias("starts_up"),
        F.count_if(F.col("is_increase") & at_end).alias("tail"),
    )
    borders = borders.withColumn("head", F.when(F.col("starts_up"), F.col("first_run")).otherwise(0)).drop("first_run")
    joined = _carried(_carried(borders, "tail", "carried_in", F.asc), "head", "carried_out", F.desc)
    own = joined.select(F.col(SYSTEM).alias("of"), F.col("chunk").alias("of_chunk"), "starts_up", "carried_in", "carried_out")
    df = df.join(own, F.col(SYSTEM).eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("of_chunk"))).drop("of", "of_chunk")
    whole = (
        F.col("length")
        + F.when(at_start & F.col("starts_up"), F.col("carried_in")).otherwise(0)
        + F.when(at_end, F.col("carried_out")).otherwise(0)
    )
    return df.withColumn("is_trend", F.col("is_increase") & (whole >= settings.min_run)).drop(
        "chunk", "changed", "run", "length", "last_run", "starts_up", "carried_in", "carried_out"
    )


def _carried(borders: DataFrame, part: str, name: str, direction) -> DataFrame:
    """Adds how many increases lie in one run right before (or, descending, after) each chunk: `part` of its neighbour and, while
    neighbours are increases throughout, of those beyond. One row for each chunk, not bucket."""
    order = W.partitionBy(SYSTEM).orderBy(direction("chunk"))
    stops = F.count_if(F.col("up") < F.col("n")).over(order.rowsBetween(W.unboundedPreceding, 0))
    grouped = borders.withColumn("stops", stops)
    along = W.partitionBy(SYSTEM, "stops").orderBy(direction("chunk")).rowsBetween(W.unboundedPreceding, 0)
    summed = grouped.withColumn("sum", F.sum(part).over(along))
    return summed.withColumn(name, F.coalesce(F.lag("sum").over(order), F.lit(0))).drop("stops", "sum")


def segments(prepared: DataFrame, chunk_seconds: int = 60) -> DataFrame:
    """Per system: events, events in a trend, and rising edges of the trend flag.

    A system may hold a large part of all events, so its events are ordered in time chunks, chunks are joined to days and days to
    systems; the edge between two of them is found from the last and first flag.
    """
    df = prepared.withColumns(
        {
            "chunk": bucket(prepared, "Timestamp", chunk_seconds),
            "at": event_order(prepared, step=False),
        }
    )
    keys = [SYSTEM, "chunk"]
    rises = F.col("trend") & ~F.lag("trend").over(W.partitionBy(*keys).orderBy("at"))
    chunks = (
        df.withColumn("rises", rises)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_if("trend").alias("trend_events"),
            F.count_if("rises").alias("edges"),
            F.min_by("trend", "at").alias("first_flag"),
            F.max_by("trend", "at").alias("last_flag"),
        )
    )
    days = _joined(chunks.withColumn("day", F.floor(F.col("chunk") * chunk_seconds / DAY_SECONDS)), [SYSTEM, "day"], "chunk")
    whole = _joined(days, [SYSTEM], "day")
    first = F.col("first_flag").cast("bigint")  # a flag that is up from the start
    return whole.select(SYSTEM, "events", "trend_events", (F.col("edges") + first).alias("segments"))


def _joined(chunks: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Chunks joined in order to one row for each of `keys`, with the edges between them."""
    previous = F.lag("last_flag").over(W.partitionBy(*keys).orderBy(by))
    return (
        chunks.withColumn("joint", F.col("first_flag") & ~previous)
        .groupBy(*keys)
        .agg(
            F.sum("events").alias("events"),
            F.sum("trend_events").alias("trend_events"),
            (F.sum("edges") + F.count_if("joint")).alias("edges"),
            F.min_by("first_flag", by).alias("first_flag"),
            F.max_by("last_flag", by).alias("last_flag"),
        )
    )


def scores(detected: DataFrame) -> DataFrame:
    """Per system: bucket confusion and scores of `is_trend` against `trend_truth`."""
    counts = confusion_counts(F.col("is_trend"), F.col("trend_truth"))
    return with_scores(detected.groupBy(SYSTEM).agg(*[c.alias(n) for n, c in counts.items()]))


def summary(prepared: DataFrame, detected: DataFrame) -> DataFrame:
    """Per system: events, trend events and segments, buckets, detected and true trend buckets."""
    per_bucket = detected.groupBy(SYSTEM).agg(
        F.count(F.lit(1)).alias("buckets"),
        F.count_if("is_trend").alias("detected_buckets"),
        F.count_if("trend_truth").alias("trend_buckets"),
    )
    zero = {c: 0 for c in ("buckets", "detected_buckets", "trend_buckets")}
    return segments(prepared).join(per_bucket, SYSTEM, "left").fillna(zero)


def recent(detected: DataFrame, hours: int = 12) -> DataFrame:
    """The last hours up to the latest bucket of each system: the series of a trend chart."""
    latest = detected.groupBy(F.col(SYSTEM).alias("of")).agg(F.max("bucket").alias("latest"))  # a row for each system
    return (
        detected.join(latest, F.col(SYSTEM).eqNullSafe(F.col("of")))
        .filter(F.col("bucket") >= F.col("latest") - F.make_dt_interval(hours=F.lit(hours)))
        .drop("latest", "of")
    )


def analyse(df: DataFrame, settings: TrendSettings = PIPELINE_SETTINGS, system: str | None = None) -> DataFrame:
    """Events to detected buckets."""
    return detect(bucketize(prepare(df, settings, system), settings), settings)
