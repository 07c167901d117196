"""Times the headline queries and the whole pipeline; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. BENCH_PIPELINE_COPIES repeats the events
(with new ids, later times) for a pipeline run at a larger scale.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from logsonde.functions.storage import materialize  # noqa: E402
from logsonde.operators import trends  # noqa: E402
from logsonde.plans.catalog import QUERIES  # noqa: E402
from logsonde.plans.pipeline import ANALYSES, Pipeline  # noqa: E402
from logsonde.plans.telemetry import telemetry  # noqa: E402

HEADLINE = [
    "snk_csv_line",
    "pro_counts",
    "pro_all_distributions",
    "pro_hist_latency",
    "bin_compare",
    "spk_by_service",
    "spk_overall",
    "spk_scores",
    "spk_trailing_5m",
    "trd_buckets_median",
    "trd_detect",
    "trd_summary",
    "flr_window_flag",
    "flr_confusion_code",
    "flr_first_system",
    "flr_propagation",
    "ano_standardize",
    "ano_reason_counts",
    "ano_iforest",
    "rca_path",
    "rca_evidence",
    "rca_diagnosis",
    "rca_pre_flags",
    "rca_recommend",
    "rca_roles",
    "prd_seq_features",
    "prd_failure",
    "clu_sizes",
    "seg_means",
    "seg_shares",
    "lbl_intervals",
]


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    """Computes every row and column without moving them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def repeated(events: DataFrame, copies: int) -> DataFrame:
    """The events `copies` times, each copy after the one before."""
    if copies <= 1:
        return events
    span = events.agg((F.max("event_id") + 1).alias("n")).first()["n"]
    return events.crossJoin(F.broadcast(events.sparkSession.range(copies).withColumnRenamed("id", "copy"))).select(
        (F.col("event_id") + F.col("copy") * span).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(days=(F.col("copy") * 31).cast("int"))).alias("ts"),
        *[c for c in events.columns if c not in ("event_id", "ts")],
    )


def pipeline_times(events: DataFrame) -> dict[str, float]:
    times = {}
    start = time.perf_counter()
    p = Pipeline(events, trend_settings=trends.PIPELINE_SETTINGS)
    times["statistics"] = time.perf_counter() - start
    for name in ANALYSES:
        at = time.perf_counter()
        for df in getattr(p, name)().values():
            run(df)
        times[name] = time.perf_counter() - at
    times["total"] = time.perf_counter() - start
    return {k: round(v, 3) for k, v in times.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    copies = int(os.environ.get("BENCH_PIPELINE_COPIES", "17"))
    spark = session()
    run(QUERIES["pro_counts"](spark, sf_dir))  # starts the JVM's compilers and the file cache
    times = {}
    for name in only:
        at = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - at, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if copies > 0:
        raw = repeated(spark.read.parquet(f"{sf_dir}/events.parquet"), copies)
        events = materialize(telemetry(raw).repartition(int(os.environ.get("BENCH_CPUS", "8"))), "bench-events")
        n = events.count()
        stages = pipeline_times(events)
        result["pipeline"] = {"events": n, "events_per_sec": round(n / stages["total"]), "seconds": stages}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
