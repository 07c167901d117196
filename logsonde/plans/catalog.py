"""The registered queries: one per operator, on the telemetry view over the whole `events` table.

Each entry calls the public operator and gives its result plain columns: doubles rounded to 6
places, counts as BIGINT, times as text, lists as joined text.
"""

from __future__ import annotations

import operator
import uuid
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logsonde.functions.storage import materialize, shared_folder
from logsonde.functions.typing import parse_timestamp, to_number, with_date_parts
from logsonde.operators import (
    anomalies,
    binning,
    failures,
    labels,
    predict,
    profile,
    rca,
    segments,
    spikes,
    trends,
)
from logsonde.plans.oracles import PIPELINE_TABLES
from logsonde.plans.pipeline import Pipeline
from logsonde.schema import MODEL_FEATURES
from logsonde.sources import logs
from logsonde.plans.telemetry import read_telemetry

Query = Callable[[SparkSession, str], DataFrame]

# The test stream has minutes between events, so buckets and windows are wider than the defaults.
TREND_MEDIAN = trends.TrendSettings(bucket_seconds=7200, smooth_window=3, min_run=3)
TREND_MEAN = trends.TrendSettings(bucket_seconds=7200, agg="mean", smooth_window=3, min_run=3)
TRAILING_MINUTES = 360
LIMIT = 1000
SAMPLE_ROWS = 5000
SAMPLE_SEQUENCES = 500
CLUSTER_PASSES = 2


def plain(df: DataFrame) -> DataFrame:
    """Columns of simple types that compare equal across engines."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)  # no negative zero
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, ",")
        elif isinstance(f.dataType, (T.StructType, T.MapType, T.VariantType)):
            continue
        out.append(c.alias(f.name))
    return df.select(*out)


QUERIES: dict[str, Query] = {}


def _on_telemetry(name: str) -> Callable:
    """Registers a function of the telemetry view."""

    def register(fn: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: plain(fn(read_telemetry(spark, sf_dir)))
        return fn

    return register


def _add(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    _on_telemetry(name)(fn)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


# -- sources and typing ---------------------------------------------------------------------

_add(
    "src_limit",
    lambda t: logs.limit_rows(t, LIMIT).select("EventSeq", "Timestamp", "SourceSystem", "LatencyMs"),
)


def _flatten_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    events = _events(spark, sf_dir).select("event_id", "event_type", "props")
    return plain(logs.flatten_attributes(events, "props", schema))


FILE_COLUMNS = ["TransactionId", "CorrelationId", "SourceSystem", "EventCode", "LatencyMs", "Priority"]
FILE_KEYS = ["CpuUsage", "Retries", "LocalQps"]


@_on_telemetry("src_file")
def _file(t: DataFrame) -> DataFrame:
    """All events written as a log file, and read back from the first path that exists, with some of the attributes."""
    path = f"{shared_folder(t.sparkSession).rstrip('/')}/log-{uuid.uuid4().hex}"
    logs.write_logs(t, path)
    back = logs.read_logs(t.sparkSession, [f"{path}-missing", path], attributes=FILE_KEYS)
    return back.select(*FILE_COLUMNS, *FILE_KEYS)


def _json_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound, blank, cut, padded and missing JSON in turn."""
    turn = F.col("event_id") % 5
    text = (
        F.when(turn == 0, F.col("props"))
        .when(turn == 1, F.lit("  "))
        .when(turn == 2, F.expr("substring(props, 1, length(props) - 1)"))
        .when(turn == 3, F.concat(F.lit("  "), F.col("props"), F.lit(" ")))
    )
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    parsed = _events(spark, sf_dir).select("event_id", logs.parse_json(text, schema).alias("a"))
    return plain(
        parsed.select(
            "event_id", F.col("a").isNotNull().alias("is_valid"), F.coalesce("a.k", F.lit(-1)).alias("k")
        )
    )


def _to_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, words, NaN and broken numbers in turn."""
    turn = F.col("event_id") % 4
    text = (
        F.when(turn == 0, F.col("value").cast("string"))
        .when(turn == 1, F.col("event_type"))
        .when(turn == 2, F.lit("NaN"))
        .otherwise(F.concat(F.col("event_id").cast("string"), F.lit("x")))
    )
    number = to_number(text)
    return plain(
        _events(spark, sf_dir).select(
            "event_id", number.isNull().alias("is_bad"), F.coalesce(number, F.lit(-1.0)).alias("number")
        )
    )


def _parse_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain, ISO, padded and bad times in turn."""
    turn = F.col("event_id") % 4
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (
        F.when(turn == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(turn == 1, iso)
        .when(turn == 2, F.concat(F.lit("  "), iso, F.lit(" ")))
        .otherwise(F.lit("no time"))
    )
    parsed = F.date_format(parse_timestamp(text), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return _events(spark, sf_dir).select("event_id", F.coalesce(parsed, F.lit("bad")).alias("parsed"))


QUERIES["src_flatten_json"] = _flatten_json
QUERIES["src_json_tolerant"] = _json_tolerant
QUERIES["typ_to_numeric"] = _to_numeric
QUERIES["typ_parse_ts"] = _parse_ts
_add("snk_csv_line", logs.csv_line)
_add(
    "typ_date_parts",
    lambda t: with_date_parts(t)
    .groupBy("TimestampHour", "TimestampDayOfWeek")
    .agg(F.count(F.lit(1)).alias("events")),
)
_add(
    "typ_code_classes",
    lambda t: labels.classify_codes(t)
    .groupBy("EventCode")
    .agg(
        F.count(F.lit(1)).alias("events"),
        *[
            F.count_if(c).alias(c)
            for c in ("is_5xx", "is_failure_code", "is_anomaly_code", "is_problem_code")
        ],
    ),
)

# -- profile and binning --------------------------------------------------------------------

_add("pro_counts", profile.counts)
_add("pro_priority", lambda t: profile.distribution(t, "Priority"))
_add("pro_event_code", lambda t: profile.distribution(t, "EventCode", by_value=True))
_add("pro_source_system", lambda t: profile.distribution(t, "SourceSystem"))
_add("pro_scenario", lambda t: profile.distribution(t, "Scenario"))
_add("pro_all_distributions", profile.distributions)
_add("pro_hist_latency", lambda t: profile.histograms(t, ["LatencyMs"]))
_add("pro_hist_cpu", lambda t: profile.histograms(t, ["CpuUsage"]))
_add("pro_hist_qps", lambda t: profile.histograms(t, ["LocalQps"]))
_add("pro_hist_disk", lambda t: profile.histograms(t, ["DiskQueueLength"]))
_add("bin_edges", binning.edges)
_add("bin_period_histogram", binning.period_histogram)
_add("bin_period_stats", binning.period_stats)
_add("bin_compare", binning.compare)

# -- spikes ---------------------------------------------------------------------------------

_add("spk_thresholds", spikes.thresholds)
for _rule in spikes.RULES:
    _add(
        f"spk_{_rule.name}",
        lambda t, r=_rule: spikes.detect(t)
        .filter(f"spike_{r.name}")
        .select("EventSeq", "SourceSystem", F.col(r.metric).cast("double").alias("value")),
    )
_add("spk_by_service", lambda t: spikes.by_service(spikes.detect(t)))
_add("spk_overall", lambda t: spikes.overall(spikes.detect(t)))
_add("spk_confusion", lambda t: spikes.confusion_counts(spikes.detect(t)))
_add("spk_scores", lambda t: spikes.scores(spikes.detect(t)))
_add("spk_trailing_5m", lambda t: spikes.trailing(t, TRAILING_MINUTES))

# -- trends ---------------------------------------------------------------------------------


def _buckets(t: DataFrame, s: trends.TrendSettings) -> DataFrame:
    return trends.bucketize(trends.prepare(t, s), s)


_add("trd_buckets_median", lambda t: _buckets(t, TREND_MEDIAN))
_add("trd_buckets_mean", lambda t: _buckets(t, TREND_MEAN))
_add(
    "trd_smooth",
    lambda t: trends.smooth(_buckets(t, TREND_MEDIAN), TREND_MEDIAN)
    .filter("metric_smooth IS NOT NULL")
    .select("SourceSystem", "bucket", "metric_agg", "metric_smooth"),
)
_add(
    "trd_detect",
    lambda t: trends.analyse(t, TREND_MEDIAN).select(
        "SourceSystem", "bucket", "is_increase", "is_trend", "trend_truth"
    ),
)
_add("trd_segments", lambda t: trends.segments(trends.prepare(t, TREND_MEDIAN)))
_add("trd_scores", lambda t: trends.scores(trends.analyse(t, TREND_MEDIAN)))
_add(
    "trd_summary",
    lambda t: trends.summary(trends.prepare(t, TREND_MEDIAN), trends.analyse(t, TREND_MEDIAN)),
)
_add(
    "trd_recent_12h",
    lambda t: trends.recent(trends.analyse(t, TREND_MEDIAN)).select(
        "SourceSystem", "bucket", "metric_agg", "metric_smooth", "is_trend", "trend_truth"
    ),
)

# -- failures -------------------------------------------------------------------------------

_add("flr_thresholds", failures.thresholds)
_add("flr_bad_windows", lambda t: failures.bad_windows(t).select("window_start", "events", "share"))
_add(
    "flr_window_flag",
    lambda t: failures.with_failure_window(t, replace=True).select("EventSeq", "FailureWindow"),
)
_add("flr_score", lambda t: failures.score(t).select("EventSeq", "FailureScore"))
_add("flr_candidates", lambda t: failures.candidate_count(failures.score(t)))
_add("flr_confusion_code", lambda t: failures.confusions(failures.score(t)).filter("truth = 'code'"))
_add("flr_confusion_window", lambda t: failures.confusions(failures.score(t)).filter("truth = 'window'"))
_add("flr_first_system", lambda t: failures.first_failures(failures.score(t)))
_add("flr_propagation", lambda t: failures.propagation(failures.score(t)))


@_on_telemetry("flr_reconcile")
def _reconcile(t: DataFrame) -> DataFrame:
    thr = failures.thresholds(t)
    return failures.reconcile(failures.score(t, thr), labels.counters(t), thr)


# -- anomalies ------------------------------------------------------------------------------


def _with_gaps(t: DataFrame) -> DataFrame:
    """The view with missing metrics: latency of anomalies and CPU of spikes."""
    return t.withColumns(
        {
            "LatencyMs": F.when(F.col("IsAnomaly") == 0, F.col("LatencyMs")),
            "CpuUsage": F.when(~F.col("SpikeWindow"), F.col("CpuUsage")),
        }
    )


_add("ano_impute", lambda t: anomalies.impute(_with_gaps(t)).select("EventSeq", *MODEL_FEATURES))
_add(
    "ano_standardize",
    lambda t: anomalies.standardize(anomalies.impute(_with_gaps(t))).select(
        "EventSeq", *[f"z_{c}" for c in MODEL_FEATURES]
    ),
)
_add("ano_contamination", anomalies.contamination)
_add(
    "ano_iforest",
    lambda t: anomalies.isolation_forest(t).select(
        "EventSeq", "SourceSystem", "IsAnomaly", "IF_Anomaly", "IF_AnomalyScore"
    ),
)
_add("ano_scores", lambda t: anomalies.scores(anomalies.isolation_forest(t)))
_add(
    "ano_confusion_rule",
    lambda t: anomalies.scores(t.withColumn("rule", (F.col("EventCode") >= 500).cast("int")), "rule"),
)
_add("ano_top_scenarios", lambda t: anomalies.top_scenarios(t, "IsAnomaly"))
_add("ano_reasons", lambda t: anomalies.reasons(t, "IsAnomaly").select("EventSeq", "Scenario", "reasons"))
_add("ano_reason_counts", lambda t: anomalies.reason_counts(t, "IsAnomaly"))
_add(
    "ano_recommend",
    lambda t: anomalies.recommendations(anomalies.reason_counts(t, "IsAnomaly")),
)



@_on_telemetry("ano_written")
def _written_scores(t: DataFrame) -> DataFrame:
    """The scores as they are read back from the table that the forest wrote them to."""
    path = f"{shared_folder(t.sparkSession).rstrip('/')}/scores-{uuid.uuid4().hex}"
    anomalies.isolation_forest(t, out_path=path)
    return t.sparkSession.read.parquet(path).select("EventSeq", "Scenario", "IF_AnomalyScore")


# -- root cause -----------------------------------------------------------------------------


def _systems(t: DataFrame) -> DataFrame:
    return rca.systems(rca.mark(t))


_add("rca_pick", rca.pick)
_add(
    "rca_timeline",
    lambda t: rca.timeline(t).select(
        "CorrelationId", "EventSeq", "Timestamp", "SourceSystem", "EventCode", "LatencyMs"
    ),
)
_add("rca_context", lambda t: rca.context(rca.mark(t)))
_add("rca_path", lambda t: rca.path(rca.mark(t)).drop("at"))
_add("rca_global_stats", lambda t: rca.stats_by_metric(rca.global_stats(t)).fillna(0.0, ["iqr"]))
_add(
    "rca_problem_rows",
    lambda t: rca.problem_rows(rca.mark(t)).select("CorrelationId", "EventSeq", "SourceSystem", "EventCode"),
)
_add(
    "rca_first_problem",
    lambda t: rca.first_problem(_systems(t)).select(
        "CorrelationId",
        "first_problem_system",
        F.coalesce("first_problem_step", F.lit(-1)).alias("first_problem_step"),
    ),
)
_add("rca_victims", lambda t: rca.victims(rca.path(rca.mark(t)), _systems(t)))
_add("rca_evidence", lambda t: rca.evidence(_systems(t)))
_add(
    "rca_pre_events",
    lambda t: rca.pre_events(rca.mark(t)).select("CorrelationId", "back", "EventSeq", "SourceSystem"),
)
_add("rca_deviations", lambda t: rca.deviations(rca.mark(t)))
_add(
    "rca_diagnosis",
    lambda t: rca.diagnosis(_systems(t)).select(
        "CorrelationId",
        "SourceSystem",
        "problem_events",
        F.coalesce("rank", F.lit(1)).alias("rank"),
        F.coalesce("reason", F.lit("none")).alias("reason"),
        F.coalesce("z", F.lit(0.0)).alias("z"),
        F.coalesce("n", F.lit(0)).alias("n"),
    ),
)
_add("rca_flags", lambda t: rca.flag_counts(_systems(t)))
_add("rca_pre_level", lambda t: rca.pre_levels(rca.pre_summary(rca.mark(t))))
_add("rca_pre_rise", lambda t: rca.pre_rises(rca.pre_summary(rca.mark(t))))
_add(
    "rca_pre_flags",
    lambda t: rca.assessment(rca.mark(t)).filter("kind IN ('flag', 'retries', 'none', 'sudden')"),
)
_add("rca_recommend", lambda t: rca.recommendations(_systems(t)))
_add("rca_watch", lambda t: rca.watch_list(_systems(t)))
_add("rca_roles", lambda t: rca.roles(_systems(t)))


@_on_telemetry("rca_report")
def _report(t: DataFrame) -> DataFrame:
    """The report of the picked correlation, measured against the whole table."""
    return rca.report(rca.mark(rca.for_correlation(t, rca.pick(t)), rca.global_stats(t)))


_add(
    "rca_records",
    lambda t: rca.report(rca.mark(t)).filter("section <> 'assessment' OR NOT item RLIKE '^(level|rise)'"),
)

# -- prediction -----------------------------------------------------------------------------

_add(
    "prd_targets",
    lambda t: predict.prepare(t).groupBy("EventCode", "is_failure", "is_anomaly_target").agg(
        F.count(F.lit(1)).alias("events")
    ),
)
_add(
    "prd_sample",
    lambda t: predict.sample_events(predict.prepare(t), SAMPLE_ROWS).select(
        "EventSeq", "is_failure", "is_anomaly_target"
    ),
)
_add(
    "prd_cardinality",
    lambda t: predict.cardinality(
        t, ["Priority", "User", "SourceSystem", "EventKind", "Scenario", "ClusterNode", "Region", "BusinessKey"]
    ).withColumn("is_kept", F.col("distinct_values") <= predict.MAX_CATEGORIES),
)
_add(
    "prd_split",
    lambda t: predict.split(predict.prepare(t), "is_failure", group="CorrelationId").select(
        "EventSeq", "CorrelationId", "is_failure", "is_test"
    ),
)


def _scores(spark: SparkSession, model: str, scores: dict[str, float | None]) -> DataFrame:
    schema = "model string, " + ", ".join(f"{k} double" for k in scores)
    return spark.createDataFrame([(model, *scores.values())], schema)


def _event_scores(label: str, scores: Callable[[predict.Fitted, str], dict]) -> Callable[[DataFrame], DataFrame]:
    return lambda t: _scores(t.sparkSession, label, scores(predict.event_models(predict.prepare(t)), label))


_add("prd_latency", _event_scores("LatencyMs", predict.value_scores))
_add("prd_failure", _event_scores("is_failure", predict.class_scores))
_add("prd_anomaly", _event_scores("is_anomaly_target", predict.class_scores))


@_on_telemetry("prd_checks")
def _model_checks(t: DataFrame) -> DataFrame:
    """Every model with its rows, and whether the gradient of its objective is zero: it is at its optimum."""
    prepared = predict.prepare(t)
    sequences = predict.sequence_models(prepared, "CorrelationId")[1]
    rows = predict.event_models(prepared).checks() + (sequences.checks() if sequences else [])
    return t.sparkSession.createDataFrame(rows, "model string, train_rows long, test_rows long, gradient_is_zero boolean")


def _small(t: DataFrame) -> DataFrame:
    """The whole prediction with one feature a model, whose fits SQL can follow."""
    return predict.predict(t, features=["CpuUsage"], sequence_columns=["LatencyMs_max"])


@_on_telemetry("prd_small_scores")
def _small_scores(t: DataFrame) -> DataFrame:
    r = _small(t)
    classes = ("classification_failure", "classification_anomaly", "sequence_tx_failure")
    named = {f"{c}_{k}": F.col(c)[k] for c in classes for k in ("precision", "recall", "f1")}
    named |= {k: F.col("regression_latency")[k] for k in ("mae", "rmse", "r2", "baseline_mae", "baseline_rmse", "mae_improvement_pct")}
    return r.select(*[c.alias(n) for n, c in named.items()], F.col("sequence_tx_failure.n_transactions").alias("sequences"))


_add("prd_small_grades", lambda t: predict.graded(_small(t)))
_add("prd_small_advice", lambda t: predict.advice(_small(t)))
_add("prd_baseline", lambda t: predict.baseline(t, t))
_add(
    "prd_seq_cap",
    lambda t: predict.cap_sequences(t, "CorrelationId", SAMPLE_SEQUENCES).select("CorrelationId", "EventSeq"),
)
_add("prd_seq_label", predict.sequence_labels)
_add(
    "prd_seq_prefix",
    lambda t: predict.sequence_prefix(t).select("CorrelationId", "position", "EventSeq"),
)
_add("prd_seq_features", predict.sequence_features)


@_on_telemetry("prd_sequence")
def _sequence(t: DataFrame) -> DataFrame:
    model = predict.sequence_models(predict.prepare(t), "CorrelationId")[1]
    return _scores(t.sparkSession, "y_tx", predict.class_scores(model, "y_tx"))


_add(
    "prd_grade",
    lambda t: failures.confusions(failures.score(t)).select(
        "truth",
        "f1",
        predict.grade_f1(F.col("f1")).alias("f1_grade"),
        predict.grade_r2(F.col("f1")).alias("r2_grade"),
    ),
)
_add("prd_advice", lambda t: predict.advice(predict.predict(t)))

# -- segments and labels --------------------------------------------------------------------

_add(
    "clu_features",
    lambda t: anomalies.standardize(segments.feature_rows(_with_gaps(t))).select(
        "EventSeq", *[f"z_{c}" for c in MODEL_FEATURES]
    ),
)


_FITTED: dict[tuple, dict] = {}


def _vectors(t: DataFrame) -> DataFrame:
    """The columns that segments need, written once: each pass, and the filter of incomplete rows, would work the view out again."""
    flags = ["EventCode", "IsAnomaly", "IsSpikeByLatency", "IsSpikeByCpu", "IsSpikeByQps"]
    return segments.feature_vectors(materialize(t.select("EventSeq", *MODEL_FEATURES, *flags), "segment-events"))


def _fitted(t: DataFrame) -> tuple[DataFrame, dict]:
    """The events with their clusters, and the models. Models are kept for a session, by the content of what they were fitted on."""
    vectors = _vectors(t)
    total = F.sum(F.xxhash64("features").cast("decimal(38,0)"))
    at = (t.sparkSession.sparkContext.applicationId, *vectors.agg(F.count("*"), total).first())
    if at not in _FITTED:
        _FITTED[at] = segments.fit_kmeans(vectors)
    return segments.assign(vectors, _FITTED[at]), _FITTED[at]


def _passed(t: DataFrame) -> DataFrame:
    """The events with the clusters of CLUSTER_PASSES passes from the first events as centres, which SQL can follow."""
    vectors = _vectors(t)
    first = [r["features"] for r in vectors.orderBy("EventSeq").limit(max(segments.K_VALUES)).select("features").collect()]
    initial = {k: np.array(first[:k]) for k in segments.K_VALUES}
    return segments.assign(vectors, segments.fit_kmeans(vectors, max_iterations=CLUSTER_PASSES, initial=initial))


def _on_clusters(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    _add(f"clu_{name}", lambda t: fn(segments.by_k(_fitted(t)[0])))
    _add(f"clu_pass_{name}", lambda t: fn(segments.by_k(_passed(t))))


_on_clusters("kmeans", lambda c: c.select("EventSeq", "k", "cluster"))
_on_clusters("sizes", lambda c: segments.sizes(c, ["k", "cluster"]))
_on_clusters("means", lambda c: segments.means(c, ["k", "cluster"]))
_on_clusters("shares", lambda c: segments.shares(c, ["k", "cluster"]))


@_on_telemetry("clu_checks")
def _cluster_checks(t: DataFrame) -> DataFrame:
    """Properties of the fits that the queries return: every event in its nearest cluster, centres at the means, more clusters cheaper."""
    return segments.checks(*_fitted(t))


@_on_telemetry("ano_checks")
def _forest_checks(t: DataFrame) -> DataFrame:
    """Properties of the forest: scores in range, the same in a second fit, and the wanted share flagged."""
    first, again = (anomalies.isolation_forest(t, columns=["EventCode"]) for _ in range(2))
    both = first.join(again.select("EventSeq", F.col("IF_AnomalyScore").alias("second")), "EventSeq")
    score = F.col("IF_AnomalyScore")
    counted = both.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if((score > -1) & (score < 0)).alias("in_range"),
        F.bool_and(score == F.col("second")).alias("same_again"),
        F.sum("IF_Anomaly").alias("flagged"),
    )
    wanted = F.col("contamination") * F.col("events")
    met = F.abs(F.col("flagged") - wanted) <= F.greatest(F.lit(2.0), wanted * 0.1)
    return counted.crossJoin(anomalies.contamination(t)).select(
        "events", "in_range", "same_again", met.alias("share_is_met")
    )


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and totals of every result of the deterministic analyses, from one pipeline run."""
    run = Pipeline(read_telemetry(spark, sf_dir), trend_system=None, trend_settings=TREND_MEDIAN)
    results = run.run(["profile", "binning", "spikes", "trends", "failures"])
    out = []
    for (analysis, name), (_, columns) in PIPELINE_TABLES.items():
        total = reduce(operator.add, [F.coalesce(F.col(c), F.lit(0)) for c in columns])
        out.append(
            plain(results[analysis][name])
            .agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum(total).cast("double"), 2).alias("total"))
            .select(F.lit(analysis).alias("analysis"), F.lit(name).alias("result"), "rows", "total")
        )
    return reduce(DataFrame.unionByName, out)


QUERIES["pip_deterministic"] = _pipeline
_add("seg_means", lambda t: segments.means(t, ["SourceSystem"]))
_add("seg_shares", lambda t: segments.shares(t, ["SourceSystem"]))


@_on_telemetry("lbl_intervals")
def _intervals(t: DataFrame) -> DataFrame:
    """Failure periods and the 100 events around each of them, as overlapping intervals of positions."""
    found = (
        t.filter("FailureWindow")
        .groupBy(F.floor(F.col("EventSeq") / 1000).alias("i"))
        .agg(F.min("EventSeq").alias("start"), F.max("EventSeq").alias("end"))
        .drop("i")
    )
    wider = found.select((F.col("start") - 50).alias("start"), (F.col("start") + 50).alias("end"))
    return labels.mark_intervals(
        t.select("EventSeq"), found.unionByName(wider), "EventSeq", "in_interval", width=700
    )


_add(
    "lbl_spikes",
    lambda t: labels.with_spike_labels(t.drop("IsSpikeByLatency", "IsSpikeByCpu", "IsSpikeByQps")).select(
        "EventSeq", "IsSpikeByLatency", "IsSpikeByCpu", "IsSpikeByQps"
    ),
)
_add(
    "lbl_roles",
    lambda t: t.groupBy("SourceSystem", labels.system_role("SourceSystem").alias("role")).agg(
        F.count(F.lit(1)).alias("events")
    ),
)
_add("lbl_counters", labels.counters)
