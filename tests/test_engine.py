"""Engine parts on hand-made tables: times, logs, order, intervals, quantiles, traces, forests, segments."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logsonde.functions.quantiles import quantiles
from logsonde.functions.storage import shared_folder
from logsonde.functions.time import event_order
from logsonde.functions.typing import parse_timestamp, with_date_parts
from logsonde.operators import anomalies, binning, failures, forest, labels, rca, segments, spikes
from logsonde.plans.pipeline import Pipeline
from logsonde.schema import MODEL_FEATURES
from logsonde.sources import logs
from logsonde.plans.telemetry import read_telemetry


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return read_telemetry(spark, sf_dir).cache()


@pytest.fixture()
def new_york(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_times_are_utc_in_any_session(new_york):
    rows = new_york.createDataFrame([("2026-01-01T02:00:00Z",), (" 2026-01-01 02:00:00.5 ",), ("2026-01-01T04:00:00+02:00",), ("2026-01-01",), ("no",), (None,)], "x string")
    got = with_date_parts(rows.select(parse_timestamp("x").alias("Timestamp"))).collect()
    assert [(r["TimestampHour"], r["TimestampDayOfWeek"]) for r in got] == [(2, 3), (2, 3), (2, 3), (0, 3), (None, None), (None, None)]


def test_a_log_comes_back_equal_in_any_session(new_york, sf_dir, tmp_path):
    written = read_telemetry(new_york, sf_dir).cache()
    logs.write_logs(written, str(tmp_path / "log"))
    back = logs.read_logs(new_york, [str(tmp_path / "none"), str(tmp_path / "log")])
    names = [c for c in written.columns if c in back.columns and c not in ("EventSeq", "Description")]
    micros = [F.unix_micros(c).alias(c) if c == "Timestamp" and dict(x.dtypes)[c] == "timestamp" else F.col(c) for x in (back,) for c in names]
    ours = [F.unix_micros(F.col(c).cast("timestamp")).alias(c) if c == "Timestamp" else F.col(c) for c in names]
    if dict(written.dtypes)["Timestamp"] == "timestamp_ntz":
        ours = [F.unix_micros(F.to_timestamp(F.concat(F.col(c).cast("string"), F.lit("Z")))).alias(c) if c == "Timestamp" else F.col(c) for c in names]
    kinds = dict(back.dtypes)
    same = [F.round(F.col(c).cast("double"), 2).alias(c) if kinds[c] in ("double", "bigint", "int") else F.col(c).cast("string").alias(c) for c in names]
    a, b = written.select(*ours).select(*same), back.select(*micros).select(*same)
    assert back.count() == written.count() > 0
    assert a.exceptAll(b).count() == 0
    stats = labels.counters(written)
    logs.write_stats(stats, str(tmp_path / "stats"))
    assert logs.read_stats(new_york, str(tmp_path / "stats")).select(*stats.columns).first() == stats.first()
    assert logs.read_stats(new_york, str(tmp_path / "nowhere")) is None
    written.unpersist()


def test_attributes_are_typed_by_their_tokens(spark):
    rows = spark.createDataFrame([('{"k":"00123","n":1,"b":true}',), ('{"n":2.5,"o":"x"}',), (None,), ("{broken",), ("",)], "AttributesJson string")
    schema = logs.infer_attributes(rows)
    assert {f.name: f.dataType.simpleString() for f in schema} == {"k": "string", "n": "double", "b": "boolean", "o": "string"}
    flat = logs.flatten_attributes(rows, schema=schema).collect()
    assert flat[0]["k"] == "00123" and flat[0]["n"] == 1.0 and flat[1]["o"] == "x"
    with pytest.raises(ValueError):
        logs.infer_attributes(rows, max_keys=2)
    assert len(logs.infer_attributes(rows.limit(0))) == 0


def test_order_is_that_of_the_picked_time(spark):
    rows = [(3, "a", "2026-01-01T00:00:01Z", 1), (1, "b", "2026-01-01T00:00:02Z", 1), (2, "c", None, 1)]
    scored = spark.createDataFrame(rows, "EventSeq long, SourceSystem string, EventTime string, FailureCandidate int").withColumn("CorrelationId", F.lit("x"))
    assert failures.first_failures(scored).first()["FirstFailSystem"] == "a"
    assert failures.first_failures(scored.withColumn("EventTime", F.to_timestamp("EventTime"))).first()["FirstFailSystem"] == "a"
    with pytest.raises(ValueError):
        event_order(scored.drop("EventTime", "EventSeq"))


@pytest.mark.parametrize("width", [7, 700, 1_000_000])
def test_intervals_of_any_length(spark, width):
    rng = random.Random(width)
    spans = [(a, a + rng.choice([0, 3, 50, 900])) for a in (rng.randrange(-500, 5000) for _ in range(30))] + [(9000, 10**12), (5, 4)]
    places = [rng.randrange(-600, 9500) for _ in range(400)] + [10**12, 10**12 + 1, None]
    df = spark.createDataFrame([(p, p) for p in places], "p long, start long")
    got = labels.mark_intervals(df, spark.createDataFrame(spans, "start long, end long"), "p", "inside", width)
    expected = [(p, p, p is not None and any(a <= p <= b for a, b in spans)) for p in places]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


def test_quantiles_are_exact(spark):
    rng = np.random.default_rng(3)
    n = 20_000
    columns = {
        "skewed": np.exp(6 * rng.standard_normal(n)),
        "tied": np.where(rng.random(n) < 0.9, 5.0, rng.random(n)),
        "uniform": rng.random(n),
    }
    rows = list(zip(*[c.tolist() for c in columns.values()], strict=True))
    df = spark.createDataFrame(rows, ["skewed", "tied", "uniform"]).repartition(4)
    probs = [0.0, 0.25, 0.5, 0.951, 1.0]
    got = quantiles(df, list(columns), probs).first()
    for c, values in columns.items():
        np.testing.assert_allclose(got[c], np.quantile(values, probs), rtol=1e-12)
    odd = spark.createDataFrame([(1.0, None), (float("inf"), None), (2.0, None), (None, None)], "x double, y double")
    got = quantiles(odd, ["x", "y"], [0.5, 1.0]).first()
    assert got["x"] == [2.0, float("inf")] and got["y"] == [None, None]
    assert quantiles(odd.limit(0), ["x"], [0.5]).first()["x"] == [None]


def test_published_confusions(spark):
    rows = [(1, 500, 8512), (1, 100, 9260), (0, 500, 2), (0, 100, 1665)]
    df = spark.createDataFrame(rows, "FailureCandidate int, EventCode int, n int")
    df = df.select("FailureCandidate", "EventCode", F.explode(F.sequence(F.lit(1), "n"))).withColumn("FailureWindow", F.lit(False))
    got = failures.confusions(df).filter("truth = 'code'").first()
    assert (got["tp"], got["fp"], got["fn"], got["tn"]) == (8512, 9260, 2, 1665)
    assert round(got["precision"], 5) == 0.47896 and round(got["recall"], 5) == 0.99977 and round(got["f1"], 5) == 0.64765


def traces(rng):
    """Long correlations that cross chunks and come back to their first system."""
    rows, seq = [], 0
    for c in range(6):
        for i in range(rng.randint(1, 40)):
            seq += 1
            minute = rng.randrange(0, 120)
            code = 500 if rng.random() < 0.08 else 100
            time = None if rng.random() < 0.05 else f"2026-01-01 {minute // 60:02d}:{minute % 60:02d}:00"
            rows.append((seq, f"c{c}", rng.choice("AAB"), time, code, float(rng.randint(1, 50)), i))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_traces_over_chunk_borders(spark, seed):
    rows = traces(random.Random(seed))
    df = spark.createDataFrame(rows, "EventSeq long, CorrelationId string, SourceSystem string, Timestamp string, EventCode int, LatencyMs double, ScenarioStepIndex int")
    df = df.withColumn("Timestamp", F.to_timestamp("Timestamp"))
    marked = rca.mark(df).cache()
    problem = {r["EventSeq"]: r["problem"] for r in marked.select("EventSeq", "problem").collect()}
    pre, route = {}, {}
    for c in {r[1] for r in rows}:
        own = sorted((r for r in rows if r[1] == c), key=lambda r: (r[3] or "9", r[6], r[0]))
        first = next((i for i, r in enumerate(own) if problem[r[0]]), len(own))
        for back, r in enumerate(reversed(own[:first][-5:]), 1):
            pre[c, back] = r[0]
        route[c] = [r[2] for i, r in enumerate(own) if i == 0 or own[i - 1][2] != r[2]]
    got = {(r["CorrelationId"], r["back"]): r["EventSeq"] for r in rca.pre_events(marked).collect()}
    assert got == pre
    found: dict = {}
    for r in rca.path(marked).orderBy("CorrelationId", "position").collect():
        found.setdefault(r["CorrelationId"], []).append(r["SourceSystem"])
    assert found == route
    marked.unpersist()


def test_edge_cases_of_tables(spark, events):
    none = events.limit(0)
    assert failures.propagation(failures.score(none)).count() == 0
    assert rca.pre_events(rca.mark(none)).count() == 0
    assert spikes.by_service(spikes.detect(none)).count() == 0
    flat = events.withColumns({"LatencyMs": F.lit(5), "CpuUsage": F.lit(1.0)})
    assert rca.deviations(rca.mark(flat)).filter("metric IN ('LatencyMs', 'CpuUsage')").count() == 0  # an IQR of zero
    assert binning.period_histogram(none).count() >= 0
    at = events.agg(F.max("Timestamp").alias("t")).first()["t"]
    assert spikes.find_timeframe(events, at, 5).count() >= 1


def test_forest_draws_alike_at_any_size_and_repeats(spark, events):
    for n in (300, 3000):
        df = spark.range(n).select(F.col("id").alias("EventSeq"), (F.col("id") % 97).cast("double").alias("x"))
        drawn = forest.tree_samples(df, ["x"], "EventSeq", 20, 64, 1).groupBy("tree").count().collect()
        assert len(drawn) == 20 and all(r["count"] == 64 for r in drawn)
    scored = anomalies.isolation_forest(events, columns=["EventCode"])
    assert scored.columns == ["EventSeq", "EventCode", "IF_AnomalyScore", "IF_Anomaly"]
    assert scored.filter("IF_AnomalyScore >= 0 OR IF_AnomalyScore <= -1").count() == 0
    known = anomalies.moments(events.withColumn("LatencyMs", F.when(F.col("EventSeq") % 3 > 0, F.col("LatencyMs"))), ["LatencyMs"])
    imputed = anomalies.impute(events.withColumn("LatencyMs", F.when(F.col("EventSeq") % 3 > 0, F.col("LatencyMs"))), ["LatencyMs"])
    row = imputed.agg(F.avg("LatencyMs").alias("m"), F.stddev_pop("LatencyMs").alias("s")).first()
    np.testing.assert_allclose(known["LatencyMs"], (row["m"], row["s"]), rtol=1e-9)


def test_segments_without_spike_columns(spark, events):
    bare = events.drop("IsSpikeByLatency", "IsSpikeByCpu", "IsSpikeByQps")
    assert "pct_IsSpikeByCpu" not in segments.shares(bare, ["SourceSystem"]).columns
    vectors = segments.feature_vectors(events, MODEL_FEATURES).cache()
    models = segments.fit_kmeans(vectors, [2, 4], starts=2)
    rows = segments.checks(segments.assign(vectors, models), models).collect()
    assert [r["clusters"] for r in rows] == [2, 4] and not any(r["nearer_to_another"] for r in rows)
    assert all(r["centres_are_means"] and r["cheaper_than_fewer"] for r in rows)
    vectors.unpersist()


def test_a_cluster_needs_a_shared_folder(spark):
    class Conf:
        get = staticmethod(lambda *_: None)

    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError):
        shared_folder(Session)
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_the_pipeline_from_a_file(spark, sf_dir, tmp_path):
    logs.write_logs(read_telemetry(spark, sf_dir), str(tmp_path / "log"))
    run = Pipeline(logs.read_logs(spark, str(tmp_path / "log")).cache(), all_correlations=True)
    results = run.run(["profile", "spikes", "failures"])
    assert results["profile"]["counts"].first()["events_count"] == read_telemetry(spark, sf_dir).count()
    assert all(df.count() >= 0 for analysis in results.values() for df in analysis.values())
