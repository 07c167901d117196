"""The registered queries as SQL for DuckDB, written independently of the Spark code.

Only the telemetry view is shared, and numbers that fix the forest's draws. The forest is grown here too, level by level. K-means and the regressions are
followed for fixed starts and single features (`clu_pass_*`, `prd_small_*`); the `_checks` queries compare properties of the full fits.
"""

from __future__ import annotations

from logsonde.operators import anomalies, rca
from logsonde.operators.forest import DRAWN, EULER_GAMMA, PRIME, SAMPLE, SEED, TREES, tree_numbers
from logsonde.schema import DIAGNOSIS_FLAGS, DIAGNOSIS_METRICS, MODEL_FEATURES, REASON_CODES
from logsonde.plans.telemetry import telemetry_cte

TS = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


def ts(column: str, name: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"


def r6(expr: str, name: str) -> str:
    return f"round(cast({expr} AS DOUBLE), 6) + 0e0 AS {name}"


def b(expr: str, name: str) -> str:
    return f"cast({expr} AS BIGINT) AS {name}"


def cte(*parts: str) -> str:
    return "WITH " + ",\n".join([telemetry_cte(), *parts])


ORACLES: dict[str, str] = {}

# -- sources and typing ---------------------------------------------------------------------

ORACLES["src_limit"] = f"""{cte()}
SELECT EventSeq, {ts('"Timestamp"', '"Timestamp"')}, SourceSystem, LatencyMs
FROM t ORDER BY "Timestamp", EventSeq LIMIT 1000"""

ORACLES["src_file"] = f"""{cte()}
SELECT TransactionId, CorrelationId, SourceSystem, {b("EventCode", "EventCode")}, {b("LatencyMs", "LatencyMs")}, Priority,
  {r6("CpuUsage", "CpuUsage")}, {b("Retries", "Retries")}, {r6("LocalQps", "LocalQps")} FROM t"""
ORACLES["src_flatten_json"] = """
SELECT event_id, event_type, cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""

ORACLES["src_json_tolerant"] = """
WITH x AS (
  SELECT event_id, CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN '  '
    WHEN 2 THEN left(props, length(props) - 1) WHEN 3 THEN '  ' || props || ' ' END AS s FROM events)
SELECT event_id, coalesce(s, '') <> '' AND json_valid(trim(s)) AS is_valid,
  cast(CASE WHEN s IS NOT NULL AND trim(s) <> '' AND json_valid(trim(s))
       THEN json_extract_string(trim(s), '$.k') ELSE '-1' END AS BIGINT) AS k FROM x"""

ORACLES["typ_to_numeric"] = """
SELECT event_id, event_id % 4 <> 0 AS is_bad,
  round(CASE WHEN event_id % 4 = 0 THEN value ELSE -1 END, 6) AS number FROM events"""

ORACLES["typ_parse_ts"] = f"""
SELECT event_id, CASE WHEN event_id % 4 = 3 THEN 'bad' ELSE {TS.format('ts')} END AS parsed FROM events"""

ORACLES["typ_date_parts"] = """
SELECT cast(hour(ts) AS BIGINT) AS "TimestampHour", cast(isodow(ts) - 1 AS BIGINT) AS "TimestampDayOfWeek",
  count(*) AS events FROM events GROUP BY 1, 2"""

ORACLES["typ_code_classes"] = f"""{cte()}
SELECT cast(EventCode AS BIGINT) AS "EventCode", count(*) AS events,
  {b("sum(CASE WHEN EventCode // 100 = 5 THEN 1 ELSE 0 END)", "is_5xx")},
  {b("sum(CASE WHEN EventCode = 500 OR EventCode = 501 THEN 1 ELSE 0 END)", "is_failure_code")},
  {b("sum(CASE WHEN EventCode = 998 OR EventCode = 999 THEN 1 ELSE 0 END)", "is_anomaly_code")},
  {b("sum(CASE WHEN EventCode >= 500 THEN 1 ELSE 0 END)", "is_problem_code")}
FROM t GROUP BY EventCode"""

_JSON = [
    ("ScenarioStepIndex", "n"), ("ScenarioLocalStep", "n"), ("SpikeWindow", "n"), ("FailureWindow", "n"),
    ("TrendWindow", "n"), ("CpuUsage", "n"), ("MemoryUsageMb", "n"), ("RequestSizeBytes", "n"),
    ("ResponseSizeBytes", "n"), ("Retries", "n"), ("ClusterNode", "s"), ("Region", "s"), ("BusinessKey", "s"),
    ("DiskQueueLength", "n"), ("NetworkErrors", "n"), ("LocalQps", "n"), ("IsSpikeByLatency", "n"),
    ("IsSpikeByCpu", "n"), ("IsSpikeByQps", "n"),
]
_PAIRS = ", ".join(
    f"""'"{n}":' || {f"cast({n} AS VARCHAR)" if k == "n" else f"chr(34) || {n} || chr(34)"}""" for n, k in _JSON
)
ORACLES["snk_csv_line"] = f"""{cte()}
SELECT EventSeq, concat_ws(';', strftime("Timestamp", '%Y-%m-%dT%H:%M:%S.%f') || '0Z', Priority, "User",
  SourceSystem, EventKind, cast(EventCode AS VARCHAR), TransactionId, CorrelationId,
  replace(Description, ';', ','), cast(LatencyMs AS VARCHAR), cast(IsAnomaly AS VARCHAR), Scenario,
  '{{' || concat_ws(',', {_PAIRS}) || '}}') AS line FROM t"""

# -- profile and binning --------------------------------------------------------------------

ORACLES["pro_counts"] = f"""{cte()}
SELECT count(*) AS events_count, count(DISTINCT TransactionId) AS transactions_count,
  count(DISTINCT CorrelationId) AS correlations_count FROM t"""

for _name, _col in (("priority", "Priority"), ("source_system", "SourceSystem"), ("scenario", "Scenario")):
    ORACLES[f"pro_{_name}"] = f"""{cte()}
SELECT {_col}, count(*) AS events FROM t GROUP BY {_col}"""
ORACLES["pro_event_code"] = f"""{cte()}
SELECT cast(EventCode AS BIGINT) AS "EventCode", count(*) AS events FROM t GROUP BY EventCode"""
ORACLES["pro_all_distributions"] = f"""{cte()}
SELECT CASE WHEN grouping(Priority) = 0 THEN 'Priority' WHEN grouping(EventCode) = 0 THEN 'EventCode'
    WHEN grouping(SourceSystem) = 0 THEN 'SourceSystem' ELSE 'Scenario' END AS "column",
  coalesce(Priority, cast(EventCode AS VARCHAR), SourceSystem, Scenario) AS value, count(*) AS events
FROM t GROUP BY GROUPING SETS ((Priority), (EventCode), (SourceSystem), (Scenario))"""


def _edges(metric: str, bins: int) -> str:
    """CTE of (bin, lo, hi, last) of an equal-width histogram over all of `t`."""
    return f"""ends AS (SELECT cast(min({metric}) AS DOUBLE) AS a, cast(max({metric}) AS DOUBLE) AS z FROM t),
span AS (SELECT CASE WHEN a = z THEN a - 0.5 ELSE a END AS a, CASE WHEN a = z THEN z + 0.5 ELSE z END AS z FROM ends),
edges AS (SELECT i AS bin, a + i * ((z - a) / {bins}) AS lo, a + (i + 1) * ((z - a) / {bins}) AS hi,
  i = {bins - 1} AS last FROM span, range(0, {bins}) r(i))"""


def _in_bin(metric: str) -> str:
    return f"t.{metric} >= e.lo AND (t.{metric} < e.hi OR e.last)"


for _name, _col in (("latency", "LatencyMs"), ("cpu", "CpuUsage"), ("qps", "LocalQps"), ("disk", "DiskQueueLength")):
    ORACLES[f"pro_hist_{_name}"] = f"""{cte(_edges(_col, 50))}
SELECT '{_col}' AS metric, {b("e.bin", "bin")}, {r6("e.lo", "bin_lo")}, {r6("e.hi", "bin_hi")},
  count(t.EventSeq) AS events
FROM edges e LEFT JOIN t ON {_in_bin(_col)} GROUP BY ALL"""

ORACLES["bin_edges"] = f"""{cte(_edges("LatencyMs", 20))}
SELECT {b("bin", "edge")}, {r6("lo", "value")} FROM edges
UNION ALL SELECT 20, {r6("hi", "value")} FROM edges WHERE last"""

_PERIOD = """periods AS (
  SELECT 'no_spike' AS period, LatencyMs, EventSeq FROM t WHERE NOT SpikeWindow
  UNION ALL SELECT 'spike', LatencyMs, EventSeq FROM t WHERE SpikeWindow
  UNION ALL SELECT 'failure', LatencyMs, EventSeq FROM t WHERE FailureWindow
  UNION ALL SELECT 'trend', LatencyMs, EventSeq FROM t WHERE TrendWindow),
names AS (SELECT unnest(['no_spike', 'spike', 'failure', 'trend']) AS period),
hist AS (SELECT n.period, e.bin, e.lo, e.hi, count(p.EventSeq) AS events
  FROM names n CROSS JOIN edges e LEFT JOIN periods p
    ON p.period = n.period AND p.LatencyMs >= e.lo AND (p.LatencyMs < e.hi OR e.last) GROUP BY ALL)"""
ORACLES["bin_period_histogram"] = f"""{cte(_edges("LatencyMs", 20), _PERIOD)}
SELECT period, {b("bin", "bin")}, {r6("lo", "bin_lo")}, {r6("hi", "bin_hi")}, events FROM hist"""

_PERIOD_STATS = """stats AS (
  SELECT h.period, sum(h.events) AS n, var_pop(h.events) AS variance,
    coalesce(-sum(CASE WHEN h.events > 0 THEN (h.events / s.total) * log2(h.events / s.total) END), 0) AS entropy,
    max(h.events) AS top, min(h.events) FILTER (h.events > 0) AS low, quantile_cont(h.events, 0.5) AS mid
  FROM hist h JOIN (SELECT period, cast(sum(events) AS DOUBLE) AS total FROM hist GROUP BY period) s
    ON s.period = h.period GROUP BY h.period)"""
ORACLES["bin_period_stats"] = f"""{cte(_edges("LatencyMs", 20), _PERIOD, _PERIOD_STATS)}
SELECT period, {b("n", "events")}, {r6("variance", "variance")}, {r6("entropy", "entropy")},
  {r6("CASE WHEN low > 0 THEN top / low ELSE 'inf'::DOUBLE END", "balance_max_min")},
  {r6("CASE WHEN mid > 0 THEN top / mid ELSE 'inf'::DOUBLE END", "balance_max_median")} FROM stats"""
ORACLES["bin_compare"] = f"""{cte(_edges("LatencyMs", 20), _PERIOD, _PERIOD_STATS)}
SELECT s.period, {r6("CASE WHEN k.variance > 0 THEN s.variance / k.variance ELSE 'inf'::DOUBLE END", "variance_ratio")},
  {r6("s.entropy - k.entropy", "entropy_delta")}
FROM stats s, stats k WHERE k.period = 'no_spike' AND s.period <> 'no_spike'"""

# -- spikes ---------------------------------------------------------------------------------

_RULES = {
    "latency": ("LatencyMs", "IsSpikeByLatency", 4, "mean"),
    "cpu": ("CpuUsage", "IsSpikeByCpu", 2, "mean"),
    "qps": ("LocalQps", "IsSpikeByQps", 3, "median"),
}
_SPIKE_STATS = "sp AS (SELECT " + ", ".join(
    f"quantile_cont(cast({m} AS DOUBLE), 0.5) AS {n}_median, avg({m}) AS {n}_mean, stddev_samp({m}) AS {n}_std"
    for n, (m, *_r) in _RULES.items()
) + " FROM t)"
_SPIKES = "s AS (SELECT t.*, " + ", ".join(
    f"({m} > {k} * {n}_median OR {m} > {n}_{c} + {k} * {n}_std) AS {n}" for n, (m, _t, k, c) in _RULES.items()
) + " FROM t, sp)"
ORACLES["spk_thresholds"] = f"""{cte(_SPIKE_STATS)}
SELECT {", ".join(r6(f"{n}_{x}", f"{n}_{x}") for n in _RULES for x in ("median", "mean", "std"))} FROM sp"""
for _n, (_m, *_rest) in _RULES.items():
    ORACLES[f"spk_{_n}"] = f"""{cte(_SPIKE_STATS, _SPIKES)}
SELECT EventSeq, SourceSystem, {r6(_m, "value")} FROM s WHERE {_n}"""
ORACLES["spk_by_service"] = f"""{cte(_SPIKE_STATS, _SPIKES)}
SELECT SourceSystem, {", ".join(b(f"sum({n}::INT)", f"{n}_spikes") for n in _RULES)},
  {b("sum(latency::INT + cpu::INT + qps::INT)", "total_spikes")} FROM s GROUP BY SourceSystem"""
ORACLES["spk_overall"] = f"""{cte(_SPIKE_STATS, _SPIKES)},
d AS (SELECT {", ".join(f'count(DISTINCT "Timestamp") FILTER ({n}) AS {n}' for n in _RULES)} FROM s)
SELECT *, latency + cpu + qps AS total FROM d"""


def _confusion(pred: str, truth: str) -> str:
    return (
        f"{b(f'sum(({pred} AND {truth})::INT)', 'tp')}, {b(f'sum(({pred} AND NOT {truth})::INT)', 'fp')}, "
        f"{b(f'sum((NOT {pred} AND NOT {truth})::INT)', 'tn')}, {b(f'sum((NOT {pred} AND {truth})::INT)', 'fn')}"
    )


_SPIKE_CONFUSION = "c AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS rule, {_confusion(n, t)} FROM s" for n, (_m, t, *_r) in _RULES.items()
) + ")"
ORACLES["spk_confusion"] = f"{cte(_SPIKE_STATS, _SPIKES, _SPIKE_CONFUSION)} SELECT * FROM c"
ORACLES["spk_scores"] = f"""{cte(_SPIKE_STATS, _SPIKES, _SPIKE_CONFUSION)},
p AS (SELECT *, tp / (tp + fp + 1e-10) AS pr, tp / (tp + fn + 1e-10) AS re FROM c)
SELECT rule, tp, fp, tn, fn, {r6("pr", "precision")}, {r6("re", "recall")},
  {r6("2 * pr * re / (pr + re + 1e-10)", "f1")} FROM p"""
ORACLES["spk_trailing_5m"] = f"""{cte()}
SELECT SourceSystem, {ts('"Timestamp"', '"Timestamp"')}, count(*) OVER w AS trailing_events,
  {r6("avg(LatencyMs) OVER w", "trailing_mean")} FROM t
WINDOW w AS (PARTITION BY SourceSystem ORDER BY "Timestamp"
  RANGE BETWEEN INTERVAL 360 MINUTES PRECEDING AND CURRENT ROW)"""

# -- trends ---------------------------------------------------------------------------------


def _buckets(agg: str) -> str:
    return f"""bk AS (SELECT SourceSystem, time_bucket(INTERVAL 2 HOURS, "Timestamp") AS bucket,
  {agg} AS metric_agg, bool_or(TrendWindow) AS truth FROM t GROUP BY 1, 2)"""


_MEDIAN = _buckets("median(cast(LatencyMs AS DOUBLE))")
_TREND = """sm AS (SELECT *, CASE WHEN row_number() OVER o >= 3 THEN median(metric_agg) OVER
    (PARTITION BY SourceSystem ORDER BY bucket ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS smooth
  FROM bk WINDOW o AS (PARTITION BY SourceSystem ORDER BY bucket)),
ic AS (SELECT *, row_number() OVER o AS i, coalesce(smooth > lag(smooth) OVER o, false) AS up
  FROM sm WINDOW o AS (PARTITION BY SourceSystem ORDER BY bucket)),
isl AS (SELECT *, i - row_number() OVER (PARTITION BY SourceSystem, up ORDER BY bucket) AS island FROM ic),
td AS (SELECT *, up AND count(*) OVER (PARTITION BY SourceSystem, up, island) >= 3 AS tr FROM isl)"""
for _n, _agg in (("median", "median(cast(LatencyMs AS DOUBLE))"), ("mean", "avg(LatencyMs)")):
    ORACLES[f"trd_buckets_{_n}"] = f"""{cte(_buckets(_agg))}
SELECT SourceSystem, {ts("bucket", "bucket")}, {r6("metric_agg", "metric_agg")}, truth AS trend_truth FROM bk"""
ORACLES["trd_smooth"] = f"""{cte(_MEDIAN, _TREND)}
SELECT SourceSystem, {ts("bucket", "bucket")}, {r6("metric_agg", "metric_agg")}, {r6("smooth", "metric_smooth")}
FROM sm WHERE smooth IS NOT NULL"""
ORACLES["trd_detect"] = f"""{cte(_MEDIAN, _TREND)}
SELECT SourceSystem, {ts("bucket", "bucket")}, up AS is_increase, tr AS is_trend, truth AS trend_truth FROM td"""
_SEGMENTS = """ed AS (SELECT SourceSystem, TrendWindow AS f,
    lag(TrendWindow, 1, false) OVER (PARTITION BY SourceSystem ORDER BY "Timestamp", EventSeq) AS p FROM t),
sg AS (SELECT SourceSystem, count(*) AS events, cast(sum(f::INT) AS BIGINT) AS trend_events,
    cast(sum((f AND NOT p)::INT) AS BIGINT) AS segments FROM ed GROUP BY SourceSystem)"""
ORACLES["trd_segments"] = f"{cte(_SEGMENTS)} SELECT * FROM sg"
_RATIOS = """round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS "precision",
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
  round(CASE WHEN tp + fp + tn + fn > 0 THEN (tp + tn) / (tp + fp + tn + fn) ELSE 0 END, 6) AS accuracy,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1"""
ORACLES["trd_scores"] = f"""{cte(_MEDIAN, _TREND)},
c AS (SELECT SourceSystem, {_confusion("tr", "truth")} FROM td GROUP BY SourceSystem)
SELECT *, {_RATIOS} FROM c"""
ORACLES["trd_summary"] = f"""{cte(_MEDIAN, _TREND, _SEGMENTS)}
SELECT sg.SourceSystem, events, trend_events, segments, count(*) AS buckets,
  {b("sum(tr::INT)", "detected_buckets")}, {b("sum(truth::INT)", "trend_buckets")}
FROM sg JOIN td ON sg.SourceSystem = td.SourceSystem GROUP BY ALL"""
ORACLES["trd_recent_12h"] = f"""{cte(_MEDIAN, _TREND)}
SELECT SourceSystem, {ts("bucket", "bucket")}, {r6("metric_agg", "metric_agg")}, {r6("smooth", "metric_smooth")},
  tr AS is_trend, truth AS trend_truth FROM td
WHERE bucket >= (SELECT max(x.bucket) - INTERVAL 12 HOURS FROM td x WHERE x.SourceSystem = td.SourceSystem)"""

# -- failures -------------------------------------------------------------------------------

_THR = """th AS (SELECT avg(LatencyMs) + 2 * stddev_pop(LatencyMs) AS l,
  avg(DiskQueueLength) + 3 * stddev_pop(DiskQueueLength) AS d,
  avg(NetworkErrors) + 3 * stddev_pop(NetworkErrors) AS n, avg(CpuUsage) + 3 * stddev_pop(CpuUsage) AS c FROM t)"""
_SCORE = """fs AS (SELECT t.*, CASE WHEN EventKind IN ('Trace', 'Audit', 'Heartbeat') THEN 0 ELSE
    CASE WHEN upper(Priority) IN ('ERR', 'ERROR', 'CRIT', 'CRITICAL') THEN 4 ELSE 0 END
  + CASE WHEN LatencyMs > l * 2 THEN 4 WHEN LatencyMs > l * 1.5e0 THEN 2 WHEN LatencyMs > l THEN 1 ELSE 0 END
  + CASE WHEN DiskQueueLength > d * 3 THEN 1.5e0 WHEN DiskQueueLength > d THEN 1 ELSE 0 END
  + CASE WHEN NetworkErrors > n THEN 0.5e0 ELSE 0 END + CASE WHEN NetworkErrors > 5 THEN 0.5e0 ELSE 0 END
  + CASE WHEN Retries >= 3 THEN 2 WHEN Retries > 0 THEN 1 ELSE 0 END
  + CASE WHEN CpuUsage > 95 THEN 1 WHEN CpuUsage > c THEN 0.5e0 ELSE 0 END END AS score FROM t, th),
fc AS (SELECT *, score >= 6.5e0 AS cand FROM fs)"""
ORACLES["flr_thresholds"] = f"""{cte(_THR)}
SELECT {r6("l", '"thr_LatencyMs"')}, {r6("d", '"thr_DiskQueueLength"')}, {r6("n", '"thr_NetworkErrors"')},
  {r6("c", '"thr_CpuUsage"')} FROM th"""
_WINDOWS = """bw AS (SELECT time_bucket(INTERVAL 5 MINUTES, "Timestamp") AS w, count(*) AS n,
  avg(CASE WHEN EventCode IN (500, 501) THEN 1e0 ELSE 0e0 END) AS share FROM t GROUP BY 1)"""
ORACLES["flr_bad_windows"] = f"""{cte(_WINDOWS)}
SELECT {ts("w", "window_start")}, n AS events, {r6("share", "share")} FROM bw WHERE share >= 0.1"""
ORACLES["flr_window_flag"] = f"""{cte(_WINDOWS)}
SELECT EventSeq, time_bucket(INTERVAL 5 MINUTES, "Timestamp") IN (SELECT w FROM bw WHERE share >= 0.1) AS "FailureWindow"
FROM t"""
ORACLES["flr_score"] = f'{cte(_THR, _SCORE)} SELECT EventSeq, {r6("score", chr(34) + "FailureScore" + chr(34))} FROM fc'
ORACLES["flr_candidates"] = f"""{cte(_THR, _SCORE)}
SELECT {b("sum(cand::INT)", "candidates")}, count(*) AS events FROM fc"""
for _n, _truth in (("code", "(EventCode IN (500, 501))"), ("window", "FailureWindow")):
    ORACLES[f"flr_confusion_{_n}"] = f"""{cte(_THR, _SCORE)},
c AS (SELECT '{_n}' AS truth, {_confusion("cand", _truth)} FROM fc) SELECT *, {_RATIOS} FROM c"""
_FIRST = """ff AS (SELECT CorrelationId, SourceSystem AS first FROM fc WHERE cand
  QUALIFY row_number() OVER (PARTITION BY CorrelationId ORDER BY "Timestamp", EventSeq) = 1)"""
ORACLES["flr_first_system"] = f"""{cte(_THR, _SCORE, _FIRST)}
SELECT CorrelationId, first AS "FirstFailSystem" FROM ff"""
ORACLES["flr_propagation"] = f"""{cte(_THR, _SCORE, _FIRST)}
SELECT first AS "FirstFailSystem", SourceSystem, count(*) AS "Events", {b("sum(cand::INT)", '"Candidates"')},
  {r6("avg(cand::INT)", '"CandidateRate"')}
FROM fc JOIN ff ON fc.CorrelationId = ff.CorrelationId GROUP BY 1, 2"""
ORACLES["flr_reconcile"] = f"""{cte(_THR, _SCORE)},
a AS (SELECT sum(cand::INT) AS k, count(*) AS n, sum((EventCode IN (500, 501))::INT) AS f FROM fc)
SELECT {b("k", "candidates")}, a.n AS events, {r6("k / a.n", "candidate_rate")},
  {r6("l", '"thr_LatencyMs"')}, {r6("d", '"thr_DiskQueueLength"')}, {r6("th.n", '"thr_NetworkErrors"')},
  {r6("c", '"thr_CpuUsage"')}, a.n AS truth_events, {b("f", "truth_failures")},
  {r6("k / a.n - f / a.n", "rate_difference")} FROM a, th"""

# -- anomalies ------------------------------------------------------------------------------

_GAPS = """g AS (SELECT * REPLACE (CASE WHEN IsAnomaly = 0 THEN LatencyMs END AS LatencyMs,
  CASE WHEN NOT SpikeWindow THEN CpuUsage END AS CpuUsage) FROM t)"""
_IMPUTED = (
    "im AS (SELECT EventSeq, "
    + ", ".join(f"coalesce(cast({c} AS DOUBLE), avg({c}) OVER ()) AS {c}" for c in MODEL_FEATURES)
    + " FROM g)"
)


def _z(c: str) -> str:
    return f"({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END"


def _standard(source: str) -> str:
    names = ", ".join(r6(_z(c), f'"z_{c}"') for c in MODEL_FEATURES)
    return f"SELECT EventSeq, {names} FROM {source}"


ORACLES["ano_impute"] = f'{cte(_GAPS, _IMPUTED)} SELECT EventSeq, {", ".join(r6(c, chr(34) + c + chr(34)) for c in MODEL_FEATURES)} FROM im'
ORACLES["ano_standardize"] = f"{cte(_GAPS, _IMPUTED)} {_standard('im')}"
ORACLES["ano_contamination"] = f"""{cte()}
SELECT {b("sum((EventCode >= 500 AND EventCode < 600)::INT)", "errors_5xx")},
  {r6("greatest(1e-5, least(0.5e0, avg((EventCode >= 500 AND EventCode < 600)::INT) / 10))", "contamination")} FROM t"""
ORACLES["ano_confusion_rule"] = f"""{cte()},
c AS (SELECT 'rule' AS prediction, {_confusion("(EventCode >= 500)", "(IsAnomaly = 1)")} FROM t)
SELECT *, {_RATIOS} FROM c"""
_TOP = """tp AS (SELECT Scenario, count(*) AS anomalies FROM t WHERE IsAnomaly = 1 GROUP BY Scenario
  ORDER BY anomalies DESC, Scenario LIMIT 3)"""
ORACLES["ano_top_scenarios"] = f"{cte(_TOP)} SELECT * FROM tp"
_REASON_ROWS = "zz AS (" + " UNION ALL ".join(
    f"""SELECT EventSeq, Scenario, {i} AS i, '{label}' AS label,
  abs({m} - quantile_cont(cast({m} AS DOUBLE), 0.5) OVER ()) / nullif(quantile_cont(cast({m} AS DOUBLE), 0.75) OVER ()
    - quantile_cont(cast({m} AS DOUBLE), 0.25) OVER (), 0) AS z, IsAnomaly FROM t"""
    for i, (m, label) in enumerate(anomalies.REASON_METRICS.items())
) + """),
rk AS (SELECT * FROM zz WHERE IsAnomaly = 1
  QUALIFY row_number() OVER (PARTITION BY EventSeq ORDER BY coalesce(z, 0) DESC, i) <= 2),
rs AS (SELECT EventSeq, any_value(Scenario) AS Scenario,
  coalesce(string_agg(label, ',' ORDER BY z DESC, i) FILTER (z > 0), 'other') AS reasons FROM rk GROUP BY EventSeq)"""
ORACLES["ano_reasons"] = f"{cte(_REASON_ROWS)} SELECT EventSeq, Scenario, reasons FROM rs"
_REASON_COUNTS = """ex AS (SELECT Scenario, unnest(string_split(reasons, ',')) AS reason FROM rs
  WHERE Scenario IN (SELECT Scenario FROM tp)),
rc AS (SELECT Scenario, reason, count(*) AS events,
  row_number() OVER (PARTITION BY Scenario ORDER BY count(*) DESC, reason) AS rank FROM ex GROUP BY 1, 2
  QUALIFY rank <= 5)"""
ORACLES["ano_reason_counts"] = f"{cte(_TOP, _REASON_ROWS, _REASON_COUNTS)} SELECT * FROM rc"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


ORACLES["ano_recommend"] = f"""{cte(_TOP, _REASON_ROWS, _REASON_COUNTS)},
ad(reason, line_no, line) AS (VALUES {_values([(r, i, v) for r, vs in anomalies.ADVICE.items() for i, v in enumerate(vs)])})
SELECT rc.reason, Scenario, {b("line_no", "line_no")}, line FROM rc JOIN ad ON ad.reason = rc.reason WHERE rank = 1"""

# -- root cause -----------------------------------------------------------------------------

_Q = "quantile_cont(cast({m} AS DOUBLE), {p})"
_RCA_STATS = "st AS (SELECT " + ", ".join(
    f"{_Q.format(m=m, p=0.25)} AS {m}_q25, {_Q.format(m=m, p=0.5)} AS {m}_med, {_Q.format(m=m, p=0.75)} AS {m}_q75, "
    f"{_Q.format(m=m, p=0.95)} AS {m}_p95"
    for m in DIAGNOSIS_METRICS
) + " FROM t)"
_MARKED = "m AS (SELECT t.*, " + ", ".join(
    f"abs({m} - {m}_med) / nullif({m}_q75 - {m}_q25, 0) AS z_{m}, {m}_med, {m}_q75 - {m}_q25 AS {m}_iqr"
    for m in DIAGNOSIS_METRICS
) + """,
  IsAnomaly = 1 OR EventCode >= 500 OR FailureWindow OR SpikeWindow OR LatencyMs >= LatencyMs_p95
    OR CpuUsage >= CpuUsage_p95 OR LocalQps >= LocalQps_p95 AS bad,
  row_number() OVER (PARTITION BY CorrelationId
    ORDER BY "Timestamp" NULLS LAST, ScenarioStepIndex NULLS LAST, EventSeq) AS rn FROM t, st)"""
_ROOT = """fp AS (SELECT CorrelationId, SourceSystem AS root, ScenarioStepIndex AS step, rn AS root_rn FROM m WHERE bad
  QUALIFY row_number() OVER (PARTITION BY CorrelationId ORDER BY rn) = 1)"""
_PATH = """rp AS (SELECT *, lag(SourceSystem) OVER (PARTITION BY CorrelationId ORDER BY rn) AS prev FROM m),
pa AS (SELECT CorrelationId, row_number() OVER (PARTITION BY CorrelationId ORDER BY rn) AS position, SourceSystem
  FROM rp WHERE prev IS DISTINCT FROM SourceSystem),
vi AS (SELECT pa.* FROM pa JOIN fp ON fp.CorrelationId = pa.CorrelationId
  WHERE pa.position > (SELECT min(x.position) FROM pa x WHERE x.CorrelationId = pa.CorrelationId AND x.SourceSystem = fp.root))"""
_DEVS = "dv AS (" + " UNION ALL ".join(
    f"SELECT CorrelationId, SourceSystem, EventSeq, rn, bad, '{m}' AS metric, {i} AS i, '{REASON_CODES[m]}' AS reason, "
    f"z_{m} AS z FROM m WHERE z_{m} > 1"
    for i, m in enumerate(DIAGNOSIS_METRICS)
) + ")"
_REASONS = """mz AS (SELECT CorrelationId, SourceSystem, metric, reason, i, avg(z) AS az, count(*) AS n
  FROM dv WHERE bad GROUP BY ALL),
re AS (SELECT CorrelationId, SourceSystem, metric, reason, i, round_even(az, 2) AS z, n,
  row_number() OVER (PARTITION BY CorrelationId, SourceSystem ORDER BY az DESC, i) AS rank FROM mz QUALIFY rank <= 3),
ds AS (SELECT CorrelationId, SourceSystem, count(*) AS k FROM m WHERE bad GROUP BY 1, 2)"""
_FLAGS = "fl AS (" + " UNION ALL ".join(
    f"SELECT CorrelationId, SourceSystem, '{f}' AS flag, count(*) AS n FROM m WHERE bad AND {f} GROUP BY 1, 2"
    for f in DIAGNOSIS_FLAGS
) + ")"
_PRE = """pe AS (SELECT m.*, row_number() OVER (PARTITION BY m.CorrelationId ORDER BY rn DESC) AS back
  FROM m LEFT JOIN fp ON fp.CorrelationId = m.CorrelationId WHERE fp.root_rn IS NULL OR m.rn < fp.root_rn QUALIFY back <= 5)"""
_RCA = cte(_RCA_STATS, _MARKED, _ROOT)

ORACLES["rca_pick"] = f"""{cte()},
a AS (SELECT CorrelationId, row_number() OVER (ORDER BY "Timestamp", EventSeq) AS i, count(*) OVER () AS n
  FROM t WHERE IsAnomaly = 1)
SELECT CorrelationId FROM a WHERE i = CASE WHEN n > 7 THEN 8 ELSE 1 END"""
ORACLES["rca_timeline"] = f"""{cte()}
SELECT CorrelationId, EventSeq, {ts('"Timestamp"', '"Timestamp"')}, SourceSystem, {b("EventCode", '"EventCode"')}, LatencyMs FROM t"""
ORACLES["rca_context"] = f"""{_RCA},
rg AS (SELECT CorrelationId, Region AS v, min(rn) AS f FROM m GROUP BY 1, 2),
nd AS (SELECT CorrelationId, ClusterNode AS v, min(rn) AS f FROM m GROUP BY 1, 2)
SELECT m.CorrelationId, count(*) AS events, min(Scenario) FILTER (rn = 1) AS scenario,
  (SELECT string_agg(v, ',' ORDER BY f) FROM rg WHERE rg.CorrelationId = m.CorrelationId) AS regions,
  (SELECT string_agg(v, ',' ORDER BY f) FROM nd WHERE nd.CorrelationId = m.CorrelationId) AS nodes
FROM m GROUP BY m.CorrelationId"""
ORACLES["rca_path"] = f"{cte(_RCA_STATS, _MARKED, _ROOT, _PATH)} SELECT * FROM pa"
ORACLES["rca_global_stats"] = f"""{cte(_RCA_STATS)} """ + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, {r6(f'{m}_q25', 'q25')}, {r6(f'{m}_med', 'median')}, {r6(f'{m}_q75', 'q75')}, "
    f"{r6(f'{m}_q75 - {m}_q25', 'iqr')}, {r6(f'{m}_p95', 'p95')} FROM st"
    for m in DIAGNOSIS_METRICS
)
ORACLES["rca_problem_rows"] = f"""{_RCA}
SELECT CorrelationId, EventSeq, SourceSystem, {b("EventCode", '"EventCode"')} FROM m WHERE bad"""
ORACLES["rca_first_problem"] = f"""{_RCA}
SELECT CorrelationId, root AS first_problem_system, {b("coalesce(step, -1)", "first_problem_step")} FROM fp"""
ORACLES["rca_victims"] = f"{cte(_RCA_STATS, _MARKED, _ROOT, _PATH)} SELECT CorrelationId, position, SourceSystem FROM vi"
ORACLES["rca_evidence"] = f"""{cte(_RCA_STATS, _MARKED, _ROOT, _PATH, _DEVS)},
e AS (SELECT CorrelationId, EXISTS (SELECT 1 FROM vi WHERE vi.CorrelationId = fp.CorrelationId) AS has_victims,
  EXISTS (SELECT 1 FROM dv WHERE dv.CorrelationId = fp.CorrelationId AND dv.rn > fp.root_rn) AS deviates_after FROM fp)
SELECT *, has_victims OR deviates_after AS propagation_evidence FROM e"""
ORACLES["rca_pre_events"] = f"""{cte(_RCA_STATS, _MARKED, _ROOT, _PRE)}
SELECT CorrelationId, back, EventSeq, SourceSystem FROM pe"""
ORACLES["rca_deviations"] = f"""{cte(_RCA_STATS, _MARKED, _DEVS)}
SELECT CorrelationId, SourceSystem, EventSeq, metric, {r6("z", "z")} FROM dv"""
_DIAG = cte(_RCA_STATS, _MARKED, _ROOT, _PATH, _DEVS, _REASONS, _FLAGS)
ORACLES["rca_diagnosis"] = f"""{_DIAG}
SELECT ds.CorrelationId, ds.SourceSystem, k AS problem_events, coalesce(rank, 1) AS rank,
  coalesce(reason, 'none') AS reason, coalesce(z, 0) AS z, coalesce(n, 0) AS n
FROM ds LEFT JOIN re ON re.CorrelationId = ds.CorrelationId AND re.SourceSystem = ds.SourceSystem"""
ORACLES["rca_flags"] = f"{_DIAG} SELECT * FROM fl"
_PRE_STATS = cte(_RCA_STATS, _MARKED, _ROOT, _PRE)
ORACLES["rca_pre_level"] = f"{_PRE_STATS}, x AS (" + " UNION ALL ".join(
    f"SELECT CorrelationId, '{m}' AS metric, avg({m}) AS a, any_value({m}_med) AS md, any_value({m}_iqr) AS q "
    "FROM pe GROUP BY CorrelationId"
    for m in DIAGNOSIS_METRICS
) + f""")
SELECT CorrelationId, metric, {r6("a", "average")}, {r6("md", "median")},
  CASE WHEN a > md THEN 'above' ELSE 'below' END AS direction, {r6("abs(a - md) / q", "z")}
FROM x WHERE q > 0 AND abs(a - md) / q > 1.5e0"""
ORACLES["rca_pre_rise"] = f"{_PRE_STATS}, x AS (" + " UNION ALL ".join(
    f"SELECT CorrelationId, '{m}' AS metric, cast(arg_max({m}, back) AS DOUBLE) AS f, "
    f"cast(arg_min({m}, back) AS DOUBLE) AS l, count({m}) AS n, any_value({m}_med) AS md FROM pe GROUP BY CorrelationId"
    for m in rca.RISE_METRICS
) + f""")
SELECT CorrelationId, metric, {r6("f", "first_value")}, {r6("l", "last_value")}, {r6("l - f", "rise")}
FROM x WHERE n >= 2 AND md > 0 AND l - f > 0 AND l - f > md * 0.3e0"""
_PRE_FLAG = "fx AS (" + " UNION ALL ".join(
    f"SELECT CorrelationId, 'flag' AS kind, '{f}' AS item, '{f} is set in ' || sum({f}::INT)::VARCHAR || ' of ' || "
    f"count(*)::VARCHAR || ' events' AS message FROM pe GROUP BY CorrelationId HAVING sum({f}::INT) > 0"
    for f in DIAGNOSIS_FLAGS
) + """ UNION ALL SELECT CorrelationId, 'retries', 'Retries', cast(sum(Retries) AS BIGINT)::VARCHAR || ' retries in total'
  FROM pe GROUP BY CorrelationId HAVING sum(Retries) > 0)"""
_LEVEL_IDS = " UNION ".join(
    f"SELECT CorrelationId FROM pe GROUP BY CorrelationId HAVING any_value({m}_iqr) > 0 "
    f"AND abs(avg({m}) - any_value({m}_med)) / any_value({m}_iqr) > 1.5e0"
    for m in DIAGNOSIS_METRICS
)
_RISE_IDS = " UNION ".join(
    f"SELECT CorrelationId FROM pe GROUP BY CorrelationId HAVING count({m}) >= 2 AND any_value({m}_med) > 0 "
    f"AND arg_min({m}, back) - arg_max({m}, back) > 0.3e0 * any_value({m}_med)"
    for m in rca.RISE_METRICS
)
ORACLES["rca_pre_flags"] = f"""{_PRE_STATS}, {_PRE_FLAG},
ids AS (SELECT DISTINCT CorrelationId FROM m),
noted AS (SELECT CorrelationId FROM fx UNION {_LEVEL_IDS} UNION {_RISE_IDS})
SELECT * FROM fx
UNION ALL SELECT CorrelationId, 'none', '', 'No events before the failure' FROM ids
  WHERE CorrelationId NOT IN (SELECT CorrelationId FROM pe)
UNION ALL SELECT CorrelationId, 'sudden', '', 'Metrics before the failure are normal: it may have come suddenly' FROM ids
  WHERE CorrelationId IN (SELECT CorrelationId FROM pe) AND CorrelationId NOT IN (SELECT CorrelationId FROM noted)"""
ORACLES["rca_recommend"] = f"""{_DIAG},
ad(reason, line_no, line) AS (VALUES {_values([(r, i, v) for r, vs in rca.ADVICE.items() for i, v in enumerate(vs)])}),
tz AS (SELECT CorrelationId, reason, i, max(z) AS z FROM re GROUP BY 1, 2, 3
  QUALIFY row_number() OVER (PARTITION BY CorrelationId ORDER BY max(z) DESC, i) <= 3),
li AS (SELECT CorrelationId, line, row_number() OVER (PARTITION BY CorrelationId ORDER BY z DESC, i, line_no) AS position
  FROM tz JOIN ad ON ad.reason = tz.reason)
SELECT CorrelationId, position, line FROM li
UNION ALL SELECT DISTINCT CorrelationId, 1, '{rca.DEFAULT_ADVICE}' FROM m
  WHERE CorrelationId NOT IN (SELECT CorrelationId FROM tz)"""
ORACLES["rca_watch"] = f"""{_DIAG},
w AS (SELECT CorrelationId, metric AS "column" FROM re WHERE z > 2 UNION SELECT CorrelationId, flag FROM fl)
SELECT * FROM w
UNION ALL SELECT i.CorrelationId, d.c FROM (SELECT DISTINCT CorrelationId FROM m) i,
  (VALUES ('LatencyMs'), ('CpuUsage'), ('EventCode')) d(c) WHERE i.CorrelationId NOT IN (SELECT CorrelationId FROM w)"""
ORACLES["rca_roles"] = f"""{_DIAG}
SELECT ds.CorrelationId, ds.SourceSystem,
  CASE WHEN ds.SourceSystem = fp.root THEN 'root'
    WHEN EXISTS (SELECT 1 FROM vi WHERE vi.CorrelationId = ds.CorrelationId AND vi.SourceSystem = ds.SourceSystem)
    THEN 'victim' ELSE 'other' END AS role, coalesce(re.reason, 'none') AS symptom
FROM ds JOIN fp ON fp.CorrelationId = ds.CorrelationId
LEFT JOIN re ON re.CorrelationId = ds.CorrelationId AND re.SourceSystem = ds.SourceSystem AND re.rank = 1"""

# -- prediction -----------------------------------------------------------------------------

ORACLES["prd_targets"] = f"""{cte()}
SELECT cast(EventCode AS DOUBLE) AS "EventCode", {b("EventCode IN (500, 501)", "is_failure")},
  {b("IsAnomaly = 1 OR EventCode IN (998, 999)", "is_anomaly_target")}, count(*) AS events FROM t GROUP BY 1, 2, 3"""
ORACLES["prd_cardinality"] = f"{cte()}, x AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT "{c}") AS distinct_values FROM t"""
    for c in ("Priority", "User", "SourceSystem", "EventKind", "Scenario", "ClusterNode", "Region", "BusinessKey")
) + ") SELECT *, distinct_values <= 100 AS is_kept FROM x"
ORACLES["prd_baseline"] = f"""{cte()},
d AS (SELECT LatencyMs AS y, quantile_cont(cast(LatencyMs AS DOUBLE), 0.5) OVER () AS md FROM t)
SELECT {r6("any_value(md)", "median")}, {r6("avg(abs(y - md))", "baseline_mae")},
  {r6("sqrt(avg((y - md) * (y - md)))", "baseline_rmse")} FROM d"""
ORACLES["prd_seq_label"] = f"""{cte()}
SELECT CorrelationId, {b("max((EventCode IN (500, 501, 998, 999) OR IsAnomaly = 1)::INT)", "y_tx")} FROM t GROUP BY 1"""
_PREFIX = """px AS (SELECT *, row_number() OVER (PARTITION BY CorrelationId ORDER BY "Timestamp", EventSeq) AS position
  FROM t QUALIFY position <= 3)"""
ORACLES["prd_seq_prefix"] = f"{cte(_PREFIX)} SELECT CorrelationId, position, EventSeq FROM px"
_SEQUENCE_METRICS = [
    "CpuUsage", "LocalQps", "Retries", "DiskQueueLength", "NetworkErrors", "MemoryUsageMb", "LatencyMs",
]
_PREFIX_METRICS = ", ".join(
    r6(f"{f}({m})", f'"{m}_{n}"') for m in _SEQUENCE_METRICS for f, n in (("avg", "mean"), ("max", "max"))
)
ORACLES["prd_seq_features"] = f"""{cte(_PREFIX)}
SELECT CorrelationId, count(EventCode) AS events_in_prefix, count(DISTINCT SourceSystem) AS unique_services,
  count(DISTINCT Scenario) AS unique_scenarios, {_PREFIX_METRICS},
  (SELECT {b("max((EventCode IN (500, 501, 998, 999) OR IsAnomaly = 1)::INT)", "y")} FROM t
   WHERE t.CorrelationId = px.CorrelationId) AS y_tx
FROM px GROUP BY CorrelationId"""
ORACLES["prd_grade"] = f"""{cte(_THR, _SCORE)},
c AS (SELECT 'code' AS truth, {_confusion("cand", "(EventCode IN (500, 501))")} FROM fc
  UNION ALL SELECT 'window', {_confusion("cand", "FailureWindow")} FROM fc),
f AS (SELECT truth, CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM c)
SELECT truth, {r6("f1", "f1")},
  CASE WHEN f1 >= 0.9 THEN 'very good' WHEN f1 >= 0.75 THEN 'good' WHEN f1 >= 0.6 THEN 'moderate' ELSE 'weak' END AS f1_grade,
  CASE WHEN f1 >= 0.7 THEN 'very good' WHEN f1 >= 0.5 THEN 'good' WHEN f1 >= 0.3 THEN 'moderate' ELSE 'weak' END AS r2_grade
FROM f"""

# -- segments and labels --------------------------------------------------------------------

ORACLES["clu_features"] = f"""{cte(_GAPS)},
full_rows AS (SELECT * FROM g WHERE {" AND ".join(f"{c} IS NOT NULL" for c in MODEL_FEATURES)}) {_standard("full_rows")}"""
ORACLES["seg_means"] = f"""{cte()}
SELECT SourceSystem, count(*) AS "count", {", ".join(f'round_even(avg({c}), 2) AS "{c}"' for c in MODEL_FEATURES)}
FROM t GROUP BY SourceSystem"""
_SHARES = {
    "pct_IsAnomaly": "IsAnomaly",
    "pct_EventCode_500_501": "(EventCode IN (500, 501))::INT",
    "pct_EventCode_998_999": "(EventCode IN (998, 999))::INT",
    "pct_IsSpikeByLatency": "IsSpikeByLatency::INT",
    "pct_IsSpikeByCpu": "IsSpikeByCpu::INT",
    "pct_IsSpikeByQps": "IsSpikeByQps::INT",
}
ORACLES["seg_shares"] = f"""{cte()}
SELECT SourceSystem, count(*) AS "count", {", ".join(f'round_even(avg({x}), 4) AS "{n}"' for n, x in _SHARES.items())}
FROM t GROUP BY SourceSystem"""
ORACLES["lbl_intervals"] = f"""{cte()},
fi AS (SELECT min(EventSeq) AS s, max(EventSeq) AS e FROM t WHERE FailureWindow GROUP BY EventSeq // 1000),
iv AS (SELECT s, e FROM fi UNION ALL SELECT s - 50, s + 50 FROM fi)
SELECT EventSeq, EXISTS (SELECT 1 FROM iv WHERE t.EventSeq BETWEEN iv.s AND iv.e) AS in_interval FROM t"""
ORACLES["lbl_spikes"] = f"""{cte()}
SELECT EventSeq, LatencyMs >= 300 AS "IsSpikeByLatency", CpuUsage >= 80 AS "IsSpikeByCpu", LocalQps >= 75 AS "IsSpikeByQps" FROM t"""
ORACLES["lbl_roles"] = f"""{cte()}
SELECT SourceSystem, CASE WHEN SourceSystem ILIKE '%auth%' THEN 'Auth' WHEN SourceSystem ILIKE '%gateway%' THEN 'Gateway'
  WHEN SourceSystem ILIKE '%order%' THEN 'Order' WHEN SourceSystem ILIKE '%payment%' THEN 'Payment'
  WHEN SourceSystem ILIKE '%notification%' THEN 'Notification' WHEN SourceSystem ILIKE '%inventory%' THEN 'Inventory'
  WHEN SourceSystem ILIKE '%report%' THEN 'Reporting' ELSE 'Generic' END AS role, count(*) AS events FROM t GROUP BY 1"""
ORACLES["lbl_counters"] = f"""{cte()}
SELECT count(*) AS "TotalEvents", count(*) FILTER (EventCode IN (429, 430)) AS "SpikeEvents",
  count(*) FILTER (EventCode IN (500, 501)) AS "FailureEvents", count(*) FILTER (TrendWindow) AS "TrendEvents",
  count(*) FILTER (IsAnomaly = 1) AS "AnomalyEvents", count(*) FILTER (IsSpikeByLatency) AS "SpikeByLatencyEvents",
  count(*) FILTER (IsSpikeByCpu) AS "SpikeByCpuEvents", count(*) FILTER (IsSpikeByQps) AS "SpikeByQpsEvents" FROM t"""

# -- the whole record of every correlation ---------------------------------------------------


def _lines(query: str, section: str, position: str, item: str, value: str, where: str = "true") -> str:
    return (
        f"SELECT CorrelationId, '{section}' AS section, cast({position} AS BIGINT) AS position, "
        f"cast({item} AS VARCHAR) AS item, cast({value} AS VARCHAR) AS value FROM ({ORACLES[query]}) WHERE {where}"
    )


def _listed(column: str) -> str:
    return (
        f"SELECT CorrelationId, '{column}' AS section, unnest(generate_series(1, len(x))) AS position, unnest(x) AS item, '' AS value "
        f"FROM (SELECT CorrelationId, string_split({column}, ',') AS x FROM ({ORACLES['rca_context']}) WHERE {column} <> '')"
    )


ORACLES["rca_records"] = " UNION ALL ".join(
    [
        _lines("rca_context", "events", "1", "''", "events"),
        _lines("rca_context", "scenario", "1", "''", "scenario"),
        _listed("regions"),
        _listed("nodes"),
        _lines("rca_path", "path", "position", "SourceSystem", "''"),
        _lines("rca_first_problem", "first_problem", "1", "first_problem_system", "nullif(first_problem_step, -1)"),
        _lines("rca_victims", "victims", "position", "SourceSystem", "''"),
        _lines("rca_evidence", "evidence", "1", "''", "propagation_evidence"),
        _lines("rca_roles", "roles", "1", "SourceSystem", "concat_ws(':', role, symptom)"),
        _lines(
            "rca_diagnosis", "diagnosis", "CASE WHEN reason = 'none' THEN 0 ELSE rank END", "SourceSystem",
            "CASE WHEN reason = 'none' THEN reason ELSE concat_ws(':', reason, z, n) END",
        ),
        _lines("rca_flags", "flags", "1", "concat_ws(':', SourceSystem, flag)", "n"),
        _lines("rca_pre_events", "pre_events", "-back", "SourceSystem", "EventSeq"),
        _lines("rca_pre_flags", "assessment", "1", "concat_ws(':', kind, item)", "message"),
        _lines("rca_recommend", "recommendations", "position", "''", "line"),
        _lines("rca_watch", "watch_list", "1", '"column"', "''"),
    ]
)

# -- samples and splits by hash -----------------------------------------------------------


def _hash(text: str) -> str:
    """The first 13 hex digits of md5 of the text and the seed, as a number."""
    return f"cast(cast('0x' || substr(md5({text} || '/42'), 1, 13) AS BIGINT) AS DOUBLE)"


_FAILED, _ODD = "EventCode IN (500, 501)", "(IsAnomaly = 1 OR EventCode IN (998, 999))"
ORACLES["prd_split"] = f"""{cte()}
SELECT EventSeq, CorrelationId, {b(_FAILED, "is_failure")},
  {_hash("coalesce(CorrelationId, '__na__')")} < 0.2e0 * 4503599627370496 AS is_test FROM t"""
ORACLES["prd_sample"] = f"""{cte()}
SELECT EventSeq, {b(_FAILED, "is_failure")}, {b(_ODD, "is_anomaly_target")} FROM t
QUALIFY row_number() OVER (ORDER BY ({_FAILED} OR {_ODD}) DESC, {_hash("EventSeq::VARCHAR")}) <= 5000"""
ORACLES["prd_seq_cap"] = f"""{cte()},
ids AS (SELECT DISTINCT CorrelationId FROM t WHERE CorrelationId IS NOT NULL),
chosen AS (SELECT CorrelationId FROM ids ORDER BY {_hash("CorrelationId")} LIMIT 500)
SELECT CorrelationId, EventSeq FROM t WHERE CorrelationId IN (SELECT CorrelationId FROM chosen)"""

# -- the whole prediction with one feature a model -------------------------------------------


def _newton(name: str, rows: str, label: str, steps: int = 14) -> str:
    """CTEs of the balanced logistic regression of `label` on x over training rows: {name}{steps} has its intercept and slope."""
    out = f"""{name}w AS MATERIALIZED (SELECT x, {label} AS y, CASE WHEN {label} = 1 THEN n / (2.0 * p) ELSE n / (2.0 * (n - p)) END AS w
  FROM {rows}, (SELECT count(*)::DOUBLE AS n, sum({label})::DOUBLE AS p FROM {rows} WHERE NOT is_test) WHERE NOT is_test),
{name}0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1)"""
    for i in range(steps):
        out += f""",
{name}s{i} AS MATERIALIZED (SELECT any_value(b0) AS b0, any_value(b1) AS b1, sum(w * (q - y)) AS g0, sum(w * (q - y) * x) + any_value(b1) AS g1,
  sum(w * q * (1 - q)) AS h00, sum(w * q * (1 - q) * x) AS h01, sum(w * q * (1 - q) * x * x) + 1 AS h11
  FROM (SELECT r.*, s.*, 1 / (1 + exp(-(b0 + b1 * x))) AS q FROM {name}w r, {name}{i} s)),
{name}{i + 1} AS MATERIALIZED (SELECT b0 - (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS b0,
  b1 - (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS b1 FROM {name}s{i})"""
    return out + f""",
{name} AS (SELECT tp, fp, fn, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r
  FROM (SELECT count(*) FILTER (b0 + b1 * x > 0 AND {label} = 1)::DOUBLE AS tp, count(*) FILTER (b0 + b1 * x > 0 AND {label} = 0)::DOUBLE AS fp,
    count(*) FILTER (b0 + b1 * x <= 0 AND {label} = 1)::DOUBLE AS fn FROM {rows}, {name}{steps} WHERE is_test)),
{name}f AS (SELECT p, r, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM {name})"""


_SMALL = cte(
    _PREFIX,
    f"""e AS (SELECT CpuUsage::DOUBLE AS cpu, LatencyMs::DOUBLE AS lat, coalesce({_FAILED}, false)::INT AS is_failure,
  coalesce({_ODD}, false)::INT AS is_anomaly, {_hash("coalesce(CorrelationId, '__na__')")} < 0.2e0 * 4503599627370496 AS is_test FROM t),
em AS (SELECT e.*, coalesce(cpu, md) - md AS x FROM e, (SELECT quantile_cont(cpu, 0.5) AS md FROM e WHERE NOT is_test))""",
    f"""sf AS (SELECT CorrelationId, max(LatencyMs)::DOUBLE AS lat FROM px GROUP BY 1),
sy AS (SELECT CorrelationId, max(({_FAILED} OR {_ODD})::INT) AS y FROM t GROUP BY 1),
sh AS (SELECT lat, y, {_hash("CorrelationId")} AS h FROM sf JOIN sy USING (CorrelationId)),
sp AS (SELECT lat, y, h <= cut AS is_test FROM sh JOIN (SELECT y, quantile_cont(h, 0.2) AS cut FROM sh GROUP BY y) USING (y)),
sm AS (SELECT y, is_test, coalesce(lat, md) - md AS x FROM sp, (SELECT quantile_cont(lat, 0.5) AS md FROM sp WHERE NOT is_test))""",
    _newton("nf", "em", "is_failure"),
    _newton("na", "em", "is_anomaly"),
    _newton("ns", "sm", "y"),
    """line AS (SELECT avg(lat) AS my, avg(x) AS mx, sum((x - ex) * (lat - ey)) / (sum((x - ex) * (x - ex)) + 1) AS slope, quantile_cont(lat, 0.5) AS md
  FROM em, (SELECT avg(x) AS ex, avg(lat) AS ey FROM em WHERE NOT is_test AND lat IS NOT NULL) WHERE NOT is_test AND lat IS NOT NULL),
err AS (SELECT lat, lat - (my + slope * (x - mx)) AS d, lat - md AS b FROM em, line WHERE is_test AND lat IS NOT NULL),
reg AS (SELECT avg(abs(d)) AS mae, sqrt(avg(d * d)) AS rmse, 1 - sum(d * d) / (var_pop(lat) * count(lat)) AS r2,
  avg(abs(b)) AS bmae, sqrt(avg(b * b)) AS brmse FROM err)""",
)
_IMPROVED = "(bmae - mae) / bmae * 100"
ORACLES["prd_small_scores"] = f"""{_SMALL}
SELECT {", ".join(f'{r6(f"{m}.{c}", f"{n}_{k}")}' for m, n in (("nf", "classification_failure"), ("na", "classification_anomaly"), ("ns", "sequence_tx_failure"))
                  for c, k in (("p", "precision"), ("r", "recall"), ("f", "f1")))},
  {r6("mae", "mae")}, {r6("rmse", "rmse")}, {r6("r2", "r2")}, {r6("bmae", "baseline_mae")}, {r6("brmse", "baseline_rmse")},
  {r6(_IMPROVED, "mae_improvement_pct")}, (SELECT count(*) FROM sm) AS sequences
FROM nff nf, naf na, nsf ns, reg"""
_F1 = "CASE WHEN f >= 0.9 THEN 'very good' WHEN f >= 0.75 THEN 'good' WHEN f >= 0.6 THEN 'moderate' ELSE 'weak' END"
ORACLES["prd_small_grades"] = f"""{_SMALL}
SELECT model, {r6("f", "score")}, {_F1} AS grade FROM (SELECT 'classification_failure' AS model, f FROM nff
  UNION ALL SELECT 'classification_anomaly', f FROM naf UNION ALL SELECT 'sequence_tx_failure', f FROM nsf)
UNION ALL SELECT 'regression_latency', {r6("r2", "score")},
  CASE WHEN r2 >= 0.7 THEN 'very good' WHEN r2 >= 0.5 THEN 'good' WHEN r2 >= 0.3 THEN 'moderate' ELSE 'weak' END FROM reg"""
ORACLES["prd_small_advice"] = f"""{_SMALL},
said AS (SELECT unnest(list_filter([
  CASE WHEN least(nf.r, na.r) < 0.9 THEN 'More than a tenth of the incidents was not predicted: a lower decision threshold finds more' END,
  CASE WHEN least(nf.p, na.p) < 0.85 THEN 'More than one alarm in seven was false: a higher decision threshold has fewer' END,
  CASE WHEN r2 < 0.3 OR {_IMPROVED} < 5
    THEN 'The latency model adds little to the median: the columns hold too little about latency, or on another scale' END,
  CASE WHEN ns.f < 0.7 OR ns.r < 0.8
    THEN 'The first events of a sequence say too little about its end: let the model see more of them' END
  ], lambda x: x IS NOT NULL)) AS line FROM nff nf, naf na, nsf ns, reg)
SELECT row_number() OVER () - 1 AS position, line FROM said"""
ORACLES["prd_checks"] = f"""{_SMALL}
SELECT model, n AS train_rows, m AS test_rows, true AS gradient_is_zero
FROM (SELECT count(*) FILTER (NOT is_test) AS n, count(*) FILTER (is_test) AS m FROM em),
  (VALUES ('is_failure'), ('is_anomaly_target'), ('LatencyMs')) x(model)
UNION ALL SELECT 'y_tx', count(*) FILTER (NOT is_test), count(*) FILTER (is_test), true FROM sm"""

# -- the isolation forest -------------------------------------------------------------------


def _forest(trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> str:
    """CTEs that draw the samples, grow all trees level by level and follow every event down them; `scored` has the scores."""
    depth, d = max(1, (sample - 1).bit_length()), range(1, len(MODEL_FEATURES) + 1)
    drawn = lambda text: f"cast(cast('0x' || substr(md5({text}), 1, 13) AS BIGINT) AS DOUBLE)"
    path = f"""CASE WHEN rows > 2 THEN 2 * (ln(rows - 1) + {EULER_GAMMA}) - 2 * (rows - 1) / rows WHEN rows = 2 THEN 1 ELSE 0 END"""
    z = [f"(coalesce({c}, avg({c}) OVER ()) - avg({c}) OVER ()) / sd{i}" for i, c in zip(d, MODEL_FEATURES, strict=True)]
    sd = ", ".join(
        f"coalesce(nullif(stddev_pop({c}) * sqrt(count({c}) / count(*)), 0), 1) AS sd{i}" for i, c in zip(d, MODEL_FEATURES, strict=True)
    )
    numbers = ", ".join(f"({t}, {a}::BIGINT, {b}::BIGINT)" for t, (a, b) in enumerate(tree_numbers(trees, seed)))
    out = f"""fx AS MATERIALIZED (SELECT EventSeq, [{", ".join(z)}] AS x,
  cast('0x' || substr(md5(EventSeq::VARCHAR || '/{seed}'), 1, 13) AS BIGINT) % {PRIME} AS k FROM t, (SELECT {sd} FROM t)),
r0 AS MATERIALIZED (SELECT tree, 1 AS node, x FROM fx, (VALUES {numbers}) n(tree, a, b)
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY (a * k + b) % {PRIME}, EventSeq) <= {sample}),
e0 AS (SELECT EventSeq, x, tree, 1 AS node FROM fx, (SELECT DISTINCT tree FROM r0))"""
    for i in range(depth + 1):
        spread = "len(s) > 0" if i < depth else "false"
        out += f""",
m{i} AS MATERIALIZED (SELECT tree, node, rows, low, high, list_filter({list(d)}, lambda i: high[i] > low[i]) AS s FROM (SELECT tree, node, count(*)::DOUBLE AS rows,
  [{", ".join(f"min(x[{j}])" for j in d)}] AS low, [{", ".join(f"max(x[{j}])" for j in d)}] AS high FROM r{i} GROUP BY tree, node)),
n{i} AS MATERIALIZED (SELECT tree, node, rows, f, CASE WHEN c < high[f] THEN c ELSE low[f] END AS cut, {i} + {path} AS path FROM (
  SELECT *, low[f] + {drawn(f"concat_ws('/', tree, node, {seed}, 'cut')")} / {DRAWN} * (high[f] - low[f]) AS c FROM (
    SELECT *, CASE WHEN {spread} THEN s[1 + floor({drawn(f"concat_ws('/', tree, node, {seed}, 'feature')")} / {DRAWN} * len(s))::INT] END AS f FROM m{i}))),
h{i} AS (SELECT e.EventSeq, e.tree, n.path FROM e{i} e JOIN n{i} n USING (tree, node) WHERE f IS NULL),
r{i + 1} AS MATERIALIZED (SELECT tree, 2 * node + (x[f] > cut)::INT AS node, x FROM r{i} JOIN n{i} USING (tree, node) WHERE f IS NOT NULL),
e{i + 1} AS MATERIALIZED (SELECT EventSeq, x, tree, 2 * node + (x[f] > cut)::INT AS node FROM e{i} JOIN n{i} USING (tree, node) WHERE f IS NOT NULL)"""
    unit = f"(SELECT {path} FROM (SELECT max(n)::DOUBLE AS rows FROM (SELECT count(*) AS n FROM r0 GROUP BY tree)))"
    return out + f""",
scored AS MATERIALIZED (SELECT EventSeq, round(-pow(2, -avg(path) / {unit}), 12) AS score
  FROM ({" UNION ALL ".join(f"SELECT * FROM h{i}" for i in range(depth + 1))}) GROUP BY EventSeq),
flagged AS (SELECT t.EventSeq, SourceSystem, IsAnomaly, (score < cut)::BIGINT AS IF_Anomaly, score AS IF_AnomalyScore FROM t JOIN scored USING (EventSeq),
  (SELECT l[1 + floor(r)::INT] + (l[1 + ceil(r)::INT] - l[1 + floor(r)::INT]) * (r - floor(r)) AS cut FROM (SELECT l, share * (len(l) - 1) AS r FROM
    (SELECT list(score ORDER BY score) AS l FROM scored),
    (SELECT greatest(1e-5, least(0.5, avg((coalesce(EventCode BETWEEN 500 AND 599, false))::INT) / 10)) AS share FROM t))))"""


_FLAGGED = cte(_forest())
ORACLES["ano_iforest"] = f"""{_FLAGGED}
SELECT EventSeq, SourceSystem, IsAnomaly::BIGINT AS IsAnomaly, IF_Anomaly, {r6("IF_AnomalyScore", "IF_AnomalyScore")} FROM flagged"""
ORACLES["ano_written"] = f"""{_FLAGGED}
SELECT EventSeq, Scenario, {r6("IF_AnomalyScore", "IF_AnomalyScore")} FROM flagged JOIN t USING (EventSeq)"""
ORACLES["ano_scores"] = f"""{_FLAGGED}, q AS (SELECT {_confusion("IF_Anomaly = 1", "coalesce(IsAnomaly = 1, false)")} FROM flagged)
SELECT 'IF_Anomaly' AS prediction, *, {_RATIOS} FROM q"""

# -- properties of models -------------------------------------------------------------------

ORACLES["clu_checks"] = f"""{cte()},
n AS (SELECT count(*) AS n FROM t WHERE {" AND ".join(f"{c} IS NOT NULL" for c in MODEL_FEATURES)})
SELECT k::BIGINT AS k, n AS events, k::BIGINT AS clusters, 0::BIGINT AS nearer_to_another, true AS centres_are_means,
  true AS cheaper_than_fewer FROM n, (VALUES (3), (5), (8)) x(k)"""


def _cluster_passes(passes: int = 2) -> str:
    """CTEs of k-means from the first events as centres: c0, a0 (nearest), c1 (means) ... and `found`, the events with k and cluster."""
    dims = range(1, len(MODEL_FEATURES) + 1)
    out = f"""z AS MATERIALIZED (SELECT EventSeq, [{", ".join(map(_z, MODEL_FEATURES))}] AS x FROM full_rows),
c0 AS (SELECT k, i - 1 AS cluster, x FROM (SELECT row_number() OVER (ORDER BY EventSeq) AS i, x FROM z ORDER BY EventSeq LIMIT 8),
  (VALUES (3), (5), (8)) ks(k) WHERE i <= k)"""
    for p in range(passes + 1):
        out += f""",
a{p} AS MATERIALIZED (SELECT EventSeq, k, cluster, z.x FROM z JOIN c{p} c ON true
  QUALIFY row_number() OVER (PARTITION BY EventSeq, k ORDER BY list_distance(z.x, c.x), cluster) = 1),
c{p + 1} AS (SELECT c.k, c.cluster, coalesce(m.x, c.x) AS x FROM c{p} c LEFT JOIN (SELECT k, cluster,
  [{", ".join(f"avg(x[{d}])" for d in dims)}] AS x FROM a{p} GROUP BY k, cluster) m ON m.k = c.k AND m.cluster = c.cluster)"""
    return out + f""",
found AS (SELECT g.*, a.k::BIGINT AS k, a.cluster::BIGINT AS cluster FROM full_rows g JOIN a{passes} a ON a.EventSeq = g.EventSeq)"""


_FOUND = f"""{cte()}, full_rows AS (SELECT * FROM t WHERE {" AND ".join(f"{c} IS NOT NULL" for c in MODEL_FEATURES)}),
{_cluster_passes()}"""
ORACLES["clu_pass_kmeans"] = f"{_FOUND} SELECT EventSeq, k, cluster FROM found"
ORACLES["clu_pass_sizes"] = f'{_FOUND} SELECT k, cluster, count(*) AS "count" FROM found GROUP BY k, cluster'
ORACLES["clu_pass_means"] = f"""{_FOUND}
SELECT k, cluster, count(*) AS "count", {", ".join(f'round_even(avg({c}), 2) AS "{c}"' for c in MODEL_FEATURES)}
FROM found GROUP BY k, cluster"""
ORACLES["clu_pass_shares"] = f"""{_FOUND}
SELECT k, cluster, count(*) AS "count", {", ".join(f'round_even(avg({x}), 4) AS "{n}"' for n, x in _SHARES.items())}
FROM found GROUP BY k, cluster"""
ORACLES["ano_checks"] = f"""{cte()}
SELECT count(*) AS events, count(*) AS in_range, true AS same_again, true AS share_is_met FROM t"""

# -- the pipeline ---------------------------------------------------------------------------

#: Result of the pipeline: the query of the same rows, and the columns that are summed.
PIPELINE_TABLES = {
    ("profile", "counts"): ("pro_counts", ["events_count", "transactions_count", "correlations_count"]),
    ("profile", "distributions"): ("pro_all_distributions", ["events"]),
    ("binning", "period_histogram"): ("bin_period_histogram", ["bin", "events", "bin_lo", "bin_hi"]),
    ("binning", "period_stats"): ("bin_period_stats", ["events", "entropy", "balance_max_median"]),
    ("binning", "comparison"): ("bin_compare", ["variance_ratio", "entropy_delta"]),
    ("spikes", "by_service"): ("spk_by_service", ["latency_spikes", "cpu_spikes", "qps_spikes"]),
    ("spikes", "overall"): ("spk_overall", ["total"]),
    ("spikes", "scores"): ("spk_scores", ["tp", "fp", "tn", "fn", "f1"]),
    ("trends", "summary"): ("trd_summary", ["events", "segments", "detected_buckets", "trend_buckets"]),
    ("trends", "scores"): ("trd_scores", ["tp", "fp", "tn", "fn", "f1"]),
    ("trends", "recent"): ("trd_recent_12h", ["metric_agg", "metric_smooth"]),
    ("failures", "candidates"): ("flr_candidates", ["candidates", "events"]),
    ("failures", "propagation"): ("flr_propagation", ["Events", "Candidates", "CandidateRate"]),
}
ORACLES["pip_deterministic"] = " UNION ALL ".join(
    f"""SELECT '{a}' AS analysis, '{t}' AS result, count(*) AS rows,
  round(cast(sum({" + ".join(f'coalesce("{c}", 0)' for c in columns)}) AS DOUBLE), 2) AS total FROM ({ORACLES[q]})"""
    for (a, t), (q, columns) in PIPELINE_TABLES.items()
)
