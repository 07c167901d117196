"""Columns and types of the event table, and the fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import types as T

# CSV columns in file order. AttributesJson is the last column of the file.
CSV_FIELDS = [
    ("Timestamp", T.TimestampType()),
    ("Priority", T.StringType()),
    ("User", T.StringType()),
    ("SourceSystem", T.StringType()),
    ("EventKind", T.StringType()),
    ("EventCode", T.IntegerType()),
    ("TransactionId", T.StringType()),
    ("CorrelationId", T.StringType()),
    ("Description", T.StringType()),
    ("LatencyMs", T.LongType()),
    ("IsAnomaly", T.IntegerType()),
    ("Scenario", T.StringType()),
]
JSON_COLUMN = "AttributesJson"

# Attributes carried in the JSON column, business keys first.
ATTRIBUTE_FIELDS = [
    ("ScenarioStepIndex", T.IntegerType()),
    ("ScenarioLocalStep", T.IntegerType()),
    ("SpikeWindow", T.BooleanType()),
    ("FailureWindow", T.BooleanType()),
    ("TrendWindow", T.BooleanType()),
    ("CpuUsage", T.DoubleType()),
    ("MemoryUsageMb", T.LongType()),
    ("RequestSizeBytes", T.LongType()),
    ("ResponseSizeBytes", T.LongType()),
    ("Retries", T.LongType()),
    ("SystemRole", T.StringType()),
    ("ClusterNode", T.StringType()),
    ("Region", T.StringType()),
    ("BusinessKey", T.StringType()),
    ("DiskQueueLength", T.LongType()),
    ("NetworkErrors", T.LongType()),
    ("LocalQps", T.DoubleType()),
    ("IsSpikeByLatency", T.BooleanType()),
    ("IsSpikeByCpu", T.BooleanType()),
    ("IsSpikeByQps", T.BooleanType()),
    ("IsBackgroundMetric", T.BooleanType()),
]

# Read as text so that a bad number or time becomes null instead of failing the row.
CSV_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n, _ in CSV_FIELDS]
    + [T.StructField(JSON_COLUMN, T.StringType())]
)
ATTRIBUTE_SCHEMA = T.StructType([T.StructField(n, t) for n, t in ATTRIBUTE_FIELDS])

# The metrics each analysis looks at.
MODEL_FEATURES = [
    "LatencyMs",
    "CpuUsage",
    "MemoryUsageMb",
    "DiskQueueLength",
    "NetworkErrors",
    "LocalQps",
    "RequestSizeBytes",
    "ResponseSizeBytes",
]
DIAGNOSIS_METRICS = [
    "LatencyMs",
    "CpuUsage",
    "MemoryUsageMb",
    "DiskQueueLength",
    "NetworkErrors",
    "LocalQps",
    "Retries",
    "RequestSizeBytes",
    "ResponseSizeBytes",
]
DIAGNOSIS_FLAGS = [
    "IsSpikeByLatency",
    "IsSpikeByCpu",
    "IsSpikeByQps",
    "SpikeWindow",
    "FailureWindow",
    "TrendWindow",
]

# Short reason code of every diagnosed metric.
REASON_CODES = {
    "LatencyMs": "latency",
    "CpuUsage": "cpu",
    "MemoryUsageMb": "memory",
    "DiskQueueLength": "disk",
    "NetworkErrors": "network",
    "LocalQps": "qps",
    "Retries": "retry",
    "RequestSizeBytes": "request_size",
    "ResponseSizeBytes": "response_size",
}

# Code classes.
FAILURE_CODES = [500, 501]
ANOMALY_CODES = [998, 999]
SPIKE_CODES = [429, 430]
