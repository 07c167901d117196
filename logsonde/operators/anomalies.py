"""Anomalies: an isolation forest over eight metrics, its score against labels, and explanations."""

from __future__ import annotations

import math

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from logsonde.functions.quantiles import quantiles
from logsonde.functions.scoring import confusion, with_scores
from logsonde.functions.storage import fix_row, materialize
from logsonde.functions.typing import to_number
from logsonde.operators import forest as iforest
from logsonde.schema import MODEL_FEATURES

# Fixed values.
CONTAMINATION_BOUNDS = (1e-5, 0.5)
REASON_METRICS = {
    "LatencyMs": "latency",
    "CpuUsage": "cpu",
    "MemoryUsageMb": "memory",
    "DiskQueueLength": "disk",
    "NetworkErrors": "network",
}
OTHER_REASON = "other"
TOP_SCENARIOS = 3
TOP_REASONS = 5
# What to look at for each reason: own wording.
ADVICE = {
    "latency": ["see which calls of the flagged events were slow and what they waited for"],
    "network": ["see whether the broken connections share a peer or a host"],
    "disk": ["see what was written while requests queued before storage"],
    "cpu": ["see which operation ran while the processor was busy"],
    "memory": ["see whether memory was given back after the flagged events"],
    "other": ["no metric explains these events alone: look at several together, by hour and by scenario"],
}


def impute(df: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Features as numbers, nulls replaced by the mean of the column."""
    df = df.withColumns({c: to_number(c) for c in features})
    means = df.agg(*[F.avg(c).alias(f"{c}__mean") for c in features])
    return (
        df.crossJoin(F.broadcast(means))
        .withColumns({c: F.coalesce(F.col(c), F.col(f"{c}__mean")) for c in features})
        .drop(*means.columns)
    )


def standardize(df: DataFrame, features: Sequence[str] = MODEL_FEATURES, prefix: str = "z_", fixed: bool = False) -> DataFrame:
    """`df` with (x - mean) / population standard deviation per feature; a deviation of 0 counts as 1.

    `fixed` computes means and deviations now; else every action on the result does so again.
    """
    moments = df.agg(
        *[f(c).alias(f"{c}__{s}") for c in features for f, s in ((F.avg, "mean"), (F.stddev_pop, "std"))]
    )
    moments = fix_row(moments) if fixed else moments
    scaled = {
        f"{prefix}{c}": (F.col(c) - F.col(f"{c}__mean")) / F.coalesce(F.nullif(f"{c}__std", F.lit(0.0)), F.lit(1.0))
        for c in features
    }
    return df.crossJoin(F.broadcast(moments)).withColumns(scaled).drop(*moments.columns)


def contamination(df: DataFrame) -> DataFrame:
    """One row: share of 5xx codes divided by ten, kept in bounds."""
    low, high = CONTAMINATION_BOUNDS
    is_5xx = F.coalesce(F.col("EventCode").between(500, 599), F.lit(False))
    return df.agg(
        F.count_if(is_5xx).alias("errors_5xx"),
        F.greatest(F.lit(low), F.least(F.lit(high), F.avg(is_5xx.cast("int")) / 10)).alias("contamination"),
    )


def moments(df: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> dict[str, tuple[float, float]]:
    """(mean, population standard deviation) of each mean-imputed feature, from one aggregate.

    Imputing the mean keeps the mean and scales the variance by the share of known values. A deviation of 0 counts
    as 1, a feature without values has mean 0.
    """
    known = [to_number(c) for c in features]
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(x).alias(f"{c}__{s}") for c, x in zip(features, known) for f, s in ((F.count, "n"), (F.avg, "mean"), (F.stddev_pop, "std"))],
    ).first()
    return {
        c: (row[f"{c}__mean"] or 0.0, (row[f"{c}__std"] or 0.0) * math.sqrt(row[f"{c}__n"] / max(1, row["n"])) or 1.0)
        for c in features
    }


def isolation_forest(
    df: DataFrame,
    features: Sequence[str] = MODEL_FEATURES,
    key: str = "EventSeq",
    out_path: str | None = None,
    seed: int = iforest.SEED,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """`df` with `IF_AnomalyScore` and `IF_Anomaly` (1 for the lowest `contamination` share).

    The scores are written once, with the key and `columns` (all of `df` if not given), to `out_path` or the shared folder: the
    cut-off and the result are then two reads of them, and the Python scoring runs once. Means and deviations come from one
    aggregate and are constants afterwards.
    """
    share = contamination(df).first()["contamination"]
    known = moments(df, features)
    names = [f"z_{c}" for c in features]
    z = {f"z_{c}": (F.coalesce(to_number(c), F.lit(m)) - F.lit(m)) / F.lit(s) for c, (m, s) in known.items()}
    kept = list(df.columns if columns is None else dict.fromkeys([key, *columns]))
    model = iforest.fit(df.select(key, *[x.alias(n) for n, x in z.items()]), names, key, seed=seed)
    scaled = df.select(*kept, *[x.alias(n) for n, x in z.items()])
    scored = materialize(iforest.with_score(scaled, model, "IF_AnomalyScore").drop(*names), "anomaly-scores", out_path)
    cut = quantiles(scored, ["IF_AnomalyScore"], [share]).select(F.col("IF_AnomalyScore")[0].alias("cut"))
    return (
        scored.crossJoin(F.broadcast(cut))
        .withColumn("IF_Anomaly", (F.col("IF_AnomalyScore") < F.col("cut")).cast("int"))
        .drop("cut")
    )


def scores(df: DataFrame, pred: str = "IF_Anomaly", truth: str = "IsAnomaly") -> DataFrame:
    """Confusion and scores of a 0/1 prediction against a 0/1 label."""
    return with_scores(confusion(df, {pred: (F.col(pred) == 1, F.col(truth) == 1)}, "prediction"))


def top_scenarios(df: DataFrame, flagged: str = "IF_Anomaly", n: int = TOP_SCENARIOS) -> DataFrame:
    return (
        df.filter((F.col(flagged) == 1) & F.col("Scenario").isNotNull())
        .groupBy("Scenario")
        .agg(F.count(F.lit(1)).alias("anomalies"))
        .orderBy(F.desc("anomalies"), "Scenario")
        .limit(n)
    )


def reasons(
    df: DataFrame, flagged: str = "IF_Anomaly", stats: DataFrame | None = None
) -> DataFrame:
    """Flagged rows with `reasons`: the two metrics farthest from the median, in IQRs, else other.

    `stats` is a known row of `<metric>__median` and `<metric>__iqr`.
    """
    if stats is None:
        q = quantiles(df, list(REASON_METRICS), [0.25, 0.5, 0.75])
        stats = q.select(
            *[F.col(m)[1].alias(f"{m}__median") for m in REASON_METRICS],
            *[F.nullif(F.col(m)[2] - F.col(m)[0], F.lit(0.0)).alias(f"{m}__iqr") for m in REASON_METRICS],
        )
    stats = stats.select(*[f"{m}__{s}" for m in REASON_METRICS for s in ("median", "iqr")])
    ranked = F.array_sort(
        F.array(
            *[
                F.struct(
                    (-F.coalesce(F.abs((to_number(m) - F.col(f"{m}__median")) / F.col(f"{m}__iqr")), F.lit(0.0))).alias("z"),
                    F.lit(i).alias("i"),
                    F.lit(label).alias("label"),
                )
                for i, (m, label) in enumerate(REASON_METRICS.items())
            ]
        )
    )
    two = F.transform(F.filter(F.slice(ranked, 1, 2), lambda s: s["z"] < 0), lambda s: s["label"])
    return (
        df.filter(F.col(flagged) == 1)
        .crossJoin(F.broadcast(stats))
        .withColumn("reasons", F.when(F.size(two) > 0, two).otherwise(F.array(F.lit(OTHER_REASON))))
        .drop(*stats.columns)
    )


def reason_counts(
    df: DataFrame, flagged: str = "IF_Anomaly", stats: DataFrame | None = None
) -> DataFrame:
    """For each of the top scenarios its most frequent reasons: (Scenario, rank, reason, events)."""
    top = top_scenarios(df, flagged).select("Scenario")
    order = W.partitionBy("Scenario").orderBy(F.desc("events"), "reason")
    return (
        reasons(df, flagged, stats)
        .join(F.broadcast(top), "Scenario", "left_semi")
        .select("Scenario", F.explode("reasons").alias("reason"))
        .groupBy("Scenario", "reason")
        .agg(F.count(F.lit(1)).alias("events"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= TOP_REASONS)
    )


def advice_lines(spark: SparkSession) -> DataFrame:
    rows = [(r, i, line) for r, lines in ADVICE.items() for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "reason string, line_no int, line string")


def recommendations(counts: DataFrame) -> DataFrame:
    """Advice for the dominant reason of each top scenario, from the rows of `reason_counts`."""
    dominant = counts.filter("rank = 1").select("Scenario", "reason")
    return dominant.join(F.broadcast(advice_lines(counts.sparkSession)), "reason")
