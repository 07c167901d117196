"""All analyses in order over one event table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from logsonde.functions.storage import fix_row, materialize
from logsonde.operators import (
    anomalies,
    binning,
    failures,
    predict,
    profile,
    rca,
    segments,
    spikes,
    trends,
)
from logsonde.sources import logs

ANALYSES = ["profile", "binning", "spikes", "trends", "failures", "anomalies", "rca", "prediction", "segments"]


def load(spark: SparkSession, paths: str | Sequence[str], table: str | None = None) -> DataFrame:
    """The log file as a Parquet table, at `table` or in the shared folder.

    Text and JSON are parsed once. Every analysis then reads only the columns it needs.
    """
    return materialize(logs.read_logs(spark, paths), "events", table)


class Pipeline:
    """The analyses of one event table. Statistics of the whole table are computed once and shared;
    the anomaly columns are passed on to the root-cause analysis."""

    def __init__(
        self,
        events: DataFrame,
        correlation: str | None = None,
        trend_system: str | None = trends.PIPELINE_SYSTEM,
        trend_settings: trends.TrendSettings = trends.PIPELINE_SETTINGS,
        all_correlations: bool = False,
    ) -> None:
        self.events = events
        self.correlation = correlation
        self.trend_system = trend_system
        self.trend_settings = trend_settings
        self.all_correlations = all_correlations
        self.stats = fix_row(rca.global_stats(events))
        self._scored: DataFrame | None = None

    @property
    def scored(self) -> DataFrame:
        """The events with the columns of the isolation forest."""
        if self._scored is None:
            self._scored = anomalies.isolation_forest(self.events)
        return self._scored

    def profile(self) -> dict[str, DataFrame]:
        return {
            "counts": profile.counts(self.events),
            "distributions": profile.distributions(self.events),
            "histograms": profile.histograms(self.events),
        }

    def binning(self) -> dict[str, DataFrame]:
        histogram = materialize(binning.period_histogram(self.events), "period-histogram")
        stats = binning.stats_of_histogram(histogram)
        return {"period_histogram": histogram, "period_stats": stats, "comparison": binning.compare_stats(stats)}

    def spikes(self) -> dict[str, DataFrame]:
        thresholds = fix_row(spikes.thresholds(self.events, medians=self.stats))
        found = spikes.detect(self.events, thresholds)
        return {
            "by_service": spikes.by_service(found),
            "overall": spikes.overall(found),
            "scores": spikes.scores(found),
        }

    def trends(self) -> dict[str, DataFrame]:
        prepared = trends.prepare(self.events, self.trend_settings, self.trend_system)
        buckets = materialize(trends.bucketize(prepared, self.trend_settings), "trend-buckets")
        found = materialize(trends.detect(buckets, self.trend_settings), "trends")
        return {
            "buckets": found,
            "summary": trends.summary(prepared, found),
            "scores": trends.scores(found),
            "recent": trends.recent(found),
        }

    def failures(self, truth: DataFrame | None = None) -> dict[str, DataFrame]:
        """`truth` is the one-row stats table, if there is one."""
        events = failures.with_failure_window(self.events)
        thr = fix_row(failures.thresholds(events))
        scored = failures.score(events, thr)
        out = {
            "candidates": failures.candidate_count(scored),
            "confusions": failures.confusions(scored),
            "propagation": failures.propagation(scored),
        }
        if truth is not None:
            out["reconcile"] = failures.reconcile(scored, truth, thr)
        return out

    def anomalies(self) -> dict[str, DataFrame]:
        counts = anomalies.reason_counts(self.scored, stats=self.stats)
        return {
            "scored": self.scored,
            "scores": anomalies.scores(self.scored),
            "top_scenarios": anomalies.top_scenarios(self.scored),
            "reason_counts": counts,
            "recommendations": anomalies.recommendations(counts),
        }

    def rca(self) -> dict[str, DataFrame]:
        """The report of the chosen correlation, or of all of them."""
        events = self.scored
        if not self.all_correlations:
            events = rca.for_correlation(events, self.correlation or rca.pick(events))
        return {"report": rca.report(rca.mark(events, self.stats))}

    def prediction(self, **settings: object) -> dict[str, DataFrame]:
        result = predict.predict(self.events, **settings)
        return {"result": result, "grades": predict.graded(result), "advice": predict.advice(result)}

    def segments(self, k_values: Sequence[int] = segments.K_VALUES, starts: int = segments.STARTS) -> dict[str, DataFrame]:
        vectors = segments.feature_vectors(self.events)
        found = segments.by_k(segments.assign(vectors, segments.fit_kmeans(vectors, k_values, starts)))
        keys = ["k", "cluster"]
        return {"means": segments.means(found, keys), "shares": segments.shares(found, keys)}

    def run(self, analyses: Sequence[str] = ANALYSES) -> dict[str, dict[str, DataFrame]]:
        return {name: getattr(self, name)() for name in analyses}
