"""Confusion counts and the scores made from them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from logsonde.functions.typing import ratio


def confusion_counts(pred: Column, truth: Column) -> dict[str, Column]:
    """Aggregates TP, FP, TN and FN of two boolean columns."""
    return {
        "tp": F.count_if(pred & truth),
        "fp": F.count_if(pred & ~truth),
        "tn": F.count_if(~pred & ~truth),
        "fn": F.count_if(~pred & truth),
    }


def confusion(df: DataFrame, pairs: Mapping[str, tuple[Column, Column]], label: str) -> DataFrame:
    """One row per named (prediction, truth) pair, all counted in one pass over `df`.

    A null prediction or truth counts as false.
    """
    no = F.lit(False)
    aggs = []
    for name, (pred, truth) in pairs.items():
        counts = confusion_counts(F.coalesce(pred, no), F.coalesce(truth, no))
        aggs += [c.alias(f"{name}__{k}") for k, c in counts.items()]
    wide = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(F.lit(n).alias(label), *[F.col(f"{n}__{k}").alias(k) for k in ("tp", "fp", "tn", "fn")])
            for n in pairs
        ]
    )
    return wide.select(F.inline(rows))


def with_scores(df: DataFrame) -> DataFrame:
    """Precision, recall, accuracy and F1 from tp/fp/tn/fn; 0 where the divisor is 0."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    df = df.withColumns(
        {
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "accuracy": ratio(tp + tn, tp + fp + tn + fn),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return df.withColumn("f1", ratio(2 * p * r, p + r))


def with_smoothed_scores(df: DataFrame, epsilon: float = 1e-10) -> DataFrame:
    """Precision, recall and F1 with `epsilon` added to every divisor."""
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    df = df.withColumns({"precision": tp / (tp + fp + epsilon), "recall": tp / (tp + fn + epsilon)})
    p, r = F.col("precision"), F.col("recall")
    return df.withColumn("f1", 2 * p * r / (p + r + epsilon))
