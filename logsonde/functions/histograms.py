"""Equal-width histograms: bounds from one aggregate, bins by arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from logsonde.functions.typing import to_number


def bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with `<column>__lo` and `<column>__hi`. Equal ends are moved apart by 1/2 each way."""
    wide = df.agg(
        *[f(to_number(c)).alias(f"{c}__{s}") for c in columns for f, s in ((F.min, "lo"), (F.max, "hi"))]
    )
    out = []
    for c in columns:
        lo, hi = F.col(f"{c}__lo"), F.col(f"{c}__hi")
        half = F.when(lo == hi, F.lit(0.5)).otherwise(F.lit(0.0))
        out += [(lo - half).alias(f"{c}__lo"), (hi + half).alias(f"{c}__hi")]
    return wide.select(*out)


def bin_of(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Number of the bin that holds `value`; the last bin is closed on both sides.

    The quotient is only a first guess: a value on an edge must compare with the edge itself.
    """
    guess = F.least(F.floor((value - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    return (
        F.when(value < edge(guess, lo, hi, bins), guess - 1)
        .when((value >= edge(guess + 1, lo, hi, bins)) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )


def edge(number: Column, lo: Column, hi: Column, bins: int) -> Column:
    return lo + number * ((hi - lo) / bins)


def all_bins(bins: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))
