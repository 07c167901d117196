"""Exact quantiles that never gather the values of a metric in one task.

1. One scan makes a sketch per metric (`percentile_approx`, bounded size) and reads from it a
   bracket around each wanted quantile. The sketch's error is bounded, so the bracket holds it.
2. One scan counts, for every bracket, the rows below it, at its ends and inside. A wanted rank at an end is
   known now, however many rows share that value.
3. Where a rank is inside, one scan counts the rows per value there: about 4/accuracy of the ranks.
   These values are cut into cells of equal numbers of values by a sketch of their own, so that skew inside a bracket does not matter;
   only the values of the cell that holds the rank are ordered.

The result is computed at once: what uses it plans it as constants and never computes it again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from logsonde.functions.storage import materialize
from logsonde.functions.typing import to_number

CELLS = 512
ACCURACY = 10_000


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """One row: for each of `columns` an array of its exact quantiles at `probs`.

    Quantiles are interpolated linearly between the two nearest values; nulls are ignored, and a
    metric without values gives an array of nulls. Infinite values are ordinary ends of the order.
    """
    columns, probs = list(columns), [float(p) for p in probs]
    base = df.select(*[to_number(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    brackets, totals = _brackets(base, len(columns), probs, accuracy)
    ends = _counted(base, brackets)

    values: dict[tuple[int, int, int], float] = {}  # by column, probability and rank
    inner: dict[tuple[int, int], list[int]] = {}
    for (i, j), (lo, hi) in brackets.items():
        below, at_lo, at_hi, inside, before, after = ends[i, j]
        rank = probs[j] * (totals[i] - 1)
        for at in {math.floor(rank), math.ceil(rank)}:
            place = at - below
            if 0 <= place < at_lo:
                values[i, j, at] = lo
            elif at_lo <= place < at_lo + inside:
                inner.setdefault((i, j), []).append(at)
            elif at_lo + inside <= place < at_lo + inside + at_hi:
                values[i, j, at] = hi
            elif place in (-1, at_lo + inside + at_hi):  # with few rows, the rank beside the bracket
                values[i, j, at] = before if place < 0 else after
            else:
                raise ValueError("quantile outside its bracket")
    if inner:
        wanted = {slot: [at - ends[slot][0] - ends[slot][1] for at in ats] for slot, ats in inner.items()}
        found = _inner_values(base, {slot: brackets[slot] for slot in inner}, wanted)
        for slot, ats in inner.items():
            values |= {(*slot, at): found[slot, at - ends[slot][0] - ends[slot][1]] for at in ats}

    def quantile(i: int, j: int) -> float | None:
        if not totals[i]:
            return None
        rank = probs[j] * (totals[i] - 1)
        low, high = (values[i, j, f(rank)] for f in (math.floor, math.ceil))
        share = rank - math.floor(rank)
        if low == high:
            return low
        return low + (high - low) * share if math.isfinite(high - low) else low * (1 - share) + high * share

    row = tuple([quantile(i, j) for j in range(len(probs))] for i in range(len(columns)))
    return df.sparkSession.createDataFrame([row], ", ".join(f"`{c}` array<double>" for c in columns))


Brackets = dict[tuple[int, int], tuple[float, float]]


def _brackets(base: DataFrame, n: int, probs: list[float], accuracy: int) -> tuple[Brackets, list[int]]:
    """The ends of the bracket of each column and probability, and the values of each column."""
    slack = 2.0 / accuracy
    around = [p for q in probs for p in (max(0.0, q - slack), min(1.0, q + slack))]
    row = base.agg(
        *[
            F.struct(F.percentile_approx(c, around, accuracy).alias("e"), F.min(c).alias("lo"), F.max(c).alias("hi"), F.count(c).alias("n")).alias(c)
            for c in base.columns
        ]
    ).first()
    out = {}
    for i, own in enumerate(row):
        for j in range(len(probs)) if own["n"] else []:
            lo = own["lo"] if around[2 * j] <= 0 else own["e"][2 * j]
            hi = own["hi"] if around[2 * j + 1] >= 1 else own["e"][2 * j + 1]
            out[i, j] = (lo, hi)
    return out, [own["n"] for own in row]


def _counted(base: DataFrame, brackets: Brackets) -> dict[tuple[int, int], tuple]:
    """Rows below each bracket, at its lower end, at its upper end if that is another value, and between them; the values beside it."""
    if not brackets:
        return {}
    aggregates = []
    for (i, _), (lo, hi) in brackets.items():
        c = F.col(f"c{i}")
        upper = F.count_if(c == hi) if hi > lo else F.lit(0)
        aggregates += [F.count_if(c < lo), F.count_if(c == lo), upper, F.count_if((c > lo) & (c < hi))]
        aggregates += [F.max(F.when(c < lo, c)), F.min(F.when(c > hi, c))]
    row = base.agg(*[a.alias(f"n{k}") for k, a in enumerate(aggregates)]).first()
    return {slot: tuple(row[6 * k : 6 * k + 6]) for k, slot in enumerate(brackets)}


def cells_of(counted: DataFrame, cells: int = CELLS) -> DataFrame:
    """`counted` (slot, v, n) with `cell`: the values of each slot in order, cut into about `cells` cells of equally many."""
    shares = [k / cells for k in range(1, cells)]
    edges = counted.groupBy("slot").agg(F.array_distinct(F.percentile_approx("v", shares, ACCURACY)).alias("edges"))
    below = F.size(F.filter("edges", lambda e: e < F.col("v")))
    return counted.join(F.broadcast(edges), "slot").withColumn("cell", below).drop("edges")


def _inner_values(base: DataFrame, brackets: Brackets, wanted: dict[tuple[int, int], list[int]]) -> dict[tuple, float]:
    """The values with the `wanted` ranks (from 0) among those inside each bracket, by slot and rank."""
    slots = list(brackets)
    cells = []
    for k, slot in enumerate(slots):
        c, (lo, hi) = F.col(f"c{slot[0]}"), brackets[slot]
        cells.append(F.when((c > lo) & (c < hi), F.struct(F.lit(k).alias("slot"), c.alias("v"))))
    inside = base.select(F.array_compact(F.array(*cells)).alias("x")).where(F.size("x") > 0).select(F.inline("x"))
    counted = materialize(inside.groupBy("slot", "v").agg(F.count(F.lit(1)).alias("n")), "bracket-values")
    placed = materialize(cells_of(counted), "bracket-cells")
    sums: dict[int, list[tuple[int, int]]] = {}
    for r in placed.groupBy("slot", "cell").agg(F.sum("n").alias("n")).collect():  # at most CELLS for each slot
        sums.setdefault(r["slot"], []).append((r["cell"], r["n"]))
    hits = []
    for k, slot in enumerate(slots):
        start = 0
        for cell, n in sorted(sums[k]):
            hits += [(k, cell, rank, rank - start) for rank in wanted[slot] if start <= rank < start + n]
            start += n
    spark = base.sparkSession
    held = F.broadcast(spark.createDataFrame(hits, "slot int, cell int, rank long, at long"))  # two for each slot
    end = F.sum("n").over(W.partitionBy("slot", "rank").orderBy("v").rowsBetween(W.unboundedPreceding, 0))
    ordered = placed.join(held, ["slot", "cell"]).withColumn("end", end)
    rows = ordered.where("at < end AND at >= end - n").collect()
    return {(slots[r["slot"]], r["rank"]): r["v"] for r in rows}


def grouped_median(
    df: DataFrame, keys: Sequence[str], value: str, name: str, any_of: Sequence[str] = ()
) -> DataFrame:
    """Exact median of `value` for each group of `keys`; boolean columns `any_of` are OR-ed.

    Rows are first counted per distinct value, so a group of very many rows is spread over the
    shuffle by value and only its distinct values are ordered together (sorted, able to spill).
    A group without values has a null median.
    """
    counted = df.groupBy(*keys, F.col(value).cast("double").alias("v")).agg(
        F.count(value).alias("n"), *[F.bool_or(c).alias(c) for c in any_of]
    )
    group = W.partitionBy(*keys)
    counted = counted.withColumns(
        {
            "end": F.sum("n").over(group.orderBy("v").rowsBetween(W.unboundedPreceding, 0)),
            "total": F.sum("n").over(group),
        }
    )

    def value_at(rank: Column) -> Column:
        holds = (rank >= F.col("end") - F.col("n")) & (rank < F.col("end"))
        return F.max(F.when(holds, F.col("v")))

    middle = (F.col("total") - 1) / 2
    return counted.groupBy(*keys).agg(
        ((value_at(F.floor(middle)) + value_at(F.ceil(middle))) / 2).alias(name),
        *[F.bool_or(c).alias(c) for c in any_of],
    )
