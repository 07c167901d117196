"""Segments: k-means over eight metrics, and tables that describe any segmentation.

All starts of all k are fitted together. The standardised rows are written once, as blocks of doubles; a pass reads every block once and returns, for
each model that still moves, the sums and counts of its clusters, which the driver (a few hundred numbers) turns into new centres. A
model leaves the passes when its centres have settled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from logsonde.functions.shipping import ship_package
from logsonde.functions.storage import materialize
from logsonde.functions.typing import flag, to_number
from logsonde.operators.anomalies import standardize
from logsonde.schema import ANOMALY_CODES, FAILURE_CODES, MODEL_FEATURES

# Fixed values.
K_VALUES = (3, 5, 8)
STARTS = 10
SEED = 42
MAX_ITERATIONS = 300
# A fit stops when the squared shifts of all k centres sum to at most this share of the features' mean variance,
# which is 1 after standardisation.
SHIFT_SHARE = 1e-4
#: Rows, drawn by a hash of their values, that the starts are chosen on. All rows take part in every pass of the fits.
START_ROWS = 8192
START_PASSES = 30
BLOCK_ROWS = 8192
SHARES = {
    "pct_IsAnomaly": lambda df: F.col("IsAnomaly").cast("double"),
    "pct_EventCode_500_501": lambda df: F.coalesce(F.col("EventCode").isin(FAILURE_CODES), F.lit(False)).cast("int"),
    "pct_EventCode_998_999": lambda df: F.coalesce(F.col("EventCode").isin(ANOMALY_CODES), F.lit(False)).cast("int"),
    "pct_IsSpikeByLatency": lambda df: flag(df, "IsSpikeByLatency").cast("int"),
    "pct_IsSpikeByCpu": lambda df: flag(df, "IsSpikeByCpu").cast("int"),
    "pct_IsSpikeByQps": lambda df: flag(df, "IsSpikeByQps").cast("int"),
}


def feature_rows(df: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Rows with a number in every feature that `df` has."""
    present = [c for c in features if c in df.columns]
    if not present:
        raise ValueError("no feature column for segmentation")
    return df.withColumns({c: to_number(c) for c in present}).dropna(subset=present)


def feature_vectors(df: DataFrame, features: Sequence[str] = MODEL_FEATURES, output: str = "features") -> DataFrame:
    """`feature_rows` with an array of standardised features. Means and deviations are computed here, once for all that follows."""
    present = [c for c in features if c in df.columns]
    scaled = standardize(feature_rows(df, features), present, fixed=True)
    names = [f"z_{c}" for c in present]
    return scaled.withColumn(output, F.array(*[F.col(c).cast("double") for c in names])).drop(*names)


@dataclass(frozen=True)
class Centres:
    """A fit: its centres (k rows), the sum of squared distances of all rows to them, and the passes that it took."""

    at: np.ndarray
    cost: float
    passes: int


def _lloyd(x: np.ndarray, models: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], list[float]]:
    """For each model the sums and the counts of its clusters over the rows of `x`, and the sum of squared distances."""
    all_centres = np.concatenate(models)
    edges = np.cumsum([0, *map(len, models)])
    sums, counts = np.zeros_like(all_centres), np.zeros(len(all_centres))
    costs = np.zeros(len(models))
    squares = (all_centres**2).sum(1)[:, None]
    # A line for each centre, so that numpy goes along the rows.
    nearest = np.empty((len(all_centres), min(len(x), BLOCK_ROWS)))
    for a in range(0, len(x), BLOCK_ROWS):
        rows = x[a : a + BLOCK_ROWS]
        n = len(rows)
        far = squares - 2 * (all_centres @ rows.T)
        own = (rows**2).sum()
        for i in range(len(models)):
            part = far[edges[i] : edges[i + 1]]
            low = part.min(0)
            cost = low.sum()
            at_low = part == low
            if np.count_nonzero(at_low) != n or np.isnan(cost):  # the first of equals
                at_low = np.arange(len(part))[:, None] == part.argmin(0)
            nearest[edges[i] : edges[i + 1], :n] = at_low
            costs[i] += cost + own
        sums += nearest[:, :n] @ rows
        counts += nearest[:, :n].sum(1)
    cut = edges[1:-1]
    return np.split(sums, cut), np.split(counts, cut), costs.tolist()


def _moved(models: list[np.ndarray], sums: list[np.ndarray], counts: list[np.ndarray]) -> list[np.ndarray]:
    """The means of the clusters; an empty cluster keeps its centre."""
    return [np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], m) for m, s, n in zip(models, sums, counts, strict=True)]


def _starts(sample: np.ndarray, k_values: Sequence[int], starts: int, seed: int) -> list[np.ndarray]:
    """Centres drawn from the sample with probability in proportion to the squared distance to those drawn before, then moved to
    the means of the sample's clusters for some passes."""
    models = []
    for k in k_values:
        for start in range(starts):
            rng = np.random.default_rng([seed, k, start])
            centres = sample[rng.integers(len(sample))][None]
            while len(centres) < k:
                far = ((sample - centres[-1]) ** 2).sum(1)
                nearest = far if len(centres) == 1 else np.minimum(nearest, far)
                total = nearest.sum()
                # Fewer distinct rows than centres: the rest repeat.
                i = rng.choice(len(sample), p=nearest / total) if total > 0 else rng.integers(len(sample))
                centres = np.concatenate([centres, sample[i][None]])
            models.append(centres)
    for _ in range(START_PASSES):
        sums, counts, _ = _lloyd(sample, models)
        models = _moved(models, sums, counts)
    return models


def _pass(blocks: DataFrame, models: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], list[float]]:
    """One scan of all rows for all models; a row of partial sums comes back from each task."""
    edges = np.cumsum([0, *map(len, models)])
    width = models[0].shape[1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block in batch.column(0):
                x = np.frombuffer(block.as_buffer()).reshape(-1, width)
                sums, counts, costs = _lloyd(x, models)
                own = np.concatenate([np.concatenate(sums).ravel(), np.concatenate(counts), costs])
                total = own if total is None else total + own
        if total is not None:
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["total"])

    rows = [np.frombuffer(r["total"]) for r in blocks.mapInArrow(scan, "total binary").collect()]  # a row for each task
    total = np.sum(rows, axis=0)
    n = int(edges[-1])
    sums, counts, costs = np.split(total, [n * width, n * width + n])
    cut = edges[1:-1]
    return np.split(sums.reshape(n, width), cut), np.split(counts, cut), costs.tolist()


def fit_kmeans(
    vectors: DataFrame,
    k_values: Sequence[int] = K_VALUES,
    starts: int = STARTS,
    seed: int = SEED,
    max_iterations: int = MAX_ITERATIONS,
    initial: dict[int, np.ndarray] | None = None,
) -> dict[int, Centres]:
    """For each k the cheapest of `starts` fits on all rows of `vectors` (features: array of doubles).

    A model stops when the squared shifts of its centres sum to at most SHIFT_SHARE, or after `max_iterations` passes; the costs that the starts
    are compared by come from a last pass with the final centres. `initial` gives centres for each k and leaves the starts out.
    """
    ship_package(vectors.sparkSession)
    rows = vectors.select("features")
    if initial is None:
        h = F.xxhash64("features")
        drawn = rows.orderBy(h, "features").limit(START_ROWS).toPandas()["features"]
        if drawn.empty:
            raise ValueError("no row to fit segments on")
        sample = np.stack(drawn.to_numpy())
        models, names = _starts(sample, k_values, starts, seed), [k for k in k_values for _ in range(starts)]
    else:
        models, names = [np.asarray(initial[k], np.float64) for k in k_values], list(k_values)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                parts = [x[i : i + BLOCK_ROWS].tobytes() for i in range(0, len(x), BLOCK_ROWS)]
                yield pa.record_batch([pa.array(parts, pa.binary())], names=["block"])

    # Dealt evenly: a pass takes as long as the task with the most rows, however few tasks read the vectors.
    packed = rows.mapInArrow(pack, "block binary").repartition(vectors.sparkSession.sparkContext.defaultParallelism)
    blocks = materialize(packed, "segment-blocks")
    moving, passes = list(range(len(models))), [0] * len(models)
    for _ in range(max_iterations):
        if not moving:
            break
        now = [models[i] for i in moving]
        sums, counts, _ = _pass(blocks, now)
        still = []
        for i, old, new in zip(moving, now, _moved(now, sums, counts), strict=True):
            models[i], passes[i] = new, passes[i] + 1
            if ((new - old) ** 2).sum() > SHIFT_SHARE:
                still.append(i)
        moving = still
    costs = _pass(blocks, models)[2]
    fits = [(k, Centres(m, c, p)) for k, m, c, p in zip(names, models, costs, passes, strict=True)]
    return {k: min((f for name, f in fits if name == k), key=lambda f: f.cost) for k in k_values}


def checks(vectors: DataFrame, models: dict[int, Centres], tolerance: float = 0.05) -> DataFrame:
    """One row per k: events, clusters, events nearer to another centre, whether centres are the means of their
    events to within `tolerance`, and whether the fit is cheaper than that of the next smaller k.

    `vectors` with `assign`'s column `clusters` is checked against centres and means computed here.
    """

    def to_centre(centre: np.ndarray) -> Column:
        squares = F.zip_with("features", F.array(*[F.lit(float(v)) for v in centre]), lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0.0), lambda total, d: total + d)

    far = [F.when(F.col("k") == k, F.array(*[to_centre(c) for c in m.at])) for k, m in models.items()]
    seen = by_k(vectors).withColumn("far", F.coalesce(*far))
    own, width = F.get("far", F.col("cluster")), len(next(iter(models.values())).at[0])
    per = seen.groupBy("k", "cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(own > F.array_min("far") + 1e-9).alias("nearer"),
        F.sum(own).alias("cost"),
        F.array(*[F.avg(F.get("features", F.lit(i))) for i in range(width)]).alias("mean"),
    ).collect()  # a row for each cluster of each k
    rows, last = [], float("inf")
    for k, model in sorted(models.items()):
        mine = [r for r in per if r["k"] == k]
        shift = max((abs(a - b) for r in mine for a, b in zip(r["mean"], model.at[r["cluster"]])), default=0.0)
        cost = sum(r["cost"] for r in mine)
        rows.append((k, sum(r["n"] for r in mine), len(mine), sum(r["nearer"] for r in mine), bool(shift <= tolerance), cost < last))
        last = cost
    names = "k long, events long, clusters long, nearer_to_another long, centres_are_means boolean, cheaper_than_fewer boolean"
    return vectors.sparkSession.createDataFrame(rows, names)


def assign(vectors: DataFrame, models: dict[int, Centres]) -> DataFrame:
    """Every row with the array column `clusters` of (k, cluster), one per model, in one pass: the nearest centre, the first of equals.

    The vectors go to Python as Arrow arrays and the numbers come back; other columns stay where they are.
    """
    at = [m.at for m in models.values()]

    @F.arrow_udf("array<int>")
    def numbers(features: pa.Array) -> pa.Array:
        x = features.flatten().to_numpy(zero_copy_only=False).reshape(len(features), -1)
        out = np.empty((len(x), len(at)), np.int32)
        for i in range(0, len(x), BLOCK_ROWS):
            for j, centres in enumerate(at):
                rows = x[i : i + BLOCK_ROWS]
                out[i : i + BLOCK_ROWS, j] = ((rows[:, None, :] - centres[None, :, :]) ** 2).sum(2).argmin(1)
        offsets = np.arange(len(x) + 1, dtype=np.int32) * len(at)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

    named = F.zip_with(F.array(*[F.lit(k) for k in models]), numbers("features"), lambda k, c: F.struct(k.alias("k"), c.alias("cluster")))
    return vectors.withColumn("clusters", named)


def by_k(assigned: DataFrame) -> DataFrame:
    """One row per event and k: k, cluster and the columns of the event."""
    # The inner form filters empty lists first, and computes the clusters a second time for that.
    return assigned.select("*", F.inline_outer("clusters")).drop("clusters").where("k IS NOT NULL")


def sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).orderBy(*keys)


def means(df: DataFrame, keys: Sequence[str], features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Rows and mean of each feature per segment, 2 decimals."""
    present = [c for c in features if c in df.columns]
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("count"), *[F.bround(F.avg(to_number(c)), 2).alias(c) for c in present])
        .orderBy(*keys)
    )


def shares(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and share of anomalies, failure and anomaly codes and spike labels per segment, 4 decimals."""
    needs = {"pct_IsAnomaly": "IsAnomaly", **{f"pct_{c}": c for c in ("IsSpikeByLatency", "IsSpikeByCpu", "IsSpikeByQps")}}
    present = [n for n in SHARES if n not in needs or needs[n] in df.columns]
    return (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("count"),
            *[F.bround(F.avg(SHARES[n](df)), 4).alias(n) for n in present],
        )
        .orderBy(*keys)
    )
