"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark jobs.

Training data are of fixed size: 256 rows for each of 100 trees, taken by hash. Each tree grows in
its own task. The trees are small arrays sent to the tasks, which score Arrow batches with numpy.

All draws are numbers that any engine can compute: the rows of a tree are those with the lowest values of a linear function, one for each tree, of
their key's md5 modulo a prime, and a node's feature and cut come from the md5 of its tree, number and seed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from logsonde.functions.shipping import ship_package

# Fixed values of the model.
TREES = 100
SAMPLE = 256
SEED = 42
EULER_GAMMA = 0.5772156649
PRIME = 2**31 - 1
DRAWN = 1 << 52  # an md5 draw: the first 13 hex digits
SCORE_PLACES = 12  # so that equal paths give equal scores in whatever order they are summed

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, path double"


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree over n rows."""
    n = np.asarray(n, dtype=float)
    many = 2.0 * (np.log(np.maximum(n, 2.0) - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, many, np.where(n == 2, 1.0, 0.0))


def tree_numbers(trees: int, seed: int) -> list[tuple[int, int]]:
    """Factor and addend of each tree's function of the keys."""
    return [(pow(48271, t + seed, PRIME), pow(69621, t + seed, PRIME)) for t in range(1, trees + 1)]


def draw(*values: object) -> float:
    """A number from 0 to 1 (excluded) by the md5 of the values."""
    return int(hashlib.md5("/".join(map(str, values)).encode()).hexdigest()[:13], 16) / DRAWN


def tree_samples(df: DataFrame, features: Sequence[str], key: str, trees: int, sample: int, seed: int) -> DataFrame:
    """(tree, features): `sample` rows without replacement for each tree, the same on every run.

    Each tree takes the rows with its lowest values. A row first drops the trees for which its value is
    above one and a half times the share wanted, so the shuffle holds about
    1.5 * trees * sample rows whatever the size of the table.
    """
    share = min(1.0, (1.5 * sample + 64) / max(1, df.count()))
    cols = [F.col(c).cast("double").alias(c) for c in features]
    digits = F.conv(F.substring(F.md5(F.concat_ws("/", F.col(key).cast("string"), F.lit(str(seed)))), 1, 13), 16, 10)
    numbers = F.array(*[F.struct(F.lit(t).alias("tree"), F.lit(a).alias("a"), F.lit(b).alias("b")) for t, (a, b) in enumerate(tree_numbers(trees, seed))])
    valued = F.transform(numbers, lambda n: F.struct(n["tree"].alias("tree"), F.pmod(n["a"].cast("long") * F.col("_k") + n["b"].cast("long"), F.lit(PRIME)).alias("h")))
    keyed = df.select(key, *cols, F.pmod(digits.cast("long"), F.lit(PRIME)).alias("_k"))
    pool = keyed.select(key, *features, F.inline(F.filter(valued, lambda x: x["h"] < int(share * PRIME) + 1)))
    lowest = F.row_number().over(W.partitionBy("tree").orderBy("h", key))
    return (
        pool.withColumn("r", lowest)
        .filter(F.col("r") <= sample)
        .select("tree", F.col("r").alias("row"), *features)
    )


def _grow(x: np.ndarray, tree: int, seed: int, limit: int) -> list[list]:
    """Nodes (feature, threshold, left, right, path length) of one tree. The children of node i are drawn as numbers 2 i and 2 i + 1."""
    nodes: list[list] = []
    pending = [(np.arange(len(x)), 0, 1, None, None)]
    while pending:
        rows, depth, number, parent, side = pending.pop()
        me = len(nodes)
        if parent is not None:
            nodes[parent][side] = me
        values = x[rows]
        low, high = (values.min(axis=0), values.max(axis=0)) if len(rows) else (np.zeros(0), np.zeros(0))
        spread = np.flatnonzero(high > low)
        if depth >= limit or len(spread) == 0:
            nodes.append([-1, 0.0, me, me, depth + float(average_path(len(rows)))])
            continue
        f = int(spread[int(draw(tree, number, seed, "feature") * len(spread))])
        cut = low[f] + draw(tree, number, seed, "cut") * (high[f] - low[f])
        cut = float(cut if cut < high[f] else low[f])
        goes_left = values[:, f] <= cut
        nodes.append([f, cut, -1, -1, 0.0])
        pending.append((rows[~goes_left], depth + 1, 2 * number + 1, me, 3))
        pending.append((rows[goes_left], depth + 1, 2 * number, me, 2))
    return nodes


@dataclass(frozen=True)
class Forest:
    """The trees as flat arrays. A leaf points to itself, so `depth` steps reach a leaf for sure."""

    features: tuple[str, ...]
    psi: int
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray

    def mean_path(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            goes_left = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(goes_left, self.left[at], self.right[at])
        return self.path[at].mean(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Lower is more anomalous, from -1 to 0."""
        c = float(average_path(self.psi)) or 1.0
        return np.round(-np.power(2.0, -self.mean_path(x) / c), SCORE_PLACES)


def fit(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
) -> Forest:
    """Fit on rows of `df`; `key` is unique and fixes the samples."""
    ship_package(df.sparkSession)
    samples = tree_samples(df, features, key, trees, sample, seed)
    names = list(features)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = pdf.sort_values("row")[names].to_numpy(dtype=float)
        limit = max(1, math.ceil(math.log2(max(len(x), 2))))
        nodes = _grow(x, tree, seed, limit)
        out = pd.DataFrame(nodes, columns=["feature", "threshold", "left", "right", "path"])
        out.insert(0, "node", np.arange(len(nodes), dtype=np.int32))
        out.insert(0, "tree", np.int32(tree))
        # The root carries the number of rows of its tree.
        out.loc[len(out)] = [tree, -1, -1, float(len(x)), -1, -1, 0.0]
        return out.astype({"tree": "int32", "node": "int32", "feature": "int32", "left": "int32", "right": "int32"})

    # At most trees * (2 * sample) rows come back.
    nodes = samples.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
    if nodes.empty:
        raise ValueError("no rows to fit an isolation forest on")
    sizes = nodes[nodes["node"] == -1]
    nodes = nodes[nodes["node"] >= 0].sort_values(["tree", "node"])
    counts = nodes.groupby("tree").size()
    offsets = counts.cumsum().shift(1, fill_value=0)
    shift = nodes["tree"].map(offsets).to_numpy()
    psi = int(sizes["threshold"].max())
    return Forest(
        features=tuple(names),
        psi=psi,
        depth=max(1, math.ceil(math.log2(max(psi, 2)))),
        roots=offsets.to_numpy(dtype=np.int32),
        feature=np.maximum(nodes["feature"].to_numpy(dtype=np.int32), 0),
        threshold=np.where(nodes["feature"] < 0, 0.0, nodes["threshold"]).astype(float),
        left=(nodes["left"].to_numpy() + shift).astype(np.int32),
        right=(nodes["right"].to_numpy() + shift).astype(np.int32),
        path=nodes["path"].to_numpy(dtype=float),
    )


def with_score(df: DataFrame, forest: Forest, name: str) -> DataFrame:
    """`df` with the anomaly score of the forest in column `name`."""
    ship_package(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = sent.value
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            # Blocks keep the (rows x trees) working set in the processor cache.
            blocks = [model.score(x[i : i + 2048]) for i in range(0, len(x), 2048)]
            yield pd.Series(np.concatenate(blocks) if blocks else np.empty(0))

    return df.withColumn(name, score(*[F.col(c).cast("double") for c in forest.features]))
