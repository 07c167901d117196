"""Near-duplicate embeddings by spherical-cap filters.

A filter is a direction; it holds the vectors whose cosine with it passes a bar. Directions are product codes: the (randomly turned)
space is cut in two halves, each half has a codebook of random unit vectors, and every pair of codewords is one direction, so that
n codewords a half give n * n directions. A vector's score with a direction is the sum of two codeword scores; its list of
directions over the bar is decoded from the two sorted halves without looking at the others. Vectors that
share a filter, a label and a dimension are compared exactly. A pair is counted in the first filter that it shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from logsonde.llm.common import components, dealt_in_blocks, in_tasks, local_roots, materialize, runs_of

#: Vectors of one filter compared by one task at a time; larger filters are compared in pairs of such blocks.
BLOCK = 1024


@dataclass
class Filters:
    """`words` * `words` directions; a random vector passes `passes` of them on average, and each at least `least`.

    A vector that few directions are near to lowers its own bar until it has `least` (at most `words`).
    """

    dimension: int
    words: int = 128
    passes: float = 18.0
    least: int = 24
    seed: int = 7
    turn: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        rng = np.random.default_rng(self.seed)
        d = self.dimension
        self.turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
        self.half = max(1, d // 2)
        self.first = _unit(rng.standard_normal((self.half, self.words)).T).T
        self.second = _unit(rng.standard_normal((d - self.half, self.words)).T).T if d > 1 else np.zeros((0, self.words))
        trial = _unit(rng.standard_normal((400, d))) @ self.turn
        scores = (trial[:, : self.half] @ self.first)[:, :, None] + (trial[:, self.half :] @ self.second)[:, None, :]
        self.bar = float(np.quantile(scores, 1 - self.passes / self.words**2))

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """The numbers of the filters of each row."""
        if self.dimension < 4:  # too few directions to tell vectors apart: one filter, compared in blocks
            return [np.zeros(1, np.int32)] * len(unit)
        turned = unit @ self.turn
        a, b = turned[:, : self.half] @ self.first, turned[:, self.half :] @ self.second
        most_a, most_b = a.max(1), b.max(1)
        # The `least` highest sums are made of the `least` highest of either half.
        k = min(self.least, self.words)
        top_a, top_b = (-np.partition(-s, k - 1, axis=1)[:, :k] for s in (a, b))
        own = (top_a[:, :, None] + top_b[:, None, :]).reshape(len(unit), -1)
        bar = np.minimum(self.bar, -np.partition(-own, k - 1, axis=1)[:, k - 1])
        out = []
        for i in range(len(unit)):
            left = np.flatnonzero(a[i] >= bar[i] - most_b[i])
            right = np.flatnonzero(b[i] >= bar[i] - most_a[i])
            x, y = np.nonzero(a[i, left][:, None] + b[i, right][None, :] >= bar[i])
            out.append(np.sort(left[x] * self.words + right[y]).astype(np.int32))
        return out


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def unit_rows(vectors: list[np.ndarray]) -> np.ndarray:
    """Rows of length 1 in double precision, scaled first so that no square is lost."""
    rows = np.stack(vectors).astype(np.float64)
    return _unit(rows / np.abs(rows).max(1, keepdims=True))


def embedding_links(rows: DataFrame, threshold: float = 0.93, words: int = 128, passes: float = 18.0, least: int = 24) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of `rows` (vec_id long, embedding array, label).

    Links join vectors of one label and dimension whose cosine, in double precision, is at least `threshold`. `n_links` counts the
    other rows linked directly, `component_id` is the smallest vec_id that links lead to, and `kept` marks its row. A row links with
    nothing if its label, id or embedding is null, or the embedding is empty, all zero, or holds a null, NaN or infinite
    number. Equal vectors (also rows that repeat) are one class with its count, so copies are never expanded into pairs; an empty
    table gives no rows; other columns are not read. Filters can miss a pair: see the measured recall in the README.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    able = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(x) > 0) & ~bad & F.exists(x, lambda v: v != 0),
        F.lit(False),
    )
    plain = F.transform(x, lambda v: v + F.lit(0).cast("float"))  # -0.0 and 0.0 are one number
    keyed = rows.select("vec_id", "label", F.when(able, plain).alias("embedding")).withColumns(
        {
            "dimension": F.when(F.col("embedding").isNotNull(), F.size("embedding")),
            "h1": F.xxhash64("label", "embedding"),
            "h2": F.xxhash64(F.lit("again"), "embedding", "label"),
        }
    )
    key = ["label", "dimension", "h1", "h2"]
    classes = (
        keyed.where("embedding IS NOT NULL")
        .groupBy(*key)
        .agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"), F.first("embedding").alias("embedding"))
    )
    classes = materialize(classes, "vector-classes")
    single = isinstance(rows.schema["embedding"].dataType.elementType, T.FloatType)
    kind = np.float32 if single else np.float64  # how a vector travels: without loss
    label_key = F.xxhash64("label", "dimension").alias("label_key")
    labelled = classes.select(label_key, "node", "weight", "embedding")

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, Filters] = {}
        for whole in batches:
            for at in range(0, len(whole), 1024):
                batch = whole.iloc[at : at + 1024]
                lists: list[bytes] = [b""] * len(batch)
                sizes = batch["embedding"].map(len).to_numpy()
                for d in np.unique(sizes):
                    own = np.flatnonzero(sizes == d)
                    filters = known.setdefault(int(d), Filters(int(d), words, passes, least))
                    for i, f in zip(own, filters.decode(unit_rows(list(batch["embedding"].iloc[own]))), strict=True):
                        lists[i] = f.tobytes()
                yield pd.DataFrame(
                    {
                        "label_key": batch["label_key"].to_numpy(),
                        "node": batch["node"].to_numpy(),
                        "weight": batch["weight"].to_numpy(),
                        "vector": [np.asarray(v, kind).tobytes() for v in batch["embedding"]],
                        "filters": lists,
                        "filter": [np.frombuffer(f, np.int32) for f in lists],
                    }
                )

    schema = "label_key long, node long, weight long, vector binary, filters binary, filter array<int>"
    listed = in_tasks(labelled, decode, schema)
    members = listed.withColumn("filter", F.explode("filter"))
    group = ["label_key", "filter"]
    counts = members.groupBy(*group).agg(F.count("*").alias("n"))
    dealt = dealt_in_blocks(members, counts, group, "node", BLOCK)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[np.ndarray] = []
        for run in runs_of(batches, [*group, "block_a", "block_b"]):
            found = _compare(run, threshold, kind)
            if found is not None:
                out.append(found)
            if len(out) > 2000:
                yield pd.DataFrame(np.concatenate(out), columns=["node", "n", "root"])
                out = []
        if out:
            yield pd.DataFrame(np.concatenate(out), columns=["node", "n", "root"])

    links = materialize(in_tasks(dealt, compare, "node long, n long, root long"), "vector-links")
    counted = links.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    classed = (
        classes.select(*key, "node", "weight")
        .join(counted, "node", "left")
        .join(roots, "node", "left")
        .select(
            *key,
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("component_id"),
        )
    )
    return keyed.join(classed, key, "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def _compare(run: dict[str, np.ndarray], threshold: float, kind: type) -> np.ndarray | None:
    """(node, links counted here, smallest node reached) for the rows of one filter that are linked; None if none is."""
    order = np.argsort(run["node"], kind="stable")
    node, weight = run["node"][order], run["weight"][order]
    unit = unit_rows([np.frombuffer(v, kind) for v in run["vector"][order]])
    linked = unit @ unit.T >= threshold
    np.fill_diagonal(linked, False)
    if run["block_a"][0] != run["block_b"][0]:
        block = run["own_block"][order]
        linked &= block[:, None] != block[None, :]
    some = linked.any(1)
    if not some.any():
        return None
    node, weight, linked = node[some], weight[some], linked[np.ix_(some, some)]
    mine = int(run["filter"][0])
    lists = [np.frombuffer(f, np.int32) for f in run["filters"][order][some]]
    earlier = [f[f < mine] for f in lists]
    counted = linked & ~_share(earlier)
    return np.stack([node, counted @ weight, node[local_roots(linked)]], axis=1)


def _share(lists: list[np.ndarray]) -> np.ndarray:
    """Which pairs of lists have a number in common."""
    n = len(lists)
    out = np.zeros((n, n), bool)
    flat = np.concatenate(lists)
    if not len(flat):
        return out
    owner = np.repeat(np.arange(n), [len(x) for x in lists])
    numbers, code, times = np.unique(flat, return_inverse=True, return_counts=True)
    for at in range(0, len(numbers), 2048):
        here = (code >= at) & (code < at + 2048) & (times[code] > 1)
        if here.any():
            has = np.zeros((n, min(2048, len(numbers) - at)), np.float32)
            has[owner[here], code[here] - at] = 1
            out |= has @ has.T > 0
    return out
