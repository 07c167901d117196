"""Hard negatives by zone maps of Hilbert-ordered blocks.

All vectors, as whole numbers, are written as Parquet blocks: range-partitioned by label and by their place on a Hilbert
curve through their leading axes, so that a block holds near neighbours of one label. Each block carries a zone map: the least and
greatest component in every dimension. From it and an anchor, interval arithmetic bounds every inner product of the anchor with a vector of the block.

Positives: an anchor's own block gives a first set of scores; then only blocks of its label are read whose upper bound reaches the
last of them. Negatives: only blocks of other labels are read whose bounds meet one of the windows that the anchor's positives
span. Bounds are exact in whole numbers, so nothing is missed. Anchors meet zone maps, and blocks, in bounded groups; no vector is joined with all
others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from logsonde.llm.common import in_tasks, materialize

SCALE = 256
BLOCK = 256  # vectors of a block
GROUP = 512  # anchors, or zone maps, compared at a time
AXES, AXIS_BITS = 9, 7  # of the curve: 63 bits
SAMPLE = 4096  # vectors that the axes are fitted on
EXACT = 1 << 53

BLOCKS = "part int, block int, label string, dimension int, n int, low binary, high binary, ids binary, vectors binary"


def hilbert_places(cells: np.ndarray, bits: int) -> np.ndarray:
    """The places on the Hilbert curve of rows of whole numbers from 0 to 2^bits - 1.

    A Gray code of each level's halves, turned level by level: the axes are swapped or mirrored so that the curve enters and leaves
    neighbouring cells side by side. The bits of all axes, interleaved, must fit 63 bits.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in range(n):
            upper = (x[axis] >> level & 1).astype(bool)
            swap = np.where(upper, 0, (x[0] ^ x[axis]) & low)
            x[0] = np.where(upper, x[0] ^ low, x[0] ^ swap)
            x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    turned = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turned ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= turned
    place = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            place = place << 1 | (x[axis] >> level & 1)
    return place


class Curve:
    """Places on a Hilbert curve through the leading axes of a sample, each cut into cells of equal counts of the sample."""

    def __init__(self, sample: np.ndarray, axes: int = AXES, bits: int = AXIS_BITS):
        self.bits = bits
        self.mean = sample.mean(0)
        _, _, turn = np.linalg.svd(sample - self.mean, full_matrices=False)
        self.turn = turn[:axes].T
        shares = np.arange(1, 1 << bits) / (1 << bits)
        self.cuts = np.quantile((sample - self.mean) @ self.turn, shares, axis=0).T

    def places(self, vectors: np.ndarray) -> np.ndarray:
        turned = (vectors - self.mean) @ self.turn
        cells = [np.searchsorted(cuts, x, "right") for cuts, x in zip(self.cuts, turned.T, strict=True)]
        return hilbert_places(np.stack(cells, 1), self.bits)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers: in doubles where they hold all sums, else in 64-bit integers."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    bound = int(np.abs(a).max()) * int(np.abs(b).max()) * max(1, a.shape[1])
    if bound < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound >= 1 << 63:
        raise ValueError("components are too large for inner products of 64 bits")
    return a @ b.T


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) inner product that each anchor can have with a vector between `low` and `high`, by interval arithmetic."""
    plus, minus = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return products(plus, low) + products(minus, high), products(plus, high) + products(minus, low)


def best(score: np.ndarray, ids: np.ndarray, keep: np.ndarray, k: int) -> np.ndarray:
    """The places of the `k` greatest scores among `keep`, ties by smaller id."""
    at = np.flatnonzero(keep)
    if len(at) > 4 * k:
        floor = np.partition(score[at], len(at) - k)[len(at) - k]
        at = at[score[at] >= floor]
    return at[np.lexsort((ids[at], -score[at]))][:k]


def _matrix(column, dimension: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.int64).reshape(len(column), dimension)


def prepared(rows: DataFrame, relabel=None, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, dimension, v): rows that take part, their components as floor(scale x), one row for each vec_id.

    `relabel`, if given, makes the label column of (vec_id, label). Labels are compared as strings afterwards.
    """
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    able = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(x) > 0) & ~bad
    label = relabel(F.col("vec_id"), F.col("label")) if relabel else F.col("label")
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    kept = rows.where(able).select("vec_id", label.cast("string").alias("label"), whole.alias("v"))
    one = kept.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("x"))
    return one.select("vec_id", "x.label", F.size("x.v").alias("dimension"), "x.v")


def write_blocks(vectors: DataFrame, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """The blocks of `prepared` vectors, written and read again (see BLOCKS).

    The curve's axes come from at most `sample` vectors of each of at most eight dimensions, picked by a hash of their id; all vectors are placed.
    """
    schema = "vec_id long, label string, dimension int, v binary, place long"
    dimensions = [r["dimension"] for r in vectors.groupBy("dimension").count().orderBy(F.desc("count"), "dimension").limit(8).collect()]
    curves = {}
    for d in dimensions:
        some = vectors.where(F.col("dimension") == d).orderBy(F.xxhash64("vec_id")).limit(sample).select("v").collect()
        curves[d] = Curve(np.array([r["v"] for r in some], np.float64))
    held = vectors.sparkSession.sparkContext.broadcast(curves)

    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            place = np.zeros(len(batch), np.int64)
            size = batch["dimension"].to_numpy()
            for d in np.unique(size):
                own = np.flatnonzero(size == d)
                if d in held.value:
                    place[own] = held.value[d].places(np.stack(batch["v"].iloc[own]).astype(np.float64))
            packed = [np.asarray(v, np.int64).tobytes() for v in batch["v"]]
            yield pd.DataFrame(
                {"vec_id": batch["vec_id"], "label": batch["label"], "dimension": size, "v": packed, "place": place}
            )

    order = ["dimension", "label", "place", "vec_id"]
    placed = materialize(in_tasks(vectors, locate, schema), "placed-vectors")
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, rest = TaskContext.get().partitionId(), 0, None

        def made(own: pd.DataFrame, at: int) -> dict:
            matrix = _matrix(own["v"], int(own["dimension"].iloc[0]))
            return {
                "part": part, "block": at, "label": own["label"].iloc[0], "dimension": matrix.shape[1], "n": len(own),
                "low": matrix.min(0).tobytes(), "high": matrix.max(0).tobytes(),
                "ids": own["vec_id"].to_numpy(np.int64).tobytes(), "vectors": matrix.tobytes(),
            }

        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch])
            groups = [g for _, g in rest.groupby(["dimension", "label"], sort=False)]
            whole = []
            for i, group in enumerate(groups):
                last = i == len(groups) - 1
                edge = len(group) // block * block if last else len(group)
                whole += [group.iloc[a : min(a + block, edge)] for a in range(0, edge, block)]
                if last:
                    rest = group.iloc[edge:]
            if whole:
                yield pd.DataFrame([made(g, number + i) for i, g in enumerate(whole)])
                number += len(whole)
        if rest is not None and len(rest):
            yield pd.DataFrame([made(rest, number)])

    return materialize(in_tasks(ordered, cut, BLOCKS), "vector-blocks")


def _grouped(rows: DataFrame, keys: list[str], columns: list[str], group: int, name: str) -> DataFrame:
    """Rows gathered in lists of about `group`: (keys, lists of columns), dealt by hash where a key has more rows."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("in_key"))
    dealt = rows.join(counts, keys).withColumn(
        "slice", F.pmod(F.xxhash64(name), F.ceil(F.col("in_key") / group)).cast("int")
    )
    gathered = dealt.groupBy(*keys, "slice").agg(F.collect_list(F.struct(*columns)).alias("rows"))
    return gathered.select(*keys, "slice", *[F.col("rows")[c].alias(c) for c in columns])


def choose_blocks(anchors: DataFrame, blocks: DataFrame, same_label: bool, group: int = GROUP) -> DataFrame:
    """(part, block, anchor_id): the blocks that anchors must read.

    `anchors` has anchor_id, label, dimension, v (binary), lows and highs (arrays): windows of scores. A block is chosen if its bounds meet one of them and it
    is of the anchor's label (`same_label`) or of another. Groups of anchors meet groups of zone maps.
    """
    zones = blocks.select("part", "block", F.col("label").alias("zone_label"), "dimension", "low", "high")
    zones = zones.withColumn("zone", F.xxhash64("part", "block"))
    zone_groups = _grouped(zones, ["dimension"], ["part", "block", "zone_label", "low", "high"], group, "zone")
    slices = zone_groups.groupBy("dimension").agg(F.count("*").alias("slices"), F.collect_set("slice").alias("own"))
    anchor_groups = _grouped(
        anchors.select("anchor_id", "label", "dimension", "v", "lows", "highs"),
        ["dimension"], ["anchor_id", "label", "v", "lows", "highs"], group, "anchor_id",
    )
    copies = anchor_groups.drop("slice").join(slices, "dimension").withColumn("slice", F.explode("own")).drop("own", "slices")
    met = copies.join(zone_groups, ["dimension", "slice"]).repartition("dimension", "slice", F.xxhash64("anchor_id"))

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                least, most = bounds(*(_matrix(m, row.dimension) for m in (row.v, row.low, row.high)))
                same = np.asarray(row.label, object)[:, None] == np.asarray(row.zone_label, object)[None, :]
                part, block = np.asarray(row.part), np.asarray(row.block)
                for i, anchor in enumerate(row.anchor_id):
                    low, high = np.asarray(row.lows[i], np.int64), np.asarray(row.highs[i], np.int64)
                    meets = ((most[i][:, None] >= low) & (least[i][:, None] <= high)).any(1) & (same[i] == same_label)
                    if meets.any():
                        yield pd.DataFrame({"part": part[meets], "block": block[meets], "anchor_id": anchor})

    return in_tasks(met, meet, "part int, block int, anchor_id long")


def read_blocks(anchors: DataFrame, chosen: DataFrame, blocks: DataFrame, k: int, group: int = GROUP) -> DataFrame:
    """(anchor_id, at, id, score): for window number `at` of each anchor the best `k` rows of each chosen block."""
    wanted = chosen.join(anchors.select("anchor_id", "v", "lows", "highs"), "anchor_id")
    gathered = _grouped(wanted, ["part", "block"], ["anchor_id", "v", "lows", "highs"], group, "anchor_id")
    read = gathered.join(blocks.select("part", "block", "dimension", "ids", "vectors"), ["part", "block"])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids = np.frombuffer(row.ids, np.int64)
                own = products(_matrix(row.v, row.dimension), np.frombuffer(row.vectors, np.int64).reshape(-1, row.dimension))
                out = []
                for i, anchor in enumerate(row.anchor_id):
                    for at, (low, high) in enumerate(zip(row.lows[i], row.highs[i], strict=True)):
                        keep = (own[i] >= low) & (own[i] <= high) & (ids != anchor)
                        out += [(anchor, at, int(ids[j]), int(own[i, j])) for j in best(own[i], ids, keep, k)]
                if out:
                    yield pd.DataFrame(out, columns=["anchor_id", "at", "id", "score"])

    return in_tasks(read, score, "anchor_id long, at int, id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    """(anchor_id, at, rows): the first `k` of all blocks, in order; their lists hold at most `k` rows of each block."""
    rows = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "id")))
    return found.groupBy("anchor_id", "at").agg(F.slice(rows, 1, k).alias("rows"))


def mine_negatives(
    rows: DataFrame, is_anchor, relabel=None, positives: int = 5, negatives: int = 5, floor: tuple[int, int] = (80, 100),
    block: int = BLOCK, group: int = GROUP,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of `rows` (vec_id long, embedding array, label).

    Components x count as floor(256 x). Scores are whole inner products with the anchor; higher ones come first, ties by smaller vec_id.
    `is_anchor(vec_id)` and `relabel(vec_id, label)` are columns. An anchor's positives are its first `positives` other rows of its
    label, all if fewer. For each, the first `negatives` rows of other labels are returned whose score is from floor[0] / floor[1] of the positive's
    up to the positive's, all if fewer; none lies there if that score is negative.

    Rows with a null id, label or vector, an empty vector, or any null or non-finite component take no part; vectors of different dimensions are not
    compared. A vec_id that repeats is one row, the one with the smallest label and vector. An empty table gives no rows; other columns are not read.
    """
    vectors = materialize(prepared(rows, relabel), "whole-vectors")
    blocks = write_blocks(vectors, block)
    packed = materialize(_anchors(blocks, is_anchor, positives), "anchors")
    chosen = materialize(choose_blocks(packed, blocks, True, group), "positive-blocks")
    near = materialize(_first(read_blocks(packed, chosen, blocks, positives, group), positives), "positives")
    listed = near.select("anchor_id", F.posexplode("rows").alias("at", "x")).select(
        "anchor_id", "at", F.col("x.id").alias("positive_id"), (-F.col("x.minus")).alias("positive_score")
    )
    listed = listed.where("positive_score >= 0")
    low = F.expr(f"(positive_score * {int(floor[0])} + {int(floor[1]) - 1}) div {int(floor[1])}")
    windows = F.array_sort(F.collect_list(F.struct("at", low.alias("low"), F.col("positive_score").alias("high"))))
    spans = listed.groupBy("anchor_id").agg(windows.alias("w"))
    searching = packed.drop("lows", "highs").join(spans, "anchor_id")
    searching = searching.select(
        "anchor_id", "label", "dimension", "v",
        F.transform("w", lambda w: w["low"]).alias("lows"), F.transform("w", lambda w: w["high"]).alias("highs"),
    )
    searching = materialize(searching, "searching-anchors")
    far_blocks = materialize(choose_blocks(searching, blocks, False, group), "negative-blocks")
    far = _first(read_blocks(searching, far_blocks, blocks, negatives, group), negatives)
    out = far.select("anchor_id", "at", F.posexplode("rows").alias("rank", "x")).join(listed, ["anchor_id", "at"])
    return out.select(
        "anchor_id", "positive_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.id").alias("negative_id"),
        "positive_score", (-F.col("x.minus")).alias("negative_score"),
    )


def _anchors(blocks: DataFrame, is_anchor, positives: int) -> DataFrame:
    """(anchor_id, label, dimension, v, lows, highs): every anchor with the window that its positives are in.

    The window begins at the last of the first `positives` scores in the anchor's own block; it is open where the block has fewer.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                ids = np.frombuffer(row.ids, np.int64)
                matrix = np.frombuffer(row.vectors, np.int64).reshape(-1, row.dimension)
                at = np.flatnonzero(np.isin(ids, np.asarray(row.anchors, np.int64)))
                own = products(matrix[at], matrix)
                for i, j in enumerate(at):
                    others = np.delete(own[i], j)
                    few = len(others) < positives
                    low = np.iinfo(np.int64).min if few else int(np.partition(others, len(others) - positives)[-positives])
                    out.append((int(ids[j]), row.label, row.dimension, matrix[j].tobytes(), [low], [np.iinfo(np.int64).max]))
            if out:
                yield pd.DataFrame(out, columns=["anchor_id", "label", "dimension", "v", "lows", "highs"])

    listed = blocks.select("part", "block", "label", "dimension", "ids", "vectors")
    unpack = in_tasks(listed.select("part", "block", "ids"), _unpacked_ids, "part int, block int, vec_id long")
    anchors = unpack.where(is_anchor(F.col("vec_id"))).groupBy("part", "block").agg(F.collect_list("vec_id").alias("anchors"))
    schema = "anchor_id long, label string, dimension int, v binary, lows array<long>, highs array<long>"
    return in_tasks(listed.join(anchors, ["part", "block"]), scan, schema)


def _unpacked_ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ids = [np.frombuffer(x, np.int64) for x in batch["ids"]]
        sizes = [len(x) for x in ids]
        yield pd.DataFrame(
            {
                "part": np.repeat(batch["part"].to_numpy(), sizes),
                "block": np.repeat(batch["block"].to_numpy(), sizes),
                "vec_id": np.concatenate(ids) if ids else np.zeros(0, np.int64),
            }
        )
