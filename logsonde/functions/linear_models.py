"""Linear models fitted in a few scans: balanced logistic regressions by Newton steps, ridge regression by its normal equations.

Encoded rows are written once, as blocks of numbers, category codes and targets. Blocks are short: Spark reads thousands of written rows
at a time, so a task's memory does not depend on the rows of its file. A scan returns one row of sums from each task, as large as the
square of the number of features, for all models that still move: loss, gradient and Hessian of each logistic model, or the
Gram matrix of a regression. The driver solves systems of that size only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from logsonde.functions.shipping import ship_package
from logsonde.functions.storage import materialize
from logsonde.functions.typing import to_number

#: Bytes of a block (a longer row is one of its own). 4,096 blocks of a file are read at a time, and 10,000 go to Python in a batch.
BLOCK_BYTES = 1024
#: Bytes of a row group and of a page, of which a task holds a whole one.
GROUP_BYTES, PAGE_BYTES = 1 << 24, 1 << 18
#: Rows that Python expands at a time.
CHUNK_ROWS = 8192
#: A logistic fit ends when its gradient is this small beside its terms, or after so many scans.
SETTLED = 1e-10
MAX_SCANS = 100


@dataclass(frozen=True)
class Encoding:
    """How rows become numbers: medians for missing numbers, the most frequent value for missing categories, a 0/1 feature for each category.

    Numbers are taken relative to their median, which changes intercepts only. A value that training rows did not have is 0 in all features.
    """

    medians: dict[str, float]
    categories: dict[str, list[str]]
    modes: dict[str, str]
    width: int = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "width", len(self.medians) + sum(map(len, self.categories.values())))

    def numbers(self) -> Column:
        shifted = [F.coalesce(to_number(c).cast("double"), F.lit(m)) - F.lit(m) for c, m in self.medians.items()]
        return F.array(*shifted).cast("array<double>")

    def codes(self) -> Column:
        """The number of each category among its column's, -1 where it is not known."""
        found = [
            F.array_position(F.array(*map(F.lit, values)), F.coalesce(F.col(c).cast("string"), F.lit(self.modes[c]))) - 1
            for c, values in self.categories.items()
        ]
        return F.array(*found).cast("array<int>")

    def expand(self, numbers: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The features of rows, with a last one of ones for the intercept."""
        out = np.zeros((len(numbers), self.width + 1))
        out[:, : numbers.shape[1]] = numbers
        out[:, -1] = 1.0
        first = numbers.shape[1]
        for j, values in enumerate(self.categories.values()):
            known = np.flatnonzero(codes[:, j] >= 0)
            out[known, first + codes[known, j]] = 1.0
            first += len(values)
        return out


@dataclass(frozen=True)
class Linear:
    """Coefficients, the intercept last; how large the gradient of the objective is there, relative to its terms; and the scans taken."""

    coefficients: np.ndarray
    gradient: float
    scans: int


def encode(df: DataFrame, encoding: Encoding, targets: Sequence[str], is_test: str = "is_test") -> DataFrame:
    """Blocks (is_test, n, numbers, codes, targets) of all rows of `df`, written once. A missing target is NaN."""
    ship_package(df.sparkSession)
    marks = [F.coalesce(F.col(t).cast("double"), F.lit(float("nan"))) for t in targets]
    rows = df.select(F.col(is_test).alias("is_test"), encoding.numbers().alias("numbers"), encoding.codes().alias("codes"), F.array(*marks).alias("targets"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            test = batch.column(0).to_numpy(zero_copy_only=False)
            flat = [batch.column(i).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for i in (1, 2, 3)]
            flat[1] = flat[1].astype(np.int16)
            block_rows = max(1, BLOCK_BYTES // max(1, sum(x.itemsize * x.shape[1] for x in flat)))
            out = []
            for side in (False, True):
                at = np.flatnonzero(test == side)
                parts = [x[at] for x in flat]
                for a in range(0, len(at), block_rows):
                    own = [x[a : a + block_rows] for x in parts]
                    out.append((side, len(own[0]), *(x.tobytes() for x in own)))
            kinds = [pa.bool_(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            arrays = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.record_batch(arrays, names=["is_test", "n", "numbers", "codes", "targets"])

    schema = "is_test boolean, n int, numbers binary, codes binary, targets binary"
    sizes = {"parquet.block.size": GROUP_BYTES, "parquet.page.size": PAGE_BYTES}
    return materialize(rows.mapInArrow(pack, schema), "encoded-rows", options=sizes)


def _unpacked(batch: pa.RecordBatch, encoding: Encoding) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The features and targets of the rows of many blocks together, at most CHUNK_ROWS (or one block) at a time."""
    counts = batch.column(batch.schema.get_field_index("n")).to_numpy()
    step = max(1, CHUNK_ROWS // int(counts.max(initial=1)))
    for a in range(0, len(counts), step):
        part, n = batch.slice(a, step), int(counts[a : a + step].sum())
        numbers, codes, targets = (
            np.frombuffer(b"".join(part.column(part.schema.get_field_index(c)).to_pylist()), kind).reshape(n, -1)
            for c, kind in (("numbers", np.float64), ("codes", np.int16), ("targets", np.float64))
        )
        yield encoding.expand(numbers, codes), targets


def _summed(blocks: DataFrame, encoding: Encoding, sums) -> np.ndarray:
    """The sum over all training blocks of `sums(features, targets)`, an array: one row from each task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x, y in _unpacked(batch, encoding):
                own = sums(x, y)
                total = own if total is None else total + own
        if total is not None:
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["total"])

    rows = blocks.where("NOT is_test").mapInArrow(scan, "total binary").collect()
    return np.sum([np.frombuffer(r["total"]) for r in rows], axis=0)


def _solve(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The solution of a symmetric positive system, scaled to a diagonal of ones first."""
    scale = 1 / np.sqrt(np.maximum(np.diag(matrix), 1e-300))
    scaled = matrix * scale[:, None] * scale[None, :]
    return scale * np.linalg.lstsq(scaled, scale * right, rcond=1e-13)[0]


def _penalty(width: int, alpha: float) -> np.ndarray:
    """The diagonal of the penalty: all coefficients, not the intercept."""
    return np.array([alpha] * width + [0.0])


def fit_logistic(blocks: DataFrame, encoding: Encoding, labels: dict[str, tuple[int, float, float]], alpha: float = 1.0) -> dict[str, Linear]:
    """Logistic regressions of 0/1 targets, all fitted in the same scans.

    `labels` gives for each model the place of its target and the weights of rows of class 1 and class 0. The sum of weighted log losses and of
    alpha / 2 times the squared coefficients is lowest at the result. A step that does not lower it is halved.
    """
    d = encoding.width + 1
    ridge = _penalty(encoding.width, alpha)
    state = {name: {"at": np.zeros(d), "best": None, "scans": 0} for name in labels}
    done: dict[str, Linear] = {}
    size = 1 + d + d * d + 1

    def sums_for(now: list[tuple[np.ndarray, int, float, float]]):
        def sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            out = np.empty((len(now), size))
            for i, (beta, target, one, zero) in enumerate(now):
                label = y[:, target]
                weight = np.where(label == 1, one, zero)
                score = x @ beta
                loss = np.logaddexp(0, score) - label * score
                p = 0.5 * (1 + np.tanh(0.5 * score))
                slope = weight * (p - label)
                out[i, 0] = weight @ loss
                out[i, 1 : d + 1] = slope @ x
                out[i, d + 1 : -1] = (x.T @ (x * (weight * p * (1 - p))[:, None])).ravel()
                out[i, -1] = np.abs(slope) @ np.abs(x).max(1)
            return out.ravel()

        return sums

    while len(done) < len(labels):
        moving = [n for n in labels if n not in done]
        total = _summed(blocks, encoding, sums_for([(state[n]["at"], *labels[n]) for n in moving])).reshape(len(moving), size)
        for name, row in zip(moving, total, strict=True):
            own = state[name]
            beta = own["at"]
            own["scans"] += 1
            loss = row[0] + 0.5 * ridge @ beta**2
            if own["best"] is not None and loss > own["best"][0] + 1e-12 * abs(loss) and own["scans"] < MAX_SCANS:
                own["at"] = (beta + own["best"][1]) / 2
                continue
            gradient = row[1 : d + 1] + ridge * beta
            hessian = row[d + 1 : -1].reshape(d, d) + np.diag(ridge)
            step = _solve(hessian, gradient)
            own["best"] = (loss, beta)
            size_of = float(np.abs(gradient).max() / max(row[-1], 1e-300))
            if size_of < SETTLED or own["scans"] >= MAX_SCANS:
                done[name] = Linear(beta, size_of, own["scans"])
            else:
                own["at"] = beta - step
    return {n: done[n] for n in labels}


def fit_ridge(blocks: DataFrame, encoding: Encoding, target: int, alpha: float = 1.0) -> Linear:
    """Ridge regression of a target, by the Gram matrix of one scan; rows without the target are left out."""
    d = encoding.width + 1

    def sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        known = ~np.isnan(y[:, target])
        x, y = x[known], y[known, target]
        return np.concatenate([(x.T @ x).ravel(), x.T @ y])

    total = _summed(blocks, encoding, sums)
    gram, right = total[: d * d].reshape(d, d) + np.diag(_penalty(encoding.width, alpha)), total[d * d :]
    # One refinement of the solution by what is left of the right side.
    beta = _solve(gram, right)
    beta = beta + _solve(gram, right - gram @ beta)
    left = np.abs(gram @ beta - right) / np.maximum(np.abs(gram) @ np.abs(beta) + np.abs(right), 1e-300)
    return Linear(beta, float(left.max()), 1)


def predict_test(blocks: DataFrame, encoding: Encoding, targets: Sequence[str], logistic: dict[str, Linear], linear: dict[str, Linear]) -> DataFrame:
    """The test rows: their targets, and `pred_<name>` of each model (0/1, or the value)."""
    models = [(f"pred_{n}", m.coefficients, True) for n, m in logistic.items()] + [(f"pred_{n}", m.coefficients, False) for n, m in linear.items()]
    names = [*targets, *[m[0] for m in models]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in _unpacked(batch, encoding):
                columns = [pa.array(y[:, i], pa.float64(), mask=np.isnan(y[:, i])) for i in range(len(targets))]
                for _, beta, is_class in models:
                    value = x @ beta
                    columns.append(pa.array((value > 0).astype(np.float64) if is_class else value))
                yield pa.record_batch(columns, names=names)

    return blocks.where("is_test").mapInArrow(run, ", ".join(f"`{n}` double" for n in names))
