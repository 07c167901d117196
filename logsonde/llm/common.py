"""Reading tables, words, and running Python functions in tasks: shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from logsonde.functions.shipping import ship_package
from logsonde.functions.storage import materialize, shared_folder

__all__ = [
    "components", "dealt_in_blocks", "in_tasks", "local_roots", "map_texts", "materialize", "part_starts", "runs_of",
    "shared_folder", "table", "words",
]

#: Rows of an Arrow batch that are taken as Python strings at a time.
SLICE_ROWS = 512

#: Byte to byte: A-Z to a-z; digits, a-z and all bytes of non-ASCII characters stay; the rest becomes a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """The words of a text with A-Z lower-cased: runs of digits, a-z and non-ASCII characters. Null has none."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def in_tasks(df: DataFrame, function, schema: str) -> DataFrame:
    """`mapInPandas` with this package on the executors' path."""
    ship_package(df.sparkSession)
    return df.mapInPandas(function, schema)


def map_texts(df: DataFrame, make, added: T.StructType, keep: list[str], text: str = "text") -> DataFrame:
    """Columns computed from a text column, beside the columns `keep`, which pass through unchanged as Arrow.

    `make()` runs once in each task and returns a function from a list of texts (None where null) to one list of
    values for each field of `added`. An added field replaces a kept column of its name.
    """
    ship_package(df.sparkSession)
    kept = [c for c in keep if c not in added.fieldNames()]
    schema = T.StructType([*[df.schema[c] for c in kept], *added.fields])
    kinds = [to_arrow_type(f.dataType) for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                values = function(batch.column(batch.schema.get_field_index("__text")).to_pylist())
                arrays = [batch.column(batch.schema.get_field_index(f"__{i}")) for i in range(len(kept))]
                arrays += [pa.array(v, type=t) for v, t in zip(values, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    renamed = [F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(kept)]
    return df.select(F.col(f"`{text}`").alias("__text"), *renamed).mapInArrow(run, schema)


def runs_of(batches: Iterator[pd.DataFrame], keys: list[str], least: int = 2) -> Iterator[dict[str, np.ndarray]]:
    """The runs of at least `least` rows with equal `keys` (integers, no nulls), each whole, from sorted batches."""
    held: list[dict[str, np.ndarray]] = []
    last = None

    def whole() -> dict[str, np.ndarray]:
        return held[0] if len(held) == 1 else {c: np.concatenate([h[c] for h in held]) for c in held[0]}

    for batch in batches:
        if batch.empty:
            continue
        columns = {c: batch[c].to_numpy() for c in batch.columns}
        codes = np.stack([columns[k].astype(np.int64) for k in keys])
        edges = [0, *(np.flatnonzero((codes[:, 1:] != codes[:, :-1]).any(0)) + 1).tolist(), codes.shape[1]]
        if held and tuple(codes[:, 0]) != last:
            if sum(len(h[keys[0]]) for h in held) >= least:
                yield whole()
            held = []
        for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            ends = b == codes.shape[1]
            if b - a >= least or (held and i == 0) or ends:
                held.append({c: v[a:b] for c, v in columns.items()})
            if not ends:
                if held and sum(len(h[keys[0]]) for h in held) >= least:
                    yield whole()
                held = []
        last = tuple(codes[:, -1])
    if held and sum(len(h[keys[0]]) for h in held) >= least:
        yield whole()


def dealt_in_blocks(rows: DataFrame, counts: DataFrame, keys: list[str], node: str, block: int) -> DataFrame:
    """`rows` for pairwise work within `keys`, no task getting more than about two blocks of a group.

    A group with more than `block` rows in `counts` (keys, n) is dealt by hash of `node` into blocks, and each pair of blocks
    becomes a group (keys, `block_a` <= `block_b`) of its own, so a row is copied once for each block of its group. Rows come
    partitioned and sorted by keys, block_a, block_b and node; `own_block` tells the row's block.
    """
    large = counts.where(F.col("n") > block).select(*keys, F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    joined = rows.join(large, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = joined.withColumn("own_block", F.pmod(F.xxhash64(node), F.col("blocks")).cast("int"))
    other = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    copies = own.withColumn("other", F.explode(other))
    copies = copies.withColumns(
        {"block_a": F.least("own_block", "other"), "block_b": F.greatest("own_block", "other")}
    ).drop("other", "blocks")
    order = [*keys, "block_a", "block_b"]
    return copies.repartition(*order).sortWithinPartitions(*order, node)


def local_roots(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix the smallest row that links lead to."""
    root = np.arange(len(linked))
    linked = linked | np.eye(len(linked), dtype=bool)
    while True:
        low = np.where(linked, root[None, :], len(root)).min(1)
        low = low[low]
        if (low == root).all():
            return root
        root = low


def part_starts(counts: DataFrame, part: str, n: str, by: list[str] | None = None) -> DataFrame:
    """`counts` (a row for each part, and `by`) with `base`: the sum of `n` over all parts before.

    A part is what one task wrote, so the window sorts as many rows as there were tasks, not documents.
    """
    w = Window.partitionBy(*(by or [])).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("base", F.coalesce(F.sum(n).over(w), F.lit(0)))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each node of `edges` (a, b: long) reaches, itself included.

    Alternating large-star and small-star steps over the edge list. Each round is written to the shared
    folder, so a lost executor costs at most one round; only counts come to the driver. Both steps are
    grouped minima joined back, so that no list of neighbours is built: a node with a third of all edges
    is aggregated before the shuffle and its join can be split.
    """
    def ordered(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    now = materialize(ordered(edges.where("a IS NOT NULL AND b IS NOT NULL")), "edges")
    state = None
    for _ in range(max_rounds):
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(ordered(large), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(ordered(small.union(least.select("a", F.col("m").alias("b")))), "edges")
        was, state = state, now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if was == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
