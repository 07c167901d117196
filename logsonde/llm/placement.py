"""Sharding by a hierarchical weighted hash tree: region, rack and shard, drawn level by level.

At each level a row draws one number for each child of the node it stands in, from a hash of its key and the
child's name, and goes to the child with the least -ln(u) / weight: a child with twice the weight gets twice the
rows, and a change of one child's weight moves rows only from or to that child. So a change below a node moves rows
only between its subtree and its siblings'. Everything is DataFrame functions: no Python in the tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from logsonde.llm.common import materialize, part_starts


@dataclass(frozen=True)
class Tree:
    """Regions, each with racks, each with shards and their weights: {region: {rack: {shard: weight}}}.

    Names of regions and racks are free; shards are integers, unique in the tree; weights are above 0.
    """

    regions: Mapping[str, Mapping[str, Mapping[int, float]]]

    @staticmethod
    def even(shards: int, racks_per_region: int = 2, shards_per_rack: int = 2) -> Tree:
        """`shards` shards of weight 1, filled rack by rack, region by region."""
        regions: dict[str, dict[str, dict[int, float]]] = {}
        for shard in range(shards):
            rack = shard // shards_per_rack
            region = rack // racks_per_region
            regions.setdefault(f"region{region}", {}).setdefault(f"rack{rack}", {})[shard] = 1.0
        return Tree(regions)

    def grown(self) -> Tree:
        """One more shard, in a region of its own: rows move into it and nowhere else."""
        shard = 1 + max(s for racks in self.regions.values() for shards in racks.values() for s in shards)
        return Tree({**self.regions, f"region+{shard}": {f"rack+{shard}": {shard: 1.0}}})

    def draw(self, key: Column) -> Column:
        """The shard (int) of the row with this key (string); the tree is of fixed size, as are the expressions."""
        def weight(node: Mapping | float) -> float:
            return sum(map(weight, node.values())) if isinstance(node, Mapping) else float(node)

        def descend(node: Mapping | float, name: int | str) -> Column:
            if not isinstance(node, Mapping):
                return F.lit(int(name))
            if len(node) == 1:
                (child, below), = node.items()
                return descend(below, child)
            best = _least(key, [(str(child), weight(below)) for child, below in node.items()])
            out = None
            for i, (child, below) in enumerate(node.items()):
                hit, to = best == F.lit(i), descend(below, child)
                out = F.when(hit, to) if out is None else out.when(hit, to)
            return out

        return descend(self.regions, "root").cast("int")


def uniform(key: Column, name: str) -> Column:
    """A number in (0, 1) from the first 13 hex digits of md5 of key, a slash and name."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"/{name}"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(16**13))


def _least(key: Column, children: Sequence[tuple[str, float]]) -> Column:
    clocks = F.array(
        *[F.struct((-F.log(uniform(key, name)) / F.lit(w)).alias("clock"), F.lit(i).alias("child")) for i, (name, w) in enumerate(children)]
    )
    return F.array_min(clocks)["child"]


def place(docs: DataFrame, tree: Tree, grown: Tree | None = None, key: str = "doc_id") -> DataFrame:
    """Every row of `docs` in a shard: key, size (UTF-8 bytes of text, plus 1), text_crc32, shard, slot, grown_shard.

    `slot` counts the rows of a shard from 0 without gaps, by md5 of the key. A null key draws as the empty string; a null
    text has size 1 and a null checksum; rows with the same key go to the same shard and keep a slot each; an empty
    table gives no rows; other columns are not read, so their names can't clash. The texts are not shuffled: a row is
    reduced to these numbers first. Ranks are made in two steps, so that a shard is never sorted in one task.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    text = F.col("text")
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.coalesce(F.octet_length(text).cast("long") + 1, F.lit(1).cast("long")).alias("size"),
        F.crc32(text).alias("text_crc32"),
        tree.draw(name).alias("shard"),
        (grown.draw(name) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.md5(name).alias("order_key"),
        F.monotonically_increasing_id().alias("row"),  # parts rows of one key, which hash alike
    )
    ordered = rows.repartitionByRange("shard", "order_key", "row").withColumn("part", F.spark_partition_id())
    ordered = materialize(ordered, "placed")
    in_part = Window.partitionBy("part", "shard").orderBy("order_key", "row")
    ranked = ordered.withColumn("rank", F.row_number().over(in_part) - 1)
    # A row for each task that wrote and shard it holds; parts are ranges of (shard, key), so about one each.
    counts = ordered.groupBy("shard", "part").agg(F.count("*").alias("n"))
    starts = part_starts(counts, "part", "n", ["shard"]).select("shard", "part", "base")
    return ranked.join(F.broadcast(starts), ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank")).alias("slot"), "grown_shard"
    )
