"""Jaccard join on word n-grams by chosen paths.

Every text becomes the set of its five-word shingles (64-bit hashes). Equal sets are one class. A set's sketch has one
min-hash for each of 96 hash functions, and two sets of similarity s agree in a place of the sketch with probability s.

Chosen paths split all sets recursively: a node (a path of sampled places and the values found there) samples on average
1 / threshold further places, and each set goes on to the child that holds its value of that place. So a pair at the
threshold keeps about one common node at every depth, while unrelated sets part soon. At depth 4 buckets are small and their
sketches are compared by brute force; larger buckets are split further, and what is still large at the greatest
depth, sets that agree almost everywhere, is one candidate group without comparison. Runs with other samples are
repeated until a pair at the threshold is missed with a probability below 1 - `recall`, also where all its nodes are split to
the greatest depth, and averaged over the agreement of the one sketch that all runs share.

Runs go in two rounds. After the first, sets take over the smallest set that their buckets lead to as their root, and a bucket of a later
run whose sets all have one root can bring nothing new: it is left out, whatever its size.

What the sketches find are candidate groups only; inside each, all pairs are then compared exactly on the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from logsonde.llm.common import components, dealt_in_blocks, in_tasks, local_roots, materialize, runs_of, words

SHINGLE = 5
THRESHOLD = 0.8
PLACES = 96
FIRST_DEPTH, DEEPER, GREATEST_DEPTH = 4, 2, 8
BUCKET = 512  # sets compared by brute force; larger buckets are split
BLOCK = 256  # texts of a candidate group compared at a time,
TEXT_SHINGLES = 1024  # fewer where they have more than so many shingles on average
FIRST_RUNS = 1  # of the first round
REMEMBERED_WORDS = 1 << 18

U = np.uint64
_ODD = np.random.default_rng(20).integers(0, 2**63, 64, dtype=np.uint64) * U(2) + U(1)
_PLACES = np.random.default_rng(21).integers(0, 2**63, PLACES, dtype=np.uint64) * U(2) + U(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers, well mixed: xor-shifts and odd multipliers, one to one."""
    x = (x ^ (x >> U(32))) * _ODD[40]
    x = (x ^ (x >> U(29))) * _ODD[41]
    return x ^ (x >> U(32))


class Shingles:
    """Shingle sets of texts, with a bounded memory of word hashes."""

    def __init__(self, n: int = SHINGLE):
        import xxhash

        self.n, self.digest = n, xxhash.xxh3_64_intdigest
        self.memory: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes; a text of fewer words has one shingle of them all, one of no words none."""
        ws = words(text)
        if len(self.memory) > REMEMBERED_WORDS:
            self.memory.clear()
        known = self.memory
        for w in set(ws).difference(known):
            known[w] = self.digest(w)
        h = np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))
        n = min(self.n, len(h))
        if not n:
            return h
        out = np.full(len(h) - n + 1, U(n))
        for k in range(n):
            out += h[k : len(h) - n + 1 + k] * _ODD[k]
        return np.unique(mixed(out))


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, whatever its order."""
    return tuple(int(mixed(shingles ^ _ODD[i]).sum(dtype=np.uint64).astype(np.int64)) for i in (50, 51))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of PLACES min-hashes (32 bits) for each set; sets are not empty."""
    starts = np.cumsum([0, *map(len, sets[:-1])])
    flat = np.concatenate(sets)
    out = np.empty((len(sets), PLACES), np.uint32)
    for i, odd in enumerate(_PLACES):
        out[:, i] = np.minimum.reduceat(flat * odd, starts) >> U(32)
    return out


def survival(agreement: float, depth: int, threshold: float | None = None, deeper: int = 0) -> float:
    """The probability that a pair whose sketches agree in this part of the places still shares a node of one run after
    `depth` levels, and `deeper` levels of two places each; `threshold`, by default the agreement, sets the places of the first."""
    q, extra = 1.0, 1 / (agreement if threshold is None else threshold) - 1
    for level in range(deeper + depth):  # from the lowest level up
        p = agreement * q
        second = 1.0 if level < deeper else extra
        q = (1 - second) * p + second * (1 - (1 - p) ** 2)
    return q


def cutoff_of(threshold: float) -> float:
    """The part of the places in which sketches of a bucket must agree to be a candidate."""
    return threshold - 4.2 * math.sqrt(threshold * (1 - threshold) / PLACES)


def missed(runs: int, threshold: float = THRESHOLD) -> float:
    """The probability that a pair at the threshold is no candidate, if all its nodes are split down to the greatest depth.

    All runs sample the same sketch, so they miss a pair independently only given the number of places in which it agrees,
    which is binomial. In small buckets, pairs below the cutoff are missed too.
    """
    total = 0.0
    for k in range(PLACES + 1):
        chance = math.comb(PLACES, k) * threshold**k * (1 - threshold) ** (PLACES - k)
        found = survival(k / PLACES, FIRST_DEPTH, threshold, GREATEST_DEPTH - FIRST_DEPTH)
        total += chance * (1.0 if k < cutoff_of(threshold) * PLACES else (1 - found) ** runs)
    return total


def runs_for(recall: float, threshold: float = THRESHOLD) -> int:
    """The fewest runs after which a pair at the threshold is missed with a probability of at most 1 - `recall`."""
    for runs in range(1, 1000):
        if missed(runs, threshold) <= 1 - recall:
            return runs
    raise ValueError(f"sketches of {PLACES} places do not reach a recall of {recall} at {threshold}")


def step(row: np.ndarray, path: np.ndarray, sketch: np.ndarray, second: float) -> tuple[np.ndarray, np.ndarray]:
    """The children of nodes: each samples a place, and another one with probability `second`."""
    h = mixed(path + _ODD[42])
    twice = ((h >> U(40)) & U(0xFFFF)) < U(round(second * 65536))
    place = np.concatenate([h % U(PLACES), (h[twice] >> U(8)) % U(PLACES)]).astype(np.int64)
    row, path = np.concatenate([row, row[twice]]), np.concatenate([path, path[twice]])
    value = sketch[row, place].astype(np.uint64)
    return row, mixed(path * _ODD[43] + place.astype(np.uint64) * _ODD[44] + value * _ODD[45])


def ngram_links(docs: DataFrame, threshold: float = THRESHOLD, recall: float = 0.9995, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, class_id, n_links, n_text_links, component_id, kept, component) for every row of `docs` (doc_id long, text).

    `class_id` is the smallest doc_id with the same shingle set. Classes are linked if their sets' Jaccard similarity is at least
    `threshold`; `n_text_links` counts the linked classes, `n_links` the other rows that are linked or of the same class.
    `component_id` is the smallest doc_id that links lead to; `kept` marks its row (and rows that repeat it entirely). Where a
    doc_id repeats with other texts, components may have one smallest id; the numbers `component`, alike only in one run, tell them apart.
    A text of one to four words is one shingle; a null text, or one without words, links with nothing, nor does a row
    with a null doc_id. An empty table gives no rows; other columns are not read. Whole texts are used, of any length.
    """
    sets = materialize(_sets(docs, shingle), "shingle-sets")
    key = ["f1", "f2", "size"]
    classes = (
        sets.where("size > 0 AND doc_id IS NOT NULL")
        .groupBy(*key)
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("row"), F.count("*").alias("weight"), F.first("sketch").alias("sketch"))
    )
    # Classes are numbered, as a doc_id may repeat with other texts; written once, the numbers stay.
    numbered = classes.select(*key, "row.*", "weight", "sketch").withColumn("node", F.monotonically_increasing_id())
    classes = materialize(numbered, "shingle-classes")
    roots = _candidates(classes.select("node", "sketch"), threshold, recall)
    links = materialize(_verified(docs, classes, roots, threshold, shingle), "ngram-links")
    counted = links.groupBy("node").agg(F.sum("rows").alias("rows"), F.sum("texts").alias("texts"))
    linked = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    least = linked.join(classes.select("node", "doc_id"), "node").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classed = (
        classes.select(*key, "node", "doc_id", "weight")
        .join(counted, "node", "left")
        .join(linked.join(least, "root").select("node", "root", "component_id"), "node", "left")
        .select(
            *key,
            F.col("doc_id").alias("first_id"),
            (F.coalesce("rows", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("texts", F.lit(0).cast("long")).alias("n_text_links"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.coalesce("root", "node").alias("component"),
        )
    )
    able = F.when(F.col("doc_id").isNotNull(), F.col("size"))
    zero = F.lit(0).cast("long")
    return (
        sets.select("doc_id", "text_hash", "f1", "f2", able.alias("size"))
        .join(classed, key, "left")
        .select(
            "doc_id",
            "text_hash",
            F.coalesce("first_id", "doc_id").alias("class_id"),
            F.coalesce("n_links", zero).alias("n_links"),
            F.coalesce("n_text_links", zero).alias("n_text_links"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
            F.coalesce("component", "text_hash").alias("component"),
        )
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, recall: float = 0.9995, shingle: int = SHINGLE) -> DataFrame:
    """The rows of `docs` that `ngram_links` keeps, one for each component, with all their columns.

    Rows without words and rows with a null doc_id all stay.
    """
    kept = ngram_links(docs, threshold, recall, shingle).where("kept AND doc_id IS NOT NULL")
    # One row for each id and text; an id that repeats with another text of the same component stays with one of them.
    by_component = kept.groupBy("component", "doc_id").agg(F.min("text_hash").alias("text_hash"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    whole = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    with_id = whole.join(by_component.select("doc_id", "text_hash"), ["doc_id", "text_hash"], "left_semi")
    one = with_id.dropDuplicates(["doc_id", "text_hash"]).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
    return one.unionByName(docs.where("doc_id IS NULL"))


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(shingle)
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.iloc[at : at + 256]
                sets = [shingles(t) for t in batch["text"]]
                full = [s for s in sets if len(s)]
                rows = iter(sketches(full)) if full else iter(())
                prints = [fingerprint(s) for s in sets]
                yield pd.DataFrame(
                    {
                        "doc_id": batch["doc_id"].astype("Int64"),
                        "text_hash": batch["text_hash"],
                        "f1": [p[0] for p in prints],
                        "f2": [p[1] for p in prints],
                        "size": [len(s) for s in sets],
                        "sketch": [next(rows).tobytes() if len(s) else b"" for s in sets],
                    }
                )

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return in_tasks(rows, task, "doc_id long, text_hash long, f1 long, f2 long, size long, sketch binary")


def _candidates(classes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(node, root): the candidate groups of `classes` (node, sketch), those of one node left out."""
    runs = runs_for(recall, threshold)
    first = _edges(classes.withColumn("root", F.col("node")), range(min(FIRST_RUNS, runs)), threshold)
    rooted = classes.join(_near_roots(first), "node", "left").withColumn("root", F.coalesce("root", "node"))
    more = _edges(materialize(rooted, "rooted-classes"), range(min(FIRST_RUNS, runs), runs), threshold)
    return components(first.union(more))


def _near_roots(edges: DataFrame, jumps: int = 2) -> DataFrame:
    """(node, root): the smallest neighbour of each node, then that one's root, so often. Equal roots tell of one component; one component
    may still have several."""
    near = edges.where("a > b").groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    near = materialize(near, "near-roots")
    for _ in range(jumps):
        up = near.select(F.col("node").alias("root"), F.col("root").alias("up"))
        near = materialize(near.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "near-roots")
    return near


def _edges(rooted: DataFrame, runs: range, threshold: float) -> DataFrame:
    """Edges (a, b) between candidates that the `runs` find, where `rooted` (node, sketch, root) does not know all of a bucket as one."""
    second = 1 / threshold - 1

    def roots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sketch = _matrix(batch["sketch"])
            for run in runs:
                row = np.arange(len(batch))
                path = np.full(len(batch), mixed(np.array([run + 1], U))[0])
                for _ in range(FIRST_DEPTH):
                    row, path = step(row, path, sketch, second)
                yield _unique(batch, row, path)

    def deeper(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sketch = _matrix(batch["sketch"])
            row, path = np.arange(len(batch)), batch["path"].to_numpy().astype(U)
            for _ in range(DEEPER):
                row, path = step(row, path, sketch, 1.0)
            yield _unique(batch, row, path)

    cutoff = cutoff_of(threshold)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[np.ndarray] = []
        for run in runs_of(batches, ["path"]):
            edges = _alike(run, cutoff)
            if len(edges):
                out.append(edges)
            if len(out) > 2000:
                yield pd.DataFrame(np.concatenate(out), columns=["a", "b"])
                out = []
        if out:
            yield pd.DataFrame(np.concatenate(out), columns=["a", "b"])

    sketched = rooted.select("node", "sketch", "root")
    nodes = in_tasks(sketched, roots, "path long, node long, root long")
    edges = None
    for depth in range(FIRST_DEPTH, GREATEST_DEPTH + 1, DEEPER):
        nodes = materialize(nodes, f"paths-{depth}")
        buckets = nodes.groupBy("path").agg(
            F.count("*").alias("n"), F.min("node").alias("least"), F.min("root").alias("low"), F.max("root").alias("high")
        )
        # All buckets are joined and written, so that as many rows come out as go in, whatever the buckets' sizes.
        members = materialize(nodes.drop("root").join(buckets, "path"), f"buckets-{depth}").where("low < high")
        small = _sketched(members.where(F.col("n") <= BUCKET), sketched.drop("root"))
        bits = small.select("path", "node", "sketch").repartition("path").sortWithinPartitions("path", "node")
        found = in_tasks(bits, compare, "a long, b long")
        large = members.where(F.col("n") > BUCKET)
        if depth + DEEPER > GREATEST_DEPTH:
            found = found.union(large.select(F.col("node").alias("a"), F.col("least").alias("b")))
        else:
            nodes = in_tasks(_sketched(large, sketched), deeper, "path long, node long, root long")
        found = materialize(found.distinct(), f"candidates-{depth}")
        edges = found if edges is None else edges.union(found)
    return edges


def _sketched(members: DataFrame, sketched: DataFrame) -> DataFrame:
    """`members` (path, node) with the columns of `sketched`: one row of the join for each set, whatever the number of its paths, which
    the tree bounds."""
    paths = members.groupBy("node").agg(F.collect_list("path").alias("paths"))
    return paths.join(sketched, "node").withColumn("path", F.explode("paths")).drop("paths")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(len(column), PLACES)


def _unique(batch: pd.DataFrame, row: np.ndarray, path: np.ndarray) -> pd.DataFrame:
    """A node of the tree holds a set once, even if its parent sampled a place twice."""
    node, root = (batch[c].to_numpy()[row] for c in ("node", "root"))
    return pd.DataFrame({"path": path.astype(np.int64), "node": node, "root": root}).drop_duplicates()


def _alike(run: dict[str, np.ndarray], cutoff: float) -> np.ndarray:
    """Edges (node, smallest node reached) of a bucket's sets whose sketches agree in more places than the cutoff."""
    sketch = np.frombuffer(b"".join(run["sketch"]), np.uint32).reshape(-1, PLACES)
    n = len(sketch)
    agree = np.zeros((n, n), np.uint8)
    for place in sketch.T:
        agree += place[:, None] == place[None, :]
    root = local_roots(agree >= cutoff * PLACES)
    moved = root != np.arange(n)
    return np.stack([run["node"][moved], run["node"][root[moved]]], axis=1)


def _verified(docs: DataFrame, classes: DataFrame, roots: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """(node, rows, texts, root): exact links, counted and joined within the blocks of each candidate group."""
    members = materialize(roots.join(classes.drop("sketch"), "node"), "candidate-members")
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    # One row for each class, however often it repeats.
    texts = hashed.join(members.hint("merge"), ["doc_id", "text_hash"]).dropDuplicates(["node"]).drop("doc_id", "text_hash")
    counts = members.groupBy("root").agg(F.greatest(F.count("*"), F.ceil(F.sum("size") / TEXT_SHINGLES)).alias("n"))
    dealt = dealt_in_blocks(texts, counts, ["root"], "node", BLOCK)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(shingle)
        out: list[np.ndarray] = []
        for run in runs_of(batches, ["root", "block_a", "block_b"]):
            found = _linked(run, shingles, threshold)
            if found is not None:
                out.append(found)
            if len(out) > 1000:
                yield pd.DataFrame(np.concatenate(out), columns=["node", "rows", "texts", "root"])
                out = []
        if out:
            yield pd.DataFrame(np.concatenate(out), columns=["node", "rows", "texts", "root"])

    return in_tasks(dealt, compare, "node long, rows long, texts long, root long")


def _linked(run: dict[str, np.ndarray], shingles: Shingles, threshold: float) -> np.ndarray | None:
    if len(run["node"]) < 2:
        return None
    order = np.argsort(run["node"], kind="stable")
    node, weight, block = (run[c][order].astype(np.int64) for c in ("node", "weight", "own_block"))
    sets = tuple(shingles(run["text"][i]) for i in order)
    size = np.array([len(s) for s in sets], np.int64)
    common = _common(sets)
    linked = common / (size[:, None] + size[None, :] - common) >= threshold
    np.fill_diagonal(linked, False)
    if run["block_a"][0] != run["block_b"][0]:
        linked &= block[:, None] != block[None, :]
    some = linked.any(1)
    if not some.any():
        return None
    root = node[local_roots(linked)]
    return np.stack([node, linked @ weight, linked.sum(1), root], axis=1)[some]


def _common(sets: tuple[np.ndarray, ...]) -> np.ndarray:
    """How many members each two sets share."""
    n = len(sets)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    numbers, code, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1  # numbers of one set only are left out
    owner, code = owner[shared[code]], number[code[shared[code]]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    out = np.zeros((n, n), np.int64)
    width = 4096
    for at in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(code, [at, at + width])
        has = np.zeros((n, width), np.float32)
        has[owner[a:b], code[a:b] - at] = 1
        out += (has @ has.T).astype(np.int64)
    np.fill_diagonal(out, [len(s) for s in sets])
    return out
