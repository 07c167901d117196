"""Packing documents into sequences: large ones matched in pairs, small ones in the best-fitting gaps.

A piece of more than a third of the capacity shares its sequence with at most one other such piece. So the large
pieces are matched greedily, the longest first, each with the longest partner that still fits, which gives the fewest
sequences that large pieces alone can have. The small ones then go, the longest first, to the smallest gap that holds them.

Pieces of one length are alike, so the whole packing follows from how many pieces there are of each length (at most
`capacity` numbers): it is planned on that histogram, in runs "the pieces of length L with ranks a to b go to sequences
s, s+1, ... at offset o", and every piece then looks its rank up. No task or driver ever holds pieces of all documents.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from logsonde.llm.common import in_tasks, materialize, part_starts
from logsonde.llm.token_ids import token_ids

CAPACITY = 2048
PIECES = "part int, doc_id long, piece int, start long, length int, ids_crc32 long, in_part long"
PIECES_WITH_IDS = PIECES + ", ids binary"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


@dataclass(frozen=True)
class Run:
    """`sequences` sequences from `first` on each take `each` pieces of one length, from `offset` on."""

    length: int
    rank: int  # of the first piece among those of its length
    first: int
    sequences: int
    each: int
    offset: int


def plan(counts: Mapping[int, int], capacity: int) -> list[Run]:
    """The runs for so many pieces of each length (1 to capacity); their number depends on the lengths, not the counts."""
    left = {n: c for n, c in counts.items() if c > 0}
    used = dict.fromkeys(left, 0)
    runs: list[Run] = []
    gaps: dict[int, list[tuple[int, int, int]]] = {}  # gap: (first sequence, sequences, offset of the gap)
    next_sequence = 0

    def take(length: int, first: int, sequences: int, each: int, offset: int) -> None:
        runs.append(Run(length, used[length], first, sequences, each, offset))
        used[length] += sequences * each
        left[length] -= sequences * each
        if not left[length]:
            del left[length]

    def leave(gap: int, first: int, sequences: int) -> None:
        if gap and sequences:
            gaps.setdefault(gap, []).append((first, sequences, capacity - gap))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        at = bisect.bisect_right(large, capacity - n) - 1
        if at < 0:
            count, gap = left[n], capacity - n
            take(n, next_sequence, count, 1, 0)
        elif (m := large[at]) == n:
            count, gap = left[n] // 2 or 1, capacity - 2 * n
            if left[n] == 1:  # the last one of the length: a shorter partner, if there is one
                if at == 0:
                    gap = capacity - n
                    take(n, next_sequence, 1, 1, 0)
                else:
                    m = large[at - 1]
                    gap = capacity - n - m
                    take(n, next_sequence, 1, 1, 0)
                    take(m, next_sequence, 1, 1, n)
            else:
                take(n, next_sequence, count, 2, 0)
        else:
            count, gap = min(left[n], left[m]), capacity - n - m
            take(n, next_sequence, count, 1, 0)
            take(m, next_sequence, count, 1, n)
        leave(gap, next_sequence, count)
        next_sequence += count
        large = [x for x in large if x in left]

    sizes = sorted(gaps)
    for n in sorted(left, reverse=True):
        while n in left:
            at = bisect.bisect_left(sizes, n)
            if at == len(sizes):  # no gap holds it: new sequences, as full of this length as they get
                each = min(capacity // n, left[n])
                count = left[n] // each
                take(n, next_sequence, count, each, 0)
                made = [(capacity - each * n, next_sequence, count)]
                next_sequence += count
            else:
                gap = sizes[at]
                first, sequences, offset = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
                each = gap // n
                count = min(sequences, left[n] // each)
                made = [(gap, first + count, sequences - count)]
                if count:
                    take(n, first, count, each, offset)
                    made.append((gap - each * n, first, count))
                else:
                    each = left[n]
                    take(n, first, 1, each, offset)
                    made = [(gap, first + 1, sequences - 1), (gap - each * n, first, 1)]
            for gap, first, sequences in made:
                if gap and sequences:
                    if gap not in gaps:
                        bisect.insort(sizes, gap)
                    leave(gap, first, sequences)
    return runs


def pack(
    docs: DataFrame, tokenizer: str, end_id: int | None = 0, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Every piece of every document of `docs` (doc_id, text) and its place.

    (doc_id, piece, start, length, ids_crc32, sequence_id, offset), and `ids` with `with_ids`. A document's ids end with `end_id`;
    only one longer than the capacity is cut, into pieces of the capacity and a rest. A null or empty text is its end id;
    without an end id it has no piece. Repeated rows are pieces of their own; a null doc_id stays null; an
    empty table has no pieces; other columns are not read. Sequences are numbered from 0 and filled without gaps.
    """
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, part = token_ids(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for at in range(0, len(batch), 1024):
                rows: list[tuple] = []
                some = batch.iloc[at : at + 1024]
                for doc_id, text in zip(some["doc_id"], some["text"], strict=True):
                    coded = encoder.encode(text) + end
                    for piece, a in enumerate(range(0, len(coded), 4 * capacity)):
                        ids = coded[a : a + 4 * capacity]
                        n = len(ids) // 4
                        row = (None if pd.isna(doc_id) else int(doc_id), piece, a // 4, n, zlib.crc32(ids), int(seen[n]))
                        rows.append((*row, ids) if with_ids else row)
                        seen[n] += 1
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "in_part", *["ids"] * with_ids]
                out = pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})
                out.insert(0, "part", part)
                yield out
        encoder.forget()

    made = in_tasks(docs.select("doc_id", "text"), cut, PIECES_WITH_IDS if with_ids else PIECES)
    pieces = materialize(made, "pieces")
    counts = materialize(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    starts = part_starts(counts, "part", "n", ["length"]).select("length", "part", "base")
    ranked = pieces.join(starts, ["length", "part"]).withColumn("rank", F.col("base") + F.col("in_part"))

    by_length: dict[int, list[Run]] = {}
    for run in plan(lengths, capacity):
        by_length.setdefault(run.length, []).append(run)
    table = {
        n: np.array([(r.rank, r.first, r.sequences, r.each, r.offset) for r in runs], np.int64).T
        for n, runs in by_length.items()
    }
    held = docs.sparkSession.sparkContext.broadcast(table)  # as large as the plan: bounded by the capacity

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            length, rank = batch["length"].to_numpy(np.int64), batch["rank"].to_numpy(np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order])) + 1
            for own in np.split(order, edges) if len(order) else []:
                n = int(length[own[0]])
                ranks, first, _, each, begin = held.value[n]
                at = np.searchsorted(ranks, rank[own], "right") - 1
                nth = rank[own] - ranks[at]
                sequence[own] = first[at] + nth // each[at]
                offset[own] = begin[at] + nth % each[at] * n
            yield batch.drop(columns=["part", "in_part", "base", "rank"]).assign(sequence_id=sequence, offset=offset)

    return in_tasks(ranked, look_up, PLACED + ", ids binary" if with_ids else PLACED)


def sequences(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, length, doc_ids, ids) of `pack(..., with_ids=True)`: a group has at most `capacity` pieces."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    made = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), rows.alias("rows"))
    joined = F.aggregate("rows", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return made.select("sequence_id", "length", F.transform("rows", lambda x: x["doc_id"]).alias("doc_ids"), joined.alias("ids"))
