"""Packing documents online into a bounded number of open windows.

Every task keeps at most `windows` open windows of `capacity` ids and takes its documents as they come. A document longer than a
window first fills whole windows of its own. What is left goes into the open window with the smallest gap that holds it
(best fit). If none does and no further window may be opened, the fullest one is emitted: as it is where its gap is at most
`slack` ids, and else filled up with the first ids of the document, which is cut there.

The windows still open at the end of a task are leftovers. Those of `merged` tasks at a time are merged by the same rule, their
longest pieces first, and what then stays open is joined and cut, so that every group of tasks keeps at most one
window that is not full; the groups are merged in the same way until one is left. So no task ever holds more than the open windows of
`merged` tasks, only leftovers are shuffled, and a single sequence of the whole table is short for want of documents.
"""

from __future__ import annotations

import base64
import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from logsonde.llm.common import in_tasks, materialize
from logsonde.llm.token_ids import PLAIN

CAPACITY = 2048
WINDOWS = 128
SLACK = 32
MERGED = 8
ROWS = "part int, window int, doc_id long, start long, length long, doc_tokens long, offset long, open boolean, ids_crc32 long, ids binary"
NAMES = [c.split()[0] for c in ROWS.split(", ")]

#: A piece: doc_id, start in its document, the document's tokens, and its ids (little-endian, 32 bits each).
Piece = tuple[int | None, int, int, bytes]


class ByteIds:
    """Ids of whole texts, equal to `Tokenizer.encode(text, add_special_tokens=False).ids` of a byte-level tokenizer.

    With `ranks` (the same vocabulary as a file of ranks) and `pattern`, plain texts without special tokens are encoded by tiktoken, which is
    some five times faster; all other texts go through the library.
    """

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.fast = Tokenizer.from_file(path), None
        if ranks and pattern:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids; a null text is empty."""
        if not text:
            return b""
        if self.fast and "<|" not in text and PLAIN.fullmatch(text):
            return np.asarray(self.fast.encode_ordinary(text), dtype="<u4").tobytes()
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@lru_cache(maxsize=1)
def byte_ids(path: str, ranks: str | None, pattern: str | None) -> ByteIds:
    """One encoder for each worker."""
    return ByteIds(path, ranks, pattern)


class OpenWindows:
    """At most `windows` open windows; emitted ones are taken with `emitted()`."""

    def __init__(self, capacity: int = CAPACITY, windows: int = WINDOWS, slack: int = SLACK):
        if min(capacity, windows) < 1 or slack < 0:
            raise ValueError("capacity and windows must be positive, slack not negative")
        self.capacity, self.windows, self.slack = capacity, windows, slack
        self.pieces: dict[int, list[Piece]] = {}
        self.gaps: list[tuple[int, int]] = []  # (gap, window), ascending
        self.done: list[tuple[int, list[Piece]]] = []
        self.next = 0

    def _emit(self, window: int) -> None:
        self.done.append((window, self.pieces.pop(window)))

    def _open(self, piece: Piece, length: int) -> None:
        self.pieces[self.next] = [piece]
        if length == self.capacity:
            self._emit(self.next)
        else:
            insort(self.gaps, (self.capacity - length, self.next))
        self.next += 1

    def place(self, doc_id: int | None, ids: bytes, start: int = 0, doc_tokens: int | None = None) -> None:
        """Places a document, or a piece of one that begins at its id `start`."""
        n, at = len(ids) // 4, 0
        total = n if doc_tokens is None else doc_tokens

        def piece(length: int) -> Piece:
            return doc_id, start + at, total, ids[4 * at : 4 * (at + length)]

        while at < n:
            length = min(n - at, self.capacity)
            fits = bisect_left(self.gaps, (length, -1))
            if length == self.capacity:
                self._open(piece(length), length)
            elif fits < len(self.gaps):
                gap, window = self.gaps.pop(fits)
                self.pieces[window].append(piece(length))
                if gap == length:
                    self._emit(window)
                else:
                    insort(self.gaps, (gap - length, window))
            elif len(self.gaps) < self.windows:
                self._open(piece(length), length)
            else:
                gap, window = self.gaps.pop(0)
                length = gap if gap > self.slack else 0
                if length:
                    self.pieces[window].append(piece(length))
                self._emit(window)
            at += length

    def join_rest(self) -> None:
        """Joins the open windows, the fullest first, into full ones, cutting pieces; at most one stays open."""
        rest = [p for _, window in self.gaps for p in self.pieces.pop(window)]
        self.gaps, held, room = [], [], self.capacity
        for doc_id, start, total, ids in rest:
            while ids:
                head, ids = ids[: 4 * room], ids[4 * room :]
                held.append((doc_id, start, total, head))
                start, room = start + len(head) // 4, room - len(head) // 4
                if not room:
                    self.done.append((self.next, held))
                    self.next, held, room = self.next + 1, [], self.capacity
        if held:
            self.pieces[self.next] = held
            self.gaps = [(room, self.next)]
            self.next += 1

    def emitted(self) -> list[tuple[int, list[Piece]]]:
        done, self.done = self.done, []
        return done

    def leftovers(self) -> list[tuple[int, list[Piece]]]:
        return sorted(self.pieces.items())


def _rows(part: int, windows: list[tuple[int, list[Piece]]], is_open: bool, with_ids: bool) -> pd.DataFrame:
    rows = []
    for window, pieces in windows:
        offset = 0
        for doc_id, start, total, ids in pieces:
            kept = ids if is_open or with_ids else None
            rows.append((part, window, doc_id, start, len(ids) // 4, total, offset, is_open, zlib.crc32(ids), kept))
            offset += len(ids) // 4
    return pd.DataFrame(rows, columns=NAMES).astype({"doc_id": "Int64"})


def pack_online(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    pattern: str | None = None,
    end_id: int | None = 1,
    capacity: int = CAPACITY,
    windows: int = WINDOWS,
    slack: int = SLACK,
    merged: int = MERGED,
    with_ids: bool = False,
) -> DataFrame:
    """Every piece of every document of `docs` (doc_id long, text) and its place in a sequence of at most `capacity` ids.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), and `ids` with `with_ids`. A document's ids end with `end_id`;
    a null or empty text is its end id alone, and without an end id has no piece. A null doc_id stays null; rows that repeat are documents of their own; an
    empty table has no pieces; other columns are not read; whole texts are used, of any length. Ties between windows of one
    gap go to the older one. Sequence ids are unique and not dense; `offset` is gapless from 0 in each.
    """
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, part = byte_ids(tokenizer, ranks, pattern), TaskContext.get().partitionId()
        held = OpenWindows(capacity, windows, slack)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                held.place(None if pd.isna(doc_id) else int(doc_id), encoder.encode(text) + end)
                if len(held.done) >= 512:
                    yield _rows(part, held.emitted(), False, with_ids)
        yield _rows(part, held.emitted(), False, with_ids)
        yield _rows(part, held.leftovers(), True, with_ids)

    def merging(last: bool):
        def merge(rows: pd.DataFrame) -> pd.DataFrame:
            """Merges the leftovers of one group of parts."""
            group = int(rows["group"].iloc[0])
            rows = rows.sort_values(["length", "part", "window", "offset"], ascending=[False, True, True, True])
            held = OpenWindows(capacity, windows, slack)
            for row in rows.itertuples(index=False):
                held.place(None if pd.isna(row.doc_id) else int(row.doc_id), row.ids, row.start, row.doc_tokens)
            held.join_rest()
            rest = _rows(group, held.leftovers(), not last, with_ids)
            return pd.concat([_rows(group, held.emitted(), False, with_ids), rest])

        return merge

    made = materialize(in_tasks(docs.select("doc_id", "text"), first, ROWS), "window-pieces")
    groups = (made.where("open").agg(F.max("part")).first()[0] or 0) + 1
    closed, depth = [], 0
    while True:
        sequence = F.shiftleft(F.lit(depth).cast("long"), 59) + F.shiftleft(F.col("part").cast("long"), 31) + F.col("window")
        closed.append(made.where("NOT open").withColumn("sequence_id", sequence))
        if depth and groups == 1:
            break
        depth, groups = depth + 1, -(-groups // merged)
        grouped = made.where("open").withColumn("group", F.floor(F.col("part") / merged).cast("int"))
        made = materialize(grouped.groupBy("group").applyInPandas(merging(groups == 1), ROWS), "window-leftovers")
    out = closed[0]
    for more in closed[1:]:
        out = out.union(more)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]
    return out.select(*names)
