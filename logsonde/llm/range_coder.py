"""Blocks of token ids, coded by an adaptive range coder whose id predictions of order 0, 1 and 2 are mixed.

A block stands alone: it starts from an empty model, and its header holds the count, the lanes and a crc32 of its
ids. Its ids are dealt to lanes (contiguous runs), each a stream of its own; all lanes code their j-th id at the
same step, with one model that learns from all lanes after the step. So each step is a few array operations.

The model of a step mixes three distributions of the next id:
* order 2: the id kept for the hash of the two ids before, with its confidence (0 to 7),
* order 1: the id kept for the id before, with its confidence (0 to 7),
* order 0: adaptive counts of all ids.
The weights of the mixture belong to the pair of confidences (and to whether both predict the same id); they are
counts of which of the three was right, and so adapt too. Everything is integer arithmetic, alike on all machines.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"LSR1"
HEADER = struct.Struct("<4sIIII")  # magic, ids, lanes, size of the vocabulary, crc32 of the ids (32-bit little-endian)
MAX_LANES = 4096
LANE_IDS = 256  # ids a lane holds before another lane is opened
MIX_BITS = 12
HASH_BITS = 16
STEP_REFRESH = 8  # steps between two rebuilds of the cumulative counts
GAIN = 24  # what one occurrence adds to an id's count, all of which start at 1
TOTAL_BOUND = 1 << 24

#: The confidence after a miss (first 8) and a hit (last 8); at 0 the id that came is kept instead.
CONFIDENCE = np.array([*[c >> 1 for c in range(8)], *[min(c + 1, 7) for c in range(8)]], np.int8)

U = np.uint64
TOP, BOTTOM = U(1 << 48), U(1 << 40)
LOW_MASK = U((1 << 40) - 1)


class Model:
    """What encoder and decoder share: predictions before a step, learning after it."""

    def __init__(self, lanes: int, vocabulary: int):
        self.vocabulary = vocabulary
        self.id1 = np.zeros(vocabulary, np.int32)
        self.sure1 = np.zeros(vocabulary, np.int8)
        self.id2 = np.zeros(1 << HASH_BITS, np.int32)
        self.sure2 = np.zeros(1 << HASH_BITS, np.int8)
        self.right = np.tile(np.array([1, 1, 2], np.int64), (128, 1))
        self.counts = np.ones(vocabulary, np.int32)
        self.seen: list[np.ndarray] = []
        self.step = 0
        self.before1 = np.zeros(lanes, np.int64)
        self.before2 = np.zeros(lanes, np.int64)
        self._weigh()
        self._cumulate()

    def _weigh(self) -> None:
        size = (1 << MIX_BITS) - 3
        share = self.right[:, :2] * size // self.right.sum(1, keepdims=True) + 1
        self.two = share[:, 0].astype(np.uint64)
        self.one = share.sum(1).astype(np.uint64)

    def _cumulate(self) -> None:
        self.upto = np.zeros(self.vocabulary + 1, np.int32)  # below 2 * TOTAL_BOUND
        np.cumsum(self.counts, out=self.upto[1:])
        self.total = int(self.upto[-1])

    def counts_of(self, ids: np.ndarray) -> np.ndarray:
        """The counts that the cumulative ones were made of; `counts` may be ahead of them."""
        return (self.upto[ids + 1] - self.upto[ids]).astype(U)

    def predict(self) -> None:
        self.slot = ((self.before2 * 40503) ^ (self.before1 * 2654435)) & ((1 << HASH_BITS) - 1)
        self.guess2, self.conf2 = self.id2.take(self.slot), self.sure2.take(self.slot)
        self.guess1, self.conf1 = self.id1.take(self.before1), self.sure1.take(self.before1)
        self.state = ((self.conf2 << 4) | (self.conf1 << 1) | (self.guess1 == self.guess2)).astype(np.int64)
        self.to2, self.to1 = self.two.take(self.state), self.one.take(self.state)

    def learn(self, ids: np.ndarray, outcome: np.ndarray) -> None:
        for guess, conf, kept, sure, at in (
            (self.guess2, self.conf2, self.id2, self.sure2, self.slot),
            (self.guess1, self.conf1, self.id1, self.sure1, self.before1),
        ):
            now = CONFIDENCE.take(((guess == ids).view(np.int8) << 3) | conf)
            sure[at] = now
            kept[at] = np.where(now == 0, ids, guess)
        self.right += np.bincount(self.state * 3 + outcome, minlength=384).reshape(128, 3)
        self.seen.append(ids[outcome == 2])
        self.before2, self.before1 = self.before1, ids
        self.step += 1
        if self.step % STEP_REFRESH == 0 or self.step < 8:
            self._weigh()
            self.counts += (GAIN * np.bincount(np.concatenate(self.seen), minlength=self.vocabulary)).astype(np.int32)
            self.seen = []
            if int(self.counts.sum()) >= TOTAL_BOUND:
                self.counts = (self.counts + 1) >> 1
            self._cumulate()


def _shape(n: int) -> tuple[int, int]:
    lanes = max(1, min(MAX_LANES, n // LANE_IDS))
    return lanes, -(-n // lanes)


def encode_block(ids: np.ndarray, vocabulary: int = 1 << 16) -> bytes:
    """One block of `ids` (any integers from 0 to `vocabulary` - 1)."""
    ids = np.ascontiguousarray(ids, dtype=np.int64)
    n = len(ids)
    if n and (ids.min() < 0 or ids.max() >= vocabulary):
        raise ValueError(f"ids must be from 0 to {vocabulary - 1}")
    lanes, steps = _shape(n)
    head = HEADER.pack(MAGIC, n, lanes, vocabulary, zlib.crc32(ids.astype("<u4").tobytes()))
    if not n:
        return head
    grid = np.zeros(lanes * steps, np.int64)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model = Model(lanes, vocabulary)
    low, size = np.zeros(lanes, U), np.full(lanes, U(2**64 - 1))
    lane_of, word_of = [], []
    for now in grid:
        model.predict()
        not2 = now != model.guess2
        not1 = not2 & (now != model.guess1)
        outcome = not2.view(np.int8) + not1.view(np.int8)
        unit = size >> U(MIX_BITS)
        start = np.where(not1, model.to1, model.to2 * not2)
        end = np.where(not1, U(1 << MIX_BITS), np.where(not2, model.to1, model.to2))
        low += start * unit
        size = (end - start) * unit
        rest = np.flatnonzero(not1)
        chosen = now[rest]
        unit = size[rest] // U(model.total)
        low[rest] += model.upto[chosen].astype(U) * unit
        size[rest] = model.counts_of(chosen) * unit
        _shift_out(low, size, lane_of, word_of)
        model.learn(now, outcome)
    for part in (48, 32):  # a number inside the last interval, whose low 32 bits are zero
        if part == 48:
            low = ((low + U(2**32 - 1)) >> U(32)) << U(32)
        lane_of.append(np.arange(lanes))
        word_of.append(((low >> U(part)) & U(0xFFFF)).astype("<u2"))
    lane, word = np.concatenate(lane_of).astype(np.uint16), np.concatenate(word_of)
    body = word[np.argsort(lane, kind="stable")]
    sizes = np.bincount(lane, minlength=lanes).astype("<u4")
    return head + sizes.tobytes() + body.tobytes()


def _shift_out(low: np.ndarray, size: np.ndarray, lane_of: list, word_of: list) -> None:
    """Writes the words that are settled, in place, until each lane has room for the next step."""
    at = np.flatnonzero(((low ^ (low + size)) < TOP) | (size < BOTTOM))
    while len(at):
        a, s = low[at], size[at]
        s = np.where((a ^ (a + s)) < TOP, s, (U(0) - a) & LOW_MASK)
        lane_of.append(at)
        word_of.append((a >> U(48)).astype("<u2"))
        a, s = a << U(16), s << U(16)
        low[at], size[at] = a, s
        at = at[((a ^ (a + s)) < TOP) | (s < BOTTOM)]


def decode_block(block: bytes) -> np.ndarray:
    """The ids (int64) of a block; raises ValueError if it is damaged."""
    if len(block) < HEADER.size:
        raise ValueError("the block is shorter than its header")
    magic, n, lanes, vocabulary, crc = HEADER.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a block of this format")
    if not n:
        return np.zeros(0, np.int64)
    if (lanes, -(-n // lanes)) != _shape(n):
        raise ValueError("the block's lanes don't fit its count")
    steps = -(-n // lanes)
    sizes = np.frombuffer(block, "<u4", lanes, HEADER.size).astype(np.int64)
    words = np.frombuffer(block, "<u2", -1, HEADER.size + 4 * lanes).astype(U)
    if int(sizes.sum()) != len(words):
        raise ValueError("the block is cut short")
    ends = np.cumsum(sizes)
    at_word = ends - sizes
    words = np.append(words, np.zeros(4, U))
    model = Model(lanes, vocabulary)
    low, size = np.zeros(lanes, U), np.full(lanes, U(2**64 - 1))
    code = np.zeros(lanes, U)
    for _ in range(4):
        code = (code << U(16)) | np.where(at_word < ends, words[np.minimum(at_word, len(words) - 1)], U(0))
        at_word = at_word + 1
    out = np.empty((steps, lanes), np.int64)
    for step in range(steps):
        model.predict()
        unit = size >> U(MIX_BITS)
        point = (code - low) // unit
        not2, not1 = point >= model.to2, point >= model.to1
        outcome = not2.view(np.int8) + not1.view(np.int8)
        start = np.where(not1, model.to1, model.to2 * not2)
        end = np.where(not1, U(1 << MIX_BITS), np.where(not2, model.to1, model.to2))
        low += start * unit
        size = (end - start) * unit
        now = np.where(not2, model.guess1, model.guess2).astype(np.int64)
        rest = np.flatnonzero(not1)
        unit = size[rest] // U(model.total)
        point = np.minimum((code[rest] - low[rest]) // unit, U(model.total - 1)).astype(np.int32)
        chosen = np.searchsorted(model.upto, point, "right") - 1
        low[rest] += model.upto[chosen].astype(U) * unit
        size[rest] = model.counts_of(chosen) * unit
        now[rest] = chosen
        at = np.flatnonzero(((low ^ (low + size)) < TOP) | (size < BOTTOM))
        while len(at):
            a, s = low[at], size[at]
            s = np.where((a ^ (a + s)) < TOP, s, (U(0) - a) & LOW_MASK)
            where = at_word[at]
            code[at] = (code[at] << U(16)) | np.where(where < ends[at], words[np.minimum(where, len(words) - 1)], U(0))
            at_word[at] = where + 1
            a, s = a << U(16), s << U(16)
            low[at], size[at] = a, s
            at = at[((a ^ (a + s)) < TOP) | (s < BOTTOM)]
        out[step] = now
        model.learn(now, outcome)
    ids = out.T.reshape(-1)[:n]
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("the block's checksum is wrong")
    return ids
