"""Spans found in texts: their order, digest and text form; shared by the scans for secrets and personal data."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Sequence
from itertools import accumulate

from pyspark.sql import types as T

Span = tuple[str, int, int]  # kind, start, end (code points, end exclusive)


def ordered(spans: Iterable[Span], kinds: Sequence[str]) -> list[Span]:
    """By start, then by the order of kinds, then by end."""
    rank = {k: i for i, k in enumerate(kinds)}
    return sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2]))


def joined(spans: Iterable[Span]) -> str:
    return ",".join([f"{k}:{a}:{b}" for k, a, b in spans])


def digest(spans: Iterable[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


class Cover:
    """Tells which spans overlap one of the given ones, each in the time of one search."""

    def __init__(self, spans: Iterable[Span]):
        pairs = sorted((a, b) for _, a, b in spans)
        self.starts = [a for a, _ in pairs]
        self.ends = list(accumulate((b for _, b in pairs), max))  # the farthest end up to each start

    def overlaps(self, span: Span) -> bool:
        before = bisect_left(self.starts, span[2])
        return before > 0 and self.ends[before - 1] > span[1]


def replaced(text: str, spans: Iterable[Span], mark: str) -> str:
    """`text` with each stretch of touching or overlapping spans replaced by `mark`."""
    parts, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1]):
        if a > at or not parts:
            parts += [text[at:a], mark]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def found_type(base_kinds: Sequence[str]) -> T.StructType:
    """Counts of the base kinds, the digest of the base spans, and all spans."""
    return T.StructType(
        [
            *[T.StructField(f"n_{k}", T.LongType()) for k in base_kinds],
            T.StructField("base_sha256", T.StringType()),
            T.StructField("spans", T.StringType()),
        ]
    )


def found_columns(found: Sequence[tuple[list[Span], list[Span]]], base_kinds: Sequence[str], kinds: Sequence[str]) -> list[list]:
    """The values of `found_type` for (base spans, added spans) of some texts."""
    counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in base_kinds]
    base = [ordered(b, kinds) for b, _ in found]
    return [*counts, [digest(b) for b in base], [joined(ordered([*b, *more], kinds)) for b, more in found]]
