"""Benchmark decontamination: the texts' words stream through a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. Each text walks it word by word and knows, at each word, the
longest run ending there that occurs in some item. A run of `window` words or more is a hit; so is a whole item that is shorter
than a window. Cost per word is constant, however many items there are.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from logsonde.llm.common import map_texts, materialize, words

WINDOW = 10

#: Words of items in one automaton, about 500 bytes each in a task; larger benchmarks take several passes.
AUTOMATON_WORDS = 200_000

WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


class Automaton:
    """Generalised suffix automaton over the words of items, given as (name, words)."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.code: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.short: dict[int, set[str]] = {}  # names of short items by the state that they end in
        coded = [(name, [self.code.setdefault(w, len(self.code)) for w in ws]) for name, ws in items if ws]
        for _, run in coded:
            last = 0
            for c in run:
                last = self._extend(last, c)
        self.shortest = min([window, *[len(run) for _, run in coded]])
        n = len(self.length)
        order = sorted(range(n), key=self.length.__getitem__)
        #: The state of the last `window` words of a match, by the state of the match; -1 where it is shorter.
        self.at_window = [-1] * n
        for v in order:
            if self.length[v] >= window:
                above = self.at_window[self.link[v]]
                self.at_window[v] = above if above >= 0 else v
        self.names: dict[int, set[str]] = {}
        for name, run in coded:
            v = 0
            for c in run:
                v = self.next[v][c]
                if self.at_window[v] >= 0:
                    self.names.setdefault(self.at_window[v], set()).add(name)
            if len(run) < window:
                self.short.setdefault(v, set()).add(name)
        #: The nearest state up the suffix links, itself included, that ends a short item; -1 if none.
        self.short_at = [-1] * n
        for v in order[1:]:
            self.short_at[v] = v if v in self.short else self.short_at[self.link[v]]

    def _extend(self, last: int, c: int) -> int:
        there = self.next[last].get(c)
        if there is not None:
            return there if self.length[there] == self.length[last] + 1 else self._split(last, there, c)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
        return new

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        """The part of state q whose runs are at most one word longer than p's gets a state of its own."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def find(self, ws: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans of word positions (start, end exclusive; merged, ascending) and the names of the items hit."""
        if len(ws) < self.shortest or not self.code:
            return [], set()
        get = self.code.get
        codes = np.fromiter((get(w, -1) for w in ws), np.int64, len(ws))
        edges = np.flatnonzero(np.diff(np.concatenate([[False], codes >= 0, [False]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.shortest  # no hit holds a word that no item has
        spans: list[tuple[int, int]] = []
        names: set[str] = set()
        for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            self._walk(codes[a:b].tolist(), a, spans, names)
        return spans, names

    def _walk(self, run: list[int], base: int, spans: list[tuple[int, int]], names: set[str]) -> None:
        state = matched = 0
        moves, link, length = self.next, self.link, self.length
        for i, c in enumerate(run, base + 1):
            while c not in moves[state]:
                state = link[state]
                matched = length[state]  # every word here is in some item, so the root has a move for it
            state = moves[state][c]
            matched += 1
            start = i
            if matched >= self.window:
                start = i - self.window
                names |= self.names[self.at_window[state]]
            v = self.short_at[state]
            while v >= 0:
                if length[v] <= matched:
                    start = min(start, i - length[v])
                    names |= self.short[v]
                v = self.short_at[link[v]]
            if start < i:
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i))


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def automata(benchmark: DataFrame, window: int, automaton_words: int) -> Iterable[Callable[[], Automaton]]:
    """Makers of automata that together hold all items; each gets a broadcast of at most about `automaton_words` words.

    The items are dealt by hash into as many shares as their total length asks for, so what one pass broadcasts
    does not grow with the benchmark; a larger one makes more passes.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"), "text").where(
        "text IS NOT NULL"
    )
    letters = items.agg(F.sum(F.length("text"))).first()[0] or 0
    shares = max(1, -(-letters // (4 * automaton_words)))
    context = benchmark.sparkSession.sparkContext
    for share in range(shares):
        own = items.where(F.pmod(F.xxhash64("name", "text"), F.lit(shares)) == share).distinct().collect()
        held = context.broadcast([(r["name"], r["text"]) for r in own])

        def make(held=held) -> Automaton:
            return Automaton([(name, words(text)) for name, text in held.value], window)

        yield make


FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "spans",
            T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
        ),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def find_items(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, automaton_words: int = AUTOMATON_WORDS
) -> DataFrame:
    """(doc_id, n_words, spans, items) for every row of `docs`: which words of its text are part of a benchmark item.

    `spans` are merged word positions (end exclusive), `items` the sorted ids, as strings, of the items with a run found. Items
    of fewer than `window` words are hit as a whole; items that are null or have no words never are; a null item_id
    reads "null"; equal items are all named. A null or empty text has no words. Rows that repeat stay. An empty table on
    either side gives no rows or no hits. Other columns are not read. Texts of any length take memory for
    their own words only. No shuffle: texts stay in their task.
    """
    passes = []
    for make in automata(benchmark, window, automaton_words):

        def task(make=make):
            automaton = make()

            def find(texts: list[str | None]) -> list[list]:
                split = [words(t) for t in texts]
                found = [automaton.find(ws) for ws in split]
                return [
                    [len(ws) for ws in split],
                    [[{"start": a, "end": b} for a, b in spans] for spans, _ in found],
                    [sorted(names) for _, names in found],
                ]

            return find

        passes.append(task)
    rows = docs.select("doc_id", "text")
    if len(passes) == 1:
        return map_texts(rows, passes[0], FOUND, ["doc_id"])
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "texts")
    parts = [materialize(map_texts(rows, task, FOUND, ["row", "doc_id"]), "found") for task in passes]
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    # One row for each pass and document, so a group is as large as the number of passes.
    both = every.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    pairs = F.aggregate(
        F.array_sort("spans"),
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["start"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    return both.select("doc_id", "n_words", pairs.alias("spans"), "items")


def remove_items(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.8, automaton_words: int = AUTOMATON_WORDS
) -> DataFrame:
    """`docs` without benchmark text: hit spans are cut out; a text of which more than `max_coverage` of the words
    was hit goes altogether.

    Cutting is repeated on what is left, since its ends may join to a new run, so that a second pass finds nothing. Each round
    cuts the hits of all items at once, and the share of hit words is taken of all rounds together, whether one automaton
    holds the items or several do.
    All columns stay; n_chars, if there is one, is counted anew where the text changed. Texts without a hit stay as they
    are; nulls, empty texts and repeated rows are kept.
    """
    columns = docs.columns
    makers = list(automata(benchmark, window, automaton_words))
    if len(makers) == 1:
        changed = [T.StructField("text", T.StringType()), T.StructField("__hit", T.DoubleType())]

        def task(make=makers[0]):
            automaton = make()

            def cut(texts: list[str | None]) -> list[list]:
                kept, shares = [], []
                for text in texts:
                    ws = words(text)
                    n, hit = len(ws), 0
                    spans, _ = automaton.find(ws)
                    while spans:
                        hit += sum(b - a for a, b in spans)
                        text = cut_words(text, spans)
                        spans, _ = automaton.find(words(text))
                    kept.append(text)
                    shares.append(hit / n if n else 0.0)
                return [kept, shares]

            return cut

        out = map_texts(docs, task, T.StructType(changed), columns)
    else:
        out = _cut_in_rounds(docs, makers)
    out = out.where(F.col("__hit") <= max_coverage)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.col("__hit") > 0, F.length("text")).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in columns])


SPANS = T.StructType([FOUND["spans"]])
CUT = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("__n", T.LongType()), T.StructField("__now", T.LongType())]
)


def _cut_in_rounds(docs: DataFrame, makers: list[Callable[[], Automaton]]) -> DataFrame:
    """`docs` with the hits of all automata cut out, and `__hit`, the part of a text's first words that was hit.

    A round looks for spans with one automaton after the other, on the same texts, and cuts them together; texts that
    changed go on to the next round. Texts are shuffled once in each round that they take part in.
    """

    def finder(make: Callable[[], Automaton]):
        def task():
            automaton = make()
            return lambda texts: [[[{"start": a, "end": b} for a, b in automaton.find(words(t))[0]] for t in texts]]

        return task

    def cutter():
        def cut(rows: list[dict]) -> list[list]:
            kept, n_words, now = [], [], []
            for row in rows:
                text, found = row["text"], row["spans"]
                spans = merged((x["start"], x["end"]) for x in found) if found else []
                n_words.append(len(words(text)) if spans else None)
                now.append(sum(b - a for a, b in spans))
                kept.append(cut_words(text, spans) if spans else text)
            return [kept, n_words, now]

        return cut

    left = docs.withColumns({"__row": F.monotonically_increasing_id(), "__words": F.lit(None).cast("long"), "__cut": F.lit(0).cast("long")})
    left = materialize(left, "texts")
    done = None
    while True:
        found = None
        for make in makers:
            part = map_texts(left.select("__row", "text"), finder(make), SPANS, ["__row"]).where("size(spans) > 0")
            part = materialize(part, "found")
            found = part if found is None else found.union(part)
        # At most one row for each pass and document, so a group is as large as the number of passes.
        spans = found.groupBy("__row").agg(F.flatten(F.collect_list("spans")).alias("__spans"))
        both = left.join(spans, "__row", "left").withColumn("__both", F.struct("text", F.col("__spans").alias("spans")))
        kept = [*docs.columns, "__row", "__words", "__cut"]
        after = map_texts(both, cutter, CUT, kept, text="__both").withColumns(
            {"__words": F.coalesce("__words", "__n"), "__cut": F.col("__cut") + F.col("__now")}
        )
        after = materialize(after, "cut")
        settled = after.where("__now = 0")
        done = settled if done is None else done.union(settled)
        left = after.where("__now > 0").drop("__n", "__now")
        if left.isEmpty():
            break
    hit = F.when(F.col("__words") > 0, F.col("__cut") / F.col("__words")).otherwise(0.0)
    return done.select(*[F.col(f"`{c}`") for c in docs.columns], hit.alias("__hit"))


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """`text` without the words of `spans` and what stands between them."""
    at = [m.span() for m in WORD.finditer(text)]
    parts, last = [], 0
    for a, b in spans:
        parts.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return "".join([*parts, text[last:]])
