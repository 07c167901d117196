"""Frequent phrases and their collocation scores, by a multikey three-way quicksort of suffix pointers.

A suffix is what follows a word in its piece, to the maximum depth. All suffixes with the same two leading words are routed to one
bucket, so the size of every partition that the quicksort finds there is a count over all documents: a partition of equal words at depth d
is a phrase of d words, and partitions that are not frequent are abandoned.

Three passes read the texts. The first counts words. The second counts leading pairs of frequent words, which are the sizes of the
routed groups, so infrequent groups are abandoned before their suffixes travel. The third sends the suffixes, cut at the first pair that is not
frequent; equal ones of a task are combined into one with a weight. Suffixes of hot leading pairs are dealt over all
buckets by all their words instead, so no bucket gets one hot group; their partial counts are summed like all others.

Words travel as 64-bit hashes that include the language. That no two words share a frequent hash is checked, not assumed. Which words and pairs are
frequent is told to the tasks by bit tables of a bounded size: a bit too many lets more suffixes travel and changes no count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from logsonde.llm.common import in_tasks, materialize

DEPTH = 5
LEAST = 100
TOP = 2000
UNKNOWN = "und"
CHUNK = 1 << 20  # letters of texts taken at a time
REMEMBERED_WORDS = 1 << 17
BUCKET = 1 << 20  # words of the corpus for each bucket
HOT = 1 << 18  # occurrences from which a leading pair is dealt over all buckets
MOST_BITS = 1 << 28  # of a bit table: 32 MB
SMALL = 64  # pointers of a partition that is put in order at the end, with all other small ones

U = np.uint64
_ODD = np.random.default_rng(31).integers(0, 2**63, DEPTH + 1, dtype=np.uint64) * U(2) + U(1)

#: A-Z to a-z, the ends of pieces to a full stop, tab to space; all other bytes stay.
PIECES = bytes(
    b + 32 if 65 <= b <= 90 else 46 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256)
)
WORD_ROWS = "h long, lang string, word binary, n long"
BLOCK_ROWS = "bucket long, hot boolean, suffixes binary, weights binary"


def spelled(texts: list[str]) -> list[bytes]:
    """The words of texts, with a full stop at the end of each piece and each text."""
    joined = b".".join([t.encode("utf-8", "surrogatepass") for t in texts])
    return joined.translate(PIECES).replace(b".", b" . ").split()


def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, list[bytes]]]:
    """Languages and the words of some of their texts."""
    for batch in batches:
        known = batch[batch["text"].notna()]
        for lang, texts in known.groupby(known["lang"].fillna(UNKNOWN), sort=False)["text"]:
            held, size = [], 0
            for text in texts:
                held.append(text)
                size += len(text)
                if size >= CHUNK:
                    yield lang, spelled(held)
                    held, size = [], 0
            if held:
                yield lang, spelled(held)


class WordHashes(dict):
    """64-bit hashes of the words of one language, never 0, with a bounded memory; the end of a piece is 0."""

    def __init__(self, lang: str, seed: int):
        import xxhash

        self.digest, self.seed = xxhash.xxh3_64_intdigest, xxhash.xxh3_64_intdigest(lang.encode(), seed)
        self.bounded(0)

    def __missing__(self, word: bytes) -> int:
        h = self.digest(word, self.seed) or 1
        if len(word) <= 64:
            self[word] = h
        return h

    def bounded(self, most: int = REMEMBERED_WORDS) -> None:
        if len(self) > most or not self:
            self.clear()
            self[b"."] = 0

    def of(self, words: list[bytes]) -> np.ndarray:
        self.bounded()
        return np.fromiter(map(self.__getitem__, words), U, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * _ODD[DEPTH]
    return x ^ (x >> U(29))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * _ODD[0] + second * _ODD[1])


class Bits:
    """A bit table of hashes: `has` is true for all of them, and for few others while it is large enough."""

    def __init__(self, table: np.ndarray):
        self.table, self.shift = table, U(64 - (len(table) * 64).bit_length() + 1)

    def has(self, h: np.ndarray) -> np.ndarray:
        slot = h >> self.shift
        return ((self.table[slot >> U(6)] >> (slot & U(63))) & U(1)).astype(bool)


def bit_table(hashes: DataFrame, n: int) -> Bits:
    """The bit table of the column `h`, for about `n` hashes: 32 bits for each, at least 2^16 and at most MOST_BITS in all."""
    power = min(max((32 * n).bit_length(), 16), MOST_BITS.bit_length() - 1)
    slot = F.shiftrightunsigned("h", 64 - power)
    words = hashes.select(F.shiftright(slot, 6).alias("at"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - power}) & 63 as int))").alias("bit"))
    rows = words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas()  # at most MOST_BITS / 64 rows
    table = np.zeros(1 << (power - 6), np.int64)
    table[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return Bits(table.view(U))


def frequent_prefixes(words: np.ndarray, weight: np.ndarray, least: int, shallow: int = 2) -> list[tuple[int, int, int]]:
    """(row, depth, count) for every prefix of `shallow` or more words whose rows weigh at least `least`.

    `words` has a row for each suffix, 0 after its end. A multikey three-way quicksort of row pointers: a partition is split around a word at
    its depth; the equal part goes on to the next word, and its weight is the count of the prefix. Parts that weigh less than
    `least` are abandoned. Small parts are left, and put in order together at the end.
    """
    depth = words.shape[1]
    out: list[tuple[int, int, int]] = []
    small: list[np.ndarray] = []
    known: list[int] = []  # the depth at which each small part was left
    stack = [(np.arange(len(words)), 0)]
    while stack:
        rows, d = stack.pop()
        if not len(rows) or weight[rows].sum() < least:
            continue
        if len(rows) <= SMALL:
            small.append(rows)
            known.append(d)
            continue
        key = words[rows, d]
        pivot = np.partition(key[:: max(1, len(key) // 9)][:9], 4)[4]
        equal = rows[key == pivot]
        stack.append((rows[key < pivot], d))
        stack.append((rows[key > pivot], d))
        if pivot:
            count = int(weight[equal].sum())
            if count >= least:
                if d + 1 >= shallow:
                    out.append((int(equal[0]), d + 1, count))
                if d + 1 < depth:
                    stack.append((equal, d + 1))
    if small:
        rows, left = np.concatenate(small), np.repeat(known, [len(s) for s in small])
        order = np.lexsort(words[rows].T[::-1])
        rows, left = rows[order], left[order]
        own = words[rows]
        new = np.ones(len(rows), bool)
        differs = np.zeros(len(rows) - 1, bool)
        for d in range(1, depth + 1):
            differs |= own[1:, d - 1] != own[:-1, d - 1]
            new[1:] = differs
            starts = np.flatnonzero(new)
            counts = np.add.reduceat(weight[rows], starts)
            good = (counts >= least) & (own[starts, d - 1] != 0) & (left[starts] < d) & (d >= shallow)
            out += [(int(r), d, int(c)) for r, c in zip(rows[starts[good]], counts[good], strict=True)]
    return out


def suffixes(codes: np.ndarray, linked: np.ndarray, depth: int) -> np.ndarray:
    """A row of `depth` words for every place that is linked with the next, 0 from the first place on that is not linked."""
    at = np.flatnonzero(linked)
    padded, joined = np.concatenate([codes, np.zeros(depth, U)]), np.concatenate([linked, np.zeros(depth, bool)])
    out = np.zeros((len(at), depth), U)
    out[:, 0] = padded[at]
    alive = np.ones(len(at), bool)
    for d in range(1, depth):
        alive &= joined[at + d - 1]
        out[alive, d] = padded[at[alive] + d]
    return out


def combined(rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal rows as one with the sum of their weights, and a hash of each."""
    h = mixed((rows * _ODD[: rows.shape[1]]).sum(1, dtype=U))
    order = np.argsort(h, kind="stable")
    rows, h = rows[order], h[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(1)
    starts = np.flatnonzero(new)
    total = np.add.reduceat(weight[order], starts) if len(starts) else weight[:0]
    return rows[starts], total, h[starts]


def blocks(bucket: np.ndarray, hot: np.ndarray, rows: np.ndarray, weight: np.ndarray) -> pd.DataFrame:
    """A row of bytes for each bucket, and for hot groups in it."""
    order = np.lexsort((hot, bucket))
    bucket, hot, rows, weight = bucket[order], hot[order], rows[order], weight[order]
    cut = np.flatnonzero((np.diff(bucket.astype(np.int64)) != 0) | (np.diff(hot.astype(np.int8)) != 0)) + 1
    starts, ends = [0, *cut.tolist()], [*cut.tolist(), len(bucket)]
    if not len(bucket):
        starts, ends = [], []
    return pd.DataFrame(
        {
            "bucket": bucket[starts].astype(np.int64),
            "hot": hot[starts],
            "suffixes": [rows[a:b].tobytes() for a, b in zip(starts, ends, strict=True)],
            "weights": [weight[a:b].astype(np.int64).tobytes() for a, b in zip(starts, ends, strict=True)],
        }
    )


def unpacked(block: pd.DataFrame, depth: int) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(b"".join(block["suffixes"]), U).reshape(-1, depth)
    return rows, np.frombuffer(b"".join(block["weights"]), np.int64)


def count_words(docs: DataFrame, least: int = LEAST, seed: int = 0) -> DataFrame:
    """(h, lang, word, n) of the words with n >= `least`, and for each language a row without a word and n of all its words.

    `docs` has text and lang. The hash `h` tells all these words apart; if two words had one, this raises an error that asks for another seed.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        held: dict[str, Counter] = {}

        def rows() -> pd.DataFrame:
            out = []
            for lang, counter in held.items():
                del counter[b"."]
                known = WordHashes(lang, seed)
                out += [(known.digest(w, known.seed) or 1, lang, w, n) for w, n in counter.items()]
                out.append((xxhash.xxh3_64_intdigest(lang.encode(), seed + 1), lang, None, counter.total()))
            held.clear()
            table = pd.DataFrame(out, columns=["h", "lang", "word", "n"])
            return table.assign(h=table["h"].astype(U).astype(np.int64), n=table["n"].astype(np.int64))

        for lang, words in chunks(batches):
            held.setdefault(lang, Counter()).update(words)
            if sum(map(len, held.values())) > REMEMBERED_WORDS * 2:
                yield rows()
        yield rows()

    counted = in_tasks(docs.select("text", "lang"), count, WORD_ROWS).groupBy("h").agg(
        F.sum("n").alias("n"), F.min(F.struct("lang", "word")).alias("least"), F.max(F.struct("lang", "word")).alias("most")
    )
    kept = counted.where((F.col("n") >= least) | F.col("least.word").isNull())
    once = F.when(F.col("least").eqNullSafe(F.col("most")), F.col("n")).otherwise(
        F.raise_error("two words have one hash: choose another seed").cast("long")
    )
    return kept.select("h", F.col("least.lang").alias("lang"), F.col("least.word").alias("word"), once.alias("n"))


def count_phrases(docs: DataFrame, words: DataFrame, least: int = LEAST, depth: int = DEPTH, seed: int = 0, hot: int = HOT) -> DataFrame:
    """(codes, n): the phrases of 2 to `depth` words that occur at least `least` times, as hashes of their words."""
    context = docs.sparkSession.sparkContext
    sizes = words.agg(
        F.sum(F.when(F.col("word").isNull(), F.col("n"))).alias("all"), F.count("word").alias("frequent")
    ).first()
    buckets = max(64, -(-int(sizes["all"] or 0) // BUCKET))
    known_words = context.broadcast(bit_table(words.where("word IS NOT NULL"), sizes["frequent"]))
    texts = docs.select("text", "lang")

    def codes(batches: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
        """Hashes of words, 0 for those that are not frequent and for ends of pieces."""
        hashes: dict[str, WordHashes] = {}
        for lang, spelled_words in chunks(batches):
            if lang not in hashes and len(hashes) >= 8:
                hashes.clear()
            h = hashes.setdefault(lang, WordHashes(lang, seed)).of(spelled_words)
            yield np.where(known_words.value.has(h), h, U(0))

    def gathered(parts: Iterator[np.ndarray], most: int) -> Iterator[np.ndarray]:
        held, n = [], 0
        for part in parts:
            held.append(part)
            n += len(part)
            if n >= most:
                yield np.concatenate(held)
                held, n = [], 0
        if n:
            yield np.concatenate(held)

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def own() -> Iterator[np.ndarray]:
            for c in codes(batches):
                at = np.flatnonzero((c[:-1] != 0) & (c[1:] != 0))
                yield pair_hashes(c[at], c[at + 1])

        for found in gathered(own(), 1 << 21):
            h, n = np.unique(found, return_counts=True)
            yield blocks(h % U(buckets), np.zeros(len(h), bool), h[:, None], n)

    def pair_counts(block: pd.DataFrame) -> pd.DataFrame:
        rows, n = unpacked(block, 1)
        rows, n, _ = combined(rows, n)
        good = n >= least
        return pd.DataFrame({"h": rows[good, 0].astype(np.int64), "n": n[good]})

    routed = in_tasks(texts, pairs, BLOCK_ROWS)
    frequent = materialize(routed.groupBy("bucket").applyInPandas(pair_counts, "h long, n long"), "leading-pairs")
    known_pairs = context.broadcast(bit_table(frequent, frequent.count()))
    hot_pairs = context.broadcast(bit_table(frequent.where(F.col("n") > hot), frequent.where(F.col("n") > hot).count()))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def own() -> Iterator[np.ndarray]:
            for c in codes(batches):
                linked = np.zeros(len(c), bool)
                at = np.flatnonzero((c[:-1] != 0) & (c[1:] != 0))
                linked[at[known_pairs.value.has(pair_hashes(c[at], c[at + 1]))]] = True
                yield suffixes(c, linked, depth)

        for found in gathered(own(), 1 << 19):
            rows, n, h = combined(found, np.ones(len(found), np.int64))
            leading = pair_hashes(rows[:, 0], rows[:, 1])
            is_hot = hot_pairs.value.has(leading)
            yield blocks(np.where(is_hot, h, leading) % U(buckets), is_hot, rows, n)

    def sort(block: pd.DataFrame) -> pd.DataFrame:
        out = []
        for is_hot, own in block.groupby("hot"):
            rows, n = unpacked(own, depth)
            rows, n, _ = combined(rows, n)
            found = frequent_prefixes(rows, n, 1 if is_hot else least)
            out += [(rows[r, :d].astype(np.int64), c) for r, d, c in found]
        return pd.DataFrame(out, columns=["codes", "n"])

    sorted_rows = in_tasks(texts, route, BLOCK_ROWS).groupBy("bucket").applyInPandas(sort, "codes array<long>, n long")
    return sorted_rows.groupBy("codes").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def mine_phrases(
    docs: DataFrame, least: int = LEAST, depth: int = DEPTH, top: int | None = TOP, seed: int = 0, hot: int = HOT
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to `depth` words of each language of `docs` (text, lang).

    Texts are lower-cased (A-Z), cut into pieces at `.,;:!?` and line ends, and these into words at spaces and tabs. n counts all words of the language, f all
    occurrences of a phrase within pieces. A phrase with a = f >= `least` is cut after its first k words into parts with l and r occurrences; its score
    floor(1000 a n / (l r)) is that of the lowest cut, the shortest first part where cuts tie. A phrase is left out if a longer one of
    at most `depth` words contains it and occurs as often. The first `top` of each language (all, if None) by score, a (both descending) and phrase in
    byte order.

    A null text is empty, a null language `und`; rows that repeat count each; an empty table gives no rows; other
    columns are not read; texts are used whole, of any length.
    """
    words = materialize(count_words(docs, least, seed), "words")
    phrases = materialize(count_phrases(docs, words, least, depth, seed, hot), "phrases")
    single = words.where("word IS NOT NULL").select(F.array("h").alias("codes"), "n")
    counts = phrases.unionByName(single)
    n_words = F.size("codes")
    # Every phrase that a longer one contains is also contained in one that is longer by one word and at least as frequent.
    inner = phrases.where(n_words > 2).select(
        F.explode(F.array(F.slice("codes", 1, n_words - 1), F.slice("codes", F.lit(2), n_words - 1))).alias("codes"),
        F.col("n").alias("a"),
    )
    open_ = phrases.withColumnRenamed("n", "a").join(inner, ["codes", "a"], "left_anti")
    totals = words.where("word IS NULL").select("lang", F.col("n").alias("all"))
    langs = words.where("word IS NOT NULL").select(F.col("h").alias("head"), "lang").join(totals, "lang")
    cuts = (
        open_.withColumn("k", F.explode(F.sequence(F.lit(1), n_words - 1)))
        .withColumn("first", F.slice("codes", F.lit(1), F.col("k")))
        .withColumn("rest", F.slice("codes", F.col("k") + 1, n_words - F.col("k")))
        .join(counts.select(F.col("codes").alias("first"), F.col("n").alias("l")), "first")
        .join(counts.select(F.col("codes").alias("rest"), F.col("n").alias("r")), "rest")
        .withColumn("head", F.element_at("codes", 1))
        .join(langs, "head")
    )
    exact = "(cast(a as decimal(17,0)) * cast(all as decimal(17,0)) * 1000) div (cast(l as decimal(19,0)) * cast(r as decimal(18,0)))"
    scored = cuts.withColumn("score", F.expr(exact).cast("long"))
    lowest = scored.groupBy("codes").agg(F.min(F.struct("score", "k", "l", "r", "a", "all", "lang")).alias("x")).select("codes", "x.*")
    spelling = lowest.select("codes", F.posexplode("codes").alias("at", "h")).join(words.select("h", "word"), "h")
    ordered = F.array_sort(F.collect_list(F.struct("at", F.col("word").cast("string").alias("word"))))
    named = spelling.groupBy("codes").agg(F.array_join(F.transform(ordered, lambda x: x["word"]), " ").alias("phrase"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = lowest.join(named, "codes").withColumn("rank", F.row_number().over(best))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("all").alias("n"), "score")
