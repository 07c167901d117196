"""Quality classifier by weak labels: heuristic labellers vote, expectation-maximisation weighs them, a linear scorer learns.

Two things make a document bad, each with labellers of its own that vote good, bad or not at all:
* junk: shouting, signs, few common words, words and lines that repeat, the quality label where there is one;
* toxic: insults, word beginnings that labelled toxic documents have and others lack, the toxic label where there is one.
Every document votes. Only how often each pattern of votes occurs goes to the driver (at most 3 ** labellers numbers);
there expectation-maximisation estimates each labeller's accuracy and, for each pattern, the probability of being bad.
These probabilities label a bounded sample of documents, on which a hashed linear scorer is trained; it decides on all.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from logsonde.llm.common import in_tasks, map_texts, materialize, words

#: Bounds of the two samples that are fitted on: labelled rows for word beginnings, documents for the scorer.
LABELLED_ROWS = 20_000
TRAINING_ROWS = 12_000

#: Word beginnings kept at most, the most frequent ones: the size of a model, not of the data.
STEMS = 4_000
STEM_BYTES = (4, 5, 7, 9, 11)

FEATURE_BITS = 17
SCALE = 20.0  # the sum of a text's feature values

MARKS = re.compile(r"[^\w\s.,]{1,3}(?!\S)")
CAPITALS = re.compile(r"[A-ZÀ-Þ]{3,}")

#: Common words of English, German, French and Spanish, and plain insults; fixed values.
COMMON = frozenset(
    "the of and a in to is it that for on was with as be by at this are from or an have not "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat "
    "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se "
    "el los y del las por con para una su al lo como más pero sus".encode().split()
)
INSULTS = frozenset("idiot moron stupid scum trash loser pathetic worthless disgusting clown".encode().split())

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"()-?")

JUNK_LABELLERS = ("shouting", "signs", "common_words", "repeated_words", "repeated_lines", "quality_label")
TOXIC_LABELLERS = ("insults", "stems", "stem_share", "toxic_label")


def junk_votes(text: str, ws: list[bytes]) -> list[int]:
    """Votes of the first five: 1 bad, -1 good, 0 none. A text without words has no votes but on its signs."""
    raw = text.encode("utf-8", "surrogatepass")
    upper, lower = (len(raw) - len(raw.translate(None, c)) for c in (UPPER, LOWER))
    signs = (len(raw) - len(raw.translate(None, SIGNS))) / max(1, len(raw))
    shout = upper / max(1, upper + lower)
    votes = [_vote(shout, 0.15, 0.4) if upper + lower >= 20 else 0, _vote(signs, 0.01, 0.05)]
    n = len(ws)
    if n < 20:
        return [*votes, 0, 0, 0]
    common = sum(map(COMMON.__contains__, ws)) / n
    fresh = sum(len(set(ws[i : i + 100])) for i in range(0, n, 100)) / n
    lines = [x for x in text.split("\n") if x.strip()]
    again = 1 - len(set(lines)) / max(1, len(lines))
    return [*votes, _vote(-common, -0.10, -0.04), _vote(1 - fresh, 0.4, 0.6), _vote(again, 0.1, 0.3) if len(lines) > 2 else 0]


def toxic_votes(ws: list[bytes], stems: frozenset[bytes]) -> list[int]:
    found = stemmed = 0
    for w in set(ws):
        found += w in INSULTS
        stemmed += any(w[:k] in stems for k in STEM_BYTES)
    share = stemmed / max(1, min(len(ws), 200))
    return [1 if found else -1, _vote(stemmed, 0, 2), _vote(share, 0.004, 0.02)]


def _vote(x: float, good: float, bad: float) -> int:
    return 1 if x >= bad else -1 if x <= good else 0


def expectation_maximisation(patterns: np.ndarray, times: np.ndarray, rounds: int = 200) -> np.ndarray:
    """P(bad) of each pattern (rows of votes -1, 0, 1, `times` each), by the two-class model of independent labellers.

    A 0 is no vote and says nothing. It starts from the mean of the votes, and with 2 votes counted where vote and class agree
    and half a one where they don't.
    """
    given = np.abs(patterns).sum(1)
    bad = np.clip(0.5 + 0.45 * patterns.sum(1) / np.maximum(1, given), 0.05, 0.95)
    hot = np.stack([patterns == v for v in (-1, 1)], axis=2).astype(float)  # pattern, labeller, vote
    start = np.array([[2.0, 0.5], [0.5, 2.0]])  # good, bad
    for _ in range(rounds):
        weight = np.stack([(1 - bad) * times, bad * times])
        seen = np.einsum("cp,plv->clv", weight, hot) + start[:, None, :]
        rate = np.log(seen / seen.sum(2, keepdims=True))
        prior = np.log((weight.sum(1) + 1) / (weight.sum() + 2))
        score = prior[:, None] + np.einsum("clv,plv->cp", rate, hot)
        now = 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))
        if np.abs(now - bad).max() < 1e-9:
            break
        bad = now
    return bad


def features(text: str, ws: list[bytes]) -> list[int]:
    """Numbers of the features of a text, repeated as they occur: words, their beginnings, ends of chunks, capitals."""
    mask, crc = (1 << FEATURE_BITS) - 1, zlib.crc32
    out = [crc(w) & mask for w in ws]
    out += [crc(w[:5] + b"*") & mask for w in ws]
    out += [crc(b"\x00" + m.encode("utf-8", "surrogatepass")) & mask for m in MARKS.findall(text)]
    out += [crc(b"\x01") & mask] * (len(CAPITALS.findall(text)))
    return out


@dataclass(frozen=True)
class QualityModel:
    """What is fitted: the word beginnings, the posterior of each pattern, and the scorer's weights."""

    stems: frozenset[bytes]
    junk: dict[tuple[int, ...], float]
    toxic: dict[tuple[int, ...], float]
    weights: np.ndarray
    intercept: float

    def score(self, text: str | None) -> float:
        """P(bad) by the scorer; a null or empty text has that of no features."""
        numbers = features(text or "", words(text))
        total = float(self.weights[numbers].sum()) * SCALE / len(numbers) if numbers else 0.0
        return float(1 / (1 + np.exp(-np.clip(self.intercept + total, -40, 40))))


VOTED = T.StructType(
    [T.StructField("junk", T.ArrayType(T.IntegerType())), T.StructField("toxic", T.ArrayType(T.IntegerType()))]
)


def fit_quality(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """The model for `docs` (doc_id, text), with `labels` (doc_id, quality 0/1, toxic 0/1; any may be null) as more labellers.

    All documents vote; the samples of LABELLED_ROWS and TRAINING_ROWS are drawn by a hash of doc_id. Labels that contradict each other
    count as their mean, rounded up to good. Without labels, or without documents, the heuristics alone decide.
    """
    spark = docs.sparkSession
    gold = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.min("toxic").alias("toxic"))
    stems = _stems(docs, gold)
    held = spark.sparkContext.broadcast(stems)

    def task():
        own = held.value

        def vote(texts: list[str | None]) -> list[list]:
            split = [(t or "", words(t)) for t in texts]
            return [[junk_votes(t, ws) for t, ws in split], [toxic_votes(ws, own) for _, ws in split]]

        return vote

    said_of = gold.withColumnsRenamed({"quality": "said_quality", "toxic": "said_toxic"})
    votes = map_texts(docs.select("doc_id", "text"), task, VOTED, ["doc_id"]).join(said_of, "doc_id", "left")
    said = lambda c, bad: F.when(F.col(c).isNull(), 0).when(F.col(c) == bad, 1).otherwise(-1)
    votes = votes.select(
        "doc_id",
        F.concat("junk", F.array(said("said_quality", 0))).alias("junk"),
        F.concat("toxic", F.array(said("said_toxic", 1))).alias("toxic"),
    )
    votes = materialize(votes, "votes")
    posterior = []
    for kind in ("junk", "toxic"):
        counted = votes.groupBy(kind).agg(F.count("*").alias("n")).collect()
        patterns = np.array([r[kind] for r in counted], int)
        bad = expectation_maximisation(patterns, np.array([r["n"] for r in counted], float)) if counted else []
        posterior.append({tuple(p.tolist()): float(b) for p, b in zip(patterns, bad, strict=True)} if counted else {})
    weights, intercept = _train(docs, votes, *posterior)
    return QualityModel(stems, *posterior, weights, intercept)


def _share(rows: int, bound: int) -> Column:
    """Rows whose hash of doc_id is low enough for about `bound` of so many rows."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < max(1, round(1_000_000 * min(1.0, bound / max(1, rows))))


def _stems(docs: DataFrame, gold: DataFrame) -> frozenset[bytes]:
    """Word beginnings in at least 4 labelled toxic documents and 30 times as frequent there as in the others."""
    rated = gold.where("toxic IS NOT NULL")
    rated = materialize(rated.where(_share(rated.count(), LABELLED_ROWS)).select("doc_id", "toxic"), "rated")
    n = {r["toxic"]: r["n"] for r in rated.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), sum(v for k, v in n.items() if k != 1)
    if not toxic or not clean:
        return frozenset()
    labelled = docs.select("doc_id", "text").join(F.broadcast(rated), "doc_id")  # about LABELLED_ROWS rows

    def beginnings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, mark in zip(batch["text"], batch["toxic"], strict=True):
                found = {w[:k] for w in set(words(text)) for k in STEM_BYTES if len(w) >= k}
                yield pd.DataFrame({"stem": list(found), "toxic": int(mark == 1)})

    counts = in_tasks(labelled.select("text", "toxic"), beginnings, "stem binary, toxic int").groupBy("stem").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")
    )
    telling = counts.where((F.col("bad") >= 4) & (F.col("bad") / toxic >= 30 * (F.col("good") + 0.5) / clean))
    return frozenset(bytes(r["stem"]) for r in telling.orderBy(F.desc("bad"), "stem").limit(STEMS).collect())


def _train(docs: DataFrame, votes: DataFrame, junk: dict, toxic: dict) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression on the posterior labels of about TRAINING_ROWS documents."""
    size = 1 << FEATURE_BITS
    rows = votes.where("doc_id IS NOT NULL")
    sample = rows.where(_share(rows.count(), TRAINING_ROWS)).dropDuplicates(["doc_id"])
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def example(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, a, b in zip(batch["text"], batch["junk"], batch["toxic"], strict=True):
                bad = 1 - (1 - junk[tuple(a.tolist())]) * (1 - toxic[tuple(b.tolist())])
                numbers = np.array(features(text or "", words(text)), np.int32).tobytes()
                out.append((numbers, float(bad >= 0.5), abs(2 * bad - 1)))
            done = pd.DataFrame(out, columns=["numbers", "label", "weight"])
            done.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield done

    made = in_tasks(joined, example, "doc_id long, numbers binary, label double, weight double")
    rows = made.where("weight > 0").toPandas().sort_values("doc_id", kind="stable")  # about TRAINING_ROWS rows
    numbers = [np.unique(np.frombuffer(x, np.int32), return_counts=True) for x in rows["numbers"]]
    return logistic(numbers, rows["label"].to_numpy(), rows["weight"].to_numpy(), size)


def logistic(
    rows: Sequence[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weights: np.ndarray, size: int, passes: int = 6, rate: float = 0.5
) -> tuple[np.ndarray, float]:
    """Logistic regression by adaptive gradient steps over (numbers, times) rows, both classes with the same total weight.

    The rows are taken in an order of a fixed seed, so equal samples give equal weights.
    """
    w, seen = np.zeros(size), np.full(size, 1e-6)
    bias, bias_seen = 0.0, 1e-6
    total = np.array([weights[labels == c].sum() for c in (0, 1)])
    if not total.all():
        return w, -10.0 if not total[1] else 10.0
    weights = weights * (total.sum() / 2 / total)[labels.astype(int)].clip(max=10)
    rng = np.random.default_rng(5)
    for _ in range(passes):
        for i in rng.permutation(len(rows)):
            at, times = rows[i]
            x = times * (SCALE / max(1, times.sum()))
            p = 1 / (1 + np.exp(-np.clip(bias + w[at] @ x, -40, 40)))
            error = (p - labels[i]) * weights[i]
            step = error * x
            seen[at] += step * step
            w[at] -= rate * step / np.sqrt(seen[at])
            bias_seen += error * error
            bias -= rate * error / np.sqrt(bias_seen)
    return w, float(bias)


SCORED = T.StructType([T.StructField("__bad_score", T.DoubleType())])


def _scores(docs: DataFrame, model: QualityModel, keep: Sequence[str]) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(model)

    def task():
        own = held.value
        return lambda texts: [[own.score(t) for t in texts]]

    return map_texts(docs, task, SCORED, list(keep))


def rate_quality(docs: DataFrame, model: QualityModel, bar: float = 0.5) -> DataFrame:
    """(doc_id, bad_score, kept) for every row of `docs`; kept where the score is below `bar`.

    A null or empty text has no features and the score of the intercept alone. Repeated rows stay; an empty table gives no
    rows; other columns are not read; long texts are scored whole.
    """
    scored = _scores(docs.select("doc_id", "text"), model, ["doc_id"])
    return scored.select("doc_id", F.col("__bad_score").alias("bad_score"), (F.col("__bad_score") < bar).alias("kept"))


def drop_bad(docs: DataFrame, model: QualityModel, bar: float = 0.5) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns as they are."""
    scored = _scores(docs, model, docs.columns)
    return scored.where(F.col("__bad_score") < bar).select(*[F.col(f"`{c}`") for c in docs.columns])
