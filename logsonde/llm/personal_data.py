"""Personal data: fixed forms, and a semi-Markov conditional random field that finds what the forms miss.

The field works on regions, runs of chunks (between white space) that hold a digit or an at sign. A segment is up to
SEGMENT_CHUNKS chunks of a region; its features look at the whole segment: shape, digits, checksums, the word before it. Each
type scores the features with weights of its own, a chunk outside any segment scores 0, and dynamic programming over the region
chooses boundaries and types together. The weights are learned from the base spans of a bounded sample, by structured
perceptron steps on the same dynamic programme, averaged. Base spans always stay; the field only adds.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from logsonde.llm.common import map_texts, materialize
from logsonde.llm.spans import Cover, Span, found_columns, found_type

KINDS = ("email", "ip", "card", "phone")

#: Documents (about) whose regions the field is trained on, drawn by a hash of doc_id.
TRAINING_ROWS = 6_000
TRAINING_REGIONS = 20_000
REGION_LETTERS = 500
SEGMENT_CHUNKS = 6
MARGIN = 3.0  # how far a segment must score above the best way without it to be added

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANCHOR = re.compile(r"[0-9@]")
CHUNK = re.compile(r"\S+")
EDGE = " \t\n.,;:!?|\"'<>[]{}*#$%&"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Around each at sign: the local part reaches left to the last match, the domain right."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield ("email", start, m.end())
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """Emails, addresses with parts up to 255, card numbers of 14 to 19 digits that pass the checksum, phones of 10 to 15 digits."""
    spans: list[Span] = list(emails(text)) if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                spans.append(("phone", *m.span()))
    return spans


def regions(text: str) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """The word before, and the chunks (start, end, bare of edge signs) of each run of chunks with a digit or at sign."""
    at = 0
    while m := ANCHOR.search(text, at):
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        before = text[max(0, start - 40) : start].split()
        chunks = []
        for c in CHUNK.finditer(text, start):
            if not ANCHOR.search(c[0]):
                break
            chunks.append(_bare(text, *c.span()))
            at = c.end()
        at = max(at, m.end())
        yield (before[-1].lower().strip(EDGE) if before else "", chunks)


def _bare(text: str, a: int, b: int) -> tuple[int, int]:
    while a < b and text[a] in EDGE:
        a += 1
    while b > a and text[b - 1] in EDGE:
        b -= 1
    return a, b


def features(s: str, before: str, n: int) -> list[str]:
    """Features of a whole segment."""
    digits = re.sub("[^0-9]", "", s)
    shape = re.sub("[0-9]+", lambda m: "9" * min(len(m[0]), 7), re.sub("[A-Za-z]+", "a", s))
    signs = "".join(sorted(set(re.sub("[A-Za-z0-9]", "", s))))
    out = ["", f"shape {shape[:40]}", f"digits {min(len(digits), 20)}", f"signs {signs[:12]}", f"chunks {n}", f"before {before[:20]}"]
    if "@" in s:
        out.append("domain" if DOMAIN.fullmatch(s.rpartition("@")[2]) and s.count("@") == 1 and s[0] != "@" else "at only")
    if 14 <= len(digits) <= 19:
        out.append(f"luhn {luhn(digits)}")
    if s.count(".") == 3 and re.fullmatch(r"[0-9.]+", s):
        out.append(f"octets {all(p and len(p) < 4 and int(p) < 256 for p in s.split('.'))}")
    if s[:1] == "+":
        out.append("plus")
    return out


Weights = Mapping[tuple[str, str], float]


def decode(text: str, before: str, chunks: list[tuple[int, int]], weights: Weights) -> list[tuple[Span, int, int, float, list[str]]]:
    """The best segments of a region: span, first chunk, chunks, score over the best way without it, features."""
    best: list[float] = [0.0]
    back: list[tuple | None] = [None]
    for j in range(1, len(chunks) + 1):
        top, how = best[j - 1], None
        for n in range(1, min(SEGMENT_CHUNKS, j) + 1):
            a, b = chunks[j - n][0], chunks[j - 1][1]
            if a >= b:
                continue
            own = features(text[a:b], before if j == n else "", n)
            for kind in KINDS:
                score = best[j - n] + sum(weights.get((kind, f), 0.0) for f in own)
                if score > top:
                    top, how = score, ((kind, a, b), j - n, n, score - best[j - 1], own)
        best.append(top)
        back.append(how)
    out, j = [], len(chunks)
    while j:
        how = back[j]
        if how is None:
            j -= 1
        else:
            out.append(how)
            j = how[1]
    return out[::-1]


def train(examples: list[tuple[str, list[Span]]], passes: int = 5) -> dict[tuple[str, str], float]:
    """Averaged perceptron weights from texts and their base spans."""
    weights: dict[tuple[str, str], float] = defaultdict(float)
    total: dict[tuple[str, str], float] = defaultdict(float)
    cases = []
    for text, spans in examples:
        for before, chunks in regions(text):
            gold = {}
            for kind, a, b in spans:
                first = [i for i, c in enumerate(chunks) if c[0] == a]
                last = [i for i, c in enumerate(chunks) if c[1] == b]
                if first and last and 0 <= last[0] - first[0] < SEGMENT_CHUNKS:
                    n = last[0] - first[0] + 1
                    gold[(kind, a, b)] = features(text[a:b], before if first[0] == 0 else "", n)
            cases.append((text, before, chunks, gold))
    step = 1
    for _ in range(passes):
        for text, before, chunks, gold in cases:
            got = {s: f for s, _, _, _, f in decode(text, before, chunks, weights)}
            for sign, these, those in ((1.0, gold, got), (-1.0, got, gold)):
                for span, own in these.items():
                    if span not in those:
                        for f in own:
                            weights[span[0], f] += sign
                            total[span[0], f] += sign * step
            step += 1
    return {k: w - total[k] / step for k, w in weights.items() if w or total[k]}


def _cut(chunks: list[tuple[int, int]], letters: int = REGION_LETTERS) -> Iterator[list[tuple[int, int]]]:
    """The chunks of a region in runs of at most so many letters, cut between chunks; a longer chunk is left out."""
    held: list[tuple[int, int]] = []
    for chunk in chunks:
        if held and chunk[1] - held[0][0] > letters:
            yield held
            held = []
        if chunk[1] - chunk[0] <= letters:
            held.append(chunk)
    if held:
        yield held


def fit_field(docs: DataFrame) -> dict[tuple[str, str], float]:
    """The field's weights: an averaged perceptron of whole segmentations, trained on the base spans of a sample of regions.

    Two bounds, both drawn by hashes: the regions of about TRAINING_ROWS documents that hold a digit or an at sign, and of these about
    TRAINING_REGIONS different ones, cut between chunks to at most REGION_LETTERS letters, go to the driver. The scan itself works on whole texts.
    """
    schema = T.StructType([T.StructField("regions", T.ArrayType(T.StringType()))])

    def task():
        def cut(texts: list[str | None]) -> list[list]:
            return [[[t[max(0, c[0][0] - 60) : c[-1][1] + 3] for _, r in regions(t or "") for c in _cut(r)] for t in texts]]

        return cut

    able = docs.select("doc_id", "text").where(F.col("text").rlike("[0-9@]"))
    rows = max(1, round(1_000_000 * min(1.0, TRAINING_ROWS / max(1, able.count()))))
    sample = able.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < rows)
    found = map_texts(sample, task, schema, []).select(F.explode("regions").alias("region"))
    found = materialize(found.withColumn("h", F.pmod(F.xxhash64("region"), F.lit(1_000_000))), "regions")
    share = max(1, round(1_000_000 * min(1.0, TRAINING_REGIONS / max(1, found.count()))))
    pieces = [r["region"] for r in found.where(F.col("h") < share).select("region").distinct().orderBy("region").collect()]
    return train([(p, base_spans(p)) for p in pieces])


def find_personal_data(docs: DataFrame, weights: Weights, margin: float = MARGIN) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of `docs` (doc_id, text).

    The counts and the digest are of the base spans; `spans` also lists the field's, where they overlap no base span, as
    "kind:start:end" in code points by start, then kind. A null text is empty; rows that repeat and null ids stay; an empty table
    gives no rows; other columns are not read. Texts of any length are scanned whole.
    """
    held = docs.sparkSession.sparkContext.broadcast(dict(weights))  # as large as the sample allows

    def task():
        own = held.value

        def scan(texts: list[str | None]) -> list[list]:
            found = []
            for text in texts:
                text = text or ""
                base = base_spans(text)
                cover = Cover(base)
                more = []
                for before, chunks in regions(text):
                    for span, _, _, gain, _ in decode(text, before, chunks, own):
                        if gain >= margin and not cover.overlaps(span):
                            more.append(span)
                found.append((base, more))
            return found_columns(found, KINDS, KINDS)

        return scan

    return map_texts(docs.select("doc_id", "text"), task, found_type(KINDS), ["doc_id"])
