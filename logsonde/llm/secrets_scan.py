"""Secret scans: fixed forms of credentials, and random strings told by how few characters a token of theirs has.

A byte-pair vocabulary spells frequent letter sequences with long tokens. A string that needs a token for every
two characters or so is not made of words. Digests of the usual lengths, UUIDs and identifiers (letters only, or words joined by
signs) are left out first, for they are no secrets or not random.
"""

from __future__ import annotations

import re
from collections.abc import Collection
from functools import lru_cache

from pyspark.sql import DataFrame, functions as F, types as T

from logsonde.llm.common import map_texts
from logsonde.llm.spans import Cover, Span, found_columns, found_type, replaced

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")

#: Characters per token below which a string of mixed characters counts as random, and its least length.
RATIO, LEAST = 2.1, 20


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


NAMES = "|".join([*map(_either_case, ("password", "passwd", "secret", "token")), _either_case("api") + "_?" + _either_case("key")])
ASSIGN = re.compile(rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("(?<![0-9a-f])[0-9a-f]{24,}")
CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST},}}")
PART = re.compile("[^=/]+")
DIGEST = re.compile("(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})")
UUID = re.compile("[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}")
IDENTIFIER = re.compile("[+/_=-]*[A-Za-z]+(?:[+/_=-]+(?:[A-Za-z]+|[0-9]{1,4}))*[0-9]{0,4}[+/_=-]*")


@lru_cache(maxsize=2)
def ranks(path: str):
    """The tiktoken encoding of a rank file; one for each worker."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def base_spans(text: str) -> list[Span]:
    """Assignments (value of 6 characters or more), access keys (20 or more) and hex runs (24 or more)."""
    spans: list[Span] = []
    if ":" in text or "=" in text:
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return spans + [("hex", *m.span()) for m in HEX.finditer(text)]


def _random(s: str, encoding, known: Collection[str]) -> bool:
    """Whether a string mixes letters and digits, is nothing known, and gives few characters a token."""
    if len(s) < LEAST or not any(map(str.isdigit, s)) or not any(map(str.isalpha, s)):
        return False
    if s in known or DIGEST.fullmatch(s) or UUID.fullmatch(s) or IDENTIFIER.fullmatch(s):
        return False
    return len(s) / len(encoding.encode_ordinary(s)) < RATIO


def random_spans(text: str, base: list[Span], encoding, known: Collection[str] = ()) -> list[Span]:
    """Strings of low token efficiency that overlap no base span and are no digests, UUIDs, identifiers or `known`.

    A name or path before a value would lift its ratio, so the parts between `=` and `/` are rated by themselves first; the whole string
    only where none of them is random.
    """
    out: list[Span] = []
    cover = Cover(base)
    for m in CANDIDATE.finditer(text):
        if m[0] in known:
            continue
        parts = [("random", m.start() + p.start(), m.start() + p.end()) for p in PART.finditer(m[0]) if len(p[0]) < len(m[0])]
        found = [s for s in parts if _random(text[s[1] : s[2]], encoding, known)]
        if not found and _random(m[0], encoding, known):
            found = [("random", *m.span())]
        out += [s for s in found if not cover.overlaps(s)]
    return out


def scan_secrets(docs: DataFrame, vocabulary: str, known: Collection[str] = ()) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for every row of `docs` (doc_id, text).

    `spans` lists "kind:start:end" in code points by start, then kind. A null text is empty; an empty one has no spans; rows that
    repeat stay; a null doc_id stays; an empty table gives no rows; other columns are not read. Texts of any length are scanned
    whole, in time in proportion to their length.
    """
    known = frozenset(known)

    def task():
        encoding = ranks(vocabulary)

        def scan(texts: list[str | None]) -> list[list]:
            found = []
            for text in texts:
                base = base_spans(text or "")
                found.append((base, random_spans(text or "", base, encoding, known)))
            return found_columns(found, BASE_KINDS, KINDS)

        return scan

    return map_texts(docs.select("doc_id", "text"), task, found_type(BASE_KINDS), ["doc_id"])


def redact_secrets(docs: DataFrame, vocabulary: str, known: Collection[str] = (), mark: str = "[secret]") -> DataFrame:
    """`docs` with every span replaced by `mark`; all rows and columns stay, and n_chars, if there is one, is counted anew
    where the text changed. Texts without spans, nulls included, stay as they are."""
    known = frozenset(known)
    changed = T.StructType([T.StructField("text", T.StringType()), T.StructField("__changed", T.BooleanType())])

    def task():
        encoding = ranks(vocabulary)

        def redact(texts: list[str | None]) -> list[list]:
            out, touched = [], []
            for text in texts:
                base = base_spans(text or "")
                spans = base + random_spans(text or "", base, encoding, known)
                touched.append(bool(spans))
                out.append(replaced(text, spans, mark) if spans else text)
            return [out, touched]

        return redact

    out = map_texts(docs, task, changed, docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__changed"), F.length("text")).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
