"""Online packing, phrase mining and hard negatives against plain versions."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from logsonde.llm import phrase_mining
from logsonde.llm.hard_negatives import Curve, bounds, hilbert_places, mine_negatives, prepared, write_blocks
from logsonde.llm.packing import sequences
from logsonde.llm.phrase_mining import frequent_prefixes, mine_phrases
from logsonde.llm.token_ids import tokenizer_path, tokenizer_pattern
from logsonde.llm.window_packing import ByteIds, OpenWindows, pack_online

BYTES, RANKS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken")


# -- online packing -------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab zZ'sStred_09²½ÀéÉß.,!<>|-—\n\t\r\xa0日", max_size=50))
def test_byte_ids_are_those_of_the_library(text):
    encoder = ByteIds(BYTES, RANKS, tokenizer_pattern())
    plain = np.asarray(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert encoder.encode(text) == plain


def test_special_token_in_a_text():
    encoder = ByteIds(BYTES, RANKS, tokenizer_pattern())
    assert np.frombuffer(encoder.encode("a<|endoftext|>b"), "<u4").tolist().count(50256) == 1
    assert encoder.encode(None) == encoder.encode("") == b""


@pytest.mark.parametrize("windows", [1, 3, 16])
@pytest.mark.parametrize("slack", [0, 5, 100])
def test_open_windows(windows, slack):
    rng = random.Random(windows + slack)
    held, docs = OpenWindows(50, windows, slack), {}
    for doc in range(400):
        ids = np.arange(rng.choice([0, 1, 5, 20, 49, 50, 51, 130]), dtype="<u4") + 1000 * doc
        docs[doc] = ids
        held.place(doc, ids.tobytes())
        assert len(held.pieces) <= windows
    before = held.emitted()
    assert all(50 - sum(len(p[3]) // 4 for p in w) <= slack for _, w in before)
    held.join_rest()
    assert len(held.pieces) <= 1
    found = defaultdict(list)
    for _, window in [*before, *held.emitted(), *held.leftovers()]:
        assert sum(len(p[3]) // 4 for p in window) <= 50
        for doc, start, total, ids in window:
            assert total == len(docs[doc])
            found[doc].append((start, ids))
    for doc, ids in docs.items():
        assert b"".join(x for _, x in sorted(found[doc])) == ids.tobytes()


def test_best_fit_and_the_fullest():
    held = OpenWindows(10, 2, slack=3)
    for doc, n in enumerate([6, 7, 3]):  # 3 fits both; the smaller gap takes it and is full
        held.place(doc, b"\0" * 4 * n)
    assert [[p[0] for p in w] for _, w in held.emitted()] == [[1, 2]]
    held.place(3, b"\0" * 4 * 8)
    held.place(4, b"\0" * 4 * 9)  # none fits: the fullest, with a gap of 2, goes as it is
    assert [[p[0] for p in w] for _, w in held.emitted()] == [[3]]
    held.place(5, b"\0" * 4 * 8)  # the fullest has a gap of 1
    assert [[p[0] for p in w] for _, w in held.emitted()] == [[4]]


def test_pack_online_round_trip(spark):
    rng = random.Random(8)
    texts = ["", None, "one", "x" * 3000, " ".join(rng.choice(["to", "be", "or"]) for _ in range(700)), "same", "same"]
    texts += [" ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randrange(60))) for _ in range(120)]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(5, "same", 1, "x"), (None, "no id", 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, part int, sequence_id string").repartition(11)
    packed = pack_online(df, BYTES, RANKS, tokenizer_pattern(), capacity=64, windows=4, slack=2, merged=2, with_ids=True)
    out = packed.toPandas()
    encoder = ByteIds(BYTES)
    wanted = Counter((i, encoder.encode(t) + (1).to_bytes(4, "little")) for i, t, *_ in rows)
    assert (out["ids"].map(zlib.crc32) == out["ids_crc32"]).all() and (out["ids"].map(len) == 4 * out["length"]).all()
    for (doc, ids), times in wanted.items():
        own = out[out["doc_id"].isna() if doc is None else out["doc_id"] == doc].sort_values("start")
        assert (own["doc_tokens"] * 4).isin([len(i) for (d, i) in wanted if d == doc]).all()
        if times == 1 and sum(d == doc for d, _ in wanted) == 1:
            assert b"".join(own["ids"]) == ids
            assert own["start"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]]
    for _, seq in out.sort_values("offset").groupby("sequence_id"):
        assert seq["offset"].tolist() == [0, *seq["length"].cumsum().tolist()[:-1]] and seq["length"].sum() <= 64
    used = out.groupby("sequence_id")["length"].sum()
    assert (used >= 62).sum() >= len(used) - 1  # all but one are full up to the slack
    assert sequences(packed, 64).count() == len(used)
    empty = pack_online(df.limit(0), BYTES, end_id=1)
    assert empty.count() == 0 and "sequence_id" in empty.columns


# -- phrases --------------------------------------------------------------------------------


def plain_phrases(rows, least, depth, top):
    """By counting all phrases of all pieces."""
    import re

    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = tuple(w for w in re.split(r"[\x20\x09]+", piece) if w)
            totals[lang] += len(ws)
            for d in range(1, depth + 1):
                counts[lang].update(ws[i : i + d] for i in range(len(ws) - d + 1))
    out = []
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in good.items():
            cuts = [((1000 * a * totals[lang]) // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            inside = any(
                len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in good.items()
            )
            if not inside:
                score, _, l, r = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -s))
    return sorted(out)


def phrase_rows():
    rng = random.Random(4)
    word = ["the", "of", "New", "york", "City", "state", "é", "日本", "rare", "x" * 70, "a-b", "\x00"]
    rows = [(None, "en"), ("", None), ("one", "en"), (". , ;", "de"), ("w " * 3000, "de")]
    for _ in range(150):
        n = rng.randrange(1, 60)
        rows.append(("".join(rng.choice(word) + rng.choice([" ", " ", "\t", "  ", ". ", "\n"]) for _ in range(n)), rng.choice(["en", "de", None])))
    return rows + [("New York City of the state", "en")] * 40 + [("of of of of of of", None)] * 6


@pytest.mark.parametrize("hot", [1 << 18, 20])
def test_phrases_equal_plain_counting(spark, hot, monkeypatch):
    monkeypatch.setattr(phrase_mining, "CHUNK", 200)
    rows = phrase_rows()
    df = spark.createDataFrame([(t, l, i, 1, "x") for i, (t, l) in enumerate(rows)], "text string, lang string, n long, rank int, codes string")
    got = mine_phrases(df.repartition(5), least=12, depth=4, top=25, hot=hot)
    assert sorted(map(tuple, got.collect())) == plain_phrases(rows, 12, 4, 25)


def test_no_phrases(spark):
    schema = "text string, lang string"
    for rows in ([], [(None, None)], [("a b c", "en")]):
        assert mine_phrases(spark.createDataFrame(rows, schema), least=2).count() == 0


def test_exact_scores_beyond_64_bits(spark):
    exact = "(cast(a as decimal(17,0)) * cast(all as decimal(17,0)) * 1000) div (cast(l as decimal(19,0)) * cast(r as decimal(18,0)))"
    rows = [(10**15 + 7, 10**16 + 3, 10**15 + 9, 10**15 + 11), (3, 7, 2, 10), (10**16 - 1, 10**16 - 1, 10**16 - 1, 10**16 - 1)]
    df = spark.createDataFrame(rows, "a long, all long, l long, r long")
    assert [r[0] for r in df.select(F.expr(exact)).collect()] == [1000 * a * n // (l * r) for a, n, l, r in rows]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 400), st.integers(1, 12), st.integers(0, 9))
def test_quicksort_counts_prefixes(n, least, seed):
    rng = np.random.default_rng(seed)
    words = rng.integers(1, 4, (n, 4)).astype(np.uint64)
    for row, length in zip(words, rng.integers(1, 5, n), strict=True):
        row[length:] = 0
    weight = rng.integers(1, 3, n)
    wanted = Counter()
    for row, w in zip(words, weight, strict=True):
        for d in range(2, 5):
            if row[d - 1]:
                wanted[tuple(row[:d])] += int(w)
    found = [(tuple(words[r, :d]), c) for r, d, c in frequent_prefixes(words, weight, least)]
    assert sorted(found) == sorted((p, c) for p, c in wanted.items() if c >= least)


# -- hard negatives -------------------------------------------------------------------------


def plain_negatives(rows, every, k=5):
    seen = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or not vector or any(x is None or not np.isfinite(x) for x in vector):
            continue
        v = tuple(int(np.floor(256 * np.float64(np.float32(x)))) for x in vector)
        seen[vec_id] = min(seen.get(vec_id, (str(label), v)), (str(label), v))
    out = []
    for anchor, (label, v) in seen.items():
        if anchor % every:
            continue
        scored = sorted((-sum(map(int.__mul__, v, w)), i, own == label) for i, (own, w) in seen.items() if i != anchor and len(w) == len(v))
        for minus, positive, _ in [s for s in scored if s[2]][:k]:
            far = [(s, i) for s, i, same in scored if not same and 80 * -minus <= 100 * -s <= 100 * -minus][:k]
            out += [(anchor, positive, r, i, -minus, -s) for r, (s, i) in enumerate(far, 1)]
    return sorted(out)


def vector_rows(n=420, d=6):
    rng = np.random.default_rng(12)
    centres = rng.standard_normal((4, d))
    rows = [(i, (centres[i % 4] + 0.4 * rng.standard_normal(d)).astype(np.float32).tolist(), i % 3) for i in range(n)]
    rows += [(n + i, rows[0][1], i % 2) for i in range(30)]  # ties
    bad = [None, [], [None] * d, [float("nan")] + [0.0] * (d - 1), [float("inf")] * d]
    rows += [(1000 + i, v, 1) for i, v in enumerate(bad)] + [(2000, rows[5][1], None), (None, rows[5][1], 1), (2010, [1.0, 2.0], 1), (2020, [2.0, 1.0], 0)]
    return rows + [rows[20], rows[20], (20, rows[21][1], 2), (2030, [0.0] * d, 0)]


@pytest.mark.parametrize(("block", "group"), [(16, 8), (64, 512)])
def test_negatives_equal_brute_force(spark, block, group):
    rows = vector_rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, block int, rank string")
    got = mine_negatives(df.repartition(3), lambda i: i % 10 == 0, block=block, group=group)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, 10)


def test_negatives_of_little(spark):
    schema = "vec_id long, embedding array<float>, label int"
    for rows in ([], [(0, [1.0, 0.0], 1)], [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)], [(0, None, 1)]):
        assert mine_negatives(spark.createDataFrame(rows, schema), lambda i: i % 10 == 0).count() == 0


def test_bounds_hold_and_blocks_are_narrow(spark):
    rng = np.random.default_rng(3)
    anchors, block = rng.integers(-300, 300, (20, 8)), rng.integers(-300, 300, (50, 8))
    low, high = bounds(anchors, block.min(0)[None], block.max(0)[None])
    own = anchors @ block.T
    assert (own >= low).all() and (own <= high).all()
    df = spark.createDataFrame(vector_rows(), "vec_id long, embedding array<float>, label int")
    blocks = write_blocks(prepared(df), block=32).toPandas()
    assert blocks["n"].max() <= 32 and blocks["n"].sum() == prepared(df).count()


def test_hilbert_curve_goes_to_neighbours():
    for n, bits in ((2, 3), (3, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
        places = hilbert_places(cells, bits)
        assert sorted(places.tolist()) == list(range(len(cells)))
        ordered = cells[np.argsort(places)]
        assert (np.abs(np.diff(ordered, axis=0)).sum(1) == 1).all()
    curve = Curve(np.random.default_rng(0).standard_normal((100, 3)))
    assert len(np.unique(curve.places(np.eye(3)))) == 3
