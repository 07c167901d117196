"""Token ids, coded blocks, token files, packing and token counts against plain versions."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from logsonde.llm import range_coder
from logsonde.llm.packing import pack, plan, sequences
from logsonde.llm.range_coder import decode_block, encode_block
from logsonde.llm.token_counts import Unigram, count_tokens, vocabulary_scores
from logsonde.llm.token_ids import TokenIds, tokenizer_path
from logsonde.llm.token_output import read_tokens, write_tokens

TOKENIZER = tokenizer_path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, part int, ids string"


def documents():
    rng = random.Random(3)
    texts = [
        "Plain words, and some more.", None, "", "É ñ ß Äpfel «été» 12_3 it's", "日本語 ﬁ ² ½ ſ İ", "<|endoftext|> here", "a" * 3000,
        " ".join(rng.choice(["to", "be", "or", "not", "tion"]) for _ in range(6000)), "same text", "same text",
    ]
    return [(i - 3, t, 1, "x") for i, t in enumerate(texts)] + [(5, "same text", 1, "x"), (None, "no id", 1, "x"), (None, None, 1, "x")]


def library_ids(text, end):
    encoder = TokenIds(TOKENIZER)
    return (encoder._whole(text) if text else b"") + end.to_bytes(4, "little")


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="abz'sStred_09²½ÀéÉß.,!<>|-—\n\t ñ¿İſ日ﬁ́", max_size=60))
def test_ids_are_those_of_the_library(text):
    encoder = TokenIds(TOKENIZER)
    assert encoder.encode(text) == encoder._whole(text)


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 700, 5000])
@pytest.mark.parametrize("kind", ["random", "runs", "one"])
def test_blocks_round_trip(n, kind):
    rng = np.random.default_rng(n)
    ids = {"random": rng.integers(0, 49408, n), "runs": np.repeat(rng.integers(0, 50, n), 3)[:n], "one": np.full(n, 49407)}[kind]
    assert np.array_equal(decode_block(encode_block(ids, 49408)), ids)


def test_repeated_ids_are_coded_shorter():
    rng = np.random.default_rng(1)
    period = np.tile(rng.integers(0, 49408, 200), 200)
    assert len(encode_block(period, 49408)) < len(period)
    with pytest.raises(ValueError):
        encode_block(np.array([49408]), 49408)


def test_damage_is_found():
    block = bytearray(encode_block(np.arange(3000) % 977, 1000))
    for at in (0, 5, range_coder.HEADER.size + 60, len(block) - 40):
        broken = bytearray(block)
        broken[at] ^= 255
        with pytest.raises(ValueError):
            decode_block(bytes(broken))
    with pytest.raises(ValueError):
        decode_block(bytes(block[:-2]))


def test_counts_are_halved_when_they_get_large(monkeypatch):
    monkeypatch.setattr(range_coder, "TOTAL_BOUND", 5000)
    ids = np.random.default_rng(2).integers(0, 300, 20000)
    assert np.array_equal(decode_block(encode_block(ids, 300)), ids)


def test_files_hold_every_document_in_order(spark, tmp_path):
    rows = documents()
    write_tokens(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "t"), TOKENIZER, block_ids=500)
    got = read_tokens(spark, str(tmp_path / "t")).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted([r[0] for r in rows], key=lambda x: (x is not None, x or 0))
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert sorted(bytes(r["ids"]) for r in got) == sorted(library_ids(r[1], 2) for r in rows)


def test_an_empty_table_makes_an_empty_file(spark, tmp_path):
    write_tokens(spark.createDataFrame([], SCHEMA), str(tmp_path / "t"), TOKENIZER)
    assert read_tokens(spark, str(tmp_path / "t")).count() == 0


def fewest_large(lengths, capacity):
    """Sequences that pieces of more than a third need, by trying all ways."""
    best = len(lengths)

    def go(rest, n):
        nonlocal best
        if n >= best:
            return
        if not rest:
            best = n
            return
        first, others = rest[0], rest[1:]
        go(others, n + 1)
        for i, x in enumerate(others):
            if first + x <= capacity:
                go(others[:i] + others[i + 1 :], n + 1)

    go(sorted(lengths, reverse=True), 0)
    return best


def fill(counts, capacity):
    sequences_: dict[int, list[tuple[int, int]]] = {}
    for run in plan(counts, capacity):
        for k in range(run.sequences):
            for e in range(run.each):
                sequences_.setdefault(run.first + k, []).append((run.offset + e * run.length, run.length))
    return sequences_


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(0, 6), max_size=12))
def test_plans_place_every_piece_once_without_gaps(counts):
    counts = {n: c for n, c in counts.items() if c}
    filled = fill(counts, 30)
    seen: dict[int, int] = {}
    for own in filled.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
            seen[length] = seen.get(length, 0) + 1
        assert at <= 30
        assert sum(3 * length > 30 for _, length in own) <= 2
    assert seen == counts
    assert sorted(filled) == list(range(len(filled)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(11, 30), max_size=8))
def test_large_pieces_take_the_fewest_sequences(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    assert len(fill(counts, 30)) == fewest_large(lengths, 30)


def test_packing_keeps_every_token(spark):
    rows = documents()
    packed = pack(spark.createDataFrame(rows, SCHEMA), TOKENIZER, end_id=0, capacity=64, with_ids=True).cache()
    got = packed.collect()
    whole = sorted(library_ids(r[1], 0) for r in rows)
    docs: dict = {}
    for r in sorted(got, key=lambda r: r["piece"]):
        assert r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and r["length"] * 4 == len(r["ids"]) and r["start"] == 64 * r["piece"]
        docs.setdefault((r["doc_id"], None if r["doc_id"] not in (5, None) else id(r)), []).append(bytes(r["ids"]))
    assert sum(len(w) for w in whole) == sum(len(r["ids"]) for r in got)
    single = sorted(b"".join(v) for (d, _), v in docs.items() if d not in (5, None))
    assert single == sorted(library_ids(r[1], 0) for r in rows if r[0] not in (5, None))
    for row in sequences(packed, 64).collect():
        assert row["length"] <= 64 and len(row["ids"]) == 4 * row["length"]
    for s in {r["sequence_id"] for r in got}:
        at = 0
        for r in sorted((r for r in got if r["sequence_id"] == s), key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
    packed.unpersist()
    assert pack(spark.createDataFrame([], SCHEMA), TOKENIZER).count() == 0


def brute_count(scores, byte, word):
    word = "▁" + word
    best = [(0.0, 0)]
    for j in range(1, len(word) + 1):
        n = len(word[j - 1].encode())
        ways = [(best[j - 1][0] + byte * n, best[j - 1][1] - n)]
        ways += [(best[i][0] + scores[word[i:j]], best[i][1] - 1) for i in range(j) if word[i:j] in scores]
        best.append(max(ways))
    return -best[-1][1]


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text(alphabet="abcd日", max_size=8), max_size=12), st.dictionaries(st.text(alphabet="▁abcd", min_size=1, max_size=4), st.integers(-9, -1), min_size=1))
def test_counts_share_prefixes_and_stay_right(words, scores):
    counter = Unigram(scores)
    counter.count(words)
    assert counter.memory == {w: brute_count(scores, counter.byte, w) for w in words}


def test_documents_are_counted_whole(spark):
    path = tokenizer_path("piece_bpe_32k.model")
    scores = vocabulary_scores(path)
    byte = min(scores.values()) - 1
    rows = [(1, "Two words", 0, ""), (2, None, 0, ""), (3, "", 0, ""), (None, "two words two", 0, ""), (1, "Two words", 0, "")]
    got = count_tokens(spark.createDataFrame(rows, SCHEMA), path).collect()
    expected = [(d, len((t or "").split()), sum(brute_count(scores, byte, w) for w in (t or "").split())) for d, t, _, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
