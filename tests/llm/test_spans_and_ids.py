"""Overlaps of spans, parts of secrets, cut regions, and ids that repeat with other texts."""

from __future__ import annotations

import random

from hypothesis import given, settings, strategies as st

from logsonde.llm.ngram_join import keep_one, ngram_links
from logsonde.llm.personal_data import REGION_LETTERS, _cut, regions
from logsonde.llm.secrets_scan import random_spans, ranks
from logsonde.llm.spans import Cover
from logsonde.llm.token_ids import tokenizer_path

SPANS = st.lists(st.tuples(st.just("x"), st.integers(0, 60), st.integers(1, 9)).map(lambda s: (s[0], s[1], s[1] + s[2])), max_size=12)


@settings(max_examples=200, deadline=None)
@given(SPANS, SPANS)
def test_cover_finds_overlaps(base, others):
    cover = Cover(base)
    for _, a, b in others:
        assert cover.overlaps(("y", a, b)) == any(a < d and c < b for _, c, d in base)


def test_random_values_behind_names():
    encoding, rng = ranks(tokenizer_path("byte_bpe_50k.tiktoken")), random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    for name in ("", "connection_string=", "authorization_header=", "/etc/service/"):
        values = ["".join(rng.choice(letters) for _ in range(24)) for _ in range(200)]
        found = [random_spans(f"set {name}{v} now", [], encoding) for v in values]
        assert sum(map(bool, found)) >= 185
        for v, spans in zip(values, found, strict=True):
            assert all(f"set {name}{v} now"[a:b].endswith(v) for _, a, b in spans)
    for clean in ("release_notes/version_2024/final_report_3", "d41d8cd98f00b204e9800998ecf8427e", "user_name=administrator_account"):
        assert random_spans(clean, [], encoding) == []


def test_regions_are_cut_between_chunks():
    text = "12 " * 5000
    for _, chunks in regions(text):
        parts = list(_cut(chunks))
        assert [c for p in parts for c in p] == chunks
        assert all(p[-1][1] - p[0][0] <= REGION_LETTERS for p in parts)
    assert list(_cut([(0, REGION_LETTERS + 1)])) == []


def test_two_texts_under_one_id_keep_their_links(spark):
    rng = random.Random(6)
    a, b = (" ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(999)) for _ in range(200)) for _ in range(2))
    rows = [(1, a), (1, b), (5, a + " more"), (6, b + " more"), (7, "other words alone here now")] + [(5, a + " more")] * 40
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, text_hash string, node int")
    links = {(r["doc_id"], r["text_hash"]): r for r in ngram_links(df).collect()}
    assert sorted((i, r["n_text_links"]) for (i, _), r in links.items()) == [(1, 1), (1, 1), (5, 1), (6, 1), (7, 0)]
    assert sorted((i, r["n_links"]) for (i, _), r in links.items()) == [(1, 1), (1, 41), (5, 41), (6, 1), (7, 0)]
    assert {r["component_id"] for (i, _), r in links.items() if i in (5, 6)} == {1}
    kept = keep_one(df).collect()
    assert sorted((r["doc_id"], r["text"], r["text_hash"], r["node"]) for r in kept) == sorted([(1, a, "x", 1), (1, b, "x", 1), (7, rows[4][1], "x", 1)])
