"""Jaccard join, embedding links, components and the pipeline against brute force."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from logsonde.llm import common, embedding_links as cap, ngram_join
from logsonde.llm.common import components, runs_of
from logsonde.llm.decontamination import find_items
from logsonde.llm.embedding_links import embedding_links
from logsonde.llm.ngram_join import keep_one, ngram_links, runs_for, survival
from logsonde.llm.secrets_scan import base_spans

SCHEMA = "doc_id long, text string, node long, size long, sketch string"


def roots_of(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(500, x) for x in range(501, 560)]
    pairs += [(3, 3), (None, 4), (5, None)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    known = [p for p in pairs if None not in p and p[0] != p[1]]
    assert got == roots_of(known, {x for p in known for x in p})
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_runs_come_whole_from_batches():
    rng = random.Random(1)
    key = sorted(rng.choices(range(40), k=300))
    frame = pd.DataFrame({"k": key, "v": range(300)})
    cuts = sorted(rng.sample(range(300), 30))
    batches = [frame.iloc[a:b] for a, b in zip([0, *cuts], [*cuts, 300], strict=True)]
    got = [(int(r["k"][0]), r["v"].tolist()) for r in runs_of(iter(batches), ["k"])]
    assert got == [(int(k), g["v"].tolist()) for k, g in frame.groupby("k") if len(g) > 1]


def near_documents(rng):
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []
    for g in range(25):
        base = rng.choices(vocabulary, k=rng.randint(5, 200))
        rows.append(base)
        for _ in range(rng.randint(0, 5)):
            other = list(base)
            for _ in range(rng.randint(0, 4)):
                other[rng.randrange(len(other))] = rng.choice(vocabulary)
            rows.append(other)
        if g % 5 == 0:
            rows += [base, base]
    common_part = rng.choices(vocabulary, k=60)
    rows += [common_part + rng.choices(vocabulary, k=60) for _ in range(8)]
    rows += [["a"], ["a"], ["a", "b", "c"], rng.choices(vocabulary, k=4)]
    hub = rng.choices(vocabulary, k=120)
    for _ in range(40):  # a large group
        other = list(hub)
        other[rng.randrange(120)] = rng.choice(vocabulary)
        rows.append(other)
    texts = [" ".join(r) if i % 3 else ", ".join(r).upper() for i, r in enumerate(rows)]
    rng.shuffle(texts)
    out = [(i, t, 1, 1, "x") for i, t in enumerate(texts)]
    return [*out, (900, None, 1, 1, "x"), (901, "", 1, 1, "x"), (902, "!!", 1, 1, "x"), (None, texts[0], 1, 1, "x"), (3, texts[3], 1, 1, "x")]


def shingles(text):
    ws = common.words(text)
    n = min(5, len(ws))
    return frozenset(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)) if n else frozenset()


def brute_links(rows, threshold=0.8):
    sets = [(d, shingles(t)) for d, t, *_ in rows]
    able = [i for i, (d, s) in enumerate(sets) if d is not None and s]
    n = dict.fromkeys(range(len(rows)), 0)
    pairs = []
    for x, i in enumerate(able):
        for j in able[:x]:
            a, b = sets[i][1], sets[j][1]
            if len(a & b) / len(a | b) >= threshold:
                n[i], n[j] = n[i] + 1, n[j] + 1
                pairs.append((sets[i][0], sets[j][0]))
    roots = roots_of(pairs, {d for d, _ in sets if d is not None})
    return [(d, n[i], roots.get(d)) for i, (d, _) in enumerate(sets)]


@pytest.mark.parametrize("block", [256, 7])
def test_links_of_texts_are_those_of_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "BUCKET", 512 if block == 256 else 6)  # the second makes large buckets split
    rows = near_documents(random.Random(7))
    table = spark.createDataFrame(rows, SCHEMA)
    got = [(r["doc_id"], r["n_links"], r["component_id"]) for r in ngram_links(table).collect()]
    assert sorted(got, key=str) == sorted(brute_links(rows), key=str)
    kept = keep_one(table).collect()
    alone = {root for _, _, root in brute_links(rows) if root is not None}
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(alone)
    assert sum(r["doc_id"] is None for r in kept) == 1
    assert ngram_links(table.limit(0)).count() == 0


def test_runs_reach_the_recall():
    assert (1 - survival(0.8, ngram_join.FIRST_DEPTH)) ** runs_for(0.9995) <= 0.0005
    rng = np.random.default_rng(3)
    missed = 0
    for _ in range(300):
        both = rng.integers(0, 2**63, 400, dtype=np.uint64)
        a = np.unique(np.concatenate([both, rng.integers(0, 2**63, 50, dtype=np.uint64)]))
        b = np.unique(np.concatenate([both, rng.integers(0, 2**63, 50, dtype=np.uint64)]))
        sketch = ngram_join.sketches([a, b])
        shared = False
        for run in range(runs_for(0.9995)):
            row, path = np.arange(2), np.full(2, ngram_join.mixed(np.array([run + 1], np.uint64))[0])
            for _ in range(ngram_join.FIRST_DEPTH):
                row, path = ngram_join.step(row, path, sketch, 0.25)
            shared |= bool(np.intersect1d(path[row == 0], path[row == 1]).size)
        missed += not shared
    assert missed <= 2


def test_runs_reach_the_recall_where_all_buckets_are_split():
    rng, pairs = np.random.default_rng(5), 20_000
    sketch = []
    for _ in range(20):  # pairs of sets of similarity 0.8
        drawn = rng.integers(0, 2**63, (pairs // 20, 250), dtype=np.uint64)
        sketch.append(ngram_join.sketches([x for d in drawn for x in (d[:225], np.concatenate([d[:200], d[225:]]))]))
    sketch = np.concatenate(sketch)
    small, split = np.zeros(pairs, bool), np.zeros(pairs, bool)
    for run in range(runs_for(0.9995)):
        row, path = np.arange(2 * pairs), np.full(2 * pairs, ngram_join.mixed(np.array([run + 1], np.uint64))[0])
        for depth in range(ngram_join.GREATEST_DEPTH):
            row, path = ngram_join.step(row, path, sketch, 0.25 if depth < ngram_join.FIRST_DEPTH else 1.0)
            nodes = pd.DataFrame({"row": row, "pair": row // 2, "path": path}).drop_duplicates()
            nodes = nodes[nodes.duplicated(["pair", "path"], keep=False)]  # a node of one of the two never meets again
            row, path = nodes["row"].to_numpy(), nodes["path"].to_numpy()
            if depth + 1 == ngram_join.FIRST_DEPTH:
                small[nodes["pair"]] = True
        split[nodes["pair"]] = True
    bound = 0.0005 * pairs + 3 * (0.0005 * pairs) ** 0.5
    print("missed of", pairs, "small", (~small).sum(), "split", (~split).sum())
    assert (~small).sum() <= bound and (~split).sum() <= bound


def vectors(rng):
    rows = []
    for label in (1, 2, None):
        for _ in range(40):
            x = rng.standard_normal(24)
            for _ in range(rng.integers(1, 5)):
                y = x + 0.25 * rng.standard_normal(24) * rng.integers(0, 3)
                rows.append((label, y.astype(np.float32).tolist()))
        x = rng.standard_normal(24).astype(np.float32).tolist()
        rows += [(label, x)] * 6 + [(label, [2 * v for v in x])]
    rows += [(1, None), (1, []), (1, [0.0] * 24), (1, [None, *[1.0] * 23]), (1, [float("nan"), *[1.0] * 23]), (1, [float("inf")] * 24)]
    rows += [(1, [1.0, 0.0]), (1, [0.99, 0.05]), (1, [0.0, 1.0]), (1, [5.0]), (1, [2.0]), (1, [-2.0])]
    out = [(i, v, label, 1) for i, (label, v) in enumerate(rows)]
    return [*out, (None, out[0][1], 1, 1), out[5]]


@pytest.mark.parametrize("block", [1024, 5])
def test_links_of_vectors_are_those_of_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(cap, "BLOCK", block)
    rows = vectors(np.random.default_rng(4))
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node int")
    able = [i for i, (d, v, label, _) in enumerate(rows) if d is not None and label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    n, pairs = dict.fromkeys(range(len(rows)), 0), []
    for x, i in enumerate(able):
        for j in able[:x]:
            if rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.float32(rows[i][1]).astype(float), np.float32(rows[j][1]).astype(float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93:
                    n[i], n[j] = n[i] + 1, n[j] + 1
                    pairs.append((rows[i][0], rows[j][0]))
    roots = roots_of(pairs, {r[0] for r in rows if r[0] is not None})
    expected = [(r[0], n[i], roots.get(r[0])) for i, r in enumerate(rows)]
    got = embedding_links(table).collect()
    assert sorted([(r["vec_id"], r["n_links"], r["component_id"]) for r in got], key=str) == sorted(expected, key=str)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"] or r["vec_id"] is None) for r in got)
    assert embedding_links(table.limit(0)).count() == 0


def test_filters_find_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    x = cap.unit_rows(list(rng.standard_normal((1500, 64))))
    side = cap.unit_rows([y - (y @ v) * v for v, y in zip(x, rng.standard_normal(x.shape), strict=True)])
    near = 0.93 * x + np.sqrt(1 - 0.93**2) * side
    filters = cap.Filters(64)
    shared = [bool(np.intersect1d(a, b).size) for a, b in zip(filters.decode(x), filters.decode(near), strict=True)]
    assert np.mean(shared) >= 0.997


def test_the_pipeline_stage_by_stage(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, sf_dir).write.parquet(str(tmp_path / str(i)))
        after = spark.read.parquet(str(tmp_path / str(i)))
        was = {r["doc_id"]: r for r in before.collect()}
        now = after.collect()
        if name != "packing":
            assert after.columns == columns
        if name == "quality":
            assert {r["doc_id"]: r for r in now}.items() <= was.items()
            labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
            kept = {r["doc_id"] for r in now}
            clean = [d in kept for d, r in labels.items() if d in was and r["quality"] == 1 and r["toxic"] == 0]
            assert np.mean(clean) >= 0.95 and len(kept) < len(was)
        elif name == "near_duplicates":
            links = brute_links([(d, r["text"]) for d, r in was.items()])
            assert sorted(r["doc_id"] for r in now) == sorted({root for _, _, root in links})
        elif name == "decontamination":
            assert find_items(after, bench).where("size(spans) > 0").count() == 0
            hit = {r["doc_id"] for r in find_items(before, bench).where("size(spans) > 0").collect()}
            assert {r["doc_id"]: r for r in now if r["doc_id"] not in hit} == {d: r for d, r in was.items() if d not in hit}
        elif name == "secrets":
            assert {r["doc_id"] for r in now} == set(was)
            assert all((r["text"] == was[r["doc_id"]]["text"]) == (not base_spans(was[r["doc_id"]]["text"])) for r in now)
            assert not any(base_spans(r["text"]) for r in now)
        else:
            assert {r["doc_id"] for r in now} == set(was)
        before = after


def test_sketches_are_joined_once_for_each_set(spark):
    members = spark.createDataFrame([(10 * n + p, n) for n in range(5) for p in range(6)], "path long, node long").repartition(2)
    sketched = spark.createDataFrame([(n, bytes([n]), n // 2) for n in range(9)], "node long, sketch binary, root long")
    got = ngram_join._sketched(members, sketched)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Join Inner")  # the copies come after the join
    want = sorted((10 * n + p, n, bytes([n]), n // 2) for n in range(5) for p in range(6))
    assert sorted((r["path"], r["node"], bytes(r["sketch"]), r["root"]) for r in got.collect()) == want
