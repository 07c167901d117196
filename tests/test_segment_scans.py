"""Segments read the events once, deal the blocks of a pass evenly and find each event's clusters once."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from logsonde.operators import segments
from logsonde.plans import catalog
from logsonde.plans.telemetry import read_telemetry


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_view_is_not_worked_out_again(spark, sf_dir):
    t = read_telemetry(spark, sf_dir)
    vectors = catalog._vectors(t)
    assert "get_json_object" not in plan(vectors) and "stddev_pop" not in plan(vectors)
    assert vectors.count() == segments.feature_rows(t).count()


def test_clusters_are_computed_once(spark):
    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(40)]
    vectors = spark.createDataFrame(rows, "EventSeq long, features array<double>").repartition(2)
    models = {k: segments.Centres(np.array([[float(i), 2.0] for i in range(k)]), 0.0, 1) for k in (2, 3)}
    found = segments.by_k(segments.assign(vectors, models))
    assert plan(found).count("ArrowEvalPython") == 1
    want = {(i, k): int(((models[k].at - np.array(x)) ** 2).sum(1).argmin()) for i, x in rows for k in models}
    assert {(r["EventSeq"], r["k"]): r["cluster"] for r in found.collect()} == want
    none = vectors.withColumn("clusters", F.expr("CAST(array() AS array<struct<k: int, cluster: int>>)"))
    assert segments.by_k(none).count() == 0


def test_blocks_of_one_task_go_to_several(spark, monkeypatch):
    seen = []
    before = segments._pass

    def scan(blocks, models):
        seen.append(len(blocks.inputFiles()))
        return before(blocks, models)

    monkeypatch.setattr(segments, "_pass", scan)
    x = F.array((F.col("id") % 97).cast("double"), (F.col("id") % 31).cast("double"))
    vectors = spark.range(0, 12 * segments.BLOCK_ROWS, 1, 1).select(x.alias("features"))
    segments.fit_kmeans(vectors, [2], initial={2: np.array([[0.0, 0.0], [90.0, 30.0]])}, max_iterations=1)
    assert min(seen) > 1


def test_a_row_as_near_to_two_centres_belongs_to_the_first():
    x = np.array([[1.0, 0.0], [0.0, 0.0], [2.0, 0.0], [1.0, 3.0]])
    models = [np.array([[0.0, 0.0], [2.0, 0.0]]), np.array([[2.0, 0.0], [2.0, 0.0], [0.0, 0.0]])]
    sums, counts, costs = segments._lloyd(x, models)
    assert [c.tolist() for c in counts] == [[3, 1], [3, 0, 1]]
    assert [s.tolist() for s in sums] == [[[2, 3], [2, 0]], [[4, 3], [0, 0], [0, 0]]]
    np.testing.assert_allclose(costs, [1 + 0 + 0 + 10, 1 + 0 + 0 + 10])
