"""All rounds of a graph in one task give what rounds as joins and aggregates give."""

import numpy as np
from pyspark.sql import functions as F

from lumenfold.operators import communities as cm
from lumenfold.operators import moves

from test_communities import KEYS, edges_of, planted, ring


def test_the_order_of_labels_is_that_of_spark(spark):
    labels = np.array([0, 1, -1, 77, 2**62, -(2**63)])
    df = spark.createDataFrame([(i, int(x)) for i, x in enumerate(labels)], "i int, label long")
    for salt in ("13:0:3", "x", "-9223372036854775808:1:22"):
        want = [r.h for r in df.select("i", F.xxhash64("label", F.lit(salt)).alias("h")).orderBy("i").collect()]
        assert moves.order_hash(labels, salt).tolist() == want


def test_rounds_run_in_one_task_and_not_as_jobs(spark, monkeypatch):
    """Each round was a stored table of its own, some jobs and seconds long however small the graphs."""
    monkeypatch.setattr(cm, "_move_round", None)
    graphs = {"ring": ring(6, 5), "two": planted(2, 10, 0.7, 0.05, 1)}
    placed = cm.detect_communities(edges_of(spark, graphs), KEYS, resolution=1.0).collect()
    assert len({(r["graph"], r["community"]) for r in placed if r["graph"] == "ring"}) == 6


def test_large_graphs_go_by_joins_and_come_out_the_same(spark, monkeypatch):
    graphs = {"g": planted(3, 8, 0.6, 0.1, 4), "ring": ring(4, 4), "some": planted(1, 25, 0.15, 0, 6)}
    edges = edges_of(spark, graphs)
    found = lambda: sorted(map(tuple, cm.detect_communities(edges, KEYS, resolution=1.0).collect()))
    inside = found()
    monkeypatch.setattr(cm, "LOCAL_LINKS", 2 * len(graphs["ring"]))  # the ring stays in a task
    assert found() == inside and {r[0] for r in inside} == set(graphs)


def test_fast_rounds_end_when_they_go_in_circles():
    assert cm._fast_enough([9, 7, 8, 7, 6]) == 4
    assert cm._fast_enough([9, 7, 8, 6, 5]) == 5
    assert cm._fast_enough([4, 0, 0, 0]) == 4
    assert cm._fast_enough([]) == 0
