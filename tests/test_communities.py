"""Communities on graphs whose best partition is known."""

import random

from pyspark.sql import functions as F

from lumenfold.operators import communities as cm
from lumenfold.session import materialize

KEYS = ["graph"]


def edges_of(spark, graphs):
    rows = [(g, min(e), max(e), float(w)) for g, edges in graphs.items() for e, w in edges.items()]
    return materialize(spark.createDataFrame(rows, "graph string, src long, dst long, w double"), "test-edges")


def planted(groups, size, inside, outside, seed):
    draw = random.Random(seed)
    n = groups * size
    chance = lambda a, b: inside if a // size == b // size else outside
    return {(a, b): 1 for a in range(n) for b in range(a + 1, n) if draw.random() < chance(a, b)}


def ring(cliques, size):
    edges = {(c * size + a, c * size + b): 1 for c in range(cliques) for a in range(size) for b in range(a + 1, size)}
    return edges | {(c * size, (c + 1) % cliques * size + 1): 1 for c in range(cliques)}


def test_planted_partitions_are_found_and_hang_together(spark):
    size = {"planted": 20, "ring": 6}
    graphs = {"planted": planted(4, 20, 0.6, 0.04, 3), "ring": ring(8, 6)}
    edges = edges_of(spark, graphs)
    placed = materialize(cm.detect_communities(edges, KEYS, resolution=1.0, refined=True), "test-placed")
    found = {}
    for r in placed.collect():
        found.setdefault((r["graph"], r["node"] // size[r["graph"]]), set()).add(r["community"])
    assert all(len(c) == 1 for c in found.values()) and len({(g, *c) for (g, _), c in found.items()}) == 4 + 8
    known = placed.withColumn("community", F.floor(F.col("node") / F.when(F.col("graph") == "planted", 20).otherwise(6)))
    best = {r["graph"]: r["quality"] for r in cm.quality(edges, known, KEYS, 1.0).collect()}
    got = {r["graph"]: r["quality"] for r in cm.quality(edges, placed, KEYS, 1.0).collect()}
    assert all(got[g] >= best[g] - 1e-9 for g in best)
    assert cm.improving_moves(edges, placed, KEYS, 1.0).count() == 0
    assert cm.improving_parts(edges, placed, KEYS, 1.0).count() == 0


def test_refinement_cuts_a_community_that_only_a_thread_holds(spark):
    graphs = {"two": {k: 1 for k in ring(2, 6) if k != (6, 1)}}  # two cliques and one link
    edges = edges_of(spark, graphs)
    one = spark.range(12).select(F.lit("two").alias("graph"), F.col("id").alias("node"), F.lit(0).cast("long").alias("community"))
    links, state = cm._state_of(edges, one, KEYS, 1.0)
    parts = {}
    for r in cm.refine(links, state, KEYS, "7").collect():
        parts.setdefault(r["part"], set()).add(r["node"] // 6)
    assert all(len(sides) == 1 for sides in parts.values())
    placed, moved = cm._move_parts(links, state, KEYS, "7")
    sides = {}
    for r in placed.collect():
        sides.setdefault(r["label"], set()).add(r["node"])
    assert moved and sorted(map(sorted, sides.values())) == [list(range(6)), list(range(6, 12))]


def test_many_nodes_join_a_community_in_one_round(spark):
    """One move a round for each community made as many rounds as a community has nodes."""
    hub = {(a, b): 1 for a in range(10) for b in range(a + 1, 10)}
    late = {(a, n): 1 for n in range(10, 40) for a in (n % 10, (n + 3) % 10, (n + 5) % 10)}
    edges = edges_of(spark, {"hub": hub | late, "far": {(a, b): 1 for a in range(60) for b in range(a + 1, 60)}})
    start = edges.selectExpr("graph", "explode(array(src, dst)) AS node").distinct()
    start = start.withColumn("community", F.when((F.col("graph") == "far") | (F.col("node") < 10), 0).otherwise(F.col("node")).cast("long"))
    start = materialize(start, "test-start")
    links, state = cm._state_of(edges, start, KEYS, 0.5)
    after = materialize(cm._move_round(links, state, KEYS, "", False, True), "test-after")
    moved = after.where("graph = 'hub' and node >= 10 and label = 0").count()
    assert moved > 15
    q = lambda placed: {r["graph"]: r["quality"] for r in cm.quality(edges, placed, KEYS, 0.5).collect()}
    before, then = q(start), q(after.withColumnRenamed("label", "community"))
    assert then["hub"] > before["hub"]


def test_moves_of_one_round_raise_the_quality(spark):
    """From random communities, where moves get in each other's way, every round adds to the quality."""
    graphs = {f"g{i}": planted(4, 10, 0.6, 0.1, i) for i in range(6)}
    edges = edges_of(spark, graphs)
    placed = edges.selectExpr("graph", "explode(array(src, dst)) AS node").distinct()
    placed = materialize(placed.withColumn("community", F.pmod(F.xxhash64("graph", "node"), F.lit(5))), "test-placed")
    quality = lambda p: {r["graph"]: r["quality"] for r in cm.quality(edges, p, KEYS, 1.0).collect()}
    before = quality(placed)
    for _ in range(3):
        links, state = cm._state_of(edges, placed, KEYS, 1.0)
        after = materialize(cm._move_round(links, state, KEYS, "", False, True), "test-after")
        improving = {r["graph"] for r in after.where("improving").select("graph").distinct().collect()}
        placed = after.withColumnRenamed("label", "community")
        then = quality(placed)
        assert improving and all(then[g] > before[g] for g in improving)
        before = then


def test_components_need_no_moves(spark, monkeypatch):
    """At resolution 0 communities are the components, which take few rounds; moves took some for each level."""
    monkeypatch.setattr(cm, "_settle", None)
    path = {(i, i + 1): 0.5 for i in range(30)} | {(100 + i, 101 + i): 2 for i in range(3)}
    placed = cm.detect_communities(edges_of(spark, {"a": path, "b": {(4, 9): 1}}), KEYS, resolution=0.0)
    got = {(r["graph"], r["node"]): r["community"] for r in placed.collect()}
    assert got == {**{("a", i): 0 for i in range(31)}, **{("a", 100 + i): 100 for i in range(4)}, ("b", 4): 4, ("b", 9): 4}


def test_links_that_are_not_positive_are_weighed(spark):
    edges = edges_of(spark, {"a": {(0, 1): 1, (1, 2): -1, (2, 3): 1}})
    got = {r["node"]: r["community"] for r in cm.detect_communities(edges, KEYS, resolution=0.0).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2}
