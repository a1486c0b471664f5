"""Neighbours from 32-bit products that are made again with 64 bits where they may count."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfold.operators import graph


def unit(rows):
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def frame(spark, rows, kind="float"):
    made = [("a", "u", i, [float(x) for x in row]) for i, row in enumerate(rows)]
    return spark.createDataFrame(made, f"app_id string, user_id string, entry_index long, vector array<{kind}>")


def test_pairs_of_a_small_scope_are_shared_by_tasks(spark):
    """Blocks are few bytes, so all pairs of a scope were brought into one task."""
    df = spark.range(120).selectExpr("'a' AS app_id", "'u' AS user_id", "id AS entry_index", "array(float(id), 1f) AS vector")
    pairs = graph._block_pairs(df, 8, once=True).select("l_block", "r_block", F.spark_partition_id().alias("task")).collect()
    assert len({frozenset((p.l_block, p.r_block)) for p in pairs}) == len(pairs) == 15 * 16 // 2
    assert len({p.task for p in pairs}) > 3
    of = [sum(p.l_block == block for p in pairs) for block in range(15)]
    assert max(of) <= min(of) + 1


@pytest.mark.parametrize("kind", ["float", "double"])
def test_neighbours_are_those_of_all_products(spark, kind):
    rng = np.random.default_rng(5)
    rows = unit(rng.normal(size=(90, 12)) * (rng.random((90, 12)) < 0.5))
    rows[60:] = rows[:30]  # copies tie
    rows = rows.astype(np.float32 if kind == "float" else np.float64).astype(np.float64)
    sims = np.round(rows @ rows.T, 9) + 0.0
    np.fill_diagonal(sims, -np.inf)
    for k, floor in ((4, None), (4, 0.4), (200, 0.1)):
        found = graph.knn_topk(frame(spark, rows, kind), k, floor, block_rows=16).collect()
        want = {
            (i, rank + 1, j): sims[i, j]
            for i in range(90)
            for rank, j in enumerate(np.lexsort((np.arange(90), -sims[i]))[: min(k, 89)].tolist())
            if sims[i, j] >= (-2.0 if floor is None else floor)
        }
        assert {(r.src, r["rank"], r.dst): r.sim for r in found} == want


def test_a_pair_at_the_floor_is_found_whatever_32_bits_say():
    """The pair's product is the floor itself; rounded to 32 bits it may fall below."""
    rng = np.random.default_rng(7)
    left, right = unit(rng.random((40, 300))).astype(np.float32), unit(rng.random((50, 300))).astype(np.float32)
    exact = np.round(left.astype(np.float64) @ right.astype(np.float64).T, 9)
    for r, c in ((0, 0), (17, 33), (39, 49)):
        floors = np.full(40, 9.0), np.full(50, 9.0)
        floors[0][r] = exact[r, c]
        found = {(i, j): sim for i, j, sim in zip(*graph._close_pairs(left, right, *floors, 60, False)) if sim >= floors[0][i]}
        assert found[r, c] == pytest.approx(exact[r, c], abs=2e-9)
        assert set(found) == {(r, int(j)) for j in np.flatnonzero(exact[r] >= exact[r, c])}
