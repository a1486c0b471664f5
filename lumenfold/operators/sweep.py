"""Choosing clustering settings per scope: candidates, scores, selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenfold.functions import vectors as vx
from lumenfold.schema import SCOPE, SMALL_SCOPE_LIMIT, SMALL_SCOPE_SETTING, SWEEP

CANDIDATE = [*SCOPE, "candidate_id"]


def _clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def default_k(n: Column) -> Column:
    """Neighbours per entry: √n rounded half to even, between 2 and 24."""
    return _clamp(F.bround(F.sqrt(F.greatest(n, F.lit(1)))), 2, 24).cast("int")


def default_min_size(n: Column, granularity: str) -> Column:
    fine = granularity == "fine"
    large = _clamp(F.bround(F.sqrt(n) / (6 if fine else 2)), 4, 6 if fine else 12)
    return F.when(n < 40, 2).when(n < 500, 4 if fine else 5).otherwise(large).cast("int")


def param_candidates(sizes: DataFrame, granularity: str = "balanced") -> DataFrame:
    """Settings to try per scope. ``sizes`` is ``(scope, n)``; a narrow projection."""
    if granularity not in SWEEP:
        raise ValueError("granularity must be 'balanced' or 'fine'")
    made = lambda i, r, t: F.struct(
        F.lit(i).alias("candidate_id"), F.lit(r).alias("resolution"), F.lit(t).alias("min_similarity")
    )
    usual = F.array(*[made(i, r, t) for i, (r, t) in enumerate(SWEEP[granularity])])
    extra = F.array(made(len(SWEEP[granularity]), *SMALL_SCOPE_SETTING))
    settings = F.when(F.col("n") < SMALL_SCOPE_LIMIT, F.concat(usual, extra)).otherwise(usual)
    return sizes.select(
        *SCOPE,
        "n",
        default_k(F.col("n")).alias("k"),
        default_min_size(F.col("n"), granularity).alias("min_cluster_size"),
        F.explode(settings).alias("_s"),
    ).select(*SCOPE, "n", "k", "min_cluster_size", "_s.*")


def range_score(value: Column, low: Column, high: Column) -> Column:
    """1 inside the range, falling off in proportion outside it."""
    below = F.when(low > 0, F.greatest(F.lit(0.0), value / low)).otherwise(0.0)
    beyond = F.greatest(F.lit(0.0), 1.0 - (value - high) / F.greatest(high, F.lit(1.0)))
    return F.when((value >= low) & (value <= high), 1.0).when(value < low, below).otherwise(beyond)


def score_communities(
    candidates: DataFrame, communities: DataFrame, members: DataFrame, vectors: DataFrame, granularity: str = "balanced"
) -> DataFrame:
    """Candidates with the pieces of their score and the ``score``.

    ``communities`` is ``(candidate, community, size)``; ``members`` is
    ``(candidate, node, community)`` of the kept communities.
    """
    cohesion = cluster_sums(members, vectors, CANDIDATE).withColumn("cohesion", pair_mean())
    tiny_limit = F.greatest(
        F.col("min_cluster_size") + 1, F.ceil(F.col("min_cluster_size") * F.lit(1.35))
    )
    sized = communities.select(*CANDIDATE, "community", "size").join(
        candidates.select(*CANDIDATE, "min_cluster_size"), CANDIDATE
    )
    shape = sized.groupBy(*CANDIDATE).agg(
        F.count("*").alias("clusters"),
        F.sum("size").alias("covered"),
        F.max("size").alias("largest"),
        F.sum((F.col("size") <= tiny_limit).cast("long")).alias("tiny"),
    )
    weighted = (
        cohesion.where("size >= 2")
        .groupBy(*CANDIDATE)
        .agg((F.sum(F.col("cohesion") * F.col("size")) / F.sum("size")).alias("cohesion"))
    )
    joined = candidates.join(shape, CANDIDATE, "left").join(weighted, CANDIDATE, "left")
    filled = joined.fillna({"clusters": 0, "covered": 0, "largest": 0, "tiny": 0, "cohesion": 0.0})
    root = F.sqrt(F.greatest("n", F.lit(1)))
    centre = _clamp(root * 1.35 if granularity == "fine" else root, 2.0, 30.0)
    low, high = (0.35, 0.80) if granularity == "fine" else (0.30, 0.70)
    share = F.col("largest") / F.col("n")
    pieces = filled.withColumns(
        {
            "count_score": range_score(
                F.col("clusters").cast("double"), F.greatest(F.lit(1.0), centre * 0.55), F.least(F.lit(45.0), centre * 1.45)
            ),
            "coverage_score": range_score(F.col("covered") / F.col("n"), F.lit(low), F.lit(high)),
            "fragmentation": F.when(F.col("clusters") > 0, F.col("tiny") / F.col("clusters")).otherwise(0.0),
            "giant": F.when(share > 0.25, F.least(F.lit(1.0), (share - 0.25) / 0.50)).otherwise(0.0),
        }
    )
    score = (
        F.lit(1.2) * F.col("count_score")
        + F.lit(1.4) * F.col("coverage_score")
        + F.col("cohesion")
        - F.lit(0.7) * F.col("fragmentation")
        - F.lit(1.2) * F.col("giant")
    )
    return pieces.withColumn("score", F.when(F.col("n") > 0, score).otherwise(0.0))


def select_params(scored: DataFrame) -> DataFrame:
    """Best-scored setting per scope; ties by smaller threshold, resolution, k."""
    # Equal scores reached by different orders of summation must tie.
    order = Window.partitionBy(*SCOPE).orderBy(F.desc(F.round("score", 9)), "min_similarity", "resolution", "k")
    return scored.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def cluster_sums(members: DataFrame, vectors: DataFrame, keys: list[str]) -> DataFrame:
    """Per community: size, vector sum and the sum of squared lengths.

    ``members`` is ``(keys, node, community)``. One join by entry, then one
    aggregate that is combined on the map side, so a giant community costs one
    vector per map task.
    """
    joined = members.select(*keys, "community", F.col("node").alias("entry_index")).join(
        vectors.select(*SCOPE, "entry_index", "vector"), [*SCOPE, "entry_index"]
    )
    return joined.groupBy(*keys, "community").agg(
        F.count("*").alias("size"),
        vx.vector_sum(F.col("vector")).alias("total"),
        F.sum(vx.squared_length(F.col("vector"))).alias("squares"),
    )


def pair_mean() -> Column:
    """Mean cosine over all pairs of a community, from its sums; 0 for a single member."""
    size = F.col("size").cast("double")
    mean = (vx.squared_length(F.col("total")) - F.col("squares")) / (size * (size - 1))
    return F.when(size > 1, mean).otherwise(0.0)
