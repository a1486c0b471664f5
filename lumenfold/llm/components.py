"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lumenfold.session import scratch_path


def components(links: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """``node, root`` for every node of a link; the root is the smallest node of its component.

    Alternates two steps until nothing changes: every larger neighbour of a node is tied to the smallest
    neighbour, then every smaller one is. Both keep the components, only ever point nodes to smaller ones and
    end in stars. Each step aggregates minima (combined before the shuffle) and joins them back, so a hub is
    never gathered in one task. Each round is stored in the shared folder. Links with a null end are ignored.
    """
    spark = links.sparkSession
    edges = links.select(F.greatest(first, second).alias("u"), F.least(first, second).alias("v"))
    edges = edges.where(F.col(first).isNotNull() & F.col(second).isNotNull() & (F.col("u") > F.col("v"))).distinct()
    edges, before = _stored(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = edges.where("u > v").distinct()
        lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, now = _stored(moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        if now == before:
            break
        before = now
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The links as a stored table, and their number and a checksum taken while writing."""
    seen, path = Observation(), scratch_path(edges.sparkSession, "links")
    check = F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    edges.observe(seen, F.count("*").alias("rows"), check.alias("check")).write.parquet(path)
    found = seen.get
    return edges.sparkSession.read.schema(edges.schema).parquet(path), (found["rows"], found["check"])
