"""Numbering rows inside a scope without sending a whole scope to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dense_index(
    df: DataFrame, keys: list[str], order: str, out: str = "entry_index", start: int = 0, width: int = 1024
) -> DataFrame:
    """Number rows 0, 1, 2, … per ``keys`` by the whole number ``order``.

    Rows are cut into ranges of ``width`` order values. Each range holds at most
    ``width`` different values and is ranked on its own; only one count per range
    is summed up per key, so a key with a third of all rows is still spread out.
    Rows without a number come first, rows with equal numbers in the order of a
    hash of their columns, and null keys are a key of their own: no row is lost.
    """
    ranged = df.withColumn("_range", F.coalesce(F.floor(F.col(order) / width), F.lit(-(2**62))))
    group = [*keys, "_range"]
    counts = ranged.groupBy(*group).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    offsets = counts.select(*[F.col(k).alias(f"_of_{k}") for k in group], offset)
    ties = F.xxhash64(*[F.col(name) for name, kind in df.dtypes if "map<" not in kind and kind != "variant"])
    inside = Window.partitionBy(*group).orderBy(order, ties)
    numbered = ranged.withColumn("_rank", F.row_number().over(inside))
    return (
        numbered.join(offsets, [numbered[k].eqNullSafe(offsets[f"_of_{k}"]) for k in group])
        .withColumn(out, (F.col("_offset") + F.col("_rank") + (start - 1)).cast("long"))
        .drop("_rank", "_offset", "_range", *[f"_of_{k}" for k in group])
    )
