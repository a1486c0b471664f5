"""Columns that are computed once, whatever is done with them later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fenced(df: DataFrame, kept: list[str], **columns: Column) -> DataFrame:
    """The ``kept`` columns of ``df`` and the new ones.

    The optimiser moves a filter on a computed column below its definition and writes the definition out again; for
    long chains of expressions over whole texts that multiplies the work. A generated column stays where it is.
    """
    made = F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))).alias("_fenced")
    return df.select(*kept, made).select(*kept, *[F.col(f"_fenced.{name}").alias(name) for name in columns])
