"""Batches between Spark and Python workers."""

from __future__ import annotations

from pyspark.sql import SparkSession

ROWS, BYTES = 1000, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on, this session hands whole texts to Python in small batches, which bounds a task's memory.

    Smaller settings of the session stay. It changes no result, and has to hold when a lazy frame runs.
    """
    for key, most in (("maxRecordsPerBatch", ROWS), ("maxBytesPerBatch", BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        held = int(str(spark.conf.get(name)).rstrip("b"))
        if held <= 0 or held > most:
            spark.conf.set(name, str(most))
