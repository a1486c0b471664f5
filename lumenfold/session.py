"""Session helpers: where durable intermediate data goes and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LOCAL_BASE: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting falls back to a temporary folder of its own; a cluster
    session without it is an error, because a machine-local folder would be lost
    with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if sc.applicationId not in _LOCAL_BASE:
        _LOCAL_BASE[sc.applicationId] = tempfile.mkdtemp(prefix="lumenfold-")
    return _LOCAL_BASE[sc.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage so that later plans start from stored data, which survives
    executor loss. In loops this is better than ``checkpoint()``: a checkpoint
    carries the size estimate of its plan, which multiplies with every join and
    soon stalls the planner, while a stored table has its real size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_counting(df: DataFrame, label: str, condition: Column) -> tuple[DataFrame, int]:
    """``materialize`` and the number of rows that meet ``condition``, counted while writing."""
    seen = Observation()
    stored = materialize(df.observe(seen, F.count(F.when(condition, 1)).alias("rows")), label)
    return stored, seen.get["rows"]


def kept_apart(df: DataFrame, row_bytes: int, limit: int = 10 << 20) -> DataFrame:
    """``df``, a stored table, with a hint that it is shuffled if its rows take more than ``limit`` bytes.

    Spark goes by the size of files. Those of vectors that are mostly zeros are a hundred times smaller than their
    rows, so it would bring gigabytes of rows to the driver to broadcast them. Counting a stored table reads no rows.
    """
    return df.hint("merge") if df.count() * row_bytes > limit else df


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark gives it, so that tasks and readers mean the same place."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(named).toString()
