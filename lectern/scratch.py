"""Intermediate tables in the cluster's shared checkpoint folder.

A step whose result is read several times is written out as parquet under
``spark.checkpoint.dir``. That cuts the lineage (a lost executor re-reads files
instead of recomputing joins), gives the next step columns to prune and exact sizes
to plan with, and pins generated ids.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor shares")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="lectern-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/lectern/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    # zstd works in the heap; snappy's direct buffers wait for a collection of the heap.
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
