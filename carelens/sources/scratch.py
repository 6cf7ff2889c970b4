"""Intermediate tables in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names. Only a session on
    one machine may do without the setting; it gets a folder of its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="carelens-"))
        folder = context.getCheckpointDir()
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, by: str) -> DataFrame:
    """Writes a table to the shared folder, foldered by a column, and reads it again: what
    follows depends neither on the executors that made it nor on its plan."""
    path = scratch(df.sparkSession, name)
    df.write.partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
