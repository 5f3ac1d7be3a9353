"""Materialising a result that several later steps start from."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors share: the session's ``spark.checkpoint.dir``, or the one set on its context."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and continue from the files.

    Later steps read only the columns they use, the optimizer sees real sizes, and
    losing an executor never means recomputing what lies before this point.
    """
    path = f"{shared_folder(df.sparkSession)}/sitefold-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
