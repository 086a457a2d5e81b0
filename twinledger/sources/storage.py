"""Intermediate results on shared storage.

A result that several later steps use is written once, as Parquet, under the folder the cluster names in
``spark.checkpoint.dir``.  It survives the loss of executors, cuts the lineage and, unlike an RDD
checkpoint, tells the optimizer its size.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set and all tasks run in this process, a new one for this session."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="twinledger-")
        spark.conf.set(CHECKPOINT_DIR, folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/twinledger/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, by: str | None = None, dense: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written rows.

    ``by`` names a column with few values that later steps filter on: they then read only its folder.
    ``dense`` files take less disk, as texts should, and a little more time.
    """
    path = new_path(df.sparkSession, name)
    writer = df.write.partitionBy(by) if by else df.write
    if dense:
        writer = writer.option("compression", "zstd")
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
