"""Lineage cuts: results that several branches of a plan read are computed once."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one beside the warehouse's tables where that is unset."""
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    at = told or spark.sparkContext.getCheckpointDir()
    if not at:
        at = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_heliograph"
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the folder that executors share (see shared_dir).

    It is made from a cached copy, so that the plan runs once, and so that the size it is planned with from here on is the one it has. A
    checkpoint made of the plan itself would keep the plan's estimate, which joins multiply: in a loop its digits grow by powers.
    """
    shared_dir(df.sparkSession)
    if df.is_cached:
        return df.checkpoint()
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        df.select("*").count()
        return df.select("*").checkpoint()
    finally:
        df.unpersist()


def kept(df: DataFrame) -> DataFrame:
    """df as Parquet in the folder that executors share. For large tables that are read in several passes: columns are packed, and nothing is cached before."""
    at = f"{shared_dir(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.parquet(at)
