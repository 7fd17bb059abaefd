"""One table over all datasets, a partition a dataset; a dataset's rows are replaced alone."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from heliograph.operators.cut import cut
from heliograph.sources import sinks

STATUS = "dataset string, status string, detail string, source_rows long, kept_rows long, source_keys long, kept_keys long, run string"


class KeyedTable:
    """Parquet at path/rows, partitioned by dataset, and an append-only log of status rows at path/status.

    Readers of other datasets never see a change: a write touches only the partitions of the datasets it is about.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.rows, self.log = spark, f"{path}/rows", f"{path}/status"

    def put(self, df: DataFrame, datasets: list[str]) -> None:
        """Replaces the rows of these datasets by df's, in one job; a dataset of theirs without rows in df is emptied.

        df has a column dataset with these names only; its plan runs once. Rows are dealt by dataset; a large dataset is split over several
        tasks and files, small ones share a task.
        """
        df = cut(df)
        found = {r[0] for r in df.select("dataset").distinct().collect()}  # a row a dataset
        if odd := found - set(datasets):
            raise ValueError(f"rows of other datasets: {odd}")
        w = df.hint("rebalance", "dataset").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        w.partitionBy("dataset").parquet(self.rows)
        for d in set(datasets) - found:
            fs, p = sinks._fs(self.spark, f"{self.rows}/dataset={d}")
            fs.delete(p, True)

    def get(self, schema: StructType | None = None) -> DataFrame:
        """All rows. schema is asked for only where the table may never have had a row. Names of datasets stay text, whatever they look like."""
        if schema is None:
            found = self.spark.read.option("mergeSchema", "true").parquet(self.rows).schema
            schema = StructType([StructField("dataset", StringType()) if f.name == "dataset" else f for f in found])
        return self.spark.read.schema(schema).parquet(self.rows)

    def append(self, status: DataFrame) -> None:
        status.write.mode("append").parquet(self.log)

    def latest(self) -> DataFrame:
        """The last status row of each dataset."""
        x = self.spark.read.schema(STATUS).parquet(self.log)
        best = F.max_by(F.struct(*[c for c in x.columns if c != "dataset"]), "run").alias("r")
        return x.groupBy("dataset").agg(best).select("dataset", "r.*")


def run_name() -> str:
    return time.strftime("%Y%m%dT%H%M%S", time.gmtime()) + f"{time.time_ns() % 10**9:09d}"
