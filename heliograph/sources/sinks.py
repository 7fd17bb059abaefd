"""Writers."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class EmptyOutput(ValueError):
    """Nothing to write where something must be."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


#: The name of a table's manifest; Spark's readers pass over names that begin so.
MANIFEST = "_MANIFEST.json"


def publish(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), allow_empty: bool = True, manifest: str | None = None) -> None:
    """Written beside the target, which is then set aside, replaced and deleted; a failure puts it back.

    manifest: a text that lies in the table's folder and so comes and goes with its data.
    """
    spark = df.sparkSession
    fs, target = _fs(spark, path)
    beside = lambda kind: spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{kind}-{uuid.uuid4().hex}")
    staging, aside = beside("tmp"), beside("old")
    try:
        w = df.write.option("compression", "zstd")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(staging.toString())
        if not allow_empty and not spark.read.schema(df.schema).parquet(staging.toString()).take(1):
            raise EmptyOutput(path)
        if manifest is not None:
            write_report(spark, {"made_from": manifest}, f"{staging.toString()}/{MANIFEST}")
        there = fs.exists(target)
        if there and not fs.rename(target, aside):
            raise OSError(f"{target} could not be set aside")
        try:
            if not fs.rename(staging, target):
                raise OSError(f"{staging} could not be renamed")
        except Exception:
            if there:
                fs.rename(aside, target)
            raise
        fs.delete(aside, True)
    finally:
        fs.delete(staging, True)


def is_complete(spark: SparkSession, path: str, columns: tuple[str, ...] = ()) -> bool:
    """Whether a stage's output is there as a whole, with the columns asked for."""
    fs, p = _fs(spark, f"{path}/_SUCCESS")
    return fs.exists(p) and set(columns) <= set(spark.read.parquet(path).columns)


def manifest(spark: SparkSession, path: str) -> str | None:
    """What a whole table was made from, as publish() was told; None where there is none."""
    if not is_complete(spark, path):
        return None
    return (read_report(spark, f"{path}/{MANIFEST}") or {}).get("made_from")


def stamp(spark: SparkSession, path: str | None) -> list:
    """Names, lengths and times of change of a file, or of all files below a folder: other contents have another stamp."""
    if not path:
        return []
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return [path, "absent"]
    out, it = [], fs.listFiles(p, True)
    while it.hasNext():
        f = it.next()
        out.append([f.getPath().getName(), f.getLen(), f.getModificationTime()])
    return sorted(out)


def write_sparse(fact: DataFrame, feature: str, values: str, index: str, cell: str = "cell") -> None:
    """The fact by cell, and its inverted index (feature, cell) by feature; nothing stored is an error. cell: the column's name there."""
    publish(fact.select(F.col("cell").alias(cell), feature, F.col("value").cast("float").alias("value")), values, allow_empty=False)
    publish(fact.select(feature, F.col("cell").alias(cell)).repartitionByRange(feature).sortWithinPartitions(feature, cell), index)


def write_small(df: DataFrame, path: str, kind: str = "csv", sep: str = ",") -> None:
    """One file, for tables of some rows (markers, groups, summaries)."""
    one = df.coalesce(1).write.mode("overwrite")
    one.json(path) if kind == "json" else one.csv(path, header=True, sep=sep)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_report(spark: SparkSession, rows: list | dict, path: str) -> None:
    write_text(spark, json.dumps(rows, indent=2, default=str), path)


def read_report(spark: SparkSession, path: str) -> list | dict | None:
    """What write_report wrote; None where nothing is."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
