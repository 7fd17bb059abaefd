"""The driver's tables as cells, facts, intervals and scores; as DataFrames here, as SQL in BASE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHROMS = ("view", "click", "signup", "purchase", "error")

#: Shared SQL, independent of the code below.
BASE = """
cells AS (SELECT o_orderkey AS cell, r_name AS project_id, n_name AS sample_id, c_mktsegment AS gpt_cell_type, o_orderstatus, o_orderpriority
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
rna AS (SELECT l_orderkey AS cell, p_brand AS gene, sum(l_quantity) AS value FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
atac AS (SELECT l_orderkey AS cell, l_suppkey AS peak, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2),
links AS (SELECT DISTINCT l_suppkey AS peak, p_brand AS gene FROM lineitem JOIN part ON l_partkey = p_partkey),
peaks AS (SELECT event_type AS chrom, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 60000000 AS "start", (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 60000000 + CAST(floor(value / 10) AS BIGINT) + 1 AS "end" FROM events),
genes AS (SELECT c_custkey AS gene, ['view', 'click', 'signup', 'purchase', 'error'][c_custkey % 5 + 1] AS chrom, (c_custkey * 7919) % 43200 AS tss, CASE WHEN c_custkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM customer),
hits AS (SELECT p_brand AS tf, l_suppkey AS peak, min(l_tax) AS motif_pvalue FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
"""


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def cells(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    j = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.select(F.col("o_orderkey").alias("cell"), F.col("r_name").alias("project_id"), F.col("n_name").alias("sample_id"), F.col("c_mktsegment").alias("gpt_cell_type"), "o_orderstatus", "o_orderpriority")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))


def rna(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).groupBy(F.col("l_orderkey").alias("cell"), F.col("p_brand").alias("gene")).agg(F.sum("l_quantity").alias("value"))


def atac(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("cell"), F.col("l_suppkey").alias("peak")).agg(F.sum("l_quantity").alias("value"))


def links(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).select(F.col("l_suppkey").alias("peak"), F.col("p_brand").alias("gene")).distinct()


def peaks(spark: SparkSession, d: str) -> DataFrame:
    start = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts) div 60000000")
    return table(spark, d, "events").select(F.col("event_type").alias("chrom"), start.alias("start"), (start + F.floor(F.col("value") / 10) + 1).alias("end"))


def genes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(k.alias("gene"), F.element_at(F.array(*map(F.lit, CHROMS)), (k % 5 + 1).cast("int")).alias("chrom"), ((k * 7919) % 43200).alias("tss"), F.when(k % 2 == 0, "+").otherwise("-").alias("strand"))


def bodies(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts of up to 20 positions from the start site."""
    plus = F.col("strand") == "+"
    width = F.col("gene") % 20 + 1
    return genes(spark, d).select("gene", "chrom", F.when(plus, F.col("tss")).otherwise(F.greatest(F.col("tss") - width, F.lit(0))).alias("start"), F.when(plus, F.col("tss") + width).otherwise(F.col("tss") + 1).alias("end"))


def hits(spark: SparkSession, d: str) -> DataFrame:
    return _lines(spark, d).groupBy(F.col("p_brand").alias("tf"), F.col("l_suppkey").alias("peak")).agg(F.min("l_tax").alias("motif_pvalue"))
