"""The corpus pipeline: language ID, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; run() writes each stage's result to the
shared folder as Parquet and rereads it as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliograph.llm import decontaminate, language_id, line_dedup, minhash_dedup, packing
from heliograph.llm.common import Spool, maybe_in


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not told with confidence go, and so do null texts and texts without a letter."""
    found = language_id.identify(docs, language_id.fit(docs))
    return found.filter(~F.col("lang_rejected")).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later near-copies of lines go; a document all of whose lines with words go, goes too. Null and empty texts stay as they are."""
    out = line_dedup.dedup_lines(docs)
    left = (F.size("lines_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    n = {"n_chars": F.when(F.size("lines_removed") == 0, F.col("n_chars")).otherwise(F.length("text"))} if "n_chars" in docs.columns else {}
    return out.filter(left).withColumns(n).select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays: the one with the smallest doc_id; of rows that share that, the least one.

    Rows without a doc_id and texts without words are copies of nothing and stay.
    """
    gone = minhash_dedup.near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    several = left.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1")
    if several.isEmpty():
        return left
    repeated = maybe_in(left, "CAST(doc_id AS BIGINT)", several.select("doc_id"))
    once = repeated.groupBy("doc_id").agg(F.min(F.struct("text", *[c for c in docs.columns if c not in ("doc_id", "text")])).alias("r"))
    others = maybe_in(left, "CAST(doc_id AS BIGINT)", several.select("doc_id"), negate=True).unionByName(left.filter("doc_id is null"))
    return others.unionByName(once.select(*[F.col(c) if c == "doc_id" else F.col(f"r.{c}").alias(c) for c in docs.columns]))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts hold none. With no items all stay."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of token sequences; a null or empty text is its closing id alone."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("minhash_dedup", dedup_documents),
    ("decontaminate", decontaminated),
    ("packing", pack),
]

#: Language models, Jaccard components and byte-level BPE are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    spool = Spool(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES:
        docs = spool.write(stage(spark, docs, sf_dir))
        if before is not None:
            spool.drop(before)
        before = docs
    return docs
