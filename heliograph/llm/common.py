"""Helpers shared by the corpus operators: shared-folder tables, word splitting, hashing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: White space between words: the blank and U+0009 to U+000D (what bytes.split() splits at).
BLANKS = "[\\x20\\x09-\\x0D]+"
#: Words in a shingle, and the similarity from which two texts are near-duplicates.
SHINGLE, SIMILARITY = 5, 0.75


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one beside the warehouse's tables where that is unset."""
    set_to = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not set_to:
        set_to = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_heliograph"
        spark.sparkContext.setCheckpointDir(set_to)
    return set_to.rstrip("/")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of texts are bounded by bytes and rows, so that Python workers' memory doesn't grow with texts' lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


#: Lets Spark remove a statement's shuffle files when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Spool:
    """Tables written to the shared folder to cut lineage; drop() removes those no longer needed, close() all of them.

    Once a table is written its shuffle files serve nothing, so they go at once.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        bounded_batches(spark)
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0

    def write(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        before = self.spark.conf.get(_CLEANUP, "false")
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._spool_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            self._delete(t._spool_path)

    def close(self) -> None:
        self._delete(self.root)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def shares(df: DataFrame, keys: DataFrame, on: list[str], name: str) -> DataFrame:
    """df with a boolean: whether the row's columns `on` are among the rows of keys."""
    marks = keys.select(*on).distinct().withColumn(name, F.lit(True))
    return df.join(marks, on, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def maybe_in(df: DataFrame, key: str, keys: DataFrame, most_bits: int = 1 << 24, negate: bool = False) -> DataFrame:
    """df without most of the rows whose key (a SQL expression, a long) is not among keys (one long column).

    A bitmap of hashes, at most 2 MB whatever the number of keys, is a scalar of the scan, so that a join with the keys shuffles
    little else; with very many keys it lets more through, and the join still decides. negate: the other rows, none of
    which has its key among keys.
    """
    spark, column = df.sparkSession, keys.columns[0]
    n = keys.count()
    bits = 1 << min(most_bits.bit_length() - 1, max(12, (16 * n).bit_length()))
    slot = f"CAST(pmod(xxhash64({{}}), {bits}) AS INT)"
    h = slot.format(column)
    by = keys.filter(F.col(column).isNotNull()).select(F.expr(f"shiftright({h}, 6)").alias("w"), F.expr(f"shiftleft(1L, {h} & 63)").alias("b")).groupBy("w").agg(F.expr("bit_or(b)").alias("b"))
    dense = spark.range(bits // 64).select(F.col("id").cast("int").alias("w")).join(by, "w", "left").select("w", F.coalesce("b", F.lit(0).cast("long")).alias("b"))
    names = [f"_heliograph_{uuid.uuid4().hex[:12]}" for _ in range(2)]
    dense.agg(F.sort_array(F.collect_list(F.struct("w", "b"))).alias("x")).select(F.col("x.b").alias("m")).createOrReplaceTempView(names[0])
    df.createOrReplaceTempView(names[1])
    at = slot.format(key)
    out = spark.sql(f"SELECT * FROM {names[1]} WHERE {key} IS NOT NULL AND {'NOT' if negate else ''} (shiftrightunsigned(element_at((SELECT m FROM {names[0]}), shiftright({at}, 6) + 1), {at} & 63) & 1L) = 1L")
    for x in names:
        spark.catalog.dropTempView(x)
    return out


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text with A-Z in lower case; null and blank texts have none."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BLANKS), lambda w: w != "")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """Word -> uint64 with a bounded memo."""

    def __init__(self, most: int = 150_000) -> None:
        self.memo: dict[bytes, int] = {}
        self.most = most

    def __call__(self, ws: list[bytes]) -> np.ndarray:
        import xxhash

        memo, h = self.memo, xxhash.xxh64_intdigest
        if len(memo) > self.most:
            memo.clear()
        out = []
        for w in ws:
            x = memo.get(w)
            if x is None:
                x = memo[w] = h(w)
            out.append(x)
        return np.array(out, dtype=np.uint64)


_POW = [np.uint64(pow(0x9E3779B97F4A7C15, i, 1 << 64)) for i in range(64)]


def shingle_hashes(text: str | None, hashes: WordHashes, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a whole text.

    A text with fewer words is one shingle; a null or blank text has none.
    """
    ws = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not ws:
        return np.empty(0, np.uint64)
    h = hashes(ws)
    n = len(h)
    width = min(k, n)
    acc = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        acc += h[i : n - width + 1 + i] * _POW[i + 1]
    return np.unique(mix64(acc + np.uint64(width)))


def id_sent(column: str) -> Column:
    """An id column as strings, for Python: a batch of longs with a null in it would come as floats, which round ids over 2**53."""
    return F.col(column).cast("long").cast("string").alias(column)


def id_received(column: str) -> Column:
    return F.col(column).cast("long").alias(column)


def texts(batches: Iterator, column: str = "text") -> Iterator:
    """Rows of pandas batches, with null text as None."""
    for pdf in batches:
        yield pdf, [None if x is None or x != x else x for x in pdf[column].tolist()]
