"""Readers: sparse matrices, gene annotation, sequences, tables, directory layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliograph.sources.matrix import cell_names, numbered_lines

HDF5_MAGIC = b"\x89HDF\r\n\x1a\n"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder of any store that Spark reads."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def is_hdf5(spark: SparkSession, path: str) -> bool:
    """By the first 8 bytes."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(b for b in (stream.read() for _ in HDF5_MAGIC) if b >= 0) == HDF5_MAGIC
    finally:
        stream.close()


def is_10x_dir(spark: SparkSession, path: str) -> bool:
    n = names_in(spark, path)
    return all(any(x.startswith(k) for x in n) for k in ("matrix", "features", "barcodes"))


def matrix_kind(spark: SparkSession, path: str) -> str:
    """h5mu, h5 (only if its content is), or mtx; in this order of preference."""
    n = names_in(spark, path)
    if any(x.endswith(".h5mu") for x in n):
        return "h5mu"
    if any(x.endswith(".h5") and is_hdf5(spark, f"{path}/{x}") for x in n):
        return "h5"
    if is_10x_dir(spark, path):
        return "mtx"
    raise FileNotFoundError(f"no matrix in {path}")


def read_mtx(spark: SparkSession, path: str) -> DataFrame:
    """cell, feature, feature_type, position, value of a 10x folder; zero entries are not stored."""
    n = names_in(spark, path)
    of = lambda k: f"{path}/{next(x for x in n if x.startswith(k))}"
    cells = cell_names(spark, path).withColumnRenamed("cell_number", "c")
    parts = F.split("line", "\t")
    features = numbered_lines(spark, of("features")).select(F.col("i").cast("int").alias("f"), F.coalesce(F.get(parts, 1), F.get(parts, 0)).alias("feature"), F.get(parts, 2).alias("feature_type"))
    row = F.split(F.trim("value"), r"\s+")
    # the first line that is no comment holds the dimensions; lines are numbered as they stand in the file (of several parts: the first by name)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(of("matrix")).select("value", place.alias("place")).filter(~F.startswith("value", F.lit("%")) & (F.size(row) == 3))
    head = lines.agg(F.min("place")).first()[0]
    body = lines.filter(F.col("place.line") != F.lit(head["line"])).select(row[0].cast("int").alias("f"), row[1].cast("int").alias("c"), row[2].cast("double").alias("value"))
    return body.filter("value <> 0").join(cells, "c").join(features, "f").select("cell", "feature", "feature_type", F.col("f").alias("position"), "value")


def clean_modalities(matrix: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rna: cell, gene, value), (atac: cell, peak, value): first of features that share a name, common cells."""
    from heliograph.operators.cells import common_cells, first_feature

    part = lambda kind, name: first_feature(matrix.filter(F.col("feature_type") == kind).withColumnRenamed("feature", name), name, "position").select("cell", name, "value")
    r, a = part("Gene Expression", "gene"), part("Peaks", "peak")
    both = common_cells(r, a)
    return r.join(both, "cell", "left_semi"), a.join(both, "cell", "left_semi")


def parse_gtf(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(genes: gene, chrom, tss, strand), (bodies: gene, chrom, start, end) of protein-coding records.

    lines: line_no, value. Nine fields are asked for; of a repeated attribute the last counts; if the first gene's chromosome lacks
    `chr`, all get it.
    """
    f = F.split("value", "\t")
    x = lines.filter(~F.startswith("value", F.lit("#")) & (F.size(f) == 9)).select("line_no", *[f[i].alias(n) for i, n in enumerate(("chrom", "source", "feature", "start", "end", "score", "strand", "frame", "attrs"))])
    def attr(name: str):
        every = F.regexp_extract_all("attrs", F.lit(rf'(?:^|[; ]){name} "([^"]*)"'), F.lit(1))
        return F.try_element_at(every, F.lit(-1))

    x = x.withColumns({"gene": attr("gene_name"), "type": F.coalesce(attr("gene_type"), attr("gene_biotype")), "start": F.col("start").cast("long"), "end": F.col("end").cast("long")})
    x = x.filter("type = 'protein_coding' AND feature IN ('gene', 'transcript') AND coalesce(gene, '') <> ''")
    bare = x.filter("feature = 'gene'").agg(F.min_by("chrom", "line_no").alias("c")).select((~F.startswith("c", F.lit("chr"))).alias("bare"))
    x = x.crossJoin(F.broadcast(bare)).withColumn("chrom", F.when(F.coalesce("bare", F.lit(False)), F.concat(F.lit("chr"), "chrom")).otherwise(F.col("chrom")))  # one row
    genes = x.filter("feature = 'gene'").select("gene", "chrom", F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("end")).alias("tss"), "strand")
    return genes, x.filter("feature = 'transcript'").select("gene", "chrom", "start", "end")


def read_gtf(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Plain or gzipped."""
    lines = spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id())
    return parse_gtf(lines)


def fasta_contigs(lines: DataFrame) -> DataFrame:
    """contig: names of the `>` lines."""
    return lines.filter(F.startswith("value", F.lit(">"))).select(F.regexp_extract("value", r"^>(\S+)", 1).alias("contig")).distinct()


def fai_contigs(lines: DataFrame) -> DataFrame:
    return lines.select(F.element_at(F.split("value", "\t"), 1).alias("contig")).filter("contig <> ''").distinct()


def parse_fasta(lines: DataFrame) -> DataFrame:
    """contig, at, sequence: contigs in pieces of CHUNK bases, each with the place of its first base. lines: line_no, value.

    Lines of one name follow each other, in the order of their numbers; a contig without bases gives no row. Names and places
    are running sums over ranges of lines, so no row or task holds a contig.
    """
    from heliograph.operators.intervals import chunked
    from heliograph.operators.order import running

    head = F.startswith("value", F.lit(">"))
    marked = running(lines.select("line_no", F.trim("value").alias("value"), head.cast("long").alias("_head")), "_head", ["line_no"], name="_part")
    names = marked.filter("_head = 1").select("_part", F.regexp_extract("value", r"^>(\S+)", 1).alias("contig"))
    body = marked.filter("_head = 0 AND value <> ''").withColumn("_bases", F.length("value").cast("long")).join(names, "_part")
    placed = running(body, "_bases", ["line_no"], by=("contig",), name="_end")
    return chunked(placed.select("contig", (F.col("_end") - F.col("_bases")).alias("at"), F.col("value").alias("sequence")))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """contig, at, sequence, in pieces as parse_fasta() gives them."""
    return parse_fasta(spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id()))


def read_strings(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A table with a header, all columns as text."""
    return spark.read.csv(path, header=True, sep=sep, inferSchema=False)


def read_motif_output(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated scan results under their names here; comments and empty files are passed over."""
    raw = spark.read.csv(path, header=True, sep="\t", comment="#", schema=None)
    if not raw.columns:
        return spark.createDataFrame([], "sequence_id string, Motif_ID string, motif_pvalue double")
    return rename_motif_output(raw)


def rename_motif_output(raw: DataFrame) -> DataFrame:
    from heliograph.operators.guards import require_columns

    #: Fixed values.
    out = raw.withColumnsRenamed({"sequence_name": "sequence_id", "motif_id": "Motif_ID", "motif_alt_id": "Motif_Alt_ID", "p-value": "motif_pvalue", "q-value": "motif_qvalue"})
    require_columns(out, "sequence_id", "Motif_ID", "motif_pvalue")
    return out.withColumn("motif_pvalue", F.col("motif_pvalue").try_cast("double"))


def read_datasets(spark: SparkSession, pattern: str, schema: T.StructType | None = None) -> DataFrame:
    """All files of a pattern .../<dataset>/<file>, with the folder's name as dataset."""
    r = spark.read.schema(schema) if schema else spark.read
    return r.parquet(pattern).withColumn("dataset", F.element_at(F.split(F.input_file_name(), "/"), -2))
