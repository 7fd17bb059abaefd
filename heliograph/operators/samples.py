"""Several samples of a dataset as one: common genes, merged peaks, remapped counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliograph.functions.names import normalize_peak, parse_peak
from heliograph.operators import cells as cell_ops
from heliograph.operators import intervals
from heliograph.operators.cut import cut


def peak_intervals(atac: DataFrame) -> DataFrame:
    """peak, chrom, start, end of the distinct peaks whose names are intervals."""
    p = parse_peak(F.col("peak"))
    return atac.select("peak").distinct().withColumn("p", p).filter("p is not null").select("peak", "p.chrom", "p.start", "p.end")


def merge_samples(rna: DataFrame, atac: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rna, atac) of all samples: genes that every sample has; overlapping peaks united, counts summed over what they unite.

    Both facts have a column sample. With one sample they come back as they are.
    """
    n = rna.select("sample").distinct().count()
    if n <= 1:
        return rna, atac
    everywhere = rna.groupBy("gene").agg(F.count_distinct("sample").alias("n")).filter(F.col("n") == n).select("gene")
    own = cut(peak_intervals(atac))
    union = cut(intervals.merge(own, 0))
    to = intervals.best_overlap(own, union, "peak").select("peak", F.concat_ws(":", "chrom", F.concat_ws("-", "b_start", "b_end")).alias("merged"))
    moved = atac.join(to, "peak").groupBy("sample", "cell", F.col("merged").alias("peak")).agg(F.sum("value").alias("value"))
    return rna.join(everywhere, "gene", "left_semi"), moved


def filter_annotate(rna: DataFrame, atac: DataFrame, genes: DataFrame, bodies: DataFrame, fraction: float, n: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rna, atac, annotation): detected features, peak names normalised, annotated peaks only, both facts normalised.

    annotation: peak, gene, distance, peak_type. n: all cells, with values left or not.
    """
    rna = rna.join(cell_ops.detected(rna, "gene", n, fraction).select("gene"), "gene", "left_semi")
    atac = atac.join(cell_ops.detected(atac, "peak", n, fraction).select("peak"), "peak", "left_semi")
    atac = cut(cell_ops.collapse(atac, "peak", normalize_peak(F.col("peak"))))
    peaks = cut(peak_intervals(atac))
    found = intervals.annotate(peaks, genes, bodies).filter(F.trim("gene") != "")
    annotation = cut(peaks.join(found, ["chrom", "start", "end"]).select("peak", "gene", "distance", "peak_type"))
    atac = atac.join(annotation.select("peak").distinct(), "peak", "left_semi")
    return cell_ops.normalize(cut(rna.select("cell", "gene", "value"))), cell_ops.normalize(cut(atac)), annotation
