"""Cells and features: quality control, detection, normalisation, merging of names.

Facts are long and sparse: (cell, feature, value); an absent row is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliograph.operators.cut import cut


def qc_metrics(fact: DataFrame, feature: str) -> tuple[DataFrame, DataFrame]:
    """By cell: n_features, total. By feature: n_cells. Zero values don't count."""
    on = fact.filter("value <> 0")
    return on.groupBy("cell").agg(F.count("*").alias("n_features"), F.sum("value").alias("total")), on.groupBy(feature).agg(F.count("*").alias("n_cells"))


def qc_cells(rna: DataFrame, atac: DataFrame, cell_genes: int = 200, cell_total: float = 100) -> DataFrame:
    """cell: those that pass. They are all cells from here on, whatever is left of their values when features are filtered."""
    rc, ac = qc_metrics(rna, "gene")[0], qc_metrics(atac, "peak")[0]
    return rc.filter(F.col("n_features") >= cell_genes).select("cell").join(ac.filter(F.col("total") >= cell_total).select("cell"), "cell", "left_semi")


def qc_filter(rna: DataFrame, atac: DataFrame, gene_cells: int = 3, cell_genes: int = 200, peak_cells: int = 3, cell_total: float = 100) -> tuple[DataFrame, DataFrame]:
    """Both facts for cells and features that pass; all metrics are of the facts as given."""
    rg, ap = qc_metrics(rna, "gene")[1], qc_metrics(atac, "peak")[1]
    cells = qc_cells(rna, atac, cell_genes, cell_total)
    r = rna.join(cells, "cell", "left_semi").join(rg.filter(F.col("n_cells") >= gene_cells), "gene", "left_semi")
    a = atac.join(cells, "cell", "left_semi").join(ap.filter(F.col("n_cells") >= peak_cells), "peak", "left_semi")
    return r, a


def detected(fact: DataFrame, feature: str, n_cells: int, fraction: float) -> DataFrame:
    """Features stored for more than fraction * n_cells cells."""
    return fact.groupBy(feature).agg(F.count("*").alias("n")).filter(F.col("n") > fraction * n_cells).select(feature, "n")


def detected_in_all(fact: DataFrame, cells: DataFrame, feature: str, sample: str, fraction: float) -> DataFrame:
    """Features present in every sample, and stored for more than fraction of all cells."""
    size = cells.agg(F.count("*").alias("n_all"), F.count_distinct(sample).alias("n_samples"))
    per = fact.join(cells.select("cell", sample), "cell").groupBy(feature).agg(F.count("*").alias("n"), F.count_distinct(sample).alias("s"))
    totals = size.first()
    return per.filter((F.col("s") == totals["n_samples"]) & (F.col("n") > fraction * totals["n_all"])).select(feature, "n")


def normalize(fact: DataFrame) -> DataFrame:
    """log1p(value * median cell total / cell total)."""
    totals = fact.groupBy("cell").agg(F.sum("value").alias("total")).filter("total > 0")
    target = median(totals.groupBy("total").agg(F.count("*").alias("n")), "total", "n") or 1.0
    return fact.join(totals, "cell").withColumn("value", F.log1p(F.col("value") * F.lit(target) / F.col("total"))).drop("total")


def median(counts: DataFrame, value: str, n: str, bins: int = 1024) -> float | None:
    """The median of values with their counts: histograms of the stretch that holds the middle, narrowed until it holds one value.

    Exact; what reaches the driver is one row a bin.
    """
    x = cut(counts.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"), F.col(n).alias("n")))
    every = x.agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if not every["n"]:
        return None

    def at(i: int) -> float:
        """The value at place i, from 0."""
        lo, hi = every["lo"], every["hi"]
        while lo < hi:
            bin_ = F.least(F.floor((F.col("v") - F.lit(lo)) * F.lit(bins / (hi - lo))), F.lit(bins - 1))
            rows = x.filter(F.col("v").between(lo, hi)).groupBy(bin_.alias("b")).agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("lo").collect()
            for r in rows:
                if i < r["n"]:
                    break
                i -= r["n"]
            lo, hi = r["lo"], r["hi"]
        return lo

    middle = at((every["n"] - 1) // 2)
    return (middle + at(every["n"] // 2)) / 2 if every["n"] % 2 == 0 else middle


def collapse(fact: DataFrame, feature: str, renamed) -> DataFrame:
    """Features renamed; those that then share a name are summed."""
    return fact.withColumn(feature, renamed).groupBy("cell", feature).agg(F.sum("value").alias("value"))


def first_feature(fact: DataFrame, feature: str, position: str) -> DataFrame:
    """Of several columns of one feature name, the first by position stays."""
    keep = fact.groupBy(feature).agg(F.min(position).alias(position))
    return fact.join(keep, [feature, position], "left_semi")


def common_cells(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("cell").intersect(b.select("cell"))


def variance_stats(fact: DataFrame, feature: str, n_cells: int) -> DataFrame:
    """Mean and sample variance over all cells, zeros included."""
    n = F.lit(float(n_cells))
    s = fact.groupBy(feature).agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"))
    mean = F.col("s") / n
    return s.select(feature, mean.alias("mean"), ((F.col("q") - n * mean * mean) / (n - 1)).alias("variance"))


def highly_variable(fact: DataFrame, feature: str, n_cells: int, top: int = 3000, bins: int = 20) -> DataFrame:
    """Normalised dispersion within bins of equal width of the log mean; the top are marked.

    Values are taken back from log1p first. A bin of one feature has its own dispersion as spread, so a score of 1.
    """
    st = variance_stats(fact.withColumn("value", F.expm1("value")), feature, n_cells)
    st = st.withColumns({"m": F.log1p("mean"), "d": F.when((F.col("mean") > 0) & (F.col("variance") > 0), F.log(F.col("variance") / F.col("mean")))})
    r = st.agg(F.min("m").alias("lo"), F.max("m").alias("hi")).first()
    width = ((r["hi"] or 0.0) - (r["lo"] or 0.0)) / bins or 1.0
    st = st.withColumn("bin", F.least(F.floor((F.col("m") - F.lit(r["lo"] or 0.0)) / F.lit(width)), F.lit(bins - 1)))
    by = st.groupBy("bin").agg(F.avg("d").alias("bm"), F.stddev_samp("d").alias("bs"))
    z = st.join(F.broadcast(by), "bin").withColumn("score", F.when(F.col("bs").isNull(), F.when(F.col("d").isNotNull(), 1.0)).when(F.col("bs") > 0, (F.col("d") - F.col("bm")) / F.col("bs")))
    best = z.filter("score is not null").orderBy(F.desc("score"), feature).limit(top).select(feature, F.lit(True).alias("highly_variable"))
    return z.select(feature, "mean", "variance", "score").join(best, feature, "left").withColumn("highly_variable", F.coalesce("highly_variable", F.lit(False)))


def scale(fact: DataFrame, feature: str, n_cells: int) -> DataFrame:
    """value / standard deviation of the feature over all cells; not centred."""
    sd = variance_stats(fact, feature, n_cells).filter("variance > 0").select(feature, F.sqrt("variance").alias("sd"))
    return fact.join(sd, feature).withColumn("value", F.col("value") / F.col("sd")).drop("sd")


def top_markers(markers: DataFrame, k: int) -> DataFrame:
    """The k best rows of each group by score, then fold change."""
    w = Window.partitionBy("group").orderBy(F.desc("scores"), F.desc("logfoldchanges"), "names")
    return markers.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
