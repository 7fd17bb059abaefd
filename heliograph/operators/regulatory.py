"""Peak-gene links, TF-peak-gene triplets and activity scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliograph.functions.scores import active_score, weighted_score
from heliograph.operators import pseudobulk, ranks
from heliograph.operators.cut import cut
from heliograph.operators.order import tasks


@dataclass(frozen=True)
class Thresholds:
    """The defaults."""

    feature_fraction: float = 0.01
    min_pseudobulk_cells: int = 10
    peak_gene_fdr: float = 0.05
    tf_pseudobulk_mean: float = 0.5
    peak_gene_r: float = 0.5
    motif_pvalue: float = 1e-5
    tf_gene_r: float = 0.5
    tf_pseudobulk_max: float = 0.5


@dataclass(frozen=True)
class Means:
    """Means over pseudobulks by (group_id, gene) and (group_id, peak), for steps that share them; n groups, of this mode."""

    gene: DataFrame
    peak: DataFrame
    n: int
    mode: str | None


def means_of(rna: DataFrame, atac: DataFrame, cells: DataFrame, t: Thresholds = Thresholds(), seed: int = 0) -> Means:
    """Both facts are read once: their means are a row a group and feature, however many cells there are."""
    groups = pseudobulk.replicate_parts(pseudobulk.groups_of(cells, t.min_pseudobulk_cells))
    assigned = pseudobulk.assign(cells, groups, seed)
    n, mode = groups.agg(F.sum("parts"), F.max("pseudobulk_mode")).first()
    return Means(cut(pseudobulk.group_means(rna, assigned, "gene")), cut(pseudobulk.group_means(atac, assigned, "peak")), n or 0, mode)


def peak_gene_links(rna: DataFrame, atac: DataFrame, cells: DataFrame, candidates: DataFrame, t: Thresholds = Thresholds(), seed: int = 0, means: Means | None = None) -> DataFrame:
    """peak, gene, spearman, pvalue, qvalue_bh, n_pseudobulks, pseudobulk_mode for every candidate pair. means: of the same cells, thresholds and seed."""
    candidates = candidates.select("peak", "gene").distinct()
    only = lambda df, f: df.join(candidates.select(f).distinct(), f, "left_semi")
    m = means or means_of(only(rna, "gene"), only(atac, "peak"), cells, t, seed)
    x, y, n, mode = (only(m.peak, "peak"), only(m.gene, "gene"), m.n, m.mode) if means else (m.peak, m.gene, m.n, m.mode)
    r = ranks.spearman(candidates, x, y, "peak", "gene", n)
    q = ranks.benjamini_hochberg(cut(ranks.with_p_values(r, n)))  # dealing by ranges reads it twice
    return q.select("peak", "gene", F.col("rho").alias("spearman"), "pvalue", "qvalue_bh", F.lit(n).cast("long").alias("n_pseudobulks"), F.lit(mode).alias("pseudobulk_mode"))


def select_links(links: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Both comparisons strict; undefined values are null, so never pass."""
    return links.filter((F.col("qvalue_bh") < t.peak_gene_fdr) & (F.col("spearman") > t.peak_gene_r))


def eligible_tfs(rna_means: DataFrame, n_groups: int, mean: float, maximum: float) -> DataFrame:
    s = pseudobulk.feature_summary(rna_means, "gene", n_groups)
    return s.filter((F.col("pseudobulk_expression_mean") > mean) & (F.col("pseudobulk_expression_max") > maximum)).withColumnRenamed("gene", "tf")


def best_motifs(hits: DataFrame) -> DataFrame:
    """The hit of least p-value of each (tf, peak)."""
    w = Window.partitionBy("tf", "peak").orderBy("motif_pvalue", *[c for c in hits.columns if c not in ("tf", "peak", "motif_pvalue")])
    return hits.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def triplets(links: DataFrame, hits: DataFrame, rna: DataFrame, cells: DataFrame, t: Thresholds = Thresholds(), absolute: bool = False, fdr: float | None = None, seed: int = 0, means: Means | None = None) -> DataFrame:
    """Selected links with motifs of expressed TFs, where TF and gene go together. means: of the same cells, thresholds and seed."""
    if means:
        n, mode, means = means.n, means.mode, means.gene
    else:
        groups = pseudobulk.replicate_parts(pseudobulk.groups_of(cells, t.min_pseudobulk_cells))
        assigned = pseudobulk.assign(cells, groups, seed)
        n, mode = groups.agg(F.sum("parts"), F.max("pseudobulk_mode")).first()
        n = n or 0
        means = cut(pseudobulk.group_means(rna, assigned, "gene"))
    tfs = eligible_tfs(means, n, t.tf_pseudobulk_mean, t.tf_pseudobulk_max)
    motifs = best_motifs(hits.filter(F.col("motif_pvalue") < t.motif_pvalue).join(tfs.select("tf"), "tf", "left_semi"))
    j = cut(select_links(links, t).drop("pseudobulk_mode", "n_pseudobulks").join(motifs, "peak").join(tfs, "tf"))
    pairs = j.select("tf", "gene").distinct()
    r = ranks.spearman(pairs, means.withColumnRenamed("gene", "tf"), means, "tf", "gene", n)
    r = ranks.benjamini_hochberg(ranks.with_p_values(r, n, p="tf_gene_pvalue"), "tf_gene_pvalue", "tf_gene_qvalue_bh").withColumnRenamed("rho", "tf_gene_spearman")
    out = j.join(r, ["tf", "gene"])
    rho = F.abs("tf_gene_spearman") if absolute else F.col("tf_gene_spearman")
    out = out.filter(rho > t.tf_gene_r)
    if fdr is not None:
        out = out.filter(F.col("tf_gene_qvalue_bh") < fdr)
    fixed = {"pseudobulk_mode": F.lit(mode), "effective_tf_mean_threshold": F.lit(t.tf_pseudobulk_mean), "effective_tf_max_threshold": F.lit(t.tf_pseudobulk_max), "effective_motif_pvalue": F.lit(t.motif_pvalue), "effective_tf_gene_r": F.lit(t.tf_gene_r), "effective_tf_gene_fdr": F.lit(fdr).cast("double")}
    return out.withColumns(fixed | {"regulation_direction": F.when(F.col("tf_gene_spearman") >= 0, F.lit("activating")).otherwise(F.lit("repressive"))})


def active_scores(trip: DataFrame, rna: DataFrame, atac: DataFrame, cells: DataFrame, dataset: str = "dataset", t: Thresholds = Thresholds(), means: Means | None = None) -> DataFrame:
    """A row per group and triplet: percentiles of TF, peak and gene among groups, their geometric mean, and weighted score.

    Groups x triplets is the result's own size. A feature's values of all groups travel as arrays, so triplets are joined before they meet the groups (few rows) and no
    row of the result is shuffled; the number of tasks grows with the result. means: of the same cells and thresholds; taken where no group was split.
    """
    groups = pseudobulk.groups_of(cells, t.min_pseudobulk_cells)
    assigned = pseudobulk.assign(cells, groups)
    g = cut(groups.withColumn("group_id", F.concat_ws("\x1f", *pseudobulk.GROUP, F.lit("0"))))
    at = ranks.group_numbers(g)
    n = at.count()

    def side(fact: DataFrame, f: str) -> DataFrame:
        whole = means is not None and means.mode == "biological"
        x = ranks.percentiles(getattr(means, f) if whole else pseudobulk.group_means(fact, assigned, f), f, n)
        return ranks.listed(x, f, at, _m="value", _p="percentile").select(f, ranks.placed("_m").alias(f"_{f}_m"), ranks.placed("_p").alias(f"_{f}_p"))

    gene = cut(side(rna, "gene"))
    tf = gene.select(F.col("gene").alias("tf"), F.col("_gene_m").alias("_tf_m"), F.col("_gene_p").alias("_tf_p"))
    x = cut(trip.select("tf", "peak", "gene", "spearman", "qvalue_bh", "tf_gene_spearman", "motif_pvalue"))
    x = x.repartition(tasks(x, x.count() * n), "peak").join(side(atac, "peak"), "peak", "left").join(gene, "gene", "left").join(tf, "tf", "left")
    of = lambda k, what: F.get(f"_{k}_{what}", F.col("i") - 1)
    x = x.crossJoin(F.broadcast(g.join(at, "group_id"))).withColumns({f"{k}_{c}": of(k, w) for k in ("tf", "peak", "gene") for c, w in (("pseudobulk_mean", "m"), ("percentile", "p"))})
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    score = active_score(zero("tf_percentile"), zero("peak_percentile"), zero("gene_percentile"))
    x = x.withColumn("active_score", score).withColumn("weighted_active_score", weighted_score(F.col("active_score"), F.col("spearman"), F.col("tf_gene_spearman")))
    return x.select(F.lit(dataset).alias("dataset"), "tf", "peak", "gene", "spearman", "qvalue_bh", "tf_gene_spearman", "motif_pvalue", *pseudobulk.GROUP, F.col("n_cells").alias("pseudobulk_n_cells"), *[zero(f"{k}_pseudobulk_mean").alias(f"{k}_pseudobulk_mean") for k in ("tf", "peak", "gene")], "active_score", "weighted_active_score")
