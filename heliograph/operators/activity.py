"""Gene activity, joint detection and dataset-level filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliograph.operators.cut import cut
from heliograph.operators.guards import many_to_one
from heliograph.operators.order import tasks
from heliograph.operators.pseudobulk import GROUP

KEYS = ("dataset", "tf", "peak", "gene", "gpt_cell_type")


def gene_activity(atac: DataFrame, links: DataFrame) -> DataFrame:
    """gene, cell, activity: accessibility summed over all links of a gene.

    A peak's genes travel as one array beside each of its values and are taken apart where a cell's rows are; the number of tasks grows with the rows
    that this makes.
    """
    genes = links.filter("peak is not null").groupBy("peak").agg(F.collect_list(F.struct("gene")).alias("genes"))
    many = genes.agg(F.avg(F.size("genes"))).first()[0]
    rows = atac.count()
    x = atac.join(genes, "peak").select("cell", "value", "genes").repartition(tasks(atac, int(rows * (many or 0))), "cell")
    return x.select("cell", "value", F.explode("genes").alias("g")).select("cell", "value", "g.gene").groupBy("gene", "cell").agg(F.sum("value").alias("activity"))


def _by_triplets(each: DataFrame, of: DataFrame) -> DataFrame:
    """tf, peak, gene, _group of every cell that has all three: from the triplets, by their peaks' cells."""
    t = of.select("peak", F.explode("of").alias("tf", "to")).select("peak", "tf", F.explode("to").alias("gene"))
    has = each.select("cell", F.explode("genes").alias("gene"))
    j = t.join(each.select("cell", "_group", F.explode("peaks").alias("peak")), "peak")
    return j.join(has.withColumnRenamed("gene", "tf"), ["tf", "cell"], "left_semi").join(has, ["gene", "cell"], "left_semi").select("tf", "peak", "gene", "_group")


def _by_cells(each: DataFrame, of: DataFrame, parts: int) -> DataFrame:
    """The same from the cells: each peak of a cell takes the cell's genes along, as an array, to the peak's triplets."""
    x = each.select("_group", "genes", F.explode("peaks").alias("peak")).repartition(parts, "peak").join(of.hint("shuffle_hash"), "peak")
    x = x.select("peak", "_group", "genes", "of", F.explode(F.array_intersect(F.map_keys("of"), "genes")).alias("tf"))
    return x.select("tf", "peak", "_group", F.explode(F.array_intersect(F.element_at("of", F.col("tf")), "genes")).alias("gene"))


def joint_counts(trip: DataFrame, rna: DataFrame, atac: DataFrame, cells: DataFrame) -> DataFrame:
    """Of each triplet and group with such cells: how many have all three above 0, and their share of the group's.

    Dense triplets over sparse cells are met from the cells, others from the triplets: by which makes fewer rows. From the cells, all rows of a
    peak are in one task, so what the cells' features multiply to is counted (every key has the peak) without a shuffle.
    """
    t = trip.filter("tf is not null and peak is not null and gene is not null")
    of = t.groupBy("peak", "tf").agg(F.collect_set("gene").alias("to")).groupBy("peak").agg(F.map_from_entries(F.collect_list(F.struct("tf", "to"))).alias("of"))
    of = cut(of)
    groups = cells.groupBy(*GROUP).agg(F.count("*").alias("group_total_cells")).dropna(subset=list(GROUP))
    groups = cut(groups.withColumn("_group", F.row_number().over(Window.partitionBy().orderBy(*GROUP))))  # few rows
    named = of.select(F.explode(F.concat(F.map_keys("of"), F.flatten(F.map_values("of")))).alias("gene")).distinct()
    listed = lambda fact, f, some: fact.filter("value > 0").select("cell", f).join(some, f, "left_semi").groupBy("cell").agg(F.collect_set(f).alias(f"{f}s"))
    each = listed(rna, "gene", named).join(listed(atac, "peak", of.select("peak")), "cell")
    each = cut(each.join(cells.select("cell", *GROUP), "cell").join(F.broadcast(groups.select("_group", *GROUP)), list(GROUP)).select("cell", "_group", "genes", "peaks"))
    p, g = F.size("peaks").cast("long"), F.size("genes")
    carried, pairs = each.agg(F.sum(p * g), F.sum(p * g * g)).first()
    of_peak = of.select("peak", F.size(F.flatten(F.map_values("of"))).alias("triplets"))
    begun = each.select(F.explode("peaks").alias("peak")).groupBy("peak").count().join(of_peak, "peak").agg(F.sum(F.col("count") * F.col("triplets"))).first()[0]
    met = _by_cells(each, of, tasks(of, pairs)) if (carried or 0) < (begun or 0) else _by_triplets(each, of)
    counted = met.groupBy("tf", "peak", "gene", "_group").agg(F.count("*").alias("active_cell_count"))
    out = counted.join(F.broadcast(groups), "_group").select(*GROUP, "tf", "peak", "gene", "active_cell_count", "group_total_cells")
    return out.withColumn("active_cell_fraction", F.col("active_cell_count") / F.col("group_total_cells"))


def add_active_fraction(scores: DataFrame, rna: DataFrame, atac: DataFrame, cells: DataFrame) -> DataFrame:
    """scores with the three joint detection columns, 0 where no cell has all three; every row must find its group."""
    groups = cut(cells.groupBy(*GROUP).agg(F.count("*").alias("group_total_cells")))
    counts = joint_counts(scores, rna, atac, cells).select("tf", "peak", "gene", *GROUP, "active_cell_count")
    x = many_to_one(scores, groups, list(GROUP)).join(counts, ["tf", "peak", "gene", *GROUP], "left")
    n = F.coalesce("active_cell_count", F.lit(0).cast("long"))
    return x.withColumn("active_cell_count", n).withColumn("active_cell_fraction", F.col("active_cell_count") / F.col("group_total_cells"))


_SUMS = {"dataset_active_cell_count": "active_cell_count", "dataset_group_total_cells": "group_total_cells"}


def _share() -> Column:
    return F.try_divide("dataset_active_cell_count", "dataset_group_total_cells")


def pooled(scores: DataFrame) -> DataFrame:
    """Ratio of sums over samples and projects; null for groups without cells."""
    s = scores.groupBy(*KEYS).agg(*[F.sum(c).alias(n) for n, c in _SUMS.items()], F.count("*").alias("_rows"))
    return s.withColumn("dataset_active_cell_fraction", _share())


def _passes(fraction: float, count: int) -> Column:
    ok = (F.col("dataset_active_cell_fraction") > fraction) & (F.col("dataset_active_cell_count") > count)
    for k in KEYS:
        ok = ok & F.col(k).isNotNull()
    return F.coalesce(ok, F.lit(False))


def dataset_filter(scores: DataFrame, fraction: float = 0.10, count: int = 20) -> DataFrame:
    """Rows whose pooled fraction and count are both above the thresholds, with the pooled columns. Rows of a key set are dealt once."""
    w = Window.partitionBy(*KEYS)
    x = scores.withColumns({n: F.sum(c).over(w) for n, c in _SUMS.items()}).withColumn("dataset_active_cell_fraction", _share())
    return x.filter(_passes(fraction, count)).select(*KEYS, *[c for c in x.columns if c not in KEYS])


def filter_summaries(scores: DataFrame, kept: DataFrame) -> DataFrame:
    """dataset, source_rows, source_keys, kept_rows, kept_keys: a row for each dataset of scores; 0 where nothing was kept."""
    def of(df: DataFrame, x: str) -> DataFrame:
        return df.groupBy(*KEYS).agg(F.count("*").alias("n")).groupBy("dataset").agg(F.sum("n").alias(f"{x}_rows"), F.count("*").alias(f"{x}_keys"))

    both = of(scores, "source").join(of(kept, "kept"), "dataset", "left")
    return both.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("kept_rows", "kept_keys")})


def filter_summary(scores: DataFrame, fraction: float = 0.10, count: int = 20) -> DataFrame:
    """One row: rows and distinct key sets before and after dataset_filter, and the shares kept; all from the pooled key sets, in one pass."""
    ok = _passes(fraction, count)
    n = lambda c, name: F.coalesce(c, F.lit(0).cast("long")).alias(name)
    both = pooled(scores).agg(n(F.sum("_rows"), "source_rows"), F.count("*").alias("source_keys"), n(F.sum(F.when(ok, F.col("_rows"))), "kept_rows"), F.count_if(ok).alias("kept_keys"))
    share = lambda x: F.coalesce(F.try_divide(F.col(f"kept_{x}"), F.col(f"source_{x}")), F.lit(0.0)).alias(f"kept_{x}_fraction")
    return both.select("*", share("rows"), share("keys"))
