"""Means over groups of cells, cells without a stored value included."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliograph.operators.order import numbered

from heliograph.functions.names import is_missing

GROUP = ("project_id", "sample_id", "gpt_cell_type")


def groups_of(cells: DataFrame, min_cells: int, keys: tuple[str, ...] = GROUP) -> DataFrame:
    """keys, n_cells of groups with enough cells."""
    return cells.groupBy(*keys).agg(F.count("*").alias("n_cells")).filter(F.col("n_cells") >= min_cells)


def replicate_parts(groups: DataFrame, min_cells: int = 50, target: int = 5) -> DataFrame:
    """groups with parts and mode.

    With one or two groups each is to be split in about `target` parts of `min_cells` cells at least; only if that gives
    three parts in all is it done.
    """
    every = Window.partitionBy()
    n = F.count("*").over(every)
    parts = F.greatest(F.lit(1), F.least(F.greatest(F.lit(2), F.ceil(F.lit(float(target)) / n)), F.floor(F.col("n_cells") / min_cells))).cast("int")
    x = groups.withColumn("_p", F.when(n < 3, parts).otherwise(F.lit(1)))
    total = F.sum("_p").over(every)
    split = (n < 3) & (total >= 3)
    return x.withColumns({"parts": F.when(split, F.col("_p")).otherwise(F.lit(1)), "pseudobulk_mode": F.when(split, F.lit("within_sample_split")).otherwise(F.lit("biological"))}).drop("_p")


def assign(cells: DataFrame, groups: DataFrame, seed: int = 0, keys: tuple[str, ...] = GROUP) -> DataFrame:
    """Cells of kept groups with group_id and part, dealt in hash order to parts whose sizes differ by one at most."""
    x = cells.join(groups if "parts" in groups.columns else groups.withColumn("parts", F.lit(1)), list(keys))
    base, extra = F.floor(F.col("n_cells") / F.col("parts")), F.col("n_cells") % F.col("parts")
    i = F.col("_n") - 1
    wide = (base + 1) * extra
    part = F.when(i < wide, F.floor(i / (base + 1))).otherwise(extra + F.floor((i - wide) / base)).cast("int")
    whole = x.filter("parts = 1").withColumn("part", F.lit(0))
    if "parts" in groups.columns:
        split = numbered(x.filter("parts > 1"), [F.xxhash64(F.lit(seed), "cell"), "cell"], keys, "_n")
        whole = whole.unionByName(split.withColumn("part", part).drop("_n"))
    return whole.withColumn("group_id", F.concat_ws("\x1f", *keys, F.col("part").cast("string")))


def group_means(fact: DataFrame, assigned: DataFrame, feature: str) -> DataFrame:
    """group_id, feature, value: sum over cells / number of cells of the group. Features without a value in a group are absent."""
    size = assigned.groupBy("group_id").agg(F.count("*").alias("n"))
    s = fact.join(assigned.select("cell", "group_id"), "cell").groupBy("group_id", feature).agg(F.sum("value").alias("s"))
    return s.filter("s <> 0").join(size, "group_id").select("group_id", feature, (F.col("s") / F.col("n")).alias("value"))


def feature_summary(means: DataFrame, feature: str, n_groups: int) -> DataFrame:
    """Mean and maximum over all groups, zeros included."""
    return means.groupBy(feature).agg((F.sum("value") / n_groups).alias("pseudobulk_expression_mean"), F.greatest(F.max("value"), F.lit(0.0)).alias("pseudobulk_expression_max"))


def context_means(fact: DataFrame, cells: DataFrame, feature: str, fields: list[str]) -> DataFrame:
    """context_name, context_value, feature, mean_value, n_cells, nnz; for labels that are not missing.

    The fact is joined once with each cell's label set and summed by (label set, feature); only these sums are multiplied by fields.
    """
    labels = cells.select("cell", *[F.col(f).cast("string").alias(f) for f in fields])
    by = lambda df, *keep: df.unpivot(list(keep), fields, "context_name", "context_value").filter(~is_missing(F.col("context_value"))).withColumn("context_value", F.trim("context_value"))
    size = by(labels.groupBy(*fields).agg(F.count("*").alias("n")), "n").groupBy("context_name", "context_value").agg(F.sum("n").alias("n_cells"))
    sums = fact.join(labels, "cell").groupBy(*fields, feature).agg(F.sum("value").alias("s"), F.count("*").alias("nnz"))
    s = by(sums, feature, "s", "nnz").groupBy("context_name", "context_value", feature).agg(F.sum("s").alias("s"), F.sum("nnz").alias("nnz"))
    return s.join(size, ["context_name", "context_value"]).select("context_name", "context_value", feature, (F.col("s") / F.col("n_cells")).alias("mean_value"), "n_cells", "nnz")
