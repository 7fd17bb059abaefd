"""Rank statistics on sparse facts: average ranks, Spearman, Benjamini-Hochberg, percentiles, rank-sum markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliograph.functions.stats import normal_two_sided, t_two_sided
from heliograph.operators.cut import cut
from heliograph.operators.order import beside, ranged


def average_rank(value: str, *by: str) -> Column:
    """Rank from 1 within `by`, ties averaged; values that are equal as floats tie, so the order of summation is of no account."""
    w, v = Window.partitionBy(*by), F.col(value).cast("float")
    return F.rank().over(w.orderBy(v)) + (F.count("*").over(w.partitionBy(*by, v)) - 1) / 2.0


def sparse_ranks(means: DataFrame, feature: str, n_groups: int) -> tuple[DataFrame, DataFrame]:
    """For non-negative values by (group_id, feature), zeros absent.

    ranks: feature, group_id, d = rank less the zeros' rank; stats: feature, c = zeros' rank less the mean rank, norm2.
    Zeros tie lowest, so a feature with z of them ranks a non-zero at z + its rank among non-zeros.
    """
    n, mid = float(n_groups), (n_groups + 1) / 2.0
    on = means.filter("value > 0")
    nnz = F.count("*").over(Window.partitionBy(feature))
    zero = (F.lit(n) - nnz + 1) / 2
    r = on.withColumn("c", zero - mid).withColumn("d", average_rank("value", feature) + (F.lit(n) - nnz) - zero)
    ranks = r.select(feature, "group_id", "d", "c")
    stats = ranks.groupBy(feature).agg(F.max("c").alias("c"), F.sum(F.col("d") * F.col("d")).alias("q")).select(feature, "c", (F.col("q") - n * F.col("c") * F.col("c")).alias("norm2"))
    return ranks.drop("c"), stats


def listed(df: DataFrame, feature: str, at: DataFrame, **columns: str) -> DataFrame:
    """feature, and for each name=column an array of {i, v}: the feature's values with the numbers i that `at` (group_id, i: few rows) gives their groups, by i."""
    x = df.join(F.broadcast(at), "group_id").groupBy(feature)
    return x.agg(*[F.sort_array(F.collect_list(F.struct("i", F.col(c).alias("v")))).alias(n) for n, c in columns.items()])


def placed(x: str) -> Column:
    """An array of listed() with the value of i at place i (from 1), null where there is none; it ends with its last value."""
    a = F.col(x)
    none = F.lit(None).cast("double")
    gap = lambda e, k: F.array_repeat(none, (e["i"] - F.coalesce(F.get(a, k - 1)["i"], F.lit(0)) - 1).cast("int"))
    return F.flatten(F.transform(a, lambda e, k: F.concat(gap(e, k), F.array(e["v"]))))


def group_numbers(ids: DataFrame) -> DataFrame:
    """group_id, i: groups numbered from 1 on; groups are few rows."""
    return cut(ids.select("group_id").distinct().withColumn("i", F.row_number().over(Window.partitionBy().orderBy("group_id"))))


def spearman(pairs: DataFrame, x: DataFrame, y: DataFrame, fx: str, fy: str, n_groups: int) -> DataFrame:
    """pairs with rho: Spearman over all groups, by a sparse equi-join on group; null where a side is constant.

    sum of products over groups where both are non-zero, less n * (zero offset of x) * (zero offset of y), over the norms.
    """
    rx, sx = sparse_ranks(x, fx, n_groups)
    ry, sy = sparse_ranks(y, fy, n_groups)
    both = pairs.select(fx, fy).distinct().join(rx, fx).join(ry.withColumnRenamed("d", "e"), [fy, "group_id"])
    dots = both.groupBy(fx, fy).agg(F.sum(F.col("d") * F.col("e")).alias("dot"))
    out = pairs.join(sx.withColumnsRenamed({"c": "cx", "norm2": "nx"}), fx, "left").join(sy.withColumnsRenamed({"c": "cy", "norm2": "ny"}), fy, "left").join(dots, [fx, fy], "left")
    norm = F.sqrt(F.col("nx") * F.col("ny"))
    rho = F.when((F.col("nx") > 1e-9) & (F.col("ny") > 1e-9), (F.coalesce("dot", F.lit(0.0)) - n_groups * F.col("cx") * F.col("cy")) / norm)
    return out.withColumn("rho", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), rho))).withColumn("rho", F.when(rho.isNotNull(), F.col("rho"))).drop("cx", "cy", "nx", "ny", "dot")


def with_p_values(df: DataFrame, n_groups: int, rho: str = "rho", p: str = "pvalue") -> DataFrame:
    return df.withColumn(p, t_two_sided(F.col(rho), F.lit(n_groups)))


def benjamini_hochberg(df: DataFrame, p: str = "pvalue", q: str = "qvalue_bh", by: tuple[str, ...] = ()) -> DataFrame:
    """q-values over all rows with a p-value (of each `by`); null p, null q.

    Rows are dealt once by ranges of p, equal p by a hash, so that a very common p lies in many ranges. A row's rank and the least
    p * n / rank from it on are taken within its range and completed from a table with one row a range. Of equal p the last has the least
    value, so all of them get it, and nothing is joined by p.
    """
    x = ranged(df.withColumn("_tie", F.xxhash64(*df.columns)), [*by, p, "_tie"])
    here, every, upto = Window.partitionBy("_range", *by), Window.partitionBy(*by), (Window.unboundedPreceding, Window.currentRow)
    sums = x.groupBy("_range", *by).agg(F.count(p).alias("_k"))
    sums = sums.select("_range", *by, (F.sum("_k").over(every.orderBy("_range").rowsBetween(*upto)) - F.col("_k")).alias("_before"), F.sum("_k").over(every).alias("_n"))
    r = beside(x.withColumn("_rank", F.count(p).over(here.orderBy(p, "_tie").rowsBetween(*upto))), sums, ["_range", *by])
    r = r.withColumn("_rank", F.col("_rank") + F.col("_before")).withColumn("_v", F.col(p) * F.col("_n") / F.col("_rank"))
    least = r.groupBy("_range", *by).agg(F.min("_v").alias("_l"))
    after = F.min("_l").over(every.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1))
    r = r.withColumn("_m", F.min("_v").over(here.orderBy(F.desc("_rank"), F.desc("_tie")).rowsBetween(*upto)))
    r = beside(r, least.select("_range", *by, after.alias("_after")), ["_range", *by])
    value = F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), "_m", F.coalesce("_after", F.lit(1.0))))
    return r.select(*df.columns, value.alias(q))


def percentiles(means: DataFrame, feature: str, n_groups: int) -> DataFrame:
    """Average rank over all groups, as a share of their number; 0 for zeros (absent)."""
    on = means.filter("value > 0")
    zeros = F.lit(float(n_groups)) - F.count("*").over(Window.partitionBy(feature))
    return on.withColumn("percentile", (average_rank("value", feature) + zeros) / n_groups)


def rank_sum_markers(fact: DataFrame, cells: DataFrame, feature: str, group: str) -> DataFrame:
    """group, names, scores, logfoldchanges, pvals, pvals_adj: each group of cells against the rest.

    Wilcoxon by normal approximation without tie correction; zeros tie lowest, so only stored values are ranked.
    """
    sizes = cells.groupBy(group).agg(F.count("*").cast("double").alias("n1"))
    total = cells.count()
    on = fact.filter("value > 0").join(cells.select("cell", group), "cell")
    # equal values of a feature are one row, so a window holds a feature's distinct values and not its cells
    same = on.groupBy(feature, F.col("value").cast("float").alias("v"), group).agg(F.count("*").alias("c"), F.sum(F.expm1("value")).alias("e"))
    values = same.groupBy(feature, "v").agg(F.sum("c").alias("ties"))
    upto = F.sum("ties").over(Window.partitionBy(feature).orderBy("v")) - F.col("ties")
    nnz = F.sum("ties").over(Window.partitionBy(feature))
    values = values.withColumns({"zero": (F.lit(float(total)) - nnz + 1) / 2, "rank": upto + (F.col("ties") + 1) / 2.0 + F.lit(float(total)) - nnz})
    r = same.join(values, [feature, "v"]).withColumn("d", F.col("c") * (F.col("rank") - F.col("zero")))
    by = r.groupBy(feature, group).agg(F.sum("d").alias("d"), F.sum("e").alias("e"))
    every = r.groupBy(feature).agg(F.max("zero").alias("zero"), F.sum("e").alias("all_e"))
    grid = every.crossJoin(sizes)  # one row a feature and group: the result's own size
    x = grid.join(by, [feature, group], "left").fillna(0.0, ["d", "e"])
    n1, n2 = F.col("n1"), F.lit(float(total)) - F.col("n1")
    mean = n1 * (total + 1) / 2
    sd = F.sqrt(n1 * n2 * (total + 1) / 12.0)
    z = F.when(sd > 0, (F.col("d") + n1 * F.col("zero") - mean) / sd)
    fold = F.log2((F.col("e") / n1 + 1e-9) / ((F.col("all_e") - F.col("e")) / n2 + 1e-9))
    out = x.select(F.col(group).alias("group"), F.col(feature).alias("names"), z.alias("scores"), F.when(n2 > 0, fold).alias("logfoldchanges"))
    return benjamini_hochberg(out.withColumn("pvals", normal_two_sided("scores")), "pvals", "pvals_adj", ("group",))
