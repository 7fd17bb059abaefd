"""Stratified capped samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliograph.operators.cut import cut


def allocation(sizes: DataFrame, most: int, minimum: int, keys: list[str]) -> DataFrame:
    """keys, size, allocated: how many rows each stratum gives.

    Every stratum first has its size or the minimum; if that is over the cap, a share by size, at least 1. What is left (or is too
    much) goes by remaining capacity; what rounding leaves goes to the stratum of the largest capacity, as much as that holds, then
    to the next. With more strata than rows wanted the largest strata give one each. The table of strata is small: one row a stratum.
    """
    every = Window.partitionBy()
    s = sizes.select(*keys, F.col("size").cast("long").alias("size")).withColumns({"total": F.sum("size").over(every), "strata": F.count("*").over(every)})
    base = F.least("size", F.lit(minimum))
    s = s.withColumn("base", base).withColumn("over", F.sum("base").over(every) > most)
    s = s.withColumn("base", F.when(F.col("over"), F.greatest(F.lit(1), F.floor(F.col("size") / F.col("total") * most))).otherwise(F.col("base")).cast("long"))
    s = s.withColumn("room", F.col("size") - F.col("base")).withColumns({"rooms": F.sum("room").over(every), "left": F.lit(most) - F.sum("base").over(every)})
    extra = F.when(F.col("rooms") > 0, F.floor(F.col("room") / F.col("rooms") * F.col("left"))).otherwise(F.lit(0)).cast("long")
    s = s.withColumn("some", F.greatest(F.lit(0), F.col("base") + F.least(extra, F.col("room")))).withColumn("left", F.lit(most) - F.sum("some").over(every))
    cap = F.col("size") - F.col("some")
    larger = F.coalesce(F.sum(cap).over(every.orderBy(F.desc(cap), *keys).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    won = F.greatest(F.lit(0), F.least(cap, F.col("left") - larger))
    few = F.row_number().over(every.orderBy(F.desc("size"), *keys)) <= most
    out = s.withColumns({"few": few, "won": won})
    return out.select(*keys, "size", F.when(F.col("total") <= most, F.col("size")).when(F.col("strata") > most, F.col("few").cast("long")).otherwise(F.col("some") + F.col("won")).alias("allocated"))


def stratified(cells: DataFrame, most: int, minimum: int, keys: list[str], seed: int = 0, order: list[Column] | None = None, share: Column | None = None) -> DataFrame:
    """cells with selected: a fixed draw by hash within strata; rows with a null key are never drawn.

    order: that of the draw, by a hash if not given; share: the same as a number from 0 to 1, spread evenly over the rows. Of a stratum only
    the rows with a small share can be drawn: those below a bound that holds the allocated number with room to spare. They alone are
    ranked, so a window holds about as many rows as are drawn, however large the stratum is. Where a bound holds too few, its stratum
    is ranked as a whole. Cells that share a name are drawn together.
    """
    known = cells.dropna(subset=keys)
    a = cut(allocation(known.groupBy(*keys).agg(F.count("*").alias("size")), most, minimum, keys).filter("allocated > 0"))
    if order is None:
        hashed = F.xxhash64(F.lit(seed), "cell")
        order, share = [hashed, F.col("cell")], hashed / F.lit(2.0**64) + 0.5
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    take = lambda rows: rows.withColumn("_n", rank).filter(F.col("_n") <= F.col("allocated")).select("cell", F.lit(True).alias("selected"))
    placed = known.select("cell", *keys).join(a, keys)
    if share is None:
        drawn = take(placed)
    else:
        low = cut(placed.filter(share <= enough(F.col("allocated"), F.col("size"))))
        held = low.groupBy(*keys).agg(F.count("*").alias("n"))
        short = cut(a.join(held, keys, "left").filter("coalesce(n, 0) < allocated").select(*keys))
        drawn = take(low.join(short, keys, "left_anti"))
        if not short.isEmpty():
            drawn = drawn.unionByName(take(placed.join(short, keys, "left_semi")))
    return cells.join(drawn.distinct(), "cell", "left").withColumn("selected", F.coalesce("selected", F.lit(False)))


def enough(wanted: Column, size: Column) -> Column:
    """The share of a stratum that holds the wanted number of rows but for six standard deviations."""
    return F.least(F.lit(1.0), (wanted + 6 * F.sqrt(wanted) + 20) / size)
