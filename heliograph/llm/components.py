"""Connected components of a distributed edge list by hooking and contraction.

Every vertex hooks to its smallest smaller neighbour, the forest is flattened by pointer jumping, and edges between
roots remain for the next round. Edge lists shrink from round to round; every round is a written table, so a lost
executor costs no more than a round, and nothing but a row count reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Spool


def _any(df: DataFrame) -> bool:
    return len(df.limit(1).take(1)) > 0


def _follow(map_: DataFrame, to: DataFrame) -> DataFrame:
    """(v, p) with p replaced by its own p where `to` has one; changed tells."""
    nxt = to.select(F.col("v").alias("_v"), F.col("p").alias("_p"))
    return map_.join(nxt, F.col("p") == F.col("_v"), "left").select("v", F.coalesce("_p", "p").alias("p"), F.col("_p").isNotNull().alias("changed"))


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "components") -> DataFrame:
    """(v, root): each vertex of edges but the roots, with the smallest vertex that it reaches.

    edges: two long columns; loops, repeated and reversed edges may occur; null ends are ignored.
    """
    spool = Spool(edges.sparkSession, name)
    e = spool.write(edges.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct())
    roots = None
    while _any(e):
        hooked = spool.write(e.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("p")))
        while True:
            jumped = spool.write(_follow(hooked, hooked))
            more = _any(jumped.filter("changed"))
            spool.drop(hooked)
            hooked = jumped
            if not more:
                break
            hooked = hooked.drop("changed")
            hooked._spool_path = jumped._spool_path
        p = hooked.select("v", "p")
        new = p if roots is None else _follow(roots, p).select("v", "p").unionByName(p)
        new = spool.write(new)
        ends = e.join(p.select(F.col("v").alias("a"), F.col("p").alias("ra")), "a", "left").join(p.select(F.col("v").alias("b"), F.col("p").alias("rb")), "b", "left")
        ra, rb = F.coalesce("ra", "a"), F.coalesce("rb", "b")
        left = spool.write(ends.filter(ra != rb).select(F.least(ra, rb).alias("a"), F.greatest(ra, rb).alias("b")).distinct())
        spool.drop(e, hooked, *([roots] if roots is not None else []))
        e, roots = left, new
    if roots is None:
        return e.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return roots.select("v", F.col("p").alias("root"))
