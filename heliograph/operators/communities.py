"""Communities of a weighted graph by modularity: local moves, splitting into connected parts, and contraction, level by level.

Vertices, edges and communities are tables; a round of moves is a join, two aggregates and no loop over rows. All vertices look at the
same state, and in a round only those that a hash draws may move, so that two cannot trade places for ever.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliograph.operators.cut import cut
from heliograph.operators.order import numbered

#: Modularity gains below this are rounding.
LEAST = 1e-9


def symmetric(edges: DataFrame) -> DataFrame:
    """src, dst, w: both directions of every pair with the larger of their weights; loops once; weights of 0 or less go."""
    e = edges.filter("weight > 0 and src is not null and dst is not null")
    one = e.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(F.max("weight").cast("double").alias("w"))
    return one.unionByName(one.filter("src <> dst").select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))


def modularity(edges: DataFrame, labels: DataFrame, resolution: float = 1.0) -> float:
    """Of labels (id, cluster) on src, dst, weight: the share of weight within clusters less what is expected, times resolution."""
    return _quality(symmetric(edges), labels.select("id", F.col("cluster").alias("c")), resolution)


def _quality(e: DataFrame, labels: DataFrame, resolution: float) -> float:
    """e: src, dst, w in both directions, where a contracted vertex's loop holds all its inner weight."""
    a, b = (labels.withColumnsRenamed({"id": x, "c": f"c_{x}"}) for x in ("src", "dst"))
    by = e.join(a, "src").join(b, "dst").groupBy(F.col("c_src").alias("c")).agg(F.sum("w").alias("tot"), F.sum(F.when(F.col("c_src") == F.col("c_dst"), F.col("w")).otherwise(0.0)).alias("inside"))
    r = by.agg(F.sum("inside").alias("inside"), F.sum("tot").alias("m2"), F.sum(F.col("tot") * F.col("tot")).alias("square")).first()
    return r["inside"] / r["m2"] - resolution * r["square"] / r["m2"] ** 2 if r["m2"] else 0.0


def connected(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """id, part: the smallest id that each vertex reaches; by neighbours' minima and pointer jumping, so rounds grow with the logarithm."""
    at = cut(vertices.select("id", F.col("id").alias("part")))
    while True:
        low = edges.join(at.withColumnRenamed("id", "dst"), "dst").groupBy(F.col("src").alias("id")).agg(F.min("part").alias("low"))
        hook = at.join(low, "id", "left").select("id", "part", F.least("part", F.coalesce("low", "part")).alias("new"))
        # a part that has a smaller neighbour points to it: all its vertices follow
        to = hook.groupBy("part").agg(F.min("new").alias("to"))
        to = to.join(to.select(F.col("part").alias("_p"), F.col("to").alias("_t")), F.col("to") == F.col("_p"), "left").select("part", F.coalesce("_t", "to").alias("to"))
        new = cut(at.join(to, "part").select("id", F.col("to").alias("part"), (F.col("to") < F.col("part")).alias("_moved")))
        at = new.select("id", "part")
        if new.filter("_moved").isEmpty():
            return at


def _moves(e: DataFrame, rounds: int, resolution: float, m2: float, seed: int) -> DataFrame:
    """id, c: each vertex's community after local moves from communities of its own."""
    degree = e.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("k"))
    at = cut(degree.select("id", "k", F.col("id").alias("c")))
    quiet = 0
    for t in range(rounds):
        total = at.groupBy("c").agg(F.sum("k").alias("tot"))
        near = e.filter("src <> dst").join(at.select(F.col("id").alias("dst"), "c"), "dst").groupBy(F.col("src").alias("id"), "c").agg(F.sum("w").alias("w"))
        own = at.select("id", "c", F.lit(0.0).alias("w"))  # staying is a choice, with or without neighbours there
        choice = near.unionByName(own).groupBy("id", "c").agg(F.sum("w").alias("w")).join(total, "c")
        choice = choice.join(at.select("id", "k", F.col("c").alias("now")), "id")
        rest = F.col("tot") - F.when(F.col("c") == F.col("now"), F.col("k")).otherwise(0.0)
        gain = F.round(F.col("w") - F.lit(resolution) * F.col("k") * rest / F.lit(m2), 12)
        choice = choice.withColumn("gain", gain)
        best = choice.groupBy("id", "k", "now").agg(
            F.max_by("c", F.struct("gain", (F.col("c") == F.col("now")), -F.col("c"))).alias("c"),
        )
        may = F.pmod(F.xxhash64("id", F.lit(seed * 1_000 + t)), F.lit(2)) == 0
        new = cut(best.select("id", "k", F.when(may, F.col("c")).otherwise(F.col("now")).alias("c"), (F.col("c") != F.col("now")).alias("_wants")))
        at = new.select("id", "k", "c")
        quiet = quiet + 1 if new.filter("_wants").isEmpty() else 0
        if quiet:
            break
    return at.select("id", "c")


def communities(edges: DataFrame, resolution: float = 1.0, rounds: int = 8, levels: int = 6, seed: int = 0) -> DataFrame:
    """id, cluster: communities of src, dst, weight (ids long), each connected, numbered from 0 by size.

    Each level moves vertices between communities, splits these into their connected parts (which never lowers modularity) and makes a
    vertex of each part. The level whose modularity is highest counts. Vertices are those that an edge names.
    """
    e = cut(symmetric(edges))
    m2 = e.agg(F.sum("w")).first()[0]
    vertices = cut(e.select(F.col("src").alias("id")).distinct())
    best = member = vertices.select("id", F.col("id").alias("c"))
    if m2 is None:
        return member.select("id", F.col("c").cast("string").alias("cluster"))
    highest = _quality(e, member, resolution)
    for level in range(levels):
        c = _moves(e, rounds, resolution, m2, seed + level)
        a, b = (c.withColumnsRenamed({"id": x, "c": f"c_{x}"}) for x in ("src", "dst"))
        inner = cut(e.join(a, "src").join(b, "dst").filter("c_src = c_dst and src <> dst").select("src", "dst"))
        part = cut(connected(inner, c))
        a, b = (part.withColumnsRenamed({"id": x, "part": f"p_{x}"}) for x in ("src", "dst"))
        e = cut(e.join(a, "src").join(b, "dst").groupBy(F.col("p_src").alias("src"), F.col("p_dst").alias("dst")).agg(F.sum("w").alias("w")))
        member = cut(member.join(part.withColumnRenamed("id", "c"), "c").select("id", F.col("part").alias("c")))
        made = e.select("src").distinct()
        now = _quality(e, made.select(F.col("src").alias("id"), F.col("src").alias("c")), resolution)
        if now <= highest + LEAST:
            break
        highest, best = now, member
    sizes = numbered(best.groupBy("c").agg(F.count("*").alias("size")), [F.desc("size"), F.col("c")])
    return best.join(sizes, "c").select("id", (F.col("n") - 1).cast("string").alias("cluster"))
