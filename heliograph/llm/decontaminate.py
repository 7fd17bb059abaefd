"""Benchmark decontamination with DataFrame functions only.

Windows as long as a benchmark item (in words) begin at each of its shingles in a text, and at the place the item would
have around that shingle; near the end of a text they are its last window. Windows and items get 64-bit SimHashes of their weighted shingles (a shingle that
occurs c times weighs c). Two fingerprints within `RADIUS` bits agree on one of RADIUS + 1 blocks at least, so an equi-join
on (length, block number, block value) finds every pair within the radius; the exact weighted similarity
sum(min)/sum(max) of those pairs decides. Any window can be moved right until it begins at its first shingle of the item
(or ends with the text) without losing a shared shingle, so these windows find every item that any window finds, in
whatever order its words stand. Before windows are made, those that begin at shingles are held against the number of shared
shingles that the similarity takes: too few places of shingles of items of that length mean too low a similarity.
`start` and `n_windows` are of the windows taken.

Shingles of whole texts are held against a bitmap of the items' shingles (a scalar of at most 8 MB, at least 64
bits a shingle up to a million) before anything is exploded. The join that follows broadcasts the items' shingles
only if they are at most BROADCAST, and shuffles otherwise. Windows of equal words are compared once.

Defined cases: null, empty and blank texts and items match nothing; a text or item of fewer words than a shingle is one
shingle; a text shorter than an item is one window; repeated items each match, by their item_id; rows with a null
doc_id or item_id have no result; an empty table on either side gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SHINGLE, SIMILARITY, Spool, words

RADIUS = 21
BROADCAST = 1_000_000
#: Bits of a fingerprint in each of RADIUS + 1 blocks.
EDGES = [64 * i // (RADIUS + 1) for i in range(RADIUS + 2)]


def shingle_at(h: str, i: str, width: int = SHINGLE) -> str:
    """SQL: hash of up to `width` word hashes of array h from index i (from 0); xxhash64 passes over the nulls beyond the end."""
    return "xxhash64(" + ", ".join(f"get({h}, {i} + {j})" for j in range(width)) + ")"


def tagged(shingles: str) -> Column:
    return F.expr(f"transform({shingles}, (x, i) -> xxhash64(x, size(filter(slice({shingles}, 1, i), y -> y = x))))")


def simhash(elements: str) -> Column:
    """64 bits, each the majority of that bit over the elements."""
    one = f"aggregate({elements}, 0, (c, x) -> c + CAST(shiftright(x, b) & 1L AS INT))"
    return F.expr(f"aggregate(sequence(0, 63), 0L, (acc, b) -> acc | IF(2 * {one} > size({elements}), shiftleft(1L, b), 0L))")


def blocks(f: str) -> Column:
    """array<struct<at, value>>: the blocks of fingerprint f."""
    return F.expr("array(" + ", ".join(f"struct({i} AS at, shiftrightunsigned({f}, {lo}) & {(1 << (hi - lo)) - 1}L AS value)" for i, (lo, hi) in enumerate(zip(EDGES, EDGES[1:]))) + ")")


def _fingerprinted(df: DataFrame, w: str) -> DataFrame:
    """df with elements (weighted shingles) and fingerprint of its word array w."""
    k = f"least({SHINGLE}, size({w}))"
    df = df.withColumn("_h", F.expr(f"transform({w}, x -> xxhash64(x))"))
    df = df.withColumn("_s", F.expr(f"transform(sequence(1, size(_h) - {k} + 1), i -> {shingle_at('_h', 'i - 1')})"))
    return df.withColumn("elements", tagged("_s")).withColumn("fingerprint", simhash("elements")).drop("_h")


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, start (word index of the best window, the first of equals), n_words, similarity, n_windows."""
    spark = docs.sparkSession
    percent = round(100 * similarity)
    # Written tables keep the optimizer from pushing null checks through, and so repeating, what fingerprints are made of.
    spool = Spool(spark, "decontaminate")
    items = _fingerprinted(benchmark.filter("item_id is not null").select("item_id", words(F.col("text")).alias("iw")).filter("size(iw) > 0"), "iw")
    items = spool.write(items.select("item_id", F.size("iw").alias("n"), "_s", "elements", "fingerprint"))
    places = items.select("item_id", "n", F.posexplode("_s").alias("j", "s"))
    size = places.agg(F.count("*"), F.collect_set(F.least(F.col("n"), F.lit(SHINGLE)))).first()
    n_places, widths = size[0], sorted(size[1])
    empty = spark.createDataFrame([], "doc_id long, item_id long, start int, n_words int, similarity double, n_windows long")
    if not n_places:
        return empty
    bits = 1 << min(26, max(12, (64 * n_places - 1).bit_length()))
    slot = f"CAST(pmod(s, {bits}) AS INT)"
    by_long = places.select(F.expr(f"shiftright({slot}, 6)").alias("w"), F.expr(f"shiftleft(1L, {slot} % 64)").alias("b")).groupBy("w").agg(F.expr("bit_or(b)").alias("b"))
    dense = spark.range(bits // 64).select(F.col("id").cast("int").alias("w")).join(by_long, "w", "left").select("w", F.coalesce("b", F.lit(0).cast("long")).alias("b"))
    bitmap = dense.agg(F.sort_array(F.collect_list(F.struct("w", "b"))).alias("wb")).select(F.col("wb.b").alias("m"))
    bitmap.createOrReplaceTempView("_heliograph_bitmap")

    # Texts shorter than a shingle have one shingle of their own width, as have such items; widths holds all that items have.
    d = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), words(F.col("text")).alias("w")).withColumn("h", F.expr("transform(w, x -> xxhash64(x))"))
    test = "(shiftrightunsigned(element_at(m, shiftright(CAST(pmod(s, {b}) AS INT), 6) + 1), CAST(pmod(s, {b}) AS INT) & 63) & 1L) = 1L".replace("{b}", str(bits))
    found = []
    for k in widths:
        at = f"CASE WHEN size(h) >= {k} THEN transform(sequence(0, size(h) - {k}), i -> struct(i AS i, {shingle_at('h', 'i', k)} AS s)) ELSE array() END"
        hit = f"filter({at}, x -> {test.replace('(s,', '(x.s,')})"
        found.append(f"transform({hit}, x -> struct(x.i AS i, x.s AS s, {k} AS k))")
    d.createOrReplaceTempView("_heliograph_docs")
    # an array of one or no array: a filter on its size would be pushed below, with all that hits are made of inside its lambdas
    hits = spark.sql(f"SELECT doc_id, w, explode(filter(array({found[0] if len(found) == 1 else 'concat(' + ', '.join(found) + ')'}), x -> size(x) > 0)) AS hits FROM (SELECT *, (SELECT m FROM _heliograph_bitmap) AS m FROM _heliograph_docs)")
    hits = spool.write(hits.withColumn("t", F.md5(F.concat_ws(" ", "w"))))
    side = places.withColumn("k", F.least(F.col("n"), F.lit(SHINGLE))).select("s", "k", "j", "n").distinct()
    if n_places <= BROADCAST:
        side = F.broadcast(side)
    seeds = hits.select("doc_id", "t", F.size("w").alias("nw"), F.explode("hits").alias("p")).select("doc_id", "t", "nw", "p.*").join(side, ["s", "k"])
    last = F.greatest(F.lit(0), F.col("nw") - F.col("n"))
    start = F.greatest(F.lit(0), F.least(F.col("i") - F.col("j"), last))
    by = seeds.groupBy("doc_id", "t", "nw", "n", "k").agg(F.sort_array(F.collect_set("i")).alias("a"), F.collect_set(start).alias("d")).withColumn("last", last)
    by = spool.write(by)  # else the sort is repeated inside the lambda below
    # shingles of a window and of an item, and how many of them must be shared
    by = by.withColumn("ws", F.expr("least(n, nw) - k + 1")).withColumn("least", F.expr(f"CAST(greatest(1, ({percent} * (ws + n - k + 1) + {99 + percent}) div {100 + percent}) AS INT)"))
    by = by.withColumn("b", F.expr("transform(filter(a, (x, p) -> get(a, p + least - 1) - x < ws), x -> least(x, last))")).filter("size(b) > 0")
    starts = by.select("doc_id", "t", "n", F.explode(F.array_union("b", "d")).alias("start"))
    windows = hits.select("doc_id", "t", "w").join(starts, ["doc_id", "t"]).select("doc_id", "start", "n", F.expr("slice(w, start + 1, n)").alias("ww"))
    windows = spool.write(windows.withColumn("key", F.md5(F.concat_ws(" ", "ww"))).groupBy("doc_id", "start", "n", "key").agg(F.first("ww").alias("ww")))
    distinct = spool.write(_fingerprinted(windows.groupBy("n", "key").agg(F.first("ww").alias("ww")), "ww").select("n", "key", "elements", "fingerprint"))
    probe = distinct.select("n", "key", "elements", "fingerprint", F.explode(blocks("fingerprint")).alias("x")).select("n", "key", "elements", "fingerprint", "x.*")
    index = items.select("n", "item_id", F.col("elements").alias("ie"), F.col("fingerprint").alias("ifp"), F.explode(blocks("fingerprint")).alias("x")).select("n", "item_id", "ie", "ifp", "x.*")
    if n_places <= BROADCAST:
        index = F.broadcast(index)
    # of the blocks that agree, the first stands for the pair
    earlier = " OR ".join(f"(at > {i} AND shiftrightunsigned(fingerprint ^ ifp, {lo}) & {(1 << (hi - lo)) - 1}L = 0L)" for i, (lo, hi) in enumerate(zip(EDGES, EDGES[1:])))
    near = probe.join(index, ["n", "at", "value"]).filter(F.expr(f"bit_count(fingerprint ^ ifp) <= {RADIUS} AND NOT ({earlier})"))
    both = F.size(F.array_intersect("elements", "ie"))
    union = F.size("elements") + F.size("ie") - both
    same = near.select("n", "key", "item_id", both.alias("both"), union.alias("union")).filter(F.lit(100) * F.col("both") >= F.lit(percent) * F.col("union"))
    out = windows.select("doc_id", "start", "n", "key").join(same, ["n", "key"]).withColumn("sim", F.col("both") / F.col("union"))
    best = F.max_by(F.struct("start", "n"), F.struct("sim", -F.col("start"))).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best, F.max("sim").alias("similarity"), F.count("*").alias("n_windows")).select("doc_id", "item_id", "b.start", F.col("b.n").alias("n_words"), "similarity", "n_windows")


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs without those that hold a benchmark item."""
    return docs.join(matches(docs, benchmark, similarity).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
