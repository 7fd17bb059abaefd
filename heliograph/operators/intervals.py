"""Half-open genomic intervals: merging, overlap and nearest joins, annotation.

Overlap joins are equi-joins on (chromosome, bin): both sides are exploded to the bins they touch, and a pair is taken
in the first bin that they share, so no distinct is needed. Unions and nearest points are carried in the order of places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliograph.functions.scores import promoter, signed_distance
from heliograph.operators import order as orders
from heliograph.operators.cut import cut
from heliograph.operators.order import ranged, scanned, tasks

#: Bases in a piece of a contig.
CHUNK = 1 << 16


def merge(df: DataFrame, slack: int = 0) -> DataFrame:
    """chrom, start, end of unions of intervals at most `slack` apart (0: bookended ones merge; -1: only overlapping).

    In the order of starts, an interval begins a union if it starts beyond all ends before it; the others belong to the latest that does.
    Both are carried over ranges of places, so no task holds a chromosome. Intervals hold a position or more.
    """
    order, by = ["start", "end"], ("chrom",)
    x = scanned(ranged(df.select("chrom", *order), ["chrom", *order]), order, by, _reach=("max", F.col("end")))
    begins = F.col("_reach").isNull() | (F.col("start") > F.col("_reach") + slack)
    x = scanned(x.withColumn("_begin", F.when(begins, F.col("start"))), order, by, _union=("last", F.col("_begin")))
    return x.groupBy("chrom", "_union").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_union")


def _binned(df: DataFrame, width: int) -> DataFrame:
    last = F.greatest(F.col("end") - 1, F.col("start"))
    return df.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(last / width))))


def _dealt(x: DataFrame, y: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """x and y dealt by bins, in as many tasks as their pairs ask for, and the key on which they meet.

    Intervals are few bytes and their pairs many rows, so the number of tasks must not follow the bytes. A bin of more pairs than a task should make is
    sliced: a row of its larger side lies in one slice, a row of the other in each.
    """
    key = ["chrom", "_bin"]
    n, m = (df.groupBy(*key).agg(F.count("*").alias(c)) for df, c in ((x, "_x"), (y, "_y")))
    met = cut(n.join(m, key).withColumn("_pairs", F.col("_x") * F.col("_y")))
    parts = tasks(x, met.agg(F.sum("_pairs")).first()[0])
    wide = met.filter(F.col("_pairs") > orders.ROWS).select(*key, F.ceil(F.col("_pairs") / orders.ROWS).cast("int").alias("_slices"), (F.col("_x") >= F.col("_y")).alias("_of_x"))
    if not wide.isEmpty():

        def sliced(df: DataFrame, own: Column) -> DataFrame:
            one = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.col("_slices").cast("long")).cast("int")
            each = F.when(F.col("_slices").isNull(), F.array(F.lit(0))).when(own, F.array(one)).otherwise(F.sequence(F.lit(0), F.col("_slices") - 1))
            return df.join(F.broadcast(wide), key, "left").withColumn("_slice", F.explode(each)).drop("_slices", "_of_x")

        x, y, key = sliced(x, F.col("_of_x")), sliced(y, ~F.col("_of_x")), [*key, "_slice"]
    return x.repartition(parts, *key), y.repartition(parts, *key), key


def overlap_join(a: DataFrame, b: DataFrame, width: int = 10_000) -> DataFrame:
    """Pairs of rows that share a position. b's chrom, start and end come as b_start, b_end."""
    x = _binned(a, width)
    y = _binned(b.withColumnsRenamed({"start": "b_start", "end": "b_end"}).withColumns({"start": F.col("b_start"), "end": F.col("b_end")}), width).drop("start", "end")
    x, y, key = _dealt(x, y)
    j = x.join(y, key).drop("_slice").filter((F.col("start") < F.col("b_end")) & (F.col("b_start") < F.col("end")))
    return j.filter(F.col("_bin") == F.floor(F.greatest("start", "b_start") / width)).drop("_bin")


def best_overlap(a: DataFrame, b: DataFrame, key: str, width: int = 10_000) -> DataFrame:
    """Each row of a with the row of b that it overlaps most, the first of equals."""
    j = overlap_join(a, b, width).withColumn("overlap", F.least("end", "b_end") - F.greatest("start", "b_start"))
    w = Window.partitionBy(key).orderBy(F.desc("overlap"), "b_start", "b_end")
    return j.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def nearest_join(peaks: DataFrame, points: DataFrame, within: int) -> DataFrame:
    """Each peak with the nearest point (tss) of its chromosome, not further than `within`; ties to the smaller tss, then gene.

    Peaks (by their starts) and points in one order of places: only the last point before a peak's start and the first one from it on can be
    its nearest. Both are carried over ranges of places, so a peak meets two points, however many lie around it.
    """
    p = peaks.filter("chrom is not null").select("chrom", "start", "end").distinct()
    at = points.filter("chrom is not null and tss is not null").groupBy("chrom", "tss").agg(F.min("gene").alias("gene"))
    point = F.struct("tss", "gene")
    none = at.select(point.alias("_point")).schema["_point"].dataType
    place = lambda c: F.col(c).cast("long").alias("_at")
    both = p.select("chrom", place("start"), F.lit(0).alias("_kind"), "start", "end", F.lit(None).cast(none).alias("_point"))
    nil = [F.lit(None).cast(p.schema[c].dataType).alias(c) for c in ("start", "end")]
    both = both.unionByName(at.select("chrom", place("tss"), F.lit(1).alias("_kind"), *nil, point.alias("_point")))
    order = ["_at", "_kind", "end"]
    x = scanned(ranged(both, ["chrom", *order]), order, ("chrom",), _left=("last", F.col("_point")), _right=("next", F.col("_point"))).filter("_kind = 0")
    d = lambda c: signed_distance(F.col("start"), F.col("end"), F.col(f"{c}.tss"))
    told = lambda c: F.when(F.col(c).isNotNull() & (F.abs(d(c)) <= within), F.struct(F.abs(d(c)).alias("far"), F.col(f"{c}.tss").alias("tss"), F.col(f"{c}.gene").alias("gene"), d(c).alias("distance")))
    best = x.withColumn("_best", F.least(told("_left"), told("_right"))).filter("_best is not null")
    return best.select("chrom", "start", "end", "_best.gene", "_best.tss", "_best.distance")


def annotate(peaks: DataFrame, genes: DataFrame, bodies: DataFrame, upstream: int = 1000, downstream: int = 100, within: int = 200_000, width: int = 10_000) -> DataFrame:
    """chrom, start, end, gene, distance, peak_type: promoter (distance 0), else distal: the nearest start site's signed distance, or
    0 in a gene's body.

    genes: gene, chrom, tss, strand. bodies: gene, chrom, start, end. A (peak, gene) is taken with its best type; promoter rows
    are all kept.
    """
    p = cut(peaks.select("chrom", "start", "end").distinct())
    lo, hi = promoter(F.col("tss"), F.col("strand"), upstream, downstream)
    windows = genes.select("gene", "chrom", "tss", lo.alias("start"), hi.alias("end")).filter("start < end")
    far = cut(nearest_join(p, genes.select("gene", "chrom", "tss"), within).select("chrom", "start", "end", "gene", "distance"))
    # a peak takes its nearest gene along, and the body of a gene with one body and one window at most takes that window along, so that both are told
    # within the pair, and promoters and bodies are met at once: no row of them is dealt. Null names are one name
    told = p.join(far.select("chrom", "start", "end", F.col("gene").alias("_near"), F.lit(True).alias("_told")), ["chrom", "start", "end"], "left")
    nearest = F.coalesce("_told", F.lit(False)) & F.col("gene").eqNullSafe(F.col("_near"))
    own = cut(_with_windows(bodies.filter("chrom is not null"), windows))
    single = (F.col("_bodies") == 1) & (F.coalesce("_windows", F.lit(1)) == 1)
    w = windows.select("chrom", "start", "end", "gene", F.lit(True).alias("_window"))
    both = w.unionByName(own.filter(single).select("chrom", "start", "end", "gene", F.lit(False).alias("_window"), "_lo", "_hi"), allowMissingColumns=True)
    mine = F.coalesce((F.col("start") < F.col("_hi")) & (F.col("_lo") < F.col("end")), F.lit(False))
    kind = F.when(F.col("_window"), "promoter").otherwise("distal").alias("peak_type")
    met = overlap_join(told, both, width).filter(F.col("_window") | ~(nearest | mine)).select("chrom", "start", "end", "gene", F.lit(0).cast("long").alias("distance"), kind)
    rest = far.withColumn("peak_type", F.lit("distal"))
    several = own.filter(~single).select("chrom", "gene")
    if not several.isEmpty():  # of these a peak may meet several bodies, and any window
        x, y = bodies.select("gene", "chrom", "start", "end").alias("x"), several.alias("y")
        x = x.join(y, (F.col("x.chrom") == F.col("y.chrom")) & F.col("x.gene").eqNullSafe(F.col("y.gene")), "left_semi")
        more = overlap_join(told, x, width).filter(~nearest).select("chrom", "start", "end", "gene").distinct()
        rest = rest.unionByName(more.select("*", F.lit(0).cast("long").alias("distance"), F.lit("distal").alias("peak_type")))
    x, y = rest.alias("x"), windows.select("chrom", "gene", F.col("start").alias("_lo"), F.col("end").alias("_hi")).alias("y")
    meets = F.col("x.gene").eqNullSafe(F.col("y.gene")) & (F.col("x.chrom") == F.col("y.chrom")) & (F.col("x.start") < F.col("y._hi")) & (F.col("y._lo") < F.col("x.end"))
    return met.unionByName(x.join(y, meets, "left_anti"))


def _with_windows(bodies: DataFrame, windows: DataFrame) -> DataFrame:
    """chrom, gene, start, end, _bodies, _lo, _hi, _windows: the hulls of a gene's bodies and of its windows, and how many there are."""
    hull = lambda df, lo, hi, n: df.groupBy("chrom", "gene").agg(F.min("start").alias(lo), F.max("end").alias(hi), F.count("*").alias(n))
    x, y = hull(bodies, "start", "end", "_bodies").alias("x"), hull(windows, "_lo", "_hi", "_windows").alias("y")
    return x.join(y, (F.col("x.chrom") == F.col("y.chrom")) & F.col("x.gene").eqNullSafe(F.col("y.gene")), "left").select("x.*", "_lo", "_hi", "_windows")


def resolve_contigs(wanted: DataFrame, contigs: DataFrame) -> DataFrame:
    """wanted.chrom with contig: the same name, else the only one of its bare and chr- forms that there is; null otherwise."""
    c = contigs.select(F.col("contig").alias("c")).distinct()
    bare = F.regexp_replace("chrom", "^chr", "")
    x = wanted.select("chrom").distinct()
    exact = x.join(c, F.col("chrom") == F.col("c"), "left").select("chrom", F.col("c").alias("exact"))
    other = x.select("chrom", F.explode(F.array(bare, F.concat(F.lit("chr"), bare))).alias("form")).filter("form <> chrom").join(c, F.col("form") == F.col("c")).groupBy("chrom").agg(F.count("*").alias("n"), F.min("c").alias("form"))
    return exact.join(other, "chrom", "left").select("chrom", F.coalesce("exact", F.when(F.col("n") == 1, F.col("form"))).alias("contig"))


def chunked(sequences: DataFrame) -> DataFrame:
    """contig, at, sequence in pieces that begin at multiples of CHUNK and, but for a contig's last one, have CHUNK bases.

    sequences: contig, sequence and at, the place of its first base (0 where there is no such column); a contig's rows of any length
    follow each other without gaps.
    """
    x = sequences.filter("sequence <> ''").withColumn("at", F.col("at") if "at" in sequences.columns else F.lit(0)).withColumn("at", F.col("at").cast("long"))
    chunk = F.col("_chunk") * CHUNK
    until = F.col("at") + F.length("sequence")
    x = x.withColumn("_chunk", F.explode(F.sequence(F.expr(f"at div {CHUNK}"), F.expr(f"(at + length(sequence) - 1) div {CHUNK}"))))
    start, end = F.greatest("at", chunk), F.least(until, chunk + CHUNK)
    part = F.substring(F.col("sequence"), (start - F.col("at") + 1).cast("int"), (end - start).cast("int"))
    whole = x.select("contig", "_chunk", start.alias("s"), part.alias("x")).groupBy("contig", "_chunk")
    return whole.agg(_in_order(F.struct("s", "x")).alias("sequence")).select("contig", chunk.alias("at"), "sequence")


def _in_order(piece: Column) -> Column:
    """The strings x of a group's pieces (struct<s, x>), by s, as one."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(piece)), lambda p: p["x"]), "")


def extract_sequences(peaks: DataFrame, contigs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(peaks with their sequence, peaks dropped as their contig lacks them). contigs: contig, sequence, and at where they come in pieces.

    A peak meets only the pieces that it touches, and equal places are read once.
    """
    pieces = chunked(contigs).withColumnRenamed("contig", "chrom").withColumn("_chunk", F.expr(f"at div {CHUNK}"))
    sizes = pieces.groupBy("chrom").agg(F.max(F.col("at") + F.length("sequence")).alias("_size"))
    located = peaks.join(sizes, "chrom", "left")
    ok = F.coalesce((F.col("start") >= 0) & (F.col("end") <= F.col("_size")), F.lit(False))
    places = located.filter(ok & (F.col("end") > F.col("start"))).select("chrom", "start", "end").distinct()
    touched = F.explode(F.sequence(F.expr(f"CAST(start AS BIGINT) div {CHUNK}"), F.expr(f"(CAST(end AS BIGINT) - 1) div {CHUNK}")))
    met = places.withColumn("_chunk", touched).join(pieces, ["chrom", "_chunk"])
    start, end = F.greatest(F.col("start").cast("long"), "at"), F.least(F.col("end").cast("long"), F.col("at") + CHUNK)
    part = F.substring(F.col("sequence"), (start - F.col("at") + 1).cast("int"), (end - start).cast("int"))
    found = met.select("chrom", "start", "end", F.struct(F.col("at").alias("s"), part.alias("x")).alias("p")).groupBy("chrom", "start", "end").agg(_in_order(F.col("p")).alias("sequence"))
    got = located.filter(ok).drop("_size").join(found, ["chrom", "start", "end"], "left")
    return got.withColumn("sequence", F.coalesce("sequence", F.lit(""))), located.filter(~ok).drop("_size")
