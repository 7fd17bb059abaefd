"""Line de-duplication by an exact set-similarity join, with DataFrame functions only.

A line's tokens are its distinct words (in lower case). Each token is one long: a rarity class above, 56 bits of
its hash below, so sorting puts rare tokens first. Rarity counts cover all documents, in RARITY buckets of token hashes.
Two lines with Jaccard >= t share a token among the first size - ceil(t*size) + 1 of each (prefix filter), at positions
that leave room for the overlap they need (positional filter), and t*size <= other size <= size/t (length filter).
A parity sketch (each token flips one of 128 bits, of 256 in lines of WIDE tokens or more) bounds the symmetric difference
from below and drops nearly all other pairs within the join. What is left is verified on the tokens.

A line goes if an earlier line matches it, judged on the input. Lines with the same tokens are one class: all but the first
occurrence go, and only first occurrences are joined. Matches are sought in two rounds: against the earliest line that shares
a pair of neighbouring prefix tokens, which settles large groups of near copies in linear numbers of rows; then lines not
settled meet all earlier candidates.

Defined cases: earlier means by doc_id, then, where several rows share a doc_id, by a hash of their texts, then by line number.
Of rows with equal doc_id and text the first keeps what it would keep alone, and the others lose every line that has words.
Lines are what newlines separate; a line without words matches nothing and stays; a null text stays null; an empty text stays
empty; a null doc_id stays whole and matches nothing; an empty table gives no rows; other columns are kept, those named like a
result (n_lines, lines_removed) are replaced. Texts of any length are read whole; each line is a row of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, Spool, maybe_in, shares

PERCENT = 75
#: Buckets of token hashes in which rarity is counted, and the part of a key that is hash (the rest is the rarity class).
RARITY, HASH = 1 << 18, (1 << 56) - 1
#: Tokens from which a line's sketch has 256 bits.
WIDE = 64
LINE = ["_id", "_seat", "line"]
SKETCH = ["y0", "y1", "y2", "y3"]


def _seated(docs: DataFrame, spool: Spool) -> DataFrame:
    """docs with _id (doc_id as long), _seat (0, or a hash of the text where rows share a doc_id) and _again (an equal row is before)."""
    rows = docs.withColumn("_id", F.col("doc_id").cast("long"))
    plain = {"_seat": F.lit(0).cast("long"), "_again": F.lit(False)}
    shared = spool.write(rows.filter("_id is not null and text is not null").groupBy("_id").count().filter("count > 1").select("_id"))
    if shared.isEmpty():
        return rows.withColumns(plain)
    single = rows.filter("_id is null").unionByName(maybe_in(rows, "_id", shared, negate=True)).withColumns(plain)
    seats = maybe_in(rows, "_id", shared).withColumn("_row", F.monotonically_increasing_id())
    several = spool.write(shares(seats, shared, ["_id"], "_several").withColumn("_several", F.col("_several") & F.col("text").isNotNull()))
    several = several.withColumn("_seat", F.when(F.col("_several"), F.xxhash64("text")).otherwise(F.lit(0).cast("long")))
    first = several.filter("_several").groupBy("_id", "_seat").agg(F.min("_row").alias("_row"))
    several = shares(several, first, ["_id", "_seat", "_row"], "_first").withColumn("_again", F.col("_several") & ~F.col("_first"))
    return single.unionByName(several.drop("_row", "_several", "_first"))


def _lines(rows: DataFrame) -> DataFrame:
    """_id, _seat, line (from 0), x: the lines that may have words, with blanks for other white space."""
    text = F.col("text")
    other = [F.contains(text, F.lit(x)) for x in "\t\x0b\x0c\r"]
    flat = F.when(other[0] | other[1] | other[2] | other[3], F.translate(text, "\t\x0b\x0c\r", "    ")).otherwise(text)
    return rows.select("_id", "_seat", F.posexplode(F.split(flat, "\n")).alias("line", "x")).filter("x <> ''")


#: Hashes of a line's distinct words.
_TOKENS = "array_remove(array_distinct(transform(split(lower(x), ' '), w -> xxhash64(w))), xxhash64(''))"


def _rarity(rows: DataFrame) -> DataFrame:
    """One row, m: for each bucket of token hashes its class (0 to 127, four to a doubling of its count) in the top byte of a long."""
    n = rows.select(F.explode(F.split(F.lower("text"), BLANKS)).alias("w")).groupBy(F.expr(f"xxhash64(w) & {RARITY - 1}L").alias("b")).count()
    every = n.unionByName(rows.sparkSession.range(RARITY).select(F.col("id").alias("b"), F.lit(0).cast("long").alias("count")))
    c = every.groupBy("b").agg(F.sum("count").alias("n")).select(F.expr("b >> 9").alias("g"), "b", F.expr("shiftleft(CAST(least(127, floor(4 * log2(1 + n))) AS BIGINT), 56)").alias("c"))
    parts = c.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("b", "c"))).alias("x")).select("g", F.col("x.c").alias("c"))
    return parts.agg(F.sort_array(F.collect_list(F.struct("g", "c"))).alias("x")).select(F.flatten("x.c").alias("m"))


def _tokens(rows: DataFrame, percent: int, spool: Spool) -> DataFrame:
    """One row a line that may have words: its size n, keys k1 and k2 of its tokens, prefix p and sketch."""
    rarity = spool.write(_rarity(rows))
    keys = _lines(rows).withColumn("m", rarity.scalar())
    keys = keys.select(*LINE, F.expr(f"sort_array(transform({_TOKENS}, h -> m[h & {RARITY - 1}L] | (h & {HASH}L)))").alias("t")).withColumn("n", F.size("t"))
    prefix = f"transform(slice(t, 1, greatest(0, n - CAST(ceil(n * {percent} / 100) AS INT) + 1)), x -> CAST((x & 4294967295L) - 2147483648L AS INT))"
    word = "aggregate(filter(t, x -> (x & {}L) = {}L), 0L, (a, x) -> a ^ shiftleft(1L, CAST(x & 63L AS INT)))"
    words = [f"IF(n < {WIDE}, {word.format(64, 64 * i) if i < 2 else '0L'}, {word.format(192, 64 * i)})" for i in range(4)]
    wide = keys.select(*LINE, "n", F.expr("xxhash64(t)").alias("k1"), F.expr("hash(t)").alias("k2"), F.expr(prefix).alias("p"), *[F.expr(x).alias(y) for x, y in zip(words, SKETCH, strict=True)])
    return spool.write(wide).filter("n > 0")


def _close(an: str, bn: str, percent: int) -> str:
    """SQL: whether sizes and sketches of a and b leave them the similarity, and a is before b."""
    wide = " + ".join(f"bit_count(a.{y} ^ b.{y})" for y in SKETCH)
    narrow = "bit_count(a.y0 ^ a.y2 ^ b.y0 ^ b.y2) + bit_count(a.y1 ^ a.y3 ^ b.y1 ^ b.y3)"
    return f"""{an} * 100 >= {bn} * {percent} AND {bn} * 100 >= {an} * {percent}
      AND (a._id < b._id OR (a._id = b._id AND (a._seat < b._seat OR (a._seat = b._seat AND a.line < b.line))))
      AND IF(least({an}, {bn}) >= {WIDE}, {wide}, {narrow}) * {100 + percent} <= ({an} + {bn}) * {100 - percent}"""


_PAIR = [f"{side}.{x} AS {side}{x}" for side in "ab" for x in LINE]


def removed_lines(rows: DataFrame, percent: int, spool: Spool) -> DataFrame:
    """_id, _seat, line of every line of rows (_id, _seat, text, all known and no two rows alike) that an earlier one matches."""
    lines = _tokens(rows, percent, spool)
    # classes of more than one line: all but the first go
    classes = lines.groupBy("k1", "k2", "n").agg(F.count("*").alias("c"), F.min(F.struct(*LINE)).alias("f")).filter("c > 1")
    classes = spool.write(classes.select("k1", "k2", "n", "f"))
    many = spool.write(maybe_in(lines, "k1", classes.select("k1")).join(classes, ["k1", "k2", "n"], "left").withColumn("copy", F.coalesce(F.struct(*LINE) != F.col("f"), F.lit(False))).drop("f"))
    copies = many.filter("copy").select(*LINE)
    once = maybe_in(lines, "k1", classes.select("k1"), negate=True).unionByName(many.filter("not copy").drop("copy")).select(*LINE, "n", "p", *SKETCH)
    # Round 1: the earliest line of each pair of neighbouring prefix tokens, by the four pairs of least hash of each line. Pairs
    # that one line alone has are found by their counts, so that few rows carry sketches.
    keys = F.expr("slice(sort_array(transform(sequence(0, size(p) - 2), i -> xxhash64(p[i], p[i + 1]))), 1, 4)")
    pairs = once.filter("size(p) > 1").select(*LINE, "n", *SKETCH, F.explode(keys).alias("s"))
    shared = spool.write(pairs.groupBy("s").count().filter("count > 1").select("s"))
    pairs = spool.write(maybe_in(pairs, "s", shared))
    first = pairs.groupBy("s").agg(F.min(F.struct(*LINE, "n", *SKETCH)).alias("f")).select("s", "f.*")
    one = pairs.alias("b").join(first.alias("a"), F.expr(f"a.s = b.s AND {_close('a.n', 'b.n', percent)}"))
    settled = _verified(rows, one.selectExpr(*_PAIR).distinct(), percent, spool)
    # Round 2: lines not settled against all earlier ones that share a prefix token. Both sides of the join read one and the same
    # shuffle: size, openness and position travel in one number, and openness is asked for in a condition on both sides,
    # which the optimizer cannot push below the shuffle of one.
    key = f"xxhash64({', '.join(LINE)})"
    settled_keys = settled.select(F.expr(key).alias("k"))
    marked = maybe_in(once, key, settled_keys, negate=True).withColumn("open", F.lit(1)).unionByName(shares(maybe_in(once, key, settled_keys), settled, LINE, "open").withColumn("open", F.when(F.col("open"), 0).otherwise(1)))
    prefixes = marked.select(*LINE, *SKETCH, "n", "open", F.posexplode("p").alias("i", "s")).select("s", F.expr("(n * 2 + open) * 4294967296L + i").alias("z"), *LINE, *SKETCH)
    an, bn, ai, bi = "shiftright(a.z, 33)", "shiftright(b.z, 33)", "(a.z & 4294967295L)", "(b.z & 4294967295L)"
    room = f"least({an} - {ai}, {bn} - {bi}) * {100 + percent} >= ({an} + {bn}) * {percent}"
    two = prefixes.alias("b").join(prefixes.alias("a"), F.expr(f"a.s = b.s AND CASE WHEN shiftright(b.z, 32) & 1L = 1L THEN {room} AND {_close(an, bn, percent)} ELSE a.z < 0 END"))
    more = _verified(rows, two.selectExpr(*_PAIR).distinct(), percent, spool)
    return copies.unionByName(settled).unionByName(more)


def _verified(rows: DataFrame, pairs: DataFrame, percent: int, spool: Spool) -> DataFrame:
    """_id, _seat, line of the later lines of the pairs whose token sets are similar enough."""
    pairs = spool.write(pairs)
    ends = pairs.select(*[F.col(f"a{x}").alias(x) for x in LINE]).unionByName(pairs.select(*[F.col(f"b{x}").alias(x) for x in LINE])).distinct()
    ends = spool.write(ends)
    own = maybe_in(rows.select("_id", "_seat", "text"), "_id", ends.select("_id").distinct())
    key = f"xxhash64({', '.join(LINE)})"
    got = spool.write(maybe_in(_lines(own), key, ends.select(F.expr(key).alias("k"))).select(*LINE, F.expr(_TOKENS).alias("w")))
    side = lambda s: got.select(*[F.col(x).alias(f"{s}{x}") for x in LINE], F.col("w").alias(f"{s}w"))
    both = F.size(F.array_intersect("aw", "bw"))
    enough = (both > 0) & (both * 100 >= (F.size("aw") + F.size("bw") - both) * percent)
    full = pairs.join(side("b"), [f"b{x}" for x in LINE]).join(side("a"), [f"a{x}" for x in LINE])
    return spool.write(full.filter(enough).select(*[F.col(f"b{x}").alias(x) for x in LINE]).distinct())


def dedup_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs with text cut to the lines that stay, n_lines (of the input) and lines_removed (array of line numbers)."""
    spool, work = Spool(docs.sparkSession, "lines"), Spool(docs.sparkSession, "lines-work")
    rest = docs.drop("lines_removed", "n_lines")
    rows = _seated(rest, spool)
    judged = rows.filter("_id is not null and text is not null and not _again").select("_id", "_seat", "text")
    gone = removed_lines(judged, percent, work).groupBy("_id", "_seat").agg(F.collect_set("line").alias("_gone"))
    gone = spool.write(gone)
    work.close()
    none = F.array().cast("array<int>")
    all_lines = F.split("text", "\n")
    with_words = F.expr("transform(filter(transform(_l, (x, i) -> struct(i AS i, x AS x)), y -> y.x RLIKE '[^\\\\x20\\\\x09-\\\\x0D]'), y -> y.i)")

    def cut(hit: DataFrame, removed: Column) -> DataFrame:
        hit = hit.withColumn("_l", all_lines).withColumn("lines_removed", F.coalesce(removed, none))
        left = F.expr("array_join(transform(array_except(sequence(0, size(_l) - 1), lines_removed), i -> _l[i]), '\\n')")
        return hit.select(*[left.alias(c) if c == "text" else F.col(c) for c in rest.columns], F.size("_l").alias("n_lines"), "lines_removed")

    key = "xxhash64(_id, _seat)"
    keys = gone.select(F.expr(key).alias("k"))
    known, unknown = rows.filter("_id is not null and text is not null and not _again"), rows.filter("_id is null or text is null")
    whole = maybe_in(known, key, keys, negate=True).unionByName(unknown)
    whole = whole.select(*rest.columns, F.when(F.col("text").isNull(), 0).otherwise(F.size(all_lines)).alias("n_lines"), none.alias("lines_removed"))
    hit = maybe_in(known, key, keys).join(gone, ["_id", "_seat"], "left")
    out = whole.unionByName(cut(hit, F.sort_array("_gone")))
    return out.unionByName(cut(rows.filter("_again"), with_words))
