"""Removal of repeated byte strings: longest-previous-factor logic over a distributed, truncated suffix order.

A position has an earlier match of at least `length` bytes if its longest previous factor is that long. In suffix
order the suffixes that agree on their first `length` bytes stand next to each other, and within such a run the
previous and next smaller positions exist for every member but the smallest. So what is needed of the suffix
array is the runs and their smallest positions; they come from ranks (64-bit hashes within 64-bit anchors) of
`length`-byte prefixes, as no task can hold a suffix array of the corpus. Not every suffix is ranked:

1. Texts that are equal are one; a text with copies is a run as a whole.
2. Every window of `length` bytes selects its smallest-hash GRAM-byte string (the rightmost of equals), so equal windows
   select equal strings at equal offsets. Windows that select the same place form an interval with one anchor. Only
   anchors seen twice go on.
3. An interval is cut into blocks of offsets. What all windows of a block have in common (its core) must occur
   twice; blocks that agree in all their bytes are decided at once, and one of them stands for the rest. Blocks still
   undecided are cut into smaller ones.
4. Only windows of blocks still undecided are ranked one by one.

All groupings are counts and minima with partial aggregation. `keep="first"` removes what has an earlier match (by doc_id, then
position); `keep="none"` removes every occurrence of a repeated string.

Defined cases: null and empty texts have no bytes; matches never cross documents; overlapping matches count;
rows that repeat a text, with the same doc_id or not, are copies; a null doc_id takes part and sorts first; an empty table gives no
rows; other columns are ignored. Texts of any length are read whole, in overlapping pieces of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Spool, maybe_in, mix64

LENGTH, GRAM = 400, 128
#: Offsets in a block, level by level.
BLOCKS = (64, 8)
PIECE = 1 << 19
#: Stands for a null doc_id, and sorts first.
NO_ID = -(2**63)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=np.uint64)


class Rolling:
    """Hashes of any substrings of b in constant time each."""

    _powers: tuple[np.ndarray, np.ndarray] | None = None

    def __init__(self, b: np.ndarray) -> None:
        n = len(b)
        p = Rolling._powers
        if p is None or len(p[0]) < n + 1:
            size = max(n + 1, 4096)
            of = lambda x: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x, np.uint64)]))
            p = Rolling._powers = of(_BASE), of(_INVERSE)
        self.up = p[0]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[b] * p[1][:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, length) -> np.ndarray:
        return mix64((self.sums[start + length] - self.sums[start]) * self.up[start] + np.uint64(1))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values: prefix and suffix minima of blocks of w."""
    n = len(x)
    pad = np.concatenate([x, np.full(-n % w, x.max(), x.dtype)]).reshape(-1, w)
    left = np.minimum.accumulate(pad, 1).ravel()
    right = np.minimum.accumulate(pad[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def anchors(b: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, anchor place, first window, last window) of the whole text, piece by piece."""
    for at in range(0, max(0, len(b) - length + 1), PIECE):
        part = b[at : at + PIECE + length - 1]
        roll = Rolling(part)
        place = np.arange(len(part) - gram + 1)
        h = roll(place, gram)
        low = np.uint64((1 << 20) - 1)
        key = (h & ~low) | (low - place.astype(np.uint64))
        chosen = sliding_min(key, length - gram + 1)
        edge = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        p = (low - (chosen[edge] & low)).astype(np.int64)
        last = np.append(edge[1:], len(chosen)) - 1
        yield h[p].view(np.int64), p + at, edge + at, last + at


def _bytes(t) -> np.ndarray:
    return np.frombuffer(t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"", np.uint8)


def _anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for doc, th, t in zip(pdf["doc_id"].tolist(), pdf["th"].tolist(), pdf["text"].tolist()):
                for fp, p, a, z in anchors(_bytes(t), length):
                    yield pd.DataFrame({"doc_id": doc, "th": th, "fp": fp, "p": p, "a": a, "z": z})

    return texts.select("doc_id", "th", "text").mapInPandas(_gathered(run), "doc_id long, th long, fp long, p long, a long, z long")


def _gathered(run, rows: int = 100_000):
    """Small frames of a generator joined into larger ones."""

    def out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for d in run(batches):
            held.append(d)
            n += len(d)
            if n >= rows:
                yield pd.concat(held, ignore_index=True)
                held, n = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)

    return out


def _pieces(b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[np.ndarray, Rolling, int]]:
    """Rows (sorted by lo) dealt to stretches of b that hold [lo, hi) of each."""
    order = np.argsort(lo, kind="stable")
    i = 0
    while i < len(order):
        start = lo[order[i]]
        j = i + int(np.searchsorted(lo[order[i:]], start + PIECE, "left"))
        rows = order[i:j]
        yield rows, Rolling(b[start : hi[rows].max()]), int(start)
        i = j


def _block_rows(texts: DataFrame, length: int, block: int) -> DataFrame:
    """A row per block of each of the windows a to z of an anchor at p in `places`: its windows [lo, hi], the core's hash and the hash of all its bytes.

    Where the interval ends within the block, `whole` is a number of its own, as the block agrees with no other as a whole.
    """
    need = block + length - 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for doc, th, t, places in zip(pdf["doc_id"].tolist(), pdf["th"].tolist(), pdf["text"].tolist(), pdf["places"].tolist()):
                b = _bytes(t)
                r = np.array([(x["fp"], x["p"], x["a"], x["z"]) for x in places], np.int64)
                first, last = (r[:, 1] - r[:, 3]) // block, (r[:, 1] - r[:, 2]) // block
                n = last - first + 1
                row = np.repeat(np.arange(len(r)), n)
                blk = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[row]
                fp, p, a, z = r[row].T
                # windows of the block start in [p - blk*block - block + 1, p - blk*block]
                hi_full, lo_full = p - blk * block, p - blk * block - block + 1
                lo, hi = np.maximum(lo_full, a), np.minimum(hi_full, z)
                full = (lo == lo_full) & (hi == hi_full)
                core, whole = np.zeros(len(row), np.uint64), np.zeros(len(row), np.uint64)
                # the core [hi_full, lo_full + length) lies within every window of the block
                for k, roll, at in _pieces(b, np.minimum(lo, hi_full), np.maximum(hi + length, lo_full + length)):
                    core[k] = roll(hi_full[k] - at, length - block + 1)
                    f = k[full[k]]
                    whole[f] = roll(lo_full[f] - at, need)
                own = mix64(np.uint64(th & (2**64 - 1)) + mix64(np.uint64(doc & (2**64 - 1)) + lo.astype(np.uint64)))
                whole[~full] = own[~full]
                yield pd.DataFrame({"doc_id": doc, "th": th, "fp": fp, "blk": blk, "core": core.view(np.int64), "whole": whole.view(np.int64), "p": p, "lo": lo, "hi": hi})

    return texts.mapInPandas(_gathered(run), "doc_id long, th long, fp long, blk long, core long, whole long, p long, lo long, hi long")


def _window_rows(texts: DataFrame, length: int) -> DataFrame:
    """A row per window of the undecided blocks in `places`: anchor, offset, rank and start."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for doc, th, t, places in zip(pdf["doc_id"].tolist(), pdf["th"].tolist(), pdf["text"].tolist(), pdf["places"].tolist()):
                b = _bytes(t)
                r = np.array([(x["fp"], x["p"], x["a"], x["z"]) for x in places], np.int64)
                n = r[:, 3] - r[:, 2] + 1
                row = np.repeat(np.arange(len(r)), n)
                s = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + r[row, 2]
                rank = np.zeros(len(s), np.uint64)
                for k, roll, at in _pieces(b, s, s + length):
                    rank[k] = roll(s[k] - at, length)
                yield pd.DataFrame({"doc_id": doc, "th": th, "fp": r[row, 0], "o": r[row, 1] - s, "rank": rank.view(np.int64), "s": s})

    return texts.mapInPandas(_gathered(run), "doc_id long, th long, fp long, o long, rank long, s long")


def _cut(texts: DataFrame, length: int) -> DataFrame:
    """doc_id, th, spans (maximal removed runs) and kept bytes, given `covered`: window starts as [lo, hi]."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc, th, t, covered in zip(pdf["doc_id"].tolist(), pdf["th"].tolist(), pdf["text"].tolist(), pdf["covered"].tolist()):
                b = _bytes(t)
                c = np.array([(x["lo"], x["hi"] + length) for x in covered], np.int64)
                step = np.zeros(len(b) + 1, np.int64)
                np.add.at(step, c[:, 0], 1)
                np.add.at(step, c[:, 1], -1)
                gone = np.cumsum(step[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).reshape(-1, 2)
                kept = b[~gone].tobytes()
                out.append((doc, th, int(gone.sum()), edge.tolist(), kept, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "th", "n_removed", "spans", "kept", "kept_sha256"])

    return texts.mapInPandas(run, "doc_id long, th long, n_removed long, spans array<array<long>>, kept binary, kept_sha256 string")


def _listed(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """Rows of a text gathered: as many as the text has, at most."""
    return df.groupBy("doc_id", "th").agg(F.collect_list(F.struct(*columns)).alias(name))


def _on(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Joined by doc_id and th."""
    b = b.withColumnsRenamed({"doc_id": "_doc", "th": "_th"})
    return a.join(b, (F.col("doc_id") == F.col("_doc")) & (F.col("th") == F.col("_th")), how).drop("_doc", "_th")


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "first") -> DataFrame:
    """A row per row of docs: doc_id, n_bytes, n_removed, spans, kept_sha256, kept (bytes; null where nothing or all was removed)."""
    spool = Spool(docs.sparkSession, "repeats")
    first = keep == "first"
    text = F.coalesce(F.col("text"), F.lit(""))
    # Within, a null doc_id is the least number: a batch of longs with a null in it would reach Python as floats, which round ids.
    d = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text")).withColumn("doc_id", F.coalesce("id", F.lit(NO_ID)))
    d = d.select("id", "doc_id", "text", F.xxhash64("text").alias("th"), F.md5("text").alias("md5"), F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    small = d.drop("text")
    same = spool.write(small.groupBy("md5", "th").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")).filter("copies > 1"))
    rows = small.join(same, ["md5", "th"], "left")
    is_rep = F.col("rep").isNull() | (F.col("doc_id") == F.col("rep"))
    # every distinct text once: those with copies by their smallest doc_id
    texts = d.filter(F.col("n_bytes") >= length).select("doc_id", "th", "text")
    members = spool.write(small.join(same.select("md5", "th", "rep"), ["md5", "th"]).groupBy("doc_id", "th").agg(F.count("*").alias("n"), F.min("rep").alias("rep")))
    others, twice = members.filter("doc_id <> rep").select("doc_id", "th"), members.filter("n > 1").select("th")
    if not twice.isEmpty():  # rows that repeat a doc_id and its text
        again = maybe_in(texts, "th", twice)
        texts = maybe_in(texts, "th", twice, negate=True).unionByName(again.groupBy("doc_id", "th").agg(F.first("text").alias("text")))
    all_ = spool.write(_anchor_rows(texts, length))
    # only the anchors that may be a copy's are held against the copies
    lone = maybe_in(all_, "th", others.select("th"), negate=True).unionByName(_on(maybe_in(all_, "th", others.select("th")), others, "left_anti"))
    seen = spool.write(lone.groupBy("fp").agg(F.count("*").alias("c")).filter("c > 1").select("fp"))
    places = spool.write(_listed(maybe_in(lone, "fp", seen).join(seen, "fp"), "places", "fp", "p", "a", "z"))
    t = spool.write(_on(maybe_in(texts, "th", places.select("th")), places))
    spool.drop(all_, seen, places)

    at, place = ["fp", "blk", "core"], F.struct("doc_id", "lo", "th")
    source, decided, plain = t, [], t.drop("places")
    for block in BLOCKS:
        blocks = spool.write(_block_rows(source, length, block))
        classes = blocks.groupBy(*at, "whole").agg(F.count("*").alias("c"), F.min(place).alias("rep"))
        versions = classes.groupBy(*at).agg(F.count("*").alias("versions"), F.max("c").alias("most")).filter("versions > 1 or most > 1").select(*at, "versions")
        rest = blocks.join(versions, at).join(classes, [*at, "whole"]).withColumn("is_rep", place.eqNullSafe(F.col("rep")))
        rest = rest.select("doc_id", "th", "fp", "p", "lo", "hi", F.expr("c > 1 and not is_rep" if first else "c > 1").alias("whole"), F.expr("versions > 1 and is_rep").alias("open"))
        rest = spool.write(rest.filter("whole or open"))
        spool.drop(blocks)
        decided.append(rest.filter("whole").select("doc_id", "th", "lo", "hi"))
        source = _on(plain, _listed(rest.filter("open").select("doc_id", "th", "fp", "p", F.col("lo").alias("a"), F.col("hi").alias("z")), "places", "fp", "p", "a", "z"))
    windows = spool.write(_window_rows(source, length))
    run = ["fp", "o", "rank"]
    w = F.struct("doc_id", "s", "th")
    runs = windows.groupBy(*run).agg(F.count("*").alias("c"), F.min(w).alias("least")).filter("c > 1")
    single = windows.join(runs, run)
    if first:
        single = single.filter(~w.eqNullSafe(F.col("least")))
    covered = decided[0].unionByName(decided[1]).unionByName(single.select("doc_id", "th", F.col("s").alias("lo"), F.col("s").alias("hi")))
    cut = spool.write(_cut(_on(plain, _listed(covered, "covered", "lo", "hi")), length))

    copy = F.col("copies").isNotNull() & (F.col("n_bytes") >= length)
    if first:  # of equal rows with equal doc_ids, which one stays is not told apart: all take the first one's result
        copy = copy & ~is_rep
    base = rows.select("id", "doc_id", "th", "n_bytes", "sha", copy.alias("copy"))
    out = _on(base, cut, "left")
    gone = F.array(F.array(F.lit(0).cast("long"), F.col("n_bytes")))
    return out.select(
        F.col("id").alias("doc_id"), "n_bytes",
        F.when(F.col("copy"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(F.col("copy"), gone).otherwise(F.coalesce("spans", F.array().cast("array<array<bigint>>"))).alias("spans"),
        F.when(F.col("copy"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(~F.col("copy"), F.col("kept")).alias("kept"),
    )
