"""Near-duplicates by MinHash with sequential Bayesian verification.

1. Each text's set of shingles gives `bands` band keys (for candidates) and a separate signature (for verification).
   Texts with equal sets are one class, known by its smallest doc_id.
2. Classes that share a band key are candidates. Every member of a bucket is first paired with the bucket's smallest
   member, which is linear in the bucket; the links found join classes into components.
3. Only buckets that still hold several components are compared further: they are dealt into blocks of bounded size,
   and pairs of different components meet block by block, as arrays and not as rows; first each member's best partners,
   then everything that is still apart. Bottom sketches (whole sets, where these are small) thin out what signatures leave.
4. A candidate pair's signatures are compared batch by batch; it is dropped once the posterior probability (uniform prior)
   that its similarity reaches the threshold is below `miss`. What is left is verified exactly on full sets.

A link is missed only if no band agrees - (1 - s**rows)**bands, under 6e-6 at 0.75 - or by the chosen miss probability.

Defined cases: a null, empty or blank text has an empty set and links with nothing; a text of fewer words than a shingle is one
shingle; rows that repeat a doc_id are one document, with the links of each of its texts, and n_shingles of each row's own; a null
doc_id is kept, with no component; an empty table gives no rows; other columns are ignored, whatever their names; texts of any
length are read whole.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SHINGLE, SIMILARITY, Spool, WordHashes, id_received, id_sent, maybe_in, mix64, shares, shingle_hashes, texts
from .components import components

BANDS, ROWS, SIGNATURE, BATCH, BLOCK = 32, 4, 128, 32, 256
#: Size of the bottom sketches that settle pairs within open buckets; a set of fewer shingles is held whole.
BOTTOM = 512
MISS = 1e-6
#: From here on are the numbers of texts that share their doc_id with others.
OWN = 1 << 62


def hash_family(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def minhash(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each a*x + b over the set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(out, (a[:, None] * x[i : i + 512] + b[:, None]).min(1), out=out)
    return out


def least_matches(threshold: float, miss: float, size: int = SIGNATURE, batch: int = BATCH) -> dict[int, int]:
    """n compared hashes -> the fewest matches with P(similarity >= threshold | matches) >= miss.

    The posterior is Beta(1 + m, 1 + n - m); its upper tail at t is P(Binomial(n + 1, t) <= m).
    """
    out = {}
    for n in range(batch, size + 1, batch):
        p, m = 0.0, -1
        while p < miss:
            m += 1
            p += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def survivors(a: np.ndarray, b: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Indices of the signature pairs (rows of a and b) that no batch prunes."""
    left, matches, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, m in least.items():
        matches[left] += (a[left, done:n] == b[left, done:n]).sum(1)
        left, done = left[matches[left] >= m], n
    return left


def sketches(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, class_key (of the set), bands, sig; the last three null for an empty set."""
    ab, sig = hash_family(BANDS * ROWS, 1), hash_family(SIGNATURE, 2)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        hashes = WordHashes()
        salt = np.arange(BANDS, dtype=np.uint64) << np.uint64(40)
        for pdf, tx in texts(batches):
            out = []
            for i, t in zip(pdf["doc_id"].tolist(), tx):
                s = shingle_hashes(t, hashes, k)
                if not len(s):
                    out.append((i, 0, None, None, None))
                    continue
                m = minhash(s, *ab).astype(np.uint64).reshape(BANDS, ROWS)
                key = salt
                for r in range(ROWS):
                    key = mix64(key + m[:, r])
                out.append((i, len(s), xxhash.xxh3_128_digest(s.tobytes()), key.view(np.int64).tolist(), minhash(s, *sig).tobytes()))
            yield pd.DataFrame(out, columns=["doc_id", "n_shingles", "class_key", "bands", "sig"])

    out = docs.select(id_sent("doc_id"), "text").mapInPandas(run, "doc_id string, n_shingles long, class_key binary, bands array<long>, sig binary")
    return out.withColumn("doc_id", id_received("doc_id"))


def bottom(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """doc_id, low: the BOTTOM smallest shingle hashes (32 bits) of the documents in ids."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for pdf, tx in texts(batches):
            low = [(shingle_hashes(t, hashes, k) >> np.uint64(32)).astype(np.uint32)[:BOTTOM].tobytes() for t in tx]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "low": low})

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return maybe_in(d, "doc_id", ids).mapInPandas(run, "doc_id long, low binary").filter("length(low) > 0")


def may_reach(x: np.ndarray, y: np.ndarray, least: int) -> bool:
    """Whether two bottom sketches leave the similarity possible: by the matches among the smallest BOTTOM of the union."""
    both = np.intersect1d(x, y)
    union = np.union1d(x, y)
    return len(union) < BOTTOM or int((both <= union[BOTTOM - 1]).sum()) >= least


def _matrix(sigs) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), np.uint32).reshape(len(sigs), -1)


def pruned(pairs: DataFrame, reps: DataFrame, least: dict[int, int]) -> DataFrame:
    """The pairs (a, b) whose signatures keep them in play."""
    s = lambda x: reps.select(F.col("doc_id").alias(x), F.col("sig").alias(f"sig_{x}"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.iloc[survivors(_matrix(pdf["sig_a"].tolist()), _matrix(pdf["sig_b"].tolist()), least)][["a", "b"]]

    return pairs.join(s("b"), "b").join(s("a"), "a").select("a", "b", "sig_a", "sig_b").mapInPandas(run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, k: int, similarity: float) -> DataFrame:
    """The pairs whose full shingle sets reach the similarity."""
    t = lambda x: docs.select(F.col("doc_id").cast("long").alias(x), F.col("text").alias(f"text_{x}"))
    percent = round(100 * similarity)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, sets = WordHashes(), OrderedDict()

        def of(i: int, text: str) -> np.ndarray:
            if (i, len(text)) not in sets:
                sets[i, len(text)] = shingle_hashes(text, hashes, k)
                if len(sets) > 64:
                    sets.popitem(last=False)
            return sets[i, len(text)]

        for pdf in batches:
            ok = []
            for a, b, ta, tb in zip(pdf["a"].tolist(), pdf["b"].tolist(), pdf["text_a"].tolist(), pdf["text_b"].tolist()):
                x, y = of(a, ta), shingle_hashes(tb, hashes, k)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
                ok.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield pdf.loc[ok, ["a", "b"]]

    tb, ta = (maybe_in(t(x), x, pairs.select(x).distinct()) for x in ("b", "a"))
    return pairs.join(tb, "b").join(ta, "a").select("a", "b", "text_a", "text_b").filter("text_a is not null and text_b is not null").mapInPandas(run, "a long, b long")


def _across(open_rows: DataFrame, least: dict[int, int], best: int | None, percent: int, few: int) -> DataFrame:
    """Pairs (a < b) of different components within open buckets that survive the signatures and the bottom sketches.

    best: only so many partners of each member, those that agree most; None: all.
    open_rows: key, size, doc_id, comp, sig, low. Members are dealt into blocks of about BLOCK rows; each pair of blocks is a group.
    """
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("long")
    own = F.pmod(F.xxhash64("doc_id"), blocks)
    dealt = open_rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("first"), "doc_id", "comp", "sig", "low")
    seen_most = 100_000

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, rows, seen = None, [], set()

        def out() -> Iterator[pd.DataFrame]:
            ids, comp = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
            if len(rows) < 2 or (comp == comp[0]).all():
                return
            sets: dict[int, set] = {}

            def low_set(r: int) -> set:
                if r not in sets:
                    sets[r] = set(np.frombuffer(rows[r][4], np.uint32).tolist())
                return sets[r]

            sig, first, same = _matrix([r[2] for r in rows]), np.array([r[3] for r in rows]), group[1] == group[2]
            for r in range(len(rows)):
                c = np.flatnonzero((comp != comp[r]) & ((np.arange(len(rows)) > r) if same else (~first)))
                if (same or first[r]) and len(c):
                    c = c[survivors(np.broadcast_to(sig[r], (len(c), sig.shape[1])), sig[c], least)]
                    if best is not None and len(c) > best:
                        c = c[np.argsort(-(sig[c] == sig[r]).sum(1), kind="stable")[:best]]
                    x, mine = np.frombuffer(rows[r][4], np.uint32), low_set(r)
                    ok = []
                    for q in c.tolist():
                        pair = (min(ids[r], ids[q]), max(ids[r], ids[q]))
                        if pair not in seen:  # another band's bucket may have shown the pair
                            if len(seen) < seen_most:
                                seen.add(pair)
                            y = low_set(q)
                            if len(mine) < BOTTOM and len(y) < BOTTOM:  # whole sets; room for one collision of 32-bit hashes
                                both = len(mine & y)
                                if 100 * (both + 1) >= percent * (len(mine) + len(y) - both - 1):
                                    ok.append(pair)
                            elif may_reach(x, np.frombuffer(rows[q][4], np.uint32), few):
                                ok.append(pair)
                    if ok:
                        yield pd.DataFrame(ok, columns=["a", "b"])

        for pdf in batches:
            for key, i, j, first, doc, comp, sig, low in zip(*(pdf[c].tolist() for c in ("key", "i", "j", "first", "doc_id", "comp", "sig", "low"))):
                if group != (key, i, j):
                    if rows:
                        yield from out()
                    group, rows = (key, i, j), []
                rows.append((doc, comp, sig, first, low))
        if rows:
            yield from out()

    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInPandas(run, "a long, b long").distinct()


def _vertices(docs: DataFrame, spool: Spool) -> tuple[DataFrame, DataFrame | None]:
    """docs (doc_id, text) with texts that share a doc_id under numbers of their own, and (a: doc_id, b: number) of those, if any.

    Such numbers lie above OWN, so the smallest vertex of a component is a doc_id; doc_ids are held to be below OWN.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    several = spool.write(docs.filter("doc_id is not null and text is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    if several.isEmpty():
        return docs, None
    rest = docs.filter("doc_id is null").unionByName(maybe_in(docs, "doc_id", several, negate=True))
    number = F.when(F.col("_several") & F.col("text").isNotNull(), F.expr(f"{OWN}L | shiftrightunsigned(xxhash64(doc_id, text), 2)")).otherwise(F.col("doc_id"))
    own = spool.write(shares(maybe_in(docs, "doc_id", several), several, ["doc_id"], "_several").select("doc_id", number.alias("b"), "text"))
    ties = spool.write(own.filter("b <> doc_id").select(F.col("doc_id").alias("a"), "b").distinct())
    return rest.unionByName(own.select(F.col("b").alias("doc_id"), "text")), ties


def near_duplicates(docs: DataFrame, k: int = SHINGLE, similarity: float = SIMILARITY, miss: float = MISS) -> DataFrame:
    """A row per row of docs: doc_id, n_shingles, component_id (smallest doc_id reachable), kept (whether it is that one)."""
    spool = Spool(docs.sparkSession, "minhash")
    docs, ties = _vertices(docs, spool)
    least = least_matches(similarity, miss)
    all_ = spool.write(sketches(docs, k))
    sets = all_.filter("class_key is not null and doc_id is not null")
    classes = sets.groupBy("class_key").agg(F.min("doc_id").alias("rep"))
    members = spool.write(sets.select("doc_id", "class_key").join(classes, "class_key").filter("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")).distinct())
    reps = spool.write(sets.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "class_key"], "left_semi").select("doc_id", "bands", "sig"))

    rows = reps.select("doc_id", F.explode("bands").alias("key"))
    buckets = spool.write(rows.groupBy("key").agg(F.count("*").alias("size"), F.min("doc_id").alias("a")).filter("size > 1"))
    placed = spool.write(rows.join(buckets, "key").select("key", "size", "a", "doc_id"))
    pairs = placed.filter("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct()
    links = spool.write(verified(spool.write(pruned(pairs, reps, least)), docs, k, similarity))

    # First each member's best partners, which joins what belongs together; then all that is still apart.
    percent, few = round(100 * similarity), least_matches(similarity, miss, BOTTOM, BOTTOM)[BOTTOM]
    low = None
    for best in (3, None):
        comp = components(links)
        wide = placed.filter("size > 2").join(comp.select(F.col("v").alias("doc_id"), "root"), "doc_id", "left").select("key", "size", "doc_id", F.coalesce("root", "doc_id").alias("comp"))
        wide = spool.write(wide)
        open_ = wide.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
        rest = spool.write(wide.join(open_, "key"))
        if low is None:
            low = spool.write(bottom(docs, rest.select("doc_id").distinct(), k))
        across = spool.write(_across(rest.join(reps.select("doc_id", "sig"), "doc_id").join(low, "doc_id"), least, best, percent, few))
        links = links.unionByName(spool.write(verified(across, docs, k, similarity)))
        spool.drop(wide, rest, across)
    root = components(links.unionByName(members) if ties is None else links.unionByName(members).unionByName(ties))
    out = all_.select("doc_id", "n_shingles").join(root.select(F.col("v").alias("doc_id"), "root"), "doc_id", "left")
    if ties is not None:
        out = out.join(ties.select(F.col("a").alias("_a"), F.col("b").alias("doc_id")), "doc_id", "left").withColumn("doc_id", F.coalesce("_a", "doc_id"))
    c = F.coalesce("root", "doc_id")
    return out.select("doc_id", "n_shingles", c.alias("component_id"), F.coalesce(c == F.col("doc_id"), F.lit(True)).alias("kept"))
