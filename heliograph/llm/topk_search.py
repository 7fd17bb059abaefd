"""Exact top-k inner-product search by no-random-access aggregation.

Every dimension of a block of candidates is a sorted list. The lists are read sequentially from the end that
favours the query; after each depth every candidate has a lower bound (what was read plus the worst of the rest)
and an upper bound (what was read plus each list's frontier value). Candidates whose upper bound is below the k-th
lower bound cannot qualify; reading goes deeper only for queries with many candidates left, and the scores of the few that are left are resolved.
The k-th best score carries over from block to block within a task.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part; vectors of other lengths
count as padded with zeros; an id in several rows counts once, with its best score, and never answers itself; ties go to
the smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK, QUERIES = 2048, 1024
#: Shares of each list read before bounds are compared.
DEPTHS = (0.125, 0.5)
#: A query whose outsiders are excluded but for so many candidates reads no further; their scores are resolved.
FEW = 64


def quantize(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """Not null, no null, NaN or infinite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def _matrix(rows: list, d: int | None = None) -> np.ndarray:
    d = max((len(r) for r in rows), default=0) if d is None else d
    out = np.zeros((len(rows), d), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _packed(df: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        ids: list[int] = []
        rows: list = []
        made, base = 0, TaskContext.get().partitionId()

        def out() -> pd.DataFrame:
            m = _matrix(rows)
            kind = "i4" if m.size == 0 or np.abs(m).max() < 2**31 else "i8"
            return pd.DataFrame({"block": [base * 1_000_003 + made], "ids": [np.array(ids, "<i8").tobytes()], "kind": [kind], "d": [m.shape[1]], "m": [m.astype(f"<{kind}").tobytes()]})

        for pdf in batches:
            for i, v in zip(pdf["id"].tolist(), pdf["v"].tolist()):
                ids.append(i)
                rows.append(v)
                if len(ids) == size:
                    yield out()
                    made += 1
                    ids, rows = [], []
        if ids:
            yield out()

    return df.mapInPandas(run, "block long, ids binary, kind string, d int, m binary")


def _unpack(ids: bytes, kind: str, d: int, m: bytes) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, "<i8")
    return i, np.frombuffer(m, f"<{kind}").reshape(len(i), d).astype(np.int64)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T, exact: in floats while every partial sum stays below 2**53."""
    top = (np.abs(a).max(initial=0) + 0.0) * (np.abs(b).max(initial=0) + 0.0) * max(1, a.shape[1])
    if top < 2**53:
        return np.rint(a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


NONE = np.iinfo(np.int64).min


class SortedLists:
    """A block of candidates as one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.x, self.n = ids, x.astype(np.float64), len(ids)
        order = np.argsort(x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.x, order, 0)
        self.rank = np.empty_like(order)
        np.put_along_axis(self.rank, order, np.arange(self.n)[:, None], 0)
        self.exact = x
        self.safe = len(np.unique(ids)) == len(ids) and (np.abs(self.x).max(initial=0)) < 2**22

    def bounds(self, q: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (query x candidate) after `depth` entries of every list."""
        pos, neg = np.maximum(q, 0.0), np.minimum(q, 0.0)
        top, low = self.rank >= self.n - depth, self.rank < depth
        seen = pos @ np.where(top, self.x, 0).T + neg @ np.where(low, self.x, 0).T
        no_top, no_low = (~top).astype(np.float64).T, (~low).astype(np.float64).T
        upper = seen + (pos * self.sorted[self.n - depth]) @ no_top + (neg * self.sorted[depth - 1]) @ no_low
        lower = seen + (pos * self.sorted[0]) @ no_top + (neg * self.sorted[-1]) @ no_low
        return lower, upper


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, q_ids: np.ndarray, q: np.ndarray, k: int) -> None:
        self.q_ids, self.q, self.k = q_ids, q, k
        self.score = np.full((len(q_ids), k), NONE)
        self.id = np.full((len(q_ids), k), np.iinfo(np.int64).max)

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Merges candidate columns (score, id per query row of `at`); an id counts once."""
        s = np.concatenate([self.score[at], score], 1)
        i = np.concatenate([self.id[at], ids], 1)
        own = i == self.q_ids[at][:, None]
        s = np.where(own, NONE, s)
        rows = np.arange(len(at))[:, None]
        o = np.lexsort((-np.maximum(s, NONE + 1), i), axis=1)
        s, i = s[rows, o], i[rows, o]
        s[:, 1:][i[:, 1:] == i[:, :-1]] = NONE
        o = np.lexsort((i, -np.maximum(s, NONE + 1)), axis=1)[:, : self.k]
        self.score[at], self.id[at] = s[rows, o], i[rows, o]

    def merge(self, block: SortedLists) -> None:
        open_, qf, k = np.arange(len(self.q_ids)), self.q.astype(np.float64), self.k
        d = min(qf.shape[1], block.x.shape[1])
        qf = qf[:, :d]
        if d == 0 or not block.safe or np.abs(qf).max(initial=0) >= 2**22 or block.x.shape[1] > d:
            self._resolve(open_, block, None)
            return
        for share in DEPTHS:
            depth = max(1, int(block.n * share))
            if not len(open_) or depth >= block.n:
                break
            lower, upper = block.bounds(qf[open_], depth)
            own = block.ids[None, :] == self.q_ids[open_][:, None]
            lower[own] = upper[own] = -np.inf
            need = self.score[open_, -1].astype(np.float64)
            if block.n > k:
                need = np.maximum(need, np.partition(lower, block.n - k, axis=1)[:, block.n - k])
            left = (upper >= need[:, None]) & ~own
            n_left = left.sum(1)
            few = n_left <= FEW
            done = np.flatnonzero(few & (n_left > 0))
            if len(done):
                self._resolve(open_[done], block, left[done])
            open_ = open_[~few]
        if len(open_):
            self._resolve(open_, block, None)

    def _resolve(self, at: np.ndarray, block: SortedLists, left: np.ndarray | None) -> None:
        d = max(self.q.shape[1], block.exact.shape[1])
        x = np.pad(block.exact, ((0, 0), (0, d - block.exact.shape[1])))
        q = np.pad(self.q[at], ((0, 0), (0, d - self.q.shape[1])))
        if left is not None:
            for r, row in zip(at, left):
                c = np.flatnonzero(row)
                self.add(np.array([r]), _product(q[at == r], x[c]), block.ids[c][None, :])
            return
        s = _product(q, x)
        ids = np.broadcast_to(block.ids, s.shape)
        if block.safe and block.n > self.k + 1:  # one more than k, for the query itself; all ties of the last
            s = np.where(ids == self.q_ids[at][:, None], NONE, s)
            last = np.partition(s, block.n - self.k, axis=1)[:, block.n - self.k]
            keep = s >= np.maximum(last, self.score[at, -1])[:, None]
            most = int(keep.sum(1).max(initial=0))
            if most < block.n:
                if not most:
                    return
                o = np.argsort(~keep, axis=1, kind="stable")[:, :most]
                rows = np.arange(len(at))[:, None]
                s, ids = np.where(keep[rows, o], s[rows, o], NONE), ids[rows, o]
        self.add(at, s, ids)


def top_k(df: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, id_col, score: the k rows of df with the highest integer inner product with each query row.

    Blocks of candidates meet blocks of queries in an equi-join on a bucket number to which every query block is
    dealt once, so work is spread over buckets whatever the data; only k rows a query leave each task.
    """
    spark = df.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    part = lambda t: t.filter(F.col(id_col).isNotNull() & usable(F.col(vector))).select(F.col(id_col).cast("long").alias("id"), quantize(F.col(vector), scale).alias("v"))
    c = _packed(part(df), BLOCK).withColumn("bucket", F.pmod(F.xxhash64("block"), F.lit(buckets)))
    q = _packed(part(queries), QUERIES).select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))).alias("bucket"), *[F.col(x).alias(f"q_{x}") for x in ("block", "ids", "kind", "d", "m")])
    both = c.join(q, "bucket")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, Best] = {}
        lists: tuple = (None, None)
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if r.q_block not in best:
                    best[r.q_block] = Best(*_unpack(r.q_ids, r.q_kind, r.q_d, r.q_m), k)
                if lists[0] != r.block:
                    lists = (r.block, SortedLists(*_unpack(r.ids, r.kind, r.d, r.m)))
                best[r.q_block].merge(lists[1])
                if len(best) > 64:  # bounded memory: what is best so far goes out and starts anew
                    for b in best.values():
                        yield from found(b)
                    best = {}
        for b in best.values():
            yield from found(b)

    def found(b: Best) -> Iterator[pd.DataFrame]:
        ok = b.score > NONE
        yield pd.DataFrame({"query_id": np.repeat(b.q_ids, ok.sum(1)), "id": b.id[ok], "score": b.score[ok]})

    partial = both.mapInPandas(run, "query_id long, id long, score long")
    one = partial.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return one.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
