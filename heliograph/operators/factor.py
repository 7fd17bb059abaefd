"""Truncated singular value decomposition of a sparse fact by a randomised range finder.

The matrix is kept as sparse tiles of bounded cells and features. Products with thin dense matrices are equi-joins of tiles with
blocks of the thin matrix's rows, summed by block; thin matrices are made orthonormal by tall-skinny QR: the blocks' triangles are
stacked and reduced by a tree until one is left. Only such triangles, `k` by `k` with some more columns, reach the driver; a task holds a
tile and a block, whatever the numbers of cells and features.

Where features are few, a cell's row is narrow: each task reduces its cells to a triangle, the triangles' triangle has the matrix's own singular
values and loadings, and scores are made in a second pass over the cells. That is exact, and nothing as long as the cells is written or shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliograph.operators.cut import cut, kept
from heliograph.operators.order import numbered

#: Rows of a block of cells and of features.
CELLS, FEATURES = 4096, 1024
#: Features that are few: their rows are made dense, CELLS at once.
FEW = 256
#: Triangles that one task of a level of the tree stacks.
FAN = 32
#: Columns beyond k, and rounds of power iteration.
MORE, ROUNDS = 10, 4
#: Of the largest singular value: directions below it are no more than rounding.
TINY = 1e-12
#: Bytes of arrays that one task reads: Spark hands Python up to 10,000 rows at once, whatever their size.
HELD = 32 << 20


def tiles(fact: DataFrame, feature: str, cells: DataFrame, features: DataFrame) -> DataFrame:
    """cb, fb (blocks), i, j (places in them), v, as arrays. cells: cell, n; features: feature, n; numbers from 1."""
    place = lambda df, key, n, size, block, at: df.select(key, F.expr(f"CAST((n - 1) div {size} AS INT)").alias(block), F.expr(f"CAST((n - 1) % {size} AS INT)").alias(at))
    x = fact.select("cell", feature, F.col("value").cast("double").alias("v")).filter("v <> 0")
    x = x.join(place(cells, "cell", "n", CELLS, "cb", "i"), "cell").join(place(features, feature, "n", FEATURES, "fb", "j"), feature)
    listed = x.groupBy("cb", "fb").agg(F.collect_list(F.struct("i", "j", "v")).alias("x"))
    return listed.select("cb", "fb", *[F.col(f"x.{c}").alias(c) for c in ("i", "j", "v")])


def _dense(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, "<f8").reshape(-1, width)


def _summed(parts: DataFrame, width: int, tasks: int) -> DataFrame:
    """block, m: the sums of a block's matrices, read one after another."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, total = None, None
        for pdf in batches:
            for b, m in zip(pdf["block"].tolist(), pdf["m"].tolist()):
                if b != block:
                    if block is not None:
                        yield pd.DataFrame({"block": [block], "m": [total.tobytes()]})
                    block, total = b, np.array(_dense(m, width))
                else:
                    total += _dense(m, width)
        if block is not None:
            yield pd.DataFrame({"block": [block], "m": [total.tobytes()]})

    return cut(parts.repartition(tasks, "block").sortWithinPartitions("block").mapInPandas(run, "block int, m binary"))


def product(t: DataFrame, thin: DataFrame, width: int, rows: dict[str, int], transposed: bool = False) -> DataFrame:
    """block, m: tiles times a thin matrix (block, m) of features, or the transposed tiles times one of cells.

    rows: how many cells and features there are, so that the last blocks are not padded, and of how many tasks each reads little. A task adds up
    what it makes of a block before it is dealt.
    """
    left, right, size, most = ("fb", "cb", FEATURES, rows["features"]) if transposed else ("cb", "fb", CELLS, rows["cells"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made, held = {}, 0

        def out() -> Iterator[pd.DataFrame]:
            for b, x in made.items():
                yield pd.DataFrame({"block": [b], "m": [x.tobytes()]})

        for pdf in batches:
            for block, i, j, v, m in zip(*(pdf[c].tolist() for c in (left, "i", "j", "v", "m"))):
                m, v = _dense(m, width), np.asarray(v)
                to, of = (j, i) if transposed else (i, j)
                o = np.argsort(to, kind="stable")
                to, terms = np.asarray(to)[o], m[np.asarray(of)[o]] * v[o, None]
                first = np.flatnonzero(np.diff(to, prepend=-1))
                if block not in made:
                    if held > HELD:
                        yield from out()
                        made, held = {}, 0
                    made[block] = np.zeros((min(size, most - block * size), width))
                    held += made[block].nbytes
                made[block][to[first]] += np.add.reduceat(terms, first, axis=0)
        yield from out()

    if transposed:  # a tile and a block of cells are one row; the features' blocks are few, so they would not spread tiles
        t = t.repartition(rows["tasks"], right)
    return _summed(t.join(thin.withColumnRenamed("block", right), right).select(left, "i", "j", "v", "m").mapInPandas(run, "block int, m binary"), width, rows["tasks"])


def _triangle(thin: DataFrame, width: int, blocks: int) -> np.ndarray:
    """R of thin = Q R, by a tree: triangles of FAN neighbouring blocks are stacked and made one, level by level."""

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"block": pdf["block"], "m": [np.linalg.qr(_dense(m, width), mode="r").tobytes() for m in pdf["m"].tolist()]})

    return _stacked(thin.mapInPandas(own, "block int, m binary"), width, blocks)


def _stacked(level: DataFrame, width: int, blocks: int) -> np.ndarray:
    """The triangle of triangles (block, m), numbered below `blocks`."""

    def stack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            whole = [np.concatenate([_dense(x, width) for x in ms]) for ms in pdf["ms"].tolist()]
            yield pd.DataFrame({"block": pdf["block"], "m": [np.linalg.qr(x, mode="r").tobytes() for x in whole]})

    while blocks > FAN:
        level = level.groupBy(F.expr(f"CAST(block div {FAN} AS INT)").alias("block")).agg(F.collect_list("m").alias("ms")).mapInPandas(stack, "block int, m binary")
        blocks = -(-blocks // FAN)
    rest = [_dense(bytes(r["m"]), width) for r in level.collect()]  # at most FAN triangles
    return np.linalg.qr(np.concatenate(rest), mode="r")


def _times(thin: DataFrame, width: int, right: np.ndarray) -> DataFrame:
    """Each block times a small matrix."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"block": pdf["block"], "m": [(_dense(m, width) @ right).tobytes() for m in pdf["m"].tolist()]})

    return thin.mapInPandas(run, "block int, m binary")


def orthonormal(thin: DataFrame, width: int, blocks: int, passes: int = 1) -> tuple[DataFrame, int]:
    """An orthonormal basis of the columns' span, and its width. A second pass removes what the condition number magnifies."""
    for _ in range(passes):
        _, s, vt = np.linalg.svd(_triangle(thin, width, blocks))
        kept = int((s > TINY * s.max(initial=0)).sum())
        thin, width = _times(thin, width, vt[:kept].T / s[:kept]), kept
    return thin, width


def _start(features: DataFrame, n: int, width: int, seed: int) -> DataFrame:
    """Normal random numbers, by blocks of features."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            blocks = pdf["id"].tolist()
            m = [np.random.default_rng([seed, b]).standard_normal((min(FEATURES, n - b * FEATURES), width)).tobytes() for b in blocks]
            yield pd.DataFrame({"block": blocks, "m": m})

    return features.sparkSession.range(-(-n // FEATURES)).mapInPandas(run, "block int, m binary")


def _signs(vectors: DataFrame, width: int) -> np.ndarray:
    """Of each column, the sign of its entry of the largest size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for b, m in zip(pdf["block"].tolist(), pdf["m"].tolist()):
                m = _dense(m, width)
                at = np.abs(m).argmax(0)
                yield pd.DataFrame({"c": np.arange(width), "v": m[at, np.arange(width)], "at": b * FEATURES + at})

    best = F.max_by("v", F.struct(F.round(F.abs("v"), 9), -F.col("at")))
    found = {r["c"]: r["v"] for r in vectors.mapInPandas(run, "c int, v double, at long").groupBy("c").agg(best.alias("v")).collect()}
    return np.array([-1.0 if found.get(c, 1.0) < 0 else 1.0 for c in range(width)])


def svd(fact: DataFrame, feature: str, k: int = 50, seed: int = 0, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray, DataFrame]:
    """(scores: cell, x, that is u * s; the k singular values; loadings: feature, x) of the uncentred matrix, signs by the largest loading.

    Cells and features without a value have no row. With k + MORE columns or fewer in the matrix the result is exact.
    """
    fact = fact.select("cell", F.struct(F.col(feature).alias("f"), F.col("value").cast("double").alias("v")).alias("x")).filter("x.v <> 0")
    listed = kept(fact.groupBy("cell").agg(F.collect_list("x").alias("x")))
    names = listed.select(F.explode("x.f").alias(feature)).distinct()
    few = names.orderBy(feature).limit(FEW + 1).collect()
    if len(few) <= FEW:
        return _svd_of_few(listed, names.schema[feature], [r[0] for r in few], k)
    fact = listed.select("cell", F.explode("x").alias("x")).select("cell", F.col("x.f").alias(feature), F.col("x.v").alias("value"))
    cells, features = (cut(numbered(df, [c])) for df, c in ((listed.select("cell"), "cell"), (names, feature)))
    rows = {"cells": cells.count(), "features": features.count()}
    least = min(rows.values())
    if min(k, least) < 2:
        raise ValueError("an embedding needs two dimensions or more")
    k, width = min(k, least), min(k + MORE, least)
    bytes_ = 16 * fact.count() + 8 * width * (rows["cells"] + rows["features"])
    rows["tasks"] = max(-(-bytes_ // HELD), min(int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-bytes_ // (1 << 20))))
    t = cut(tiles(fact, feature, cells, features).repartition(rows["tasks"], "cb", "fb"))
    cb, fb = -(-rows["cells"] // CELLS), -(-rows["features"] // FEATURES)
    steps = 0 if width == least else rounds  # as many columns as the matrix can fill span all of it at once
    basis, w = orthonormal(product(t, _start(features, rows["features"], width, seed), width, rows), width, cb, 1 if steps else 2)
    for step in range(steps):
        back, w = orthonormal(product(t, basis, w, rows, True), w, fb)
        basis, w = orthonormal(product(t, back, w, rows), w, cb, 2 if step == steps - 1 else 1)
    basis = cut(basis)
    back = product(t, basis, w, rows, True)  # the transposed matrix times the basis: features by w
    _, s, vt = np.linalg.svd(_triangle(back, w, fb))
    k = min(k, int((s > TINY * s.max(initial=0)).sum()))
    loadings = cut(_times(back, w, vt[:k].T / s[:k]))
    signs = _signs(loadings, k)
    scores = _times(basis, w, vt[:k].T * (s[:k] * signs))
    return _named(scores, k, cells, "cell", CELLS), s[:k], _named(_times(loadings, k, np.diag(signs)), k, features, feature, FEATURES)


def _svd_of_few(listed: DataFrame, feature: T.StructField, names: list, k: int) -> tuple[DataFrame, np.ndarray, DataFrame]:
    """As svd, exact. listed: cell, x: array of (f, v); names: the different f, in their order."""
    width, least = len(names), min(listed.count(), len(names))
    if min(k, least) < 2:
        raise ValueError("an embedding needs two dimensions or more")

    def rows(x: pa.ListArray) -> np.ndarray:
        flat = x.flatten()
        j = pc.index_in(flat.field("f"), value_set=pa.array(names, flat.type.field("f").type)).to_numpy()
        i = np.repeat(np.arange(len(x)), pc.list_value_length(x).to_numpy())
        return np.bincount(i * width + j, flat.field("v").to_numpy(), len(x) * width).reshape(-1, width)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, CELLS):
                yield batch.slice(s, CELLS)

    def triangle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in parts(batches):
            r = np.linalg.qr(np.concatenate([r, rows(batch.column("x"))]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_pydict({"block": pa.array([TaskContext.get().partitionId()], pa.int32()), "m": pa.array([r.tobytes()], pa.binary())})

    x = listed.select("x")
    _, s, vt = np.linalg.svd(_stacked(x.mapInArrow(triangle, "block int, m binary"), width, x.rdd.getNumPartitions()))
    k = min(k, least, int((s > TINY * s.max(initial=0)).sum()))
    v = vt[:k].T
    v = v * np.where(v[np.abs(v).round(9).argmax(0), np.arange(k)] < 0, -1.0, 1.0)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            u = rows(batch.column("x")) @ v
            yield pa.RecordBatch.from_arrays([batch.column("cell"), pa.ListArray.from_arrays(pa.array(np.arange(len(u) + 1) * k, pa.int32()), pa.array(u.ravel()))], ["cell", "x"])

    of = lambda key: T.StructType([key, T.StructField("x", T.ArrayType(T.DoubleType()))])
    loadings = listed.sparkSession.createDataFrame([(n, r) for n, r in zip(names, v.tolist())], of(feature))
    return listed.mapInArrow(scored, of(listed.schema["cell"])), s[:k], loadings


def _named(thin: DataFrame, width: int, names: DataFrame, key: str, size: int) -> DataFrame:
    """key, x: the rows of a thin matrix with their names."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for b, m in zip(pdf["block"].tolist(), pdf["m"].tolist()):
                m = _dense(m, width)
                yield pd.DataFrame({"n": b * size + 1 + np.arange(len(m)), "x": list(m)})

    return names.join(thin.mapInPandas(run, "n long, x array<double>"), "n").select(key, "x")


def truncated_svd(fact: DataFrame, feature: str, k: int = 50) -> DataFrame:
    """cell, x: array of k scores, u * s of the uncentred matrix."""
    return svd(fact, feature, k)[0]

