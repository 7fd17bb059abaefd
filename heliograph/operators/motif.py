"""Motifs: catalogue and matrices, selection, threshold ladder, scan of sequences on both strands."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliograph.functions.scores import source_priority

BACKGROUND = 0.25
#: Ladder of (mean, maximum) expression thresholds after the configured one. Fixed values.
LADDER = ((0.25, 0.5), (0.25, 0.25), (0.1, 0.25))
ENOUGH = 3
#: Places of a sequence that are scored at once, and hits that a task holds before it hands them on.
PLACES, HELD = 1 << 14, 10_000


def valid_matrices(rows: DataFrame) -> DataFrame:
    """motif_id, pos, p (array A, C, G, T, rows normalised), of matrices with 4 rows or more, all finite, row sums above 0.

    rows: motif_id, pos, A, C, G, T.
    """
    bases = ["A", "C", "G", "T"]
    total = sum((F.col(b) for b in bases[1:]), F.col(bases[0]))
    finite = F.lit(True)
    for b in bases:
        finite = finite & F.coalesce(~F.isnan(b) & (F.abs(b) < float("inf")), F.lit(False))
    ok = rows.groupBy("motif_id").agg(F.count("*").alias("n"), F.bool_and(finite & F.coalesce(total > 0, F.lit(False))).alias("ok")).filter("ok and n >= 4")
    return rows.join(ok.select("motif_id"), "motif_id", "left_semi").select("motif_id", "pos", F.array(*[F.col(b) / total for b in bases]).alias("p"))


def information_content(matrices: DataFrame) -> DataFrame:
    """motif_id, information_content (bits), width."""
    bits = F.aggregate("p", F.lit(0.0), lambda acc, p: acc + F.when(p > 0, p * F.log2(p / BACKGROUND)).otherwise(0.0))
    return matrices.groupBy("motif_id").agg(F.sum(bits).alias("information_content"), F.count("*").alias("width"))


def select_matrices(catalog: DataFrame, content: DataFrame, most: int | None = None) -> DataFrame:
    """Of each TF the motifs of its best evidence tier, by source priority, information content, id; with selected_rank.

    catalog: tf, motif_id, status (D: direct, I: inferred), source.
    """
    tier = F.when(F.col("status") == "D", 0).when(F.col("status") == "I", 1).otherwise(2)
    x = catalog.join(content, "motif_id").withColumns({"tier": tier, "source_priority": source_priority(F.col("source"))})
    x = x.withColumn("best", F.min("tier").over(Window.partitionBy("tf"))).filter("tier = best")
    order = [F.asc("source_priority"), F.desc("information_content"), F.asc("motif_id")]
    x = x.withColumn("_d", F.row_number().over(Window.partitionBy("tf", "motif_id").orderBy(*order, "source", "status"))).filter("_d = 1")
    x = x.withColumn("selected_rank", F.row_number().over(Window.partitionBy("tf").orderBy(*order)))
    if most is not None:
        x = x.filter(F.col("selected_rank") <= most)
    name = F.when(F.col("tier") == 0, "direct").otherwise("inferred")
    return x.select("tf", "motif_id", "source", "source_priority", "information_content", "selected_rank", name.alias("evidence_tier"))


def rungs(mean: float, maximum: float) -> list[tuple[float, float]]:
    return list(dict.fromkeys([(mean, maximum), *[r for r in LADDER if r[0] <= mean and r[1] <= maximum]]))


def ladder(summary: DataFrame, motifs: DataFrame, mean: float, maximum: float, forced: tuple[str, ...] = ()) -> DataFrame:
    """rung, mean, maximum, n_tfs of the chosen rung: the first with enough TFs that have a motif, else the last.

    Where no rung leaves a TF with a motif, collecting the row raises. summary: tf, pseudobulk_expression_mean, pseudobulk_expression_max. All rungs are counted in one aggregate.
    """
    steps = rungs(mean, maximum)
    x = summary.join(motifs.select("tf").distinct(), "tf", "left_semi")
    ok = lambda m, h: ((F.col("pseudobulk_expression_mean") > m) & (F.col("pseudobulk_expression_max") > h)) | F.col("tf").isin(*forced) if forced else (F.col("pseudobulk_expression_mean") > m) & (F.col("pseudobulk_expression_max") > h)
    counts = x.agg(F.array(*[F.count_if(ok(m, h)) for m, h in steps]).alias("n"))
    table = F.array(*[F.struct(F.lit(i).alias("rung"), F.lit(m).alias("mean"), F.lit(h).alias("maximum"), F.element_at("n", i + 1).alias("n_tfs")) for i, (m, h) in enumerate(steps)])
    chosen = F.coalesce(F.try_element_at(F.filter(table, lambda s: s["n_tfs"] >= ENOUGH), F.lit(1)), F.element_at(table, -1))
    some = F.when(F.array_max("n") > 0, chosen).otherwise(F.raise_error(F.lit("no TF with a motif passes any expression threshold")))
    return counts.select(some.alias("c")).select("c.*")


def log_odds(p: np.ndarray, pseudo: float = 1e-3) -> np.ndarray:
    return np.log2((p + pseudo * BACKGROUND) / (1 + pseudo) / BACKGROUND)


def score_tail(odds: np.ndarray, bins: int = 1000) -> tuple[float, float, np.ndarray]:
    """(least score, bin width, P(score >= bin)) under a uniform background, by dynamic programming over positions."""
    low, span = odds.min(1).sum(), max(1e-9, (odds.max(1) - odds.min(1)).sum())
    step = span / bins
    k = np.rint((odds - odds.min(1, keepdims=True)) / step).astype(int)
    dist = np.ones(1)
    for row in k:
        nxt = np.zeros(len(dist) + row.max())
        for b in row:
            nxt[b : b + len(dist)] += dist * BACKGROUND
        dist = nxt
    return low, step, np.minimum(1.0, np.cumsum(dist[::-1])[::-1])


def scan(sequences: DataFrame, matrices: dict[str, np.ndarray], threshold: float = 1e-5) -> DataFrame:
    """peak, motif_id, start, stop (half-open), strand, score, motif_pvalue below the threshold, both strands.

    matrices: the selected motifs (hundreds, of some kilobytes), sent with the function; sequences stay distributed.
    Positions with other letters than A, C, G, T don't match.
    """
    tables = {m: (log_odds(p), log_odds(p[::-1, ::-1])) for m, p in matrices.items()}
    tails = {m: score_tail(t[0]) for m, t in tables.items()}
    code = np.full(256, 4, np.uint8)
    for i, b in enumerate(b"ACGT"):
        code[b] = code[b + 32] = i

    columns = ["peak", "motif_id", "start", "stop", "strand", "score", "motif_pvalue"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for peak, seq in zip(pdf["peak"], pdf["sequence"]):
                if len(out) >= HELD:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
                s = code[np.frombuffer((seq or "").encode("latin-1", "replace"), np.uint8)]
                for m, both in tables.items():
                    width = len(both[0])
                    if len(s) < width:
                        continue
                    low, step, tail = tails[m]
                    for first in range(0, len(s) - width + 1, PLACES):
                        at = np.lib.stride_tricks.sliding_window_view(s[first : first + PLACES + width - 1], width)
                        for strand, t in zip("+-", both):
                            t5 = np.concatenate([t, np.full((width, 1), -1e9)], 1)
                            score = t5[np.arange(width), at].sum(1)
                            k = np.rint((score - low) / step).astype(np.int64)
                            p = np.where(score < -1e8, 1.0, tail[np.clip(k, 0, len(tail) - 1)])
                            for i in np.flatnonzero(p < threshold):
                                out.append((peak, m, first + int(i), first + int(i + width), strand, float(score[i]), float(p[i])))
            yield pd.DataFrame(out, columns=columns)

    return sequences.select("peak", "sequence").mapInPandas(run, "peak string, motif_id string, start long, stop long, strand string, score double, motif_pvalue double")


def tf_peak_hits(hits: DataFrame, motifs: DataFrame) -> DataFrame:
    """tf, peak, motif_id, motif_pvalue: the best hit of each TF in each peak."""
    from heliograph.operators.regulatory import best_motifs

    return best_motifs(hits.join(motifs.select("tf", "motif_id"), "motif_id").select("tf", "peak", "motif_id", "motif_pvalue"))
