"""Scores, distances and windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Order of motif sources; others come last. Fixed values.
SOURCE_PRIORITY = {"ChIP-exo": 0, "ChIP-seq_and_ChIP-exo": 0, "ChIP-seq": 1, "GHT-SELEX": 2, "SELEX": 2, "SMiLE-seq": 2, "meSMiLE-seq": 2, "PBM": 3, "B1H": 3, "JASPAR": 4, "Transfac": 4, "Misc": 5}
OTHER_SOURCE = 9


def active_score(tf: Column, peak: Column, gene: Column) -> Column:
    """Geometric mean of three percentiles."""
    return F.cbrt(tf * peak * gene)


def weighted_score(active: Column, rho: Column, rho_tf: Column) -> Column:
    """active * sqrt(rho * rho_tf); null where the product is negative."""
    both = rho * rho_tf
    return F.when(both >= 0, active * F.sqrt(both))


def signed_distance(start: Column, end: Column, point: Column) -> Column:
    """From a point to a half-open interval: positive after it, negative before it, 0 within."""
    return F.when(start > point, start - point).when(end < point, end - point).otherwise(F.lit(0).cast("long"))


def promoter(tss: Column, strand: Column, upstream: int, downstream: int) -> tuple[Column, Column]:
    """Half-open window around a start site, by strand, not below 0."""
    plus = strand == "+"
    lo = F.when(plus, tss - upstream).otherwise(tss - downstream)
    return F.greatest(lo, F.lit(0)).cast("long"), F.when(plus, tss + downstream).otherwise(tss + upstream).cast("long")


def source_priority(source: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in SOURCE_PRIORITY.items() for x in kv])
    return F.coalesce(F.try_element_at(m, source), F.lit(OTHER_SOURCE))


def job_limit(cells: Column, most: Column, free_mb: Column) -> Column:
    """Concurrent scan jobs: by cells, by half the free memory at 512 MB a job, at least 1."""
    by_cells = F.when(cells <= 10_000, 48).when(cells <= 25_000, 32).when(cells <= 50_000, 24).when(cells <= 100_000, 12).otherwise(8)
    return F.greatest(F.lit(1), F.least(most, by_cells, F.floor(free_mb / 2 / 512).cast("int")))
