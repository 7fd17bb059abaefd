"""Contracts checked at boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A table breaks what an operator asks of it."""


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    if missing := sorted(set(names) - set(df.columns)):
        raise ContractError(f"missing columns: {', '.join(missing)}")
    return df


def require_unique(df: DataFrame, *keys: str) -> DataFrame:
    if found := df.groupBy(*keys).count().filter("count > 1").limit(5).collect():
        raise ContractError(f"{', '.join(keys)} not unique: {[tuple(r)[:-1] for r in found]}")
    return df


def require_none(df: DataFrame, what: str) -> None:
    """No row is left."""
    if found := df.limit(5).collect():
        raise ContractError(f"{what}: {[tuple(r) for r in found]}")


def require_same_keys(a: DataFrame, b: DataFrame, *keys: str) -> None:
    require_none(set_difference(a, b, *keys), f"{', '.join(keys)} differ")


def set_difference(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """Keys of either side that the other lacks, with the side."""
    x, y = a.select(*keys).distinct(), b.select(*keys).distinct()
    return x.join(y, list(keys), "left_anti").withColumn("side", F.lit("left")).unionByName(y.join(x, list(keys), "left_anti").withColumn("side", F.lit("right")))


def one_to_one(a: DataFrame, b: DataFrame, keys: list[str], what: str = "unmatched rows") -> DataFrame:
    """Left join of unique keys where every row of a has its match."""
    require_unique(a, *keys)
    require_unique(b, *keys)
    require_none(a.join(b, keys, "left_anti").select(*keys), what)
    return a.join(b, keys)


def many_to_one(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    require_unique(b, *keys)
    require_none(a.join(b, keys, "left_anti").select(*keys).distinct(), "rows without a match")
    return a.join(b, keys, "left")
