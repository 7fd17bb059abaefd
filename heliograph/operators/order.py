"""Numbers, sums, maxima and neighbours in an order, without all rows of a key in one task.

Rows are dealt by ranges of the order; what a row needs of other ranges comes from a table with one row a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliograph.operators.cut import cut

#: Rows that one task makes of a table which a join multiplies: they stay in memory.
ROWS = 1_000_000


def tasks(df: DataFrame, rows: int | None) -> int:
    """Partitions for so many rows, and no fewer than the session's."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(rows or 0) // ROWS))


def beside(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """a with b's other columns, by null-safe equality."""
    x, y = a.alias("x"), b.alias("y")
    cond = F.lit(True)
    for k in on:
        cond = cond & F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}"))
    return x.join(y, cond).select("x.*", *[f"y.{c}" for c in b.columns if c not in on])


def ranged(df: DataFrame, keys: list[str | Column]) -> DataFrame:
    """df dealt by ranges of keys, with the range's number _range; written once, so that it can be read by several branches."""
    return cut(df.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()))


def running(df: DataFrame, amount: str | None, order: list[str | Column], by: tuple[str, ...] = (), name: str = "n") -> DataFrame:
    """df with name: the sum of `amount` (of 1, if None) up to each row, within `by`, in an order without ties.

    Rows are dealt by ranges of (by, order); what a row adds up to is its sum within its range and the sums of ranges before.
    """
    one = F.lit(1).cast("long") if amount is None else F.col(amount)
    x = ranged(df, [F.col(k) if isinstance(k, str) else k for k in (*by, *order)])
    sums = x.groupBy("_range", *by).agg(F.sum(one).alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy(*by).orderBy("_range")) - F.col("_rows")
    local = F.sum(one).over(Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = beside(x.withColumn(name, local), sums.select("_range", *by, before.alias("_before")), ["_range", *by])
    return out.withColumn(name, F.col(name) + F.col("_before")).drop("_range", "_before")


def numbered(df: DataFrame, order: list[str | Column], by: tuple[str, ...] = (), name: str = "n") -> DataFrame:
    """df with name: the row's number from 1, within `by`, in an order without ties."""
    return running(df, None, order, by, name)


def scanned(x: DataFrame, order: list[str], by: tuple[str, ...], **columns: tuple[str, Column]) -> DataFrame:
    """x (of ranged) with columns that each row takes from others, within `by`, in the order.

    columns: name=(kind, value). "max": the largest value of the rows before; "last": the latest value that is not null, up to and with the
    row; "next": the first that is not null, from the row on. Rows that are equal in `by` and order lie in one range and count in no
    certain order among themselves.
    """
    here, up = Window.partitionBy("_range", *by), Window.partitionBy(*by).orderBy("_range")
    ahead, back = here.orderBy(*order), here.orderBy(*[F.desc(c) for c in order])
    before = lambda w, last: w.rowsBetween(Window.unboundedPreceding, last)
    at = lambda v: F.when(v.isNotNull(), F.struct(*order))
    # "next" is "last" in the reverse order: a frame that ends with the partition would be summed anew for every row
    local = {"max": lambda v: F.max(v).over(before(ahead, -1)), "last": lambda v: F.last(v, True).over(before(ahead, 0)), "next": lambda v: F.last(v, True).over(before(back, 0))}
    whole = {"max": F.max, "last": lambda v: F.max_by(v, at(v)), "next": lambda v: F.min_by(v, at(v))}
    carry = {
        "max": lambda c: F.max(c).over(before(up, -1)),
        "last": lambda c: F.last(c, True).over(before(up, -1)),
        "next": lambda c: F.last(c, True).over(before(Window.partitionBy(*by).orderBy(F.desc("_range")), -1)),
    }
    ranges = x.groupBy("_range", *by).agg(*[whole[kind](v).alias(f"_of_{n}") for n, (kind, v) in columns.items()])
    ranges = ranges.select("_range", *by, *[carry[kind](F.col(f"_of_{n}")).alias(f"_to_{n}") for n, (kind, _) in columns.items()])
    out = beside(x.withColumns({n: local[kind](v) for n, (kind, v) in columns.items()}), ranges, ["_range", *by])
    both = lambda n, kind: F.greatest(n, f"_to_{n}") if kind == "max" else F.coalesce(n, f"_to_{n}")
    return out.withColumns({n: both(n, kind) for n, (kind, _) in columns.items()}).drop(*[f"_to_{n}" for n in columns])
