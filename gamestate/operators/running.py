"""Running sums and previous values over a whole table, without a window that takes it to one task.

Rows are dealt out by ranges of the order, and the number of its range is written with each row. Every range sums its own
rows; the sums of all ranges, a row for each, give the offset at which a range begins. So the work is a sort by ranges and
one small table, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(df: DataFrame, order: list[str], keep: Callable[[DataFrame], DataFrame], sums: dict[str, Column] | None = None, previous: dict[str, str] | None = None, parts: int = 64) -> DataFrame:
    """df with the running sum, up to and with each row, of each expression, and the value a column had one row before.

    order makes rows unique; equal ones lie in one range and in any order there. Nulls add nothing. The first row of all has
    null previous values. keep writes a frame as a table. Sums are long or decimal, so they are exact.
    """
    sums, previous = sums or {}, previous or {}
    terms = {f"_v_{k}": F.coalesce(c, F.lit(0)) for k, c in sums.items()}
    ranged = keep(df.withColumns(terms).repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()))
    last = F.max_by(F.struct(F.lit(1).alias("_there"), *[F.col(c).alias(k) for k, c in previous.items()]), F.struct(*order))
    of_range = ranged.groupBy("_range").agg(*[F.sum(v).alias(v) for v in terms], last.alias("_last"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each of `parts` ranges
    starts = of_range.select("_range", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_at{v}") for v in terms], F.lag("_last").over(Window.orderBy("_range")).alias("_last"))
    w = Window.partitionBy("_range").orderBy(*order)
    up_to = w.rowsBetween(Window.unboundedPreceding, 0)
    first = F.row_number().over(w) == 1
    out = ranged.join(F.broadcast(starts), "_range")
    new = {k: F.sum(f"_v_{k}").over(up_to) + F.col(f"_at_v_{k}") for k in sums}
    new |= {k: F.when(first, F.col("_last")[k]).otherwise(F.lag(c).over(w)) for k, c in previous.items()}
    return out.withColumns(new).select(*df.columns, *new)
