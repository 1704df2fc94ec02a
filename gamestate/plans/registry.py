"""Registered queries: name, function of (spark, sf_dir), SQL twin or None."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts(spark: SparkSession, sf_dir: str, rows: int = 50_000) -> int:
    """Tasks that events are dealt to: one for each `rows` of them, so a task's share doesn't grow with the table; all cores from small tables on."""
    n = table(spark, sf_dir, "events").count()
    return max(-(-n // rows), min(spark.sparkContext.defaultParallelism, -(-n // 4_000)), 1)


@contextmanager
def dealt(spark: SparkSession, n: int) -> Iterator[None]:
    """What runs here is shuffled into n parts, none of which are merged."""
    settings = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def shown(df: DataFrame, plain: list[str], doubles: list[str] = ()) -> DataFrame:
    """Columns for comparison: doubles to six places, without negative zeros."""
    return df.select(*plain, *[rounded(c) for c in doubles])


def rounded(c: str) -> Column:
    r = F.round(F.col(c), 6)
    return F.when(r == 0, 0.0).otherwise(r).alias(c)


def sql_shown(plain: list[str], doubles: list[str] = ()) -> str:
    return ", ".join([*[f'"{c}"' for c in plain], *[sql_rounded(f'"{c}"', c) for c in doubles]])


def sql_rounded(value: str, name: str) -> str:
    return f'CASE WHEN round({value}, 6) = 0 THEN CAST(0 AS DOUBLE) ELSE round({value}, 6) END AS "{name}"'
