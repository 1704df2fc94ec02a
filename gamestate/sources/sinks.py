"""Writing tables: by season, as CSV beside Parquet, and over the table that is being read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def by_season(df: DataFrame, path: str) -> None:
    """Parquet in season folders; only the seasons that df holds are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("season").parquet(path)


def both(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(f"{path}/parquet")
    df.write.mode("overwrite").option("header", True).csv(f"{path}/csv")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def replace(df: DataFrame, path: str) -> None:
    """Overwrite a table that df itself may read: written beside it, then renamed. The old table stays until then."""
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    df.write.parquet(beside)
    fs, new = _fs(spark, beside)
    _, old = _fs(spark, path)
    _, aside = _fs(spark, beside + "-old")
    if fs.exists(old):
        fs.rename(old, aside)
    if not fs.rename(new, old):
        fs.rename(aside, old)
        raise OSError(f"{path} can't be replaced")
    if fs.exists(aside):
        fs.delete(aside, True)


def add(df: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Read, add what is new, write again: rows whose keys are new, or without keys all distinct rows."""
    spark = df.sparkSession
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        replace(df.distinct(), path)
        return
    from gamestate.operators.schedule import append_new

    old = spark.read.parquet(path)
    replace(append_new(old, df, keys) if keys else old.unionByName(df, allowMissingColumns=True).distinct(), path)


def within(known: DataFrame, by: str, df: DataFrame) -> DataFrame:
    """The rows of a table partitioned by a column whose value there df has (few values); other folders are not read."""
    values = {r[0] for r in df.select(by).distinct().collect()}
    some = F.col(by).isin([v for v in values if v is not None])
    return known.where(some | F.col(by).isNull() if None in values else some)


def append(df: DataFrame, path: str, keys: list[str], by: str | None = None) -> None:
    """Append the rows whose keys the table lacks, one for each key; nothing is rewritten.

    by: the table is partitioned by this column, of few values in df, and only their folders are read.
    """
    spark = df.sparkSession
    new = df.dropDuplicates(keys)
    fs, at = _fs(spark, path)
    if fs.exists(at):
        known = spark.read.parquet(path)
        if by is not None:
            known = within(known, by, df)
        new = new.join(known.select(*keys).distinct(), keys, "left_anti").select(*df.columns)
    out = new.write.mode("append")
    (out if by is None else out.partitionBy(by)).parquet(path)
