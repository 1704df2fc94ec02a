"""Tables laid out by game: bucketed and sorted, so that windows, joins and groups by game find their rows in place."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from gamestate.functions.core import GAME


def by_game(df: DataFrame, name: str, buckets: int, order: list[str]) -> DataFrame:
    """df as the table `name`, in buckets of whole games, each sorted by game and then by `order`."""
    df.repartition(buckets, *GAME).write.mode("overwrite").bucketBy(buckets, *GAME).sortBy(*GAME, *order).saveAsTable(name)
    return df.sparkSession.table(name)


@contextmanager
def in_place(spark: SparkSession) -> Iterator[None]:
    """While plans are made here, rows that lie by game serve keys that begin with the game, such as its periods.

    Bounds on automatic broadcasts don't change; tables of equally many buckets meet without an exchange.
    """
    settings = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false", "spark.sql.sources.bucketing.enabled": "true"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
