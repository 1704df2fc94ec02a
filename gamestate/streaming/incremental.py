"""Incremental loads: landed documents as a stream of files, each batch's unknown games appended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gamestate.sources import sinks


def stream(spark: SparkSession, path: str, schema: str, files: int = 100) -> DataFrame:
    """Documents that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(path)


def once(rows: DataFrame, keys: list[str], time: str, delay: str = "10 minutes") -> DataFrame:
    """Each key once, of rows whose repeats come within `delay` of each other by their time; the first that arrives stays.

    Keys are forgotten once the latest time seen is `delay` past theirs, so the state holds the keys of one delay. A repeat
    that is later than that comes again if its own time is within the delay, and is dropped as late if it isn't.
    """
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def load(docs: DataFrame, make: Callable[[DataFrame], DataFrame], out: str, keys: list[str], checkpoint: str, by: str | None = None) -> StreamingQuery:
    """Turn each batch into rows and append those whose keys the table lacks. A repeated batch adds nothing twice.

    by: a column, such as the season, that partitions the table and that keys determine: then a batch reads the folders of
    its own values only.
    """

    def one(batch: DataFrame, _: int) -> None:
        sinks.append(make(batch), out, keys, by)

    return docs.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
