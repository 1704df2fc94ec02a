"""How fast loads run: a listener that keeps a row for each batch of the streams it watches, as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

COLUMNS = "query string, batch long, began timestamp, rows long, games long, seconds double, rows_a_second double, games_a_minute double"
METRIC = "load"
KEPT = 10_000  # batches that a listener holds at most before the oldest goes; take() what it has in time


def measured(docs: DataFrame, game: str) -> DataFrame:
    """docs, whose batches say how many rows and (about, within 5 %) how many games they hold. No pass of its own."""
    return docs.observe(METRIC, F.count(F.lit(1)).alias("rows"), F.approx_count_distinct(game).alias("games"))


class Loads(StreamingQueryListener):
    """spark.streams.addListener(loads); later loads.take(spark) has a row for each batch of measured() streams."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        seen = p.observedMetrics.get(METRIC)
        if seen is None or not seen["rows"]:
            return
        seconds = p.durationMs.get("triggerExecution", 0) / 1000
        rate = lambda n, unit: float(n) * unit / seconds if seconds else None
        began = p.timestamp.replace("Z", "+00:00")
        self.rows.append((p.name or str(p.id), p.batchId, began, int(seen["rows"]), int(seen["games"]), seconds, rate(seen["rows"], 1), rate(seen["games"], 60)))
        del self.rows[:-KEPT]

    def take(self, spark: SparkSession) -> DataFrame:
        """The batches so far, which the listener then forgets; append them to a table to keep them."""
        rows, self.rows = self.rows, []
        return spark.createDataFrame(rows, COLUMNS.replace("timestamp", "string")).withColumn("began", F.col("began").cast("timestamp"))
