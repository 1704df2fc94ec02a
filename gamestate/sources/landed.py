"""Landed feed documents (JSON lines in storage) and seasons of tables. Nothing is fetched from a network.

Documents are read with declared types: keys they lack are null, keys nobody declared are left out, and lines that are
no JSON go to _corrupt_record, to be set aside by `bad`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gamestate.schemas import PBP_JSON, PBP_RAW, PLAYER_JSON, ROSTER_JSON, SCHEDULE_JSON, SHIFT_JSON


def parsed(lines: DataFrame, schema: str) -> DataFrame:
    """The documents of lines (value), in batches or of a stream."""
    doc = F.from_json("value", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return lines.where("trim(value) <> ''").select(doc.alias("d")).select("d.*")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return parsed(spark.read.text(path), schema)


def schedules(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, SCHEDULE_JSON)


def rosters(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, ROSTER_JSON)


def players(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed player document."""
    return _read(spark, path, PLAYER_JSON)


def shifts(spark: SparkSession, path: str) -> DataFrame:
    """One row per shift of the landed shift documents."""
    return _read(spark, path, SHIFT_JSON).select(F.explode("data").alias("s")).select("s.*")


def pbp(spark: SparkSession, path: str) -> DataFrame:
    """One row per play with the header of its game, in the declared raw columns."""
    return plays(_read(spark, path, PBP_JSON))


def headers(spark: SparkSession, path: str) -> DataFrame:
    """Id and season of the landed games; their plays are not parsed."""
    return _read(spark, path, "id int, season int").where("id is not null").select("id", "season")


def plays(docs: DataFrame) -> DataFrame:
    """The rows of pbp from documents in its declared type."""
    from gamestate.operators.game import conform

    plays = docs.select("id", "season", "gameDate", "gameType", F.col("awayTeam.id").alias("away_id"), F.col("awayTeam.abbrev").alias("away_abbrev"), F.col("homeTeam.id").alias("home_id"), F.col("homeTeam.abbrev").alias("home_abbrev"), F.explode("plays").alias("p"))
    own = [f.name for f in plays.schema["p"].dataType.fields if f.name not in ("periodDescriptor", "details", "typeCode")]
    inner = plays.schema["p"].dataType["details"].dataType.fieldNames()
    flat = plays.select(
        *[c for c in plays.columns if c != "p"],
        *[f"p.{c}" for c in own],
        F.col("p.typeCode").alias("typeCode"),
        F.col("p.periodDescriptor.number").alias("period"),
        F.col("p.periodDescriptor.periodType").alias("periodType"),
        *[F.col(f"p.details.{c}").alias("penaltyTypeCode" if c == "typeCode" else c) for c in inner],
    )
    return conform(flat, PBP_RAW)


def bad(docs: DataFrame) -> DataFrame:
    return docs.where("_corrupt_record is not null").select("_corrupt_record")


def good(docs: DataFrame) -> DataFrame:
    return docs.where("_corrupt_record is null").drop("_corrupt_record")


def set_aside(docs: DataFrame, path: str) -> DataFrame:
    """The lines that are JSON; the others are added to a table of bad records at path, with the time of the load."""
    bad(docs).withColumn("loaded_at", F.current_timestamp()).write.mode("append").parquet(path)
    return good(docs)


def counted(docs: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """docs, and an observation that has the numbers of documents and bad records once docs has been written.

    The counts come with the load itself; no other pass reads the files.
    """
    seen = Observation(name)
    broken = F.count_if(F.col("_corrupt_record").isNotNull())
    return docs.observe(seen, F.count(F.lit(1)).alias("documents"), broken.alias("bad")), seen


def seasons(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """A table partitioned by season; the bounds prune partitions."""
    df = spark.read.parquet(path)
    if first is not None:
        df = df.where(F.col("season") >= first)
    return df if last is None else df.where(F.col("season") <= last)


def pairs_to_load(teams: DataFrame, season_ids: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Every team and season, without those already known; both inputs are dimension tables."""
    every = teams.select("team").distinct().na.drop().crossJoin(season_ids.select("season").distinct().na.drop())
    return every if known is None else every.join(known.select("team", "season").distinct(), ["team", "season"], "left_anti")
