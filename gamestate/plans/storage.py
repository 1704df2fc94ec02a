"""Queries over sources and sinks: round trips through Parquet, CSV and landed JSON."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestate.plans.registry import query, table
from gamestate.sources import sinks, snapshots, variants


def kept(df: DataFrame) -> DataFrame:
    """df from a table in a new folder, for plans that read it several times."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def folder(spark: SparkSession) -> str:
    """A new folder for this application, in the folder that the cluster names for checkpoints or else inside the warehouse."""
    return f"{_top(spark)}/{uuid.uuid4().hex}"


def _top(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/_plans/{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> None:
    """Remove all that queries of this application have written; results that read it must have been written before."""
    p = spark._jvm.org.apache.hadoop.fs.Path(_top(spark))
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@query("SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders WHERE year(o_orderdate) >= 1996")
def season_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamestate.sources.landed import seasons

    path = folder(spark)
    sinks.by_season(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("season")), path)
    return seasons(spark, path, 1996).select("o_orderkey", "o_totalprice", "season")


@query("SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name FROM nation")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark)
    sinks.both(table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name"), path)
    return spark.read.schema("n_nationkey long, n_name string").option("header", True).csv(f"{path}/csv")


@query("SELECT s_suppkey, s_name FROM supplier UNION SELECT c_custkey, c_name FROM customer")
def read_modify_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark)
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    sinks.add(s, path)
    sinks.add(s.limit(0).union(table(spark, sf_dir, "customer").select("c_custkey", "c_name")), path)
    sinks.add(s, path)
    return spark.read.parquet(path)


@query("SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS missing FROM events")
def landed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark)
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.from_json("props", "k int").alias("details"), F.lit(1).alias("extra"))
    e.write.json(path)
    docs = spark.read.schema("event_id long, event_type string, details struct<k:int,absent:string>").json(path)
    return docs.select("event_id", "event_type", F.col("details.k").alias("k"), F.col("details.absent").alias("missing"))


@query("SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders")
def append_by_season(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A season's table grows by increments that overlap what is there; only the folders of an increment's seasons are read."""
    path = folder(spark)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("season"))
    mid = rows.agg(F.percentile_approx("season", 0.5)).first()[0]
    for part in (rows.where(F.col("season") <= mid), rows.where(F.col("season") >= mid), rows):
        sinks.append(part, path, ["season", "o_orderkey"], "season")
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", "season")


@query("SELECT s_suppkey AS id, s_name AS name, 1 AS version FROM supplier UNION ALL SELECT * FROM (SELECT s_suppkey, s_name, 2 FROM supplier UNION SELECT c_custkey, c_name, 2 FROM customer)")
def snapshot_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is read, changed and written as a new version, while the old one stays readable."""
    path = folder(spark)
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    snapshots.update(spark, path, lambda old: s)
    snapshots.update(spark, path, lambda old: old.union(c).distinct())
    return snapshots.read(spark, path, 1).withColumn("version", F.lit(1)).union(snapshots.read(spark, path, 2).withColumn("version", F.lit(2)))


@query(
    """SELECT 'details.k2' AS path, 'BIGINT' AS kind, count(*) AS documents, CAST(sum(event_id % 7) AS BIGINT) AS total FROM events WHERE event_id % 3 = 0
    UNION ALL SELECT 'plays[].mood', 'STRING', count(*), CAST(NULL AS BIGINT) FROM events
    UNION ALL SELECT 'venue', 'OBJECT<id: BIGINT>', count(*), CAST(sum(user_id) AS BIGINT) FROM events WHERE event_id % 2 = 0"""
)
def undeclared_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that landed documents hold and no schema declares, with what they hold."""
    e = table(spark, sf_dir, "events")
    details = F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"), F.when(F.col("event_id") % 3 == 0, F.col("event_id") % 7).alias("k2"))
    plays = F.array(F.struct("event_type", F.concat(F.lit("m"), "user_id").alias("mood")))
    venue = F.when(F.col("event_id") % 2 == 0, F.struct(F.col("user_id").alias("id")))
    path = folder(spark)
    e.select(F.to_json(F.struct("event_id", details.alias("details"), plays.alias("plays"), venue.alias("venue"))).alias("value")).write.text(path)
    docs = variants.documents(spark, path)
    declared = spark.createDataFrame([], "event_id long, details struct<k:int>, plays array<struct<event_type:string>>").schema
    sums = docs.agg(F.sum(variants.get("details.k2", "long")).alias("details.k2"), F.sum(variants.get("venue.id", "long")).alias("venue")).unpivot([], ["`details.k2`", "venue"], "path", "total")
    return variants.undeclared(docs, declared).join(F.broadcast(sums.withColumn("path", F.regexp_replace("path", "`", ""))), "path", "left")
