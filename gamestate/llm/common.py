"""Shared helpers of the text operators: reading tables, durable cuts of the lineage, components of a link graph."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SALTS = 32
#: A write's shuffle files go when it ends; else they stay until the driver collects its garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; where the cluster names none, one inside the warehouse."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it again: the lineage ends in files that outlive any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the files of a materialized frame that nothing will read again."""
    path = getattr(df, "_stage_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Stages:
    """Materialized frames of an operator, removed when the block ends: what it returns must not read them."""

    def __enter__(self) -> Stages:
        self.frames: list[DataFrame] = []
        return self

    def keep(self, df: DataFrame, tag: str) -> DataFrame:
        self.frames.append(materialize(df, tag))
        return self.frames[-1]

    def __exit__(self, *_: object) -> None:
        for f in self.frames:
            discard(f)


def clean(spark: SparkSession) -> None:
    """Remove all frames this application has materialized. Results that read them must have been written before."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def broadcast_if(df: DataFrame, most_rows: int, tag: str) -> DataFrame:
    """df, materialized, with the broadcast hint only if it has at most that many rows."""
    df = materialize(df, tag)
    return F.broadcast(df) if df.count() <= most_rows else df


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def move_new(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a folder to a name that nobody has yet; False, and nothing happens, if it is taken."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.getFileSystem(conf).getUri(), conf)
    try:
        context.rename(source, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName() or exists(spark, to):
            return False
        raise
    return True


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Connected components of (u, v) by alternating large-star and small-star steps.

    Returns the materialized frame (node, component) with the smallest node of each component, for every node of an edge. Each round
    is joins and minima only, and ends in files of the shared folder; no neighbour list is gathered.
    """
    e = (
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    e = materialize(e, "cc")
    before = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = materialize(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        now = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(e)
        e = new
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    out = materialize(e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).distinct(), "components")
    discard(e)
    return out


def in_blocks(members: DataFrame, bucket: str, item: str, limit: int, weight: str | None = None, main: str | None = None) -> DataFrame:
    """Deal every bucket out in blocks of about `limit` members (or weight) and pair the blocks, each with itself and each other.

    A hot bucket becomes many (bucket, bi, bj) groups of bounded size instead of one task; others are one group (0, 0). A
    member carries `side` 0 in the pairs where its block is bi and 1 where it is bj; in the pair of a block with itself, 0.
    Members of a hot bucket whose flag `main` is set need no comparison with each other: their blocks meet only those of
    the rest. Sizes of hot buckets reach the members over SALTS copies, so no task reads a whole bucket.
    """
    w = F.col(weight) if weight else F.lit(1)
    is_main = F.coalesce(F.col(main), F.lit(False)) if main else F.lit(False)
    sizes = members.groupBy(bucket).agg(F.sum(w).alias("_w"), F.sum(F.when(is_main, w).otherwise(0)).alias("_m")).where(F.col("_w") > limit)
    blocks = lambda c: F.ceil(c / F.lit(limit)).cast("int")
    sizes = sizes.select(bucket, F.greatest(blocks(F.col("_w") - F.col("_m")), F.lit(1)).alias("_b"), blocks(F.col("_m")).alias("_bm"))
    sizes = sizes.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = members.withColumn("_s", F.pmod(F.xxhash64(item, F.lit(9)), F.lit(SALTS)).cast("int")).join(sizes, [bucket, "_s"], "left")
    at = F.pmod(F.xxhash64(item, F.lit(7)), F.greatest(F.when(is_main, F.col("_bm")).otherwise(F.col("_b")), F.lit(1))).cast("int")

    def pairs(n: Column, pair: Callable[[Column], tuple[Column, Column, Column]]) -> Column:
        numbers = F.filter(F.sequence(F.lit(0), n), lambda j: j < n)  # none where n is 0
        return F.transform(numbers, lambda j: F.struct(*[c.cast("int").alias(k) for k, c in zip(("bi", "bj", "side"), pair(j), strict=True)]))

    b, i, zero = F.col("_b"), F.col("_i"), F.lit(0)
    rest = pairs(b, lambda j: (F.least(i, j), F.greatest(i, j), F.when(i <= j, 0).otherwise(1)))
    rest = F.concat(rest, pairs(F.col("_bm"), lambda j: (i, b + j, zero)))
    mains = pairs(b, lambda j: (j, b + i, F.lit(1)))
    one = F.array(F.struct(zero.alias("bi"), zero.alias("bj"), zero.alias("side")))
    each = F.explode(F.when(b.isNull(), one).when(is_main, mains).otherwise(rest)).alias("_p")
    return own.withColumn("_i", at).select(*members.columns, each).select(*members.columns, "_p.bi", "_p.bj", "_p.side")
