"""Relational vocabulary: scans, projections, filters, joins, windows, sets, scalar functions, each as a query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gamestate.functions.core import whole
from gamestate.operators import game
from gamestate.plans import synthetic
from gamestate.operators.running import running
from gamestate.plans.registry import query, table
from gamestate.plans.storage import kept

_P = f"WITH {synthetic.PBP_SQL} "


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 250000 AND o_orderstatus = 'F'")
def scan_project_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_totalprice > 250000 and o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, coalesce(CAST(json_extract_string(props, '$.none') AS INTEGER), 100) AS absent FROM events")
def json_props_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.from_json("props", "k int, none int")
    return table(spark, sf_dir, "events").select("event_id", p.alias("p")).select("event_id", F.col("p.k").alias("k"), F.coalesce("p.none", F.lit(100)).alias("absent"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS player_id, CAST(c_nationkey AS BIGINT) AS season, CAST(NULL AS VARCHAR) AS headshot FROM customer")
def rename_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("player_id", StringType()), StructField("season", LongType()), StructField("headshot", StringType())])
    df = table(spark, sf_dir, "customer").withColumnsRenamed({"c_custkey": "player_id", "c_nationkey": "season"})
    return game.conform(df, schema)


@query(
    """SELECT event_id, code, rank FROM events LEFT JOIN (VALUES ('click', 'CL', 1), ('error', 'ER', 2), ('purchase', 'PU', 3)) AS t(event_type, code, rank) USING (event_type)"""
)
def literal_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the columns of a table that the query holds; types that it lacks have none."""
    dim = spark.createDataFrame([("click", "CL", 1), ("error", "ER", 2), ("purchase", "PU", 3)], "event_type string, code string, rank int")
    return table(spark, sf_dir, "events").join(F.broadcast(dim), "event_type", "left").select("event_id", "code", "rank")


@query(
    """WITH days AS (SELECT unnest(generate_series(min(date_trunc('day', o_orderdate))::TIMESTAMP, max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders),
    games AS (SELECT date_trunc('day', o_orderdate)::TIMESTAMP AS d, count(*) AS n FROM orders GROUP BY 1)
    SELECT strftime(d, '%Y-%m-%d') AS iso, CAST(day(d) AS INTEGER) AS day_of_month, CAST(coalesce(n, 0) AS BIGINT) AS games FROM days LEFT JOIN games USING (d)"""
)
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from the first to the last game, with its number of games, also where there is none."""
    games = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("games"))
    days = games.agg(F.min("day").alias("first"), F.max("day").alias("last")).select(F.explode(F.expr("sequence(first, last, interval 1 day)")).alias("day"))
    return days.join(games, "day", "left").select(F.date_format("day", "yyyy-MM-dd").alias("iso"), F.dayofmonth("day").alias("day_of_month"), F.coalesce("games", F.lit(0)).cast("long").alias("games"))


@query("SELECT n_name, season FROM (SELECT DISTINCT n_name FROM nation WHERE n_name IS NOT NULL) n, (VALUES ('20222023'), ('20232024')) AS s(season)")
def cartesian_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    seasons = spark.createDataFrame([("20222023",), ("20232024",)], "season string")
    return table(spark, sf_dir, "nation").select("n_name").distinct().na.drop().crossJoin(F.broadcast(seasons))


@query(_P + "SELECT event_id FROM syn_pbp WHERE \"situationCode\" NOT IN ('0101', '1010') AND event_type IN ('SHOT', 'GOAL') AND NOT (x IS NULL)")
def filter_in_notin_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = synthetic.pbp(spark, sf_dir)
    return df.where(~F.col("situationCode").isin("0101", "1010") & F.col("event_type").isin("SHOT", "GOAL") & ~F.col("x").isNull()).select("event_id")


@query(_P + "SELECT event_id, period FROM syn_pbp WHERE (period < 5 AND season_type = 'R') OR season_type = 'P'")
def eligibility_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamestate.operators.features import eligible

    return synthetic.pbp(spark, sf_dir).where(eligible()).select("event_id", "period")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS game_date FROM orders WHERE strftime(o_orderdate, '%Y-%m-%d') BETWEEN '1995-01-01' AND '1995-12-31'")
def iso_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the scan filters on the timestamp itself, the text is for show
    o = table(spark, sf_dir, "orders").where("o_orderdate >= timestamp'1995-01-01' and o_orderdate < timestamp'1996-01-01'")
    return o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("game_date"))


@query("SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def left_dim_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "c_name", "n_name")


@query("SELECT l.l_orderkey, CAST(count(*) AS BIGINT) AS n, min(c.n_name) AS buyer, min(s.n_name) AS seller FROM lineitem l JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation c ON c.n_nationkey = c_nationkey LEFT JOIN nation s ON s.n_nationkey = s_nationkey GROUP BY l.l_orderkey")
def role_playing_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    buyer = n.toDF("c_nationkey", "buyer_name")
    seller = n.toDF("s_nationkey", "seller_name")
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")  # noqa: E741
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(buyer, "c_nationkey", "left")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").join(seller, "s_nationkey", "left")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(c, F.col("c_custkey") == F.col("o_custkey"))
    both = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(s, F.col("s_suppkey") == F.col("l_suppkey"))
    return both.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.min("buyer_name").alias("buyer"), F.min("seller_name").alias("seller"))


@query(f"WITH {synthetic.PBP_SQL}, {synthetic.ROSTER_SQL} SELECT DISTINCT event_player_1_id AS player_id FROM syn_pbp WHERE event_player_1_id NOT IN (SELECT player_id FROM syn_roster WHERE \"pos_G\" = 0)")
def anti_missing_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = synthetic.roster(spark, sf_dir).where("pos_G = 0").select("player_id")
    return synthetic.pbp(spark, sf_dir).select(F.col("event_player_1_id").alias("player_id")).distinct().join(known, "player_id", "left_anti")


@query("SELECT DISTINCT o_custkey AS custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("custkey"))
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey")).join(c, "custkey", "left_semi").distinct()


@query("SELECT a.event_id, a.event_type, b.k, c.value FROM events a JOIN (SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE event_type <> 'view') b ON a.event_id = b.event_id AND a.user_id = b.user_id JOIN (SELECT event_id, user_id, value FROM events WHERE value > 1) c ON a.event_id = c.event_id AND a.user_id = c.user_id")
def inner_three_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    keys = ["event_id", "user_id"]
    b = e.where("event_type <> 'view'").select(*keys, F.get_json_object("props", "$.k").cast("int").alias("k"))
    c = e.where("value > 1").select(*keys, "value")
    return e.select(*keys, "event_type").join(b, keys).join(c, keys).select("event_id", "event_type", "k", "value")


@query("SELECT event_id, (SELECT min(event_id) FROM events) AS first_id FROM events")
def cross_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id").crossJoin(F.broadcast(e.agg(F.min("event_id").alias("first_id"))))


@query(_P + "SELECT event_id, lag(event_type) OVER w AS event_type_last, game_seconds - lag(game_seconds) OVER w AS since, lag(x) OVER w AS x_last FROM syn_pbp WINDOW w AS (PARTITION BY season, game_id, period ORDER BY event_idx)")
def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("season", "game_id", "period").orderBy("event_idx")
    return synthetic.pbp(spark, sf_dir).select("event_id", F.lag("event_type").over(w).alias("event_type_last"), (F.col("game_seconds") - F.lag("game_seconds").over(w)).alias("since"), F.lag("x").over(w).alias("x_last"))


@query(_P + "SELECT event_id, CASE WHEN row_number() OVER w > 1 AND (home_on IS DISTINCT FROM lag(home_on) OVER w OR away_on IS DISTINCT FROM lag(away_on) OVER w) THEN 1 ELSE 0 END AS changed FROM syn_pbp WINDOW w AS (PARTITION BY season, game_id ORDER BY event_idx)")
def change_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("season", "game_id").orderBy("event_idx")
    who = F.struct("home_on", "away_on")
    changed = F.lag(F.lit(1)).over(w).isNotNull() & ~who.eqNullSafe(F.lag(who).over(w))
    return synthetic.pbp(spark, sf_dir).select("event_id", F.when(changed, 1).otherwise(0).alias("changed"))


@query(_P + "SELECT event_id, first(game_seconds ORDER BY event_idx) OVER (PARTITION BY season, game_id, period, home_on) AS shift_start, last(game_seconds ORDER BY event_idx) OVER (PARTITION BY season, game_id, period, home_on) AS shift_end FROM syn_pbp")
def first_last_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = whole("season", "game_id", "period", "home_on")
    return synthetic.pbp(spark, sf_dir).select("event_id", F.first("game_seconds").over(w).alias("shift_start"), F.last("game_seconds").over(w).alias("shift_end"))


@query(_P + "SELECT event_id, max(event_idx) OVER w AS last_idx, CAST(count(*) OVER w AS BIGINT) AS n, event_idx = max(event_idx) OVER w AS is_last FROM syn_pbp WINDOW w AS (PARTITION BY season, game_id, period, period_seconds)")
def max_count_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("season", "game_id", "period", "period_seconds")
    top = F.max("event_idx").over(w)
    return synthetic.pbp(spark, sf_dir).select("event_id", top.alias("last_idx"), F.count("*").over(w).alias("n"), (F.col("event_idx") == top).alias("is_last"))


@query(_P + 'SELECT event_id, last_value("situationCode" IGNORE NULLS) OVER (PARTITION BY season, game_id ORDER BY event_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS code FROM syn_pbp')
def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("season", "game_id").orderBy("event_idx").rowsBetween(Window.unboundedPreceding, 0)
    return synthetic.pbp(spark, sf_dir).select("event_id", F.last("situationCode", ignorenulls=True).over(w).alias("code"))


@query(_P + ", a AS (SELECT *, CASE WHEN event_zone = 'O' AND avg(x) OVER (PARTITION BY season, game_id) > 0 THEN 1 ELSE -1 END AS flipped FROM syn_pbp) SELECT event_id, flipped, max(flipped) OVER (PARTITION BY season, game_id, period) AS flip FROM a")
def game_mean_flip(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = F.avg("x").over(Window.partitionBy("season", "game_id"))
    df = synthetic.pbp(spark, sf_dir).withColumn("flipped", F.when((F.col("event_zone") == "O") & (mean > 0), 1).otherwise(-1))
    return df.select("event_id", "flipped", F.max("flipped").over(Window.partitionBy("season", "game_id", "period")).alias("flip"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 25")
def topk_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(25)


@query("SELECT n_name AS name, 'n' AS kind FROM nation UNION ALL SELECT r_name, 'r' FROM region")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.lit("n").alias("kind"))
    return n.unionByName(table(spark, sf_dir, "region").select(F.col("r_name").alias("name"), F.lit("r").alias("kind")))


@query("SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nationkey"))
    return c.union(table(spark, sf_dir, "supplier").select("s_nationkey")).distinct()


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def union_missing_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return c.unionByName(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), allowMissingColumns=True)


@query("SELECT event_type, max(ts) AS last_ts, min(ts) AS first_ts, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT user_id) AS BIGINT) AS users FROM events GROUP BY event_type")
def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.max("ts").alias("last_ts"), F.min("ts").alias("first_ts"), F.count("*").alias("n"), F.countDistinct("user_id").alias("users"))


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query(
    "SELECT event_id, strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York', '%Y-%m-%d') AS game_date, strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York', '%H:%M') AS \"start_time_ET\" FROM events"
)
def tz_et_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamestate.operators.schedule import eastern

    return table(spark, sf_dir, "events").select("event_id", *eastern(F.col("ts")))


@query(
    "SELECT p_partkey, upper(p_name) AS upper_name, substr(p_name, 1, 5) AS first5, octet_length(encode(p_name)) AS bytes, p_brand || '|' || p_type AS joined, coalesce(string_split(p_type, ' ')[2], '') AS second, string_split(p_type, ' ')[9] AS ninth, lpad(CAST(p_size AS VARCHAR), 5, '0') AS padded FROM part"
)
def string_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("p_type", " ")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.upper("p_name").alias("upper_name"),
        F.substring("p_name", 1, 5).alias("first5"),
        F.octet_length("p_name").cast("long").alias("bytes"),
        F.concat("p_brand", F.lit("|"), "p_type").alias("joined"),
        F.coalesce(F.get(words, F.lit(1)), F.lit("")).alias("second"),
        F.get(words, F.lit(8)).alias("ninth"),
        F.lpad(F.col("p_size").cast("string"), 5, "0").alias("padded"),
    )


@query("SELECT c_custkey, CAST(least(greatest(c_acctbal / 10000, 0), 1) AS DOUBLE) AS clipped, round(sqrt(abs(c_acctbal)), 6) AS root, CAST(CASE WHEN c_acctbal = 0 THEN NULL ELSE round(1000 / c_acctbal, 6) END AS DOUBLE) AS inverse FROM customer")
def clip_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamestate.functions.core import clip

    b = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select("c_custkey", clip(b / 10000, 0.0, 1.0).alias("clipped"), F.round(F.sqrt(F.abs(b)), 6).alias("root"), F.round(F.try_divide(F.lit(1000.0), b), 6).alias("inverse"))


@query("SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds FROM events GROUP BY user_id")
def set_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamestate.functions.core import joined_ids

    return table(spark, sf_dir, "events").groupBy("user_id").agg(joined_ids(F.collect_set("event_type")).alias("kinds"))


@query("SELECT event_id, unnest(string_split(event_type || ',' || CAST(user_id AS VARCHAR), ',')) AS part FROM events")
def explode_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.explode(F.split(F.concat("event_type", F.lit(","), F.col("user_id").cast("string")), ",")).alias("part"))


@query(
    "WITH old AS (SELECT * FROM events WHERE event_id < (SELECT avg(event_id) FROM events)), new AS (SELECT * FROM events WHERE event_id NOT IN (SELECT event_id FROM old)) SELECT event_id, user_id, event_type, 'old' AS load FROM old UNION ALL SELECT event_id, user_id, event_type, 'new' FROM new"
)
def incremental_antijoin_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamestate.operators.schedule import append_new

    e = table(spark, sf_dir, "events")
    middle = e.agg(F.avg("event_id").alias("m"))
    old = e.join(F.broadcast(middle), F.col("event_id") < F.col("m")).select("event_id", "user_id", "event_type", F.lit("old").alias("load"))
    new = e.select("event_id", "user_id", "event_type", F.lit("new").alias("load"))
    return append_new(old, new, ["event_id"])


@query(
    _P
    + """SELECT event_id, sum(CASE WHEN event_type = 'FACEOFF' THEN 1 ELSE 0 END) OVER w AS face_index, sum(CASE WHEN event_type = 'PENALTY' THEN 1 ELSE 0 END) OVER w AS pen_index,
    sum(CASE WHEN changed THEN 1 ELSE 0 END) OVER w AS home_shift_index, last_home
    FROM (SELECT *, lag(home_on) OVER (ORDER BY season, game_id, event_idx) AS last_home, home_on IS DISTINCT FROM lag(home_on) OVER (ORDER BY season, game_id, event_idx) AS changed FROM syn_pbp)
    WINDOW w AS (ORDER BY season, game_id, event_idx ROWS UNBOUNDED PRECEDING)"""
)
def global_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters that run over all games and seasons, and the row before each, across games too."""
    order = ["season", "game_id", "event_idx"]
    df = synthetic.pbp(spark, sf_dir).select("event_id", *order, "event_type", "home_on")
    df = running(df, order, kept, previous={"last_home": "home_on"})
    sums = {"face_index": F.col("event_type") == "FACEOFF", "pen_index": F.col("event_type") == "PENALTY", "home_shift_index": ~F.col("home_on").eqNullSafe(F.col("last_home"))}
    out = running(df, order, kept, {k: c.cast("long") for k, c in sums.items()})
    return out.select("event_id", *sums, "last_home")
