"""Play-by-play, roster and shift tables derived from the generic test tables, to exercise every branch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gamestate.plans.registry import parts


def _choice(key: str, table: dict[str, Column]) -> Column:
    out = F
    for value, result in table.items():
        out = out.when(F.col(key) == value, result)
    return out


def pbp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: a user is a game, its quarter a period. Games are dealt to tasks whose number follows the events'."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", F.col("event_type").alias("kind"), F.get_json_object("props", "$.k").cast("int").alias("k"))
    ev = ev.repartition(parts(spark, sf_dir), "user_id")
    game = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ev = ev.withColumns({"rn": F.row_number().over(game), "n": F.count("*").over(Window.partitionBy("user_id"))})
    ev = ev.withColumn("period", F.expr("cast(1 + ((rn - 1) * 4) div n as int)"))
    part = Window.partitionBy("user_id", "period")
    ev = ev.withColumns({"pr": F.row_number().over(part.orderBy("rn")), "pn": F.count("*").over(part)})
    k, e, u = F.col("k"), F.col("event_id"), F.col("user_id")
    kind = _choice(
        "kind",
        {
            "purchase": F.when(k < 25, "GOAL").otherwise("SHOT"),
            "click": F.when(k % 2 == 0, "SHOT").otherwise("MISSED_SHOT"),
            "error": F.when(k < 15, "PENALTY").otherwise("GIVEAWAY"),
            "signup": F.when(k < 50, "FACEOFF").otherwise("HIT"),
            "view": F.when(k < 40, "BLOCKED_SHOT").when(k < 80, "TAKEAWAY").otherwise("STOPPAGE"),
        },
    )
    placed = ~((F.col("pr") == 1) | ((F.col("kind") == "view") & (k >= 80)))
    code = F
    for below, value in ((40, "1551"), (46, "1441"), (50, "1331"), (60, "1451"), (70, "1541"), (74, "1351"), (78, "1531"), (80, "1341"), (82, "1431"), (87, "0651"), (92, "1560"), (94, "0541"), (96, "1450"), (97, "0551"), (98, None), (99, "0101"), (100, "1010")):
        code = code.when(k < below, F.lit(value).cast("string"))
    shot = F
    for i, name in enumerate(("Wrist", "Slap", "Snap", "Backhand", "Tip-In", "Deflected", "Wrap-Around", "Poked")):
        shot = shot.when(k % 8 == i, name)
    ev = ev.withColumns(
        {
            "game_id": u,
            "event_idx": F.col("rn"),
            "season": F.when(u % 2 == 0, 20232024).otherwise(20242025),
            "season_type": F.when(u % 3 == 0, "P").otherwise("R"),
            "period_seconds": F.expr("cast(((((pr - 1) div 2) * 2 * 1200) div pn) div 20 * 20 as int)"),
            "event_type": F.when(F.col("pr") == 1, "PERIOD_START").otherwise(kind),
            "event_team_type": F.when((e + k) % 2 == 0, "home").otherwise("away"),
            "home_abbreviation": F.concat(F.lit("H"), u),
            "away_abbreviation": F.concat(F.lit("A"), u),
            "x": F.when(placed, ((e * 37 + k * 11) % 199 - 99).cast("double")),
            "y": F.when(placed, ((e * 53 + k * 7) % 85 - 42).cast("double")),
            "event_zone": F.when(e % 3 == 0, "O").when(e % 3 == 1, "N").otherwise("D"),
            "homeTeamDefendingSide": F.when(u % 5 == 0, F.lit(None).cast("string")).when((u + F.col("period")) % 2 == 0, "left").otherwise("right"),
            "situationCode": code,
            "event_player_1_id": ((e * 31) % 150).cast("string"),
            "secondary_type": F.when(k % 11 != 0, shot),
            "home_goalie": F.concat(F.lit("gh"), u),
            "away_goalie": F.concat(F.lit("ga"), u),
            "home_on": F.concat(F.lit("h"), F.expr("rn div 4")),
            "away_on": F.concat(F.lit("a"), F.expr("rn div 3")),
        }
    )
    running = Window.partitionBy("game_id").orderBy("event_idx")
    goal = lambda side: F.sum(F.when((F.col("event_type") == "GOAL") & (F.col("event_team_type") == side), 1).otherwise(0)).over(running)
    is_goal = F.col("event_type") == "GOAL"
    ev = ev.withColumns(
        {
            "game_seconds": F.col("period_seconds") + (F.col("period") - 1) * 1200,
            "event_team_abbr": F.when(F.col("event_team_type") == "home", F.col("home_abbreviation")).otherwise(F.col("away_abbreviation")),
            "home_score": F.when(is_goal, goal("home")),
            "away_score": F.when(is_goal, goal("away")),
        }
    )
    return ev.drop("kind", "ts", "user_id", "rn", "n", "pr", "pn", "value")


PBP_SQL = """ev AS (SELECT event_id, ts, user_id, event_type AS kind, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
ev1 AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM ev),
ev2 AS (SELECT *, CAST(1 + ((rn - 1) * 4) // n AS INTEGER) AS period FROM ev1),
ev3 AS (SELECT *, row_number() OVER (PARTITION BY user_id, period ORDER BY rn) AS pr, count(*) OVER (PARTITION BY user_id, period) AS pn FROM ev2),
ev4 AS (SELECT event_id, k, period, user_id AS game_id, rn AS event_idx, CASE WHEN user_id % 2 = 0 THEN 20232024 ELSE 20242025 END AS season, CASE WHEN user_id % 3 = 0 THEN 'P' ELSE 'R' END AS season_type,
 CAST(((((pr - 1) // 2) * 2 * 1200) // pn) // 20 * 20 AS INTEGER) AS period_seconds,
 CASE WHEN pr = 1 THEN 'PERIOD_START' WHEN kind = 'purchase' THEN CASE WHEN k < 25 THEN 'GOAL' ELSE 'SHOT' END WHEN kind = 'click' THEN CASE WHEN k % 2 = 0 THEN 'SHOT' ELSE 'MISSED_SHOT' END
  WHEN kind = 'error' THEN CASE WHEN k < 15 THEN 'PENALTY' ELSE 'GIVEAWAY' END WHEN kind = 'signup' THEN CASE WHEN k < 50 THEN 'FACEOFF' ELSE 'HIT' END
  WHEN kind = 'view' THEN CASE WHEN k < 40 THEN 'BLOCKED_SHOT' WHEN k < 80 THEN 'TAKEAWAY' ELSE 'STOPPAGE' END END AS event_type,
 CASE WHEN (event_id + k) % 2 = 0 THEN 'home' ELSE 'away' END AS event_team_type, 'H' || user_id AS home_abbreviation, 'A' || user_id AS away_abbreviation,
 CASE WHEN pr = 1 OR (kind = 'view' AND k >= 80) THEN NULL ELSE CAST((event_id * 37 + k * 11) % 199 - 99 AS DOUBLE) END AS x,
 CASE WHEN pr = 1 OR (kind = 'view' AND k >= 80) THEN NULL ELSE CAST((event_id * 53 + k * 7) % 85 - 42 AS DOUBLE) END AS y,
 CASE event_id % 3 WHEN 0 THEN 'O' WHEN 1 THEN 'N' ELSE 'D' END AS event_zone,
 CASE WHEN user_id % 5 = 0 THEN NULL WHEN (user_id + period) % 2 = 0 THEN 'left' ELSE 'right' END AS "homeTeamDefendingSide",
 CASE WHEN k < 40 THEN '1551' WHEN k < 46 THEN '1441' WHEN k < 50 THEN '1331' WHEN k < 60 THEN '1451' WHEN k < 70 THEN '1541' WHEN k < 74 THEN '1351' WHEN k < 78 THEN '1531' WHEN k < 80 THEN '1341' WHEN k < 82 THEN '1431'
  WHEN k < 87 THEN '0651' WHEN k < 92 THEN '1560' WHEN k < 94 THEN '0541' WHEN k < 96 THEN '1450' WHEN k = 96 THEN '0551' WHEN k = 97 THEN NULL WHEN k = 98 THEN '0101' ELSE '1010' END AS "situationCode",
 CAST((event_id * 31) % 150 AS VARCHAR) AS event_player_1_id,
 CASE WHEN k % 11 = 0 THEN NULL ELSE ['Wrist', 'Slap', 'Snap', 'Backhand', 'Tip-In', 'Deflected', 'Wrap-Around', 'Poked'][k % 8 + 1] END AS secondary_type,
 'gh' || user_id AS home_goalie, 'ga' || user_id AS away_goalie, 'h' || (rn // 4) AS home_on, 'a' || (rn // 3) AS away_on FROM ev3),
syn_pbp AS (SELECT *, period_seconds + (period - 1) * 1200 AS game_seconds, CASE WHEN event_team_type = 'home' THEN home_abbreviation ELSE away_abbreviation END AS event_team_abbr,
 CASE WHEN event_type = 'GOAL' THEN CAST(sum(CASE WHEN event_type = 'GOAL' AND event_team_type = 'home' THEN 1 ELSE 0 END) OVER (PARTITION BY game_id ORDER BY event_idx) AS BIGINT) END AS home_score,
 CASE WHEN event_type = 'GOAL' THEN CAST(sum(CASE WHEN event_type = 'GOAL' AND event_team_type = 'away' THEN 1 ELSE 0 END) OVER (PARTITION BY game_id ORDER BY event_idx) AS BIGINT) END AS away_score FROM ev4)"""


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    goalie, forward = c % 10 == 0, (c % 10 != 0) & (c % 3 != 0)
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        c.cast("string").alias("player_id"),
        F.col("c_name").alias("lastName"),
        F.when(forward, 1).otherwise(0).alias("pos_F"),
        F.when(~goalie & ~forward, 1).otherwise(0).alias("pos_D"),
        F.when(goalie, 1).otherwise(0).alias("pos_G"),
        F.when(c % 3 == 1, 1).otherwise(0).alias("hand_R"),
        F.when(c % 3 == 1, 0).otherwise(1).alias("hand_L"),
    )


ROSTER_SQL = """syn_roster AS (SELECT CAST(c_custkey AS VARCHAR) AS player_id, c_name AS "lastName", CASE WHEN c_custkey % 10 <> 0 AND c_custkey % 3 <> 0 THEN 1 ELSE 0 END AS "pos_F",
 CASE WHEN c_custkey % 10 <> 0 AND c_custkey % 3 = 0 THEN 1 ELSE 0 END AS "pos_D", CASE WHEN c_custkey % 10 = 0 THEN 1 ELSE 0 END AS "pos_G",
 CASE WHEN c_custkey % 3 = 1 THEN 1 ELSE 0 END AS "hand_R", CASE WHEN c_custkey % 3 = 1 THEN 0 ELSE 1 END AS "hand_L" FROM customer)"""


def shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shift intervals of both teams of every period of pbp: skaters in slots, a goalie, now and then an extra skater.

    The games are dealt before their shifts are made: a game makes some 850, so the games' own number would fill too few tasks.
    """
    games = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy(F.col("user_id").alias("game_id")).agg(F.count("*").alias("n"))
    games = games.repartition(parts(spark, sf_dir), "game_id")
    occur = F.array_distinct(F.expr("transform(sequence(0, n - 1), i -> cast(1 + (i * 4) div n as int))"))  # as in pbp
    periods = games.select(F.when(F.col("game_id") % 2 == 0, 20232024).otherwise(20242025).alias("season"), "game_id", F.explode(occur).alias("period"))
    sides = periods.select("*", F.explode(F.array(F.lit("home"), F.lit("away"))).alias("team_type"))
    skater = sides.select("*", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("slot")).select("*", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("j")).where("(j + slot) % 2 = 0")
    skater = skater.select("season", "game_id", "period", "team_type", F.concat(F.lit("S"), "team_type", "slot").alias("player_id"), F.lit(0).alias("pos_G"), (F.col("j") * 60).alias("start_s"), (F.col("j") * 60 + 60).alias("end_s"))
    goalie = sides.select("season", "game_id", "period", "team_type", F.concat(F.lit("G"), "team_type").alias("player_id"), F.lit(1).alias("pos_G"), F.lit(0).alias("start_s"), F.when((F.col("team_type") == "away") & (F.col("period") == 3), 560).otherwise(1200).alias("end_s"))
    extra = sides.where("team_type = 'home' or period % 2 = 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("m"))
    extra = extra.select("season", "game_id", "period", "team_type", F.concat(F.lit("X"), "team_type").alias("player_id"), F.lit(0).alias("pos_G"), (F.col("m") * 280 + 140).alias("start_s"), (F.col("m") * 280 + 220).alias("end_s"))
    return skater.unionByName(goalie).unionByName(extra)


SHIFTS_SQL = """per AS (SELECT DISTINCT season, game_id, period FROM syn_pbp), sides AS (SELECT * FROM per, (VALUES ('home'), ('away')) AS t(team_type)),
syn_shifts AS (SELECT season, game_id, period, team_type, 'S' || team_type || slot AS player_id, 0 AS "pos_G", j * 60 AS start_s, j * 60 + 60 AS end_s FROM sides, range(1, 11) AS a(slot), range(0, 20) AS b(j) WHERE (j + slot) % 2 = 0
 UNION ALL SELECT season, game_id, period, team_type, 'G' || team_type, 1, 0, CASE WHEN team_type = 'away' AND period = 3 THEN 560 ELSE 1200 END FROM sides
 UNION ALL SELECT season, game_id, period, team_type, 'X' || team_type, 0, m * 280 + 140, m * 280 + 220 FROM sides, range(0, 4) AS c(m) WHERE team_type = 'home' OR period % 2 = 0)"""
