"""Domain queries over the synthetic play-by-play: state, on-ice, indexes, splits, model columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestate.functions.core import clock_seconds, padded
from gamestate.operators import features, game, onice
from gamestate.plans import seasons, synthetic, twins
from gamestate.plans.registry import parts, query, shown, sql_rounded, sql_shown, table
from gamestate.plans.storage import folder, kept
from gamestate.sources import landed, layout, sinks

ON = {"home": ["home_on"], "away": ["away_on"]}
KEYS = ["season", "game_id", "event_idx"]
SHARE = 25_000  # events of a task that looks up who is on: each meets a dozen shifts


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game.strength(synthetic.pbp(spark, sf_dir))


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game.coordinates(state(spark, sf_dir))


def indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.index(game.clean(placed(spark, sf_dir)), ON)


def shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.shots(indexed(spark, sf_dir))


@query(
    twins.upto("sh")
    + 'SELECT strength_state, CAST(count(*) AS BIGINT) AS shots, CAST(sum(CASE WHEN event_type = \'GOAL\' THEN 1 ELSE 0 END) AS BIGINT) AS goals, round(avg(CASE WHEN event_type = \'GOAL\' THEN 1.0 ELSE 0.0 END), 6) AS goal_rate, round(avg(event_distance), 6) AS mean_distance FROM sh WHERE "in_EV" = 1 GROUP BY strength_state'
)
def goal_rate_by_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    goal = F.when(F.col("event_type") == "GOAL", 1).otherwise(0)
    return (
        features.split(shots(spark, sf_dir), "EV")
        .groupBy("strength_state")
        .agg(F.count("*").alias("shots"), F.sum(goal).alias("goals"), F.round(F.avg(goal), 6).alias("goal_rate"), F.round(F.avg("event_distance"), 6).alias("mean_distance"))
    )


_PBP = [*KEYS, "period", "period_seconds", "game_seconds", "season_type", "event_type", "event_team_type", "event_team_abbr", "x", "y", "event_zone", "homeTeamDefendingSide", "situationCode", "event_player_1_id", "secondary_type", "home_score", "away_score"]


@query(f"WITH {synthetic.PBP_SQL} SELECT {sql_shown(_PBP)} FROM syn_pbp")
def synthetic_pbp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(synthetic.pbp(spark, sf_dir), _PBP)


_ST = [*KEYS, "away_en", "home_en", "away_skaters", "home_skaters", "strength_state", "true_strength_state"]


@query(twins.upto("st") + f"SELECT {sql_shown(_ST)} FROM st")
def strength_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(state(spark, sf_dir), _ST)


@query(
    twins.upto("co")
    + f"SELECT season, game_id, event_idx, {sql_rounded('x_abs', 'x_abs')}, {sql_rounded('y_abs', 'y_abs')}, {sql_rounded('sqrt((89.0 - x_abs) * (89.0 - x_abs) + y_abs * y_abs)', 'event_distance')}, {sql_rounded('degrees(atan2(abs(y_abs), 89.0 - x_abs))', 'event_angle')} FROM co"
)
def coords_abs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(placed(spark, sf_dir), KEYS, ["x_abs", "y_abs", "event_distance", "event_angle"])


_CL = [*KEYS, "event_team", "event_zone", "home_event_zone"]


@query(twins.upto("cl") + f"SELECT {sql_shown(_CL, ['event_distance', 'event_angle'])} FROM cl")
def zones_distance_angle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(game.clean(placed(spark, sf_dir)), _CL, ["event_distance", "event_angle"])


_IX = [*KEYS, "face_index", "pen_index", *[f"{s}_shift_{k}" for s in ("all", "home", "away") for k in ("index", "start_seconds", "end_seconds", "length")]]


@query(twins.upto("ix") + f"SELECT {sql_shown(_IX)} FROM ix")
def cumulative_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(indexed(spark, sf_dir), _IX)


_SH = [*KEYS, "strength_state", "true_strength_state", "event_type_last", "event_team_last", "event_strength_last", "same_team_last", "is_home", "is_overtime", "is_playoff", "is_pen", "is_two_ma", "pen_seconds_since", "prior_event_EV", "is_EV", "event_goalie_id", "home_score", "away_score", "score_state", "event_team_toi", "def_team_toi", "event_team_shift_time_diff"]
_SHD = ["x_abs", "y_abs", "event_distance", "event_angle", "x_abs_last", "y_abs_last", "seconds_since_last", "distance_from_last", "event_angle_last", "puck_speed_since_last", "event_angle_change", "event_angle_change_speed"]


def _split(name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(features.split(shots(spark, sf_dir), name), _SH, _SHD)

    run.__name__ = f"split_{name.lower()}"
    query(twins.upto("sh") + f'SELECT {sql_shown(_SH, _SHD)} FROM sh WHERE "in_{name}" = 1')(run)

    hands = ["hand_R", "hand_L", "pos_F", "pos_D", "pos_G"] + (["G_hand_R", "G_hand_L"] if name != "EN" else [])
    flags = ["is_goal", "off_wing", *features.state_flags_names(name), *features.score_names(), *features.prior_names(), *features.SEQUENCES]

    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        shot = features.split(shots(spark, sf_dir), name)
        return shown(features.prepare(shot, synthetic.roster(spark, sf_dir), name), [*KEYS, *hands, *flags])

    prepared.__name__ = f"prep_{name.lower()}"
    query(twins.upto("sh", twins.ROSTER, twins.prep(name)) + f"SELECT {sql_shown([*KEYS, *hands, *flags])} FROM p")(prepared)


for _name in ("EV", "PP", "SH", "EN"):
    _split(_name)


@query(
    twins.upto("sh")
    + 'SELECT "in_EV", "in_PP", "in_SH", "in_EN", CAST(count(*) AS BIGINT) AS shots FROM sh GROUP BY ALL'
)
def split_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shots(spark, sf_dir).groupBy("in_EV", "in_PP", "in_SH", "in_EN").agg(F.count("*").alias("shots"))


@query(twins.upto("sh") + " UNION ALL ".join(f"""SELECT {sql_shown(KEYS, ['event_distance'])}, '{s}' AS strength_type FROM sh WHERE "in_{s}" = 1""" for s in seasons.SPLITS))
def season_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frames of all splits from a table of several seasons, one below the other, with the split's name."""
    path = folder(spark)
    sinks.by_season(placed(spark, sf_dir), path)
    frames = seasons.model_frames(landed.seasons(spark, path, 20232024, 20242025), synthetic.roster(spark, sf_dir), ON)
    parts = [shown(f, [*KEYS, "strength_type"], ["event_distance"]) for f in frames.values()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


_LI = [f"{s}_{n}_{k}" for s in ("home", "away") for n in ("skater", "goalie") for k in ("cur", "on", "off")]


@query(twins.on_ice() + f"SELECT {sql_shown([*KEYS, *_LI])} FROM li")
def onice_interval_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(onice.lists(synthetic.pbp(spark, sf_dir), synthetic.shifts(spark, sf_dir), parts(spark, sf_dir, SHARE)), [*KEYS, *_LI])


_OI = [*KEYS, *[f"{s}_{i}_on_id" for s in ("home", "away") for i in range(1, 7)], "home_goalie_on_id", "away_goalie_on_id"]


@query(twins.on_ice() + f"SELECT {sql_shown(_OI)} FROM oi")
def onice_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(onice.on_ice(synthetic.pbp(spark, sf_dir), synthetic.shifts(spark, sf_dir), parts(spark, sf_dir, SHARE)), _OI)


@query(twins.on_ice() + f"SELECT {sql_shown(_OI)} FROM oi")
def onice_slots_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over tables laid out by game: no row moves between the scan and the result."""
    names = [f"{n}_{uuid.uuid4().hex}" for n in ("events", "shifts")]
    try:
        with layout.in_place(spark):
            buckets = parts(spark, sf_dir, SHARE)
            events = layout.by_game(synthetic.pbp(spark, sf_dir), names[0], buckets, ["event_idx"])
            shifts = layout.by_game(synthetic.shifts(spark, sf_dir), names[1], buckets, ["period", "start_s"])
            return kept(shown(onice.on_ice(events, shifts), _OI))
    finally:
        for n in names:
            spark.sql(f"drop table if exists {n}")


@query(
    twins.on_ice()
    + "SELECT season, game_id, period, CAST(count(*) FILTER (WHERE d_home_skater IS NULL AND NOT boundary) AS BIGINT) AS holes, CAST(count(*) FILTER (WHERE lst) AS BIGINT) AS last_of_second, CAST(count(*) FILTER (WHERE d_away_goalie LIKE 'G%') AS BIGINT) AS with_goalie FROM oi2 GROUP BY ALL"
)
def onice_decision_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    from gamestate.schemas import BOUNDARY_EVENTS

    df = onice.lists(synthetic.pbp(spark, sf_dir), synthetic.shifts(spark, sf_dir), parts(spark, sf_dir, SHARE))
    boundary = F.col("event_type").isin(BOUNDARY_EVENTS)
    at = Window.partitionBy("season", "game_id", "period", "period_seconds")
    df = df.withColumns({"b": boundary, "lst": F.coalesce(F.col("event_idx") == F.max(F.when(~boundary, F.col("event_idx"))).over(at), F.lit(False))})
    pick = lambda n: onice.decide(*(F.col(f"{n}_{k}") for k in ("cur", "on", "off")), F.col("lst"))
    df = df.withColumns({"s": F.when(~F.col("b"), pick("home_skater")), "g": F.when(~F.col("b"), pick("away_goalie"))})
    return df.groupBy("season", "game_id", "period").agg(F.count_if(F.col("s").isNull() & ~F.col("b")).alias("holes"), F.count_if("lst").alias("last_of_second"), F.count_if(F.col("g").startswith("G")).alias("with_goalie"))


@query(
    "SELECT event_id, lpad(CAST((event_id % 1200) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') AS padded, CAST(event_id % 1200 AS INTEGER) AS period_seconds, CAST(1200 - event_id % 1200 AS INTEGER) AS period_seconds_remaining, "
    "CAST(event_id % 1200 + (event_id % 4) * 1200 AS INTEGER) AS game_seconds, CAST(3600 - event_id % 1200 + (event_id % 4 - 2) * 1200 AS INTEGER) AS game_seconds_remaining FROM events"
)
def clock_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    df = table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.floor(e % 1200 / 60).cast("string"), F.lit(":"), F.lpad((e % 60).cast("string"), 2, "0")).alias("timeInPeriod"),
        (e % 4 + 1).cast("int").alias("period"),
    )
    df = df.withColumn("padded", padded(F.col("timeInPeriod")))
    out = game.clock(df)
    return out.select("event_id", "padded", *[F.col(c).cast("int").alias(c) for c in ("period_seconds", "period_seconds_remaining", "game_seconds", "game_seconds_remaining")])


_FEED = ["winningPlayerId", "losingPlayerId", "hittingPlayerId", "hitteePlayerId", "scoringPlayerId", "shootingPlayerId", "goalieInNetId", "committedByPlayerId", "drawnByPlayerId", "servedByPlayerId", "blockingPlayerId", "assist1PlayerId", "assist2PlayerId", "playerId"]
_FEED_SQL = "feed AS (SELECT *, " + ", ".join(f"CASE WHEN (event_id + {i}) % 7 = 0 THEN NULL ELSE CAST((event_id * {i}) % 97 AS VARCHAR) END AS \"{c}\"" for i, c in enumerate(_FEED, 1)) + " FROM syn_pbp)"


@query(
    f"WITH {synthetic.PBP_SQL}, {_FEED_SQL} SELECT season, game_id, event_idx, "
    """CASE event_type WHEN 'FACEOFF' THEN "winningPlayerId" WHEN 'HIT' THEN "hittingPlayerId" WHEN 'GOAL' THEN "scoringPlayerId" WHEN 'SHOT' THEN "shootingPlayerId" WHEN 'MISSED_SHOT' THEN "shootingPlayerId" WHEN 'BLOCKED_SHOT' THEN "shootingPlayerId" WHEN 'PENALTY' THEN "committedByPlayerId" WHEN 'GIVEAWAY' THEN "playerId" WHEN 'TAKEAWAY' THEN "playerId" END AS event_player_1_id,
 CASE event_type WHEN 'FACEOFF' THEN 'Winner' WHEN 'HIT' THEN 'Hitter' WHEN 'GOAL' THEN 'Scorer' WHEN 'SHOT' THEN 'Shooter' WHEN 'MISSED_SHOT' THEN 'Shooter' WHEN 'BLOCKED_SHOT' THEN 'Shooter' WHEN 'PENALTY' THEN 'PenaltyOn' WHEN 'GIVEAWAY' THEN 'PlayerID' WHEN 'TAKEAWAY' THEN 'PlayerID' END AS event_player_1_type,
 CASE event_type WHEN 'FACEOFF' THEN "losingPlayerId" WHEN 'HIT' THEN "hitteePlayerId" WHEN 'GOAL' THEN "goalieInNetId" WHEN 'SHOT' THEN "goalieInNetId" WHEN 'MISSED_SHOT' THEN "goalieInNetId" WHEN 'BLOCKED_SHOT' THEN "goalieInNetId" WHEN 'PENALTY' THEN "drawnByPlayerId" END AS event_player_2_id,
 CASE event_type WHEN 'FACEOFF' THEN 'Loser' WHEN 'HIT' THEN 'Hittee' WHEN 'GOAL' THEN CASE WHEN "goalieInNetId" IS NULL THEN 'EmptyNet' ELSE 'Goalie' END WHEN 'SHOT' THEN 'Goalie' WHEN 'MISSED_SHOT' THEN 'Goalie' WHEN 'BLOCKED_SHOT' THEN 'Goalie' WHEN 'PENALTY' THEN 'DrewBy' WHEN 'GIVEAWAY' THEN 'PlayerID' WHEN 'TAKEAWAY' THEN 'PlayerID' END AS event_player_2_type,
 CASE event_type WHEN 'GOAL' THEN "assist1PlayerId" WHEN 'PENALTY' THEN "servedByPlayerId" WHEN 'BLOCKED_SHOT' THEN "blockingPlayerId" END AS event_player_3_id,
 CASE WHEN event_type = 'GOAL' AND "assist1PlayerId" IS NOT NULL THEN 'Assist' WHEN event_type = 'PENALTY' AND "servedByPlayerId" IS NOT NULL THEN 'ServedBy' WHEN event_type = 'BLOCKED_SHOT' AND "blockingPlayerId" IS NOT NULL THEN 'Blocker' END AS event_player_3_type,
 CASE WHEN event_type = 'GOAL' THEN "assist2PlayerId" END AS event_player_4_id, CASE WHEN event_type = 'GOAL' AND "assist2PlayerId" IS NOT NULL THEN 'Assist' END AS event_player_4_type FROM feed"""
)
def player_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    feed = synthetic.pbp(spark, sf_dir).withColumns({c: F.when((e + i) % 7 != 0, (e * i % 97).cast("string")) for i, c in enumerate(_FEED, 1)})
    return game.player_roles(feed).select(*KEYS, *[f"event_player_{i}_{k}" for i in (1, 2, 3, 4) for k in ("id", "type")])


_TYPES = list(features.SHOT_COLUMNS)


@query(twins.upto("sh") + 'SELECT season, game_id, event_idx, ' + ", ".join(f"CASE WHEN secondary_type = '{v}' THEN 1 ELSE 0 END AS {k}" for k, v in features.SHOT_COLUMNS.items()) + " FROM sh")
def one_hot_shot_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.shot_types(shots(spark, sf_dir)).select(*KEYS, *_TYPES)


@query(
    "SELECT event_id, CASE event_type WHEN 'click' THEN 'CLICK' WHEN 'view' THEN 'VIEWED' ELSE event_type END AS event_type, CAST(value AS INTEGER) AS whole FROM (SELECT event_id, event_type, floor(value) AS value FROM events)"
)
def recode_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamestate.functions.core import recode

    return table(spark, sf_dir, "events").select("event_id", recode(F.col("event_type"), {"click": "CLICK", "view": "VIEWED"}).alias("event_type"), F.floor("value").cast("int").alias("whole"))


@query(
    "WITH a AS (SELECT event_id, lpad(CAST(event_id % 20 AS VARCHAR), 2, '0') || ':' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') AS c FROM events) SELECT event_id, CAST((event_id % 20) * 60 + event_id % 60 AS INTEGER) AS seconds, c AS clock FROM a"
)
def clock_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    df = table(spark, sf_dir, "events").select("event_id", F.concat(F.lpad((e % 20).cast("string"), 2, "0"), F.lit(":"), F.lpad((e % 60).cast("string"), 2, "0")).alias("clock"))
    return df.select("event_id", clock_seconds(F.col("clock")).alias("seconds"), "clock")
