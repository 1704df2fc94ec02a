"""End-to-end loads: landed documents to tables by season, tables to model frames, frames to scored events."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestate.functions.core import GAME
from gamestate.operators import features, game, models, onice, schedule
from gamestate.operators.boosting import Booster
from gamestate.sources import landed, sinks

SPLITS = ("EV", "PP", "SH", "EN")
ON_ICE = {s: [f"{s}_{i}_on_id" for i in range(1, 7)] + [f"{s}_goalie_on_id"] for s in ("home", "away")}


def load_schedule(spark: SparkSession, path: str, pbp_link: str = "pbp/{}", shift_link: str = "shifts/{}") -> DataFrame:
    """All regular and playoff games of landed schedule documents."""
    return schedule.games(landed.schedules(spark, path), pbp_link, shift_link)


def update_schedule(spark: SparkSession, path: str, table: str, pbp_link: str = "pbp/{}", shift_link: str = "shifts/{}") -> None:
    """Add finished games on or after the latest known date to a schedule table, each once; nothing is rewritten."""
    new = schedule.since(schedule.finished(load_schedule(spark, path, pbp_link, shift_link)), spark.read.parquet(table))
    sinks.append(new, table, ["game_id"])


def load_roster(spark: SparkSession, path: str) -> DataFrame:
    return schedule.roster(landed.rosters(spark, path)).distinct()


def events(raw: DataFrame, shift_rows: DataFrame, roster: DataFrame) -> DataFrame:
    """Plays and shifts to events with clock, roles, strength, coordinates and the players on."""
    plays = game.coordinates(game.strength(game.player_roles(game.clock(game.align(raw)))))
    spans = onice.intervals(onice.normalise_shifts(shift_rows), plays.select(*GAME, "home_id", "away_id"), roster)
    out = onice.on_ice(plays, spans)
    return out.withColumns({"home_goalie": F.col("home_goalie_on_id"), "away_goalie": F.col("away_goalie_on_id")})


def load_pbp(spark: SparkSession, plays: str, shifts: str, roster: DataFrame) -> DataFrame:
    return events(landed.pbp(spark, plays), landed.shifts(spark, shifts), roster)


def update_pbp(spark: SparkSession, plays: str, shifts: str, roster: DataFrame, table: str) -> None:
    """Events of landed games that the table lacks are added to their seasons' folders; no other folder is read."""
    known = sinks.within(spark.read.parquet(table), "season", landed.headers(spark, plays)).select("game_id").distinct()
    raw = landed.pbp(spark, plays).join(known.withColumnRenamed("game_id", "id"), "id", "left_anti")
    new = events(raw, landed.shifts(spark, shifts).join(known.withColumnRenamed("game_id", "gameId"), "gameId", "left_anti"), roster)
    new.write.mode("append").partitionBy("season").parquet(table)


def model_frames(pbp: DataFrame, roster: DataFrame, on_ice: dict[str, list[str]] | None = None, **options: object) -> dict[str, DataFrame]:
    """The prepared frame of each strength split, from events of any number of seasons."""
    shots = features.shots(features.index(game.clean(pbp), on_ice or ON_ICE), **options)
    return {s: features.prepare(features.split(shots, s), roster, s) for s in SPLITS}


def predictions(scored: dict[str, DataFrame]) -> DataFrame:
    """Keys, split and xG of all splits together."""
    out = None
    for df in scored.values():
        part = df.select(*models.KEYS, "strength_type", "xG")
        out = part if out is None else out.unionByName(part)
    return out


def score_events(pbp: DataFrame, frames: dict[str, DataFrame], fitted: dict[str, Booster | PipelineModel]) -> DataFrame:
    """Events with the xG of each split that a shot belongs to."""
    scored = {s: models.goals(m, frames[s]) if isinstance(m, Booster) else models.score(m, frames[s]) for s, m in fitted.items()}
    slim = None
    for df in scored.values():
        part = df.select(*models.KEYS, "strength_type", "is_goal", "event_distance", "event_angle")
        slim = part if slim is None else slim.unionByName(part)
    base = pbp.select(*models.KEYS, "period", "game_seconds", "event_type", "event_team_type", "event_player_1_id")
    return models.final_join(base, slim, predictions(scored))
