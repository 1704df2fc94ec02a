"""Schedules and rosters: normalising, flattening, compiling over seasons, and finding what is new or missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamestate.functions.core import flag
from gamestate.schemas import SEASON_TYPES


def eastern(utc: Column) -> list[Column]:
    """game_date and start_time_ET of an instant, as text."""
    t = F.from_utc_timestamp(utc, "America/New_York")
    return [F.date_format(t, "yyyy-MM-dd").alias("game_date"), F.date_format(t, "HH:mm").alias("start_time_ET")]


def games(landed: DataFrame, pbp_link: str, shift_link: str) -> DataFrame:
    """Games of landed schedule documents (gameWeek, days, games): regular season and playoffs, one row per game.

    The links are patterns with {} for the game's id.
    """
    g = landed.select(F.explode(F.get("gameWeek", F.lit(0))["games"]).alias("g")).select("g.*")
    start = F.to_timestamp("startTimeUTC", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    link = lambda pattern: F.concat(F.lit(pattern.split("{}")[0]), F.col("id").cast("string"), F.lit(pattern.split("{}")[1]))
    state = F.when(F.col("gameScheduleState") == "Final", "OK").otherwise(F.col("gameScheduleState"))
    return (
        g.where(F.col("gameType").isin(*SEASON_TYPES))
        .select(
            F.col("id").alias("game_id"),
            "season",
            *eastern(start),
            F.when(F.col("gameType") == 2, "R").otherwise("P").alias("season_type"),
            state.alias("game_schedule_state"),
            F.col("awayTeam.id").alias("away_team_id"),
            F.col("awayTeam.score").alias("away_score"),
            F.col("awayTeam.abbrev").alias("away_abbreviation"),
            F.col("homeTeam.score").alias("home_score"),
            F.col("homeTeam.id").alias("home_team_id"),
            F.col("homeTeam.abbrev").alias("home_abbreviation"),
            link(pbp_link).alias("pbp_link"),
            link(shift_link).alias("shift_link"),
            start.alias("start_time_utc"),
            F.col("gameState").alias("game_state"),
        )
        .distinct()
    )


def with_odds(landed: DataFrame, provider: int = 9) -> DataFrame:
    """Today's games with venue and one provider's odds (null where the provider is absent)."""
    g = landed.select(F.explode(F.get("gameWeek", F.lit(0))["games"]).alias("g")).select("g.*")
    odds = lambda side: F.get(F.filter(F.col(f"{side}.odds"), lambda o: o["providerId"] == provider), F.lit(0))["value"].try_cast("double")
    return g.select(F.col("id").alias("game_id"), F.col("venue.default").alias("venue_name"), "neutralSite", odds("homeTeam").alias("home_odds"), odds("awayTeam").alias("away_odds"))


def finished(schedule: DataFrame) -> DataFrame:
    return schedule.where((F.col("game_schedule_state") == "OK") & F.col("game_state").isin("OFF", "FINAL"))


def since(schedule: DataFrame, known: DataFrame) -> DataFrame:
    """Games on or after the latest known date; all if none is known. The date is one row."""
    mark = known.agg(F.max("game_date").alias("_mark"))
    return schedule.join(F.broadcast(mark), F.col("_mark").isNull() | (F.col("game_date") >= F.col("_mark"))).drop("_mark")


def append_new(known: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """known and the rows of new whose keys it lacks."""
    return known.unionByName(new.join(known.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def roster(landed: DataFrame) -> DataFrame:
    """Players of landed roster documents (season, team, positions by kind), with indicators of position and hand."""
    p = landed.select("season", "team", F.explode("positions").alias("position", "players")).select("season", "team", "position", F.explode("players").alias("p"))
    return p.select(*_player(F.col("position")))


def _player(position: Column) -> list[Column | str]:
    """The columns of a player p of a kind of position, with indicators."""
    named = lambda c: F.upper(F.col(f"p.{c}.default"))
    forward, goalie = flag(position == "forwards"), flag(position == "goalies")
    return [
        "season",
        "team",
        F.col("p.id").alias("player_id"),
        named("firstName").alias("firstName"),
        named("lastName").alias("lastName"),
        F.coalesce("p.sweaterNumber", F.lit(100)).alias("sweaterNumber"),
        F.col("p.positionCode").alias("positionCode"),
        F.col("p.shootsCatches").alias("shootsCatches"),
        F.col("p.birthDate").alias("birthDate"),
        F.col("p.birthCity.default").alias("birthCity"),
        F.coalesce("p.birthStateProvince.default", F.lit("")).alias("birthStateProvince"),
        F.col("p.birthCountry").alias("birthCountry"),
        forward.alias("pos_F"),
        flag((forward == 0) & (goalie == 0)).alias("pos_D"),
        goalie.alias("pos_G"),
        flag(F.col("p.shootsCatches") == "R").alias("hand_R"),
        flag(F.col("p.shootsCatches") == "L").alias("hand_L"),
    ]


def additions(landed: DataFrame, season: int) -> DataFrame:
    """Players of landed player documents, in the columns of roster(): those that no roster of a team has."""
    code = F.col("position")
    return landed.select(
        F.lit(season).cast("long").alias("season"),
        F.col("currentTeamAbbrev").alias("team"),
        F.when(code == "G", "goalies").when(code == "D", "defensemen").otherwise("forwards").alias("kind"),
        F.struct(F.col("playerId").alias("id"), "firstName", "lastName", "sweaterNumber", code.alias("positionCode"), "shootsCatches", "birthDate", "birthCity", "birthStateProvince", "birthCountry").alias("p"),
    ).select(*_player(F.col("kind")))


def slim(full: DataFrame) -> DataFrame:
    return full.select("player_id", "firstName", "lastName", "pos_F", "pos_D", "pos_G", "hand_R", "hand_L").distinct()


def compile_rosters(parts: list[DataFrame]) -> DataFrame:
    """All seasons and additions, repeated rows once."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.distinct()


def missing_players(pbp: DataFrame, known: DataFrame) -> DataFrame:
    """Ids of skaters and goalies of the play-by-play that the roster lacks."""
    slots = [f"{s}_{i}_on_id" for s in ("home", "away") for i in range(1, 7)] + ["home_goalie_on_id", "away_goalie_on_id"]
    ids = pbp.select(F.explode(F.array(*[c for c in slots if c in pbp.columns])).alias("player_id")).where("player_id is not null").distinct()
    return ids.join(known.select("player_id"), "player_id", "left_anti")
