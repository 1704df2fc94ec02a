"""State of play: strength, coordinates, clock, player roles, zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamestate.functions.core import GAME, PERIOD, angle, clock_seconds, distance, flag, of_game, recode
from gamestate.schemas import BLUE_LINE, EVENT_TYPES, FEATURE_GOAL_LINE, INGEST_GOAL_LINE, PERIOD_SECONDS, SHOT_TYPES


def conform(df: DataFrame, schema) -> DataFrame:
    """Exactly the schema's columns: present ones cast, missing ones null, others left out."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def align(raw: DataFrame) -> DataFrame:
    """Feed rows to events: kept are regular and playoff games outside shootouts; types recoded, sides named."""
    kept = raw.where((F.col("periodType") != "SO") & F.col("gameType").isin(2, 3))
    side = F.when(F.col("eventOwnerTeamId") == F.col("home_id"), "home").when(F.col("eventOwnerTeamId") == F.col("away_id"), "away")
    return kept.withColumns(
        {
            "event_type": recode(F.col("typeDescKey"), EVENT_TYPES),
            "secondary_type": recode(F.col("shotType"), SHOT_TYPES),
            "season_type": F.when(F.col("gameType") == 2, "R").otherwise("P"),
            "event_team_type": side,
            "event_team_abbr": F.when(side == "home", F.col("home_abbrev")).when(side == "away", F.col("away_abbrev")),
        }
    ).withColumnsRenamed(
        {"id": "game_id", "sortOrder": "event_idx", "xCoord": "x", "yCoord": "y", "zoneCode": "event_zone", "homeScore": "home_score", "awayScore": "away_score", "home_abbrev": "home_abbreviation", "away_abbrev": "away_abbreviation"}
    )


def clock(df: DataFrame, time: str = "timeInPeriod") -> DataFrame:
    """Seconds played and left. game_seconds_remaining counts from the third period, as the feed's users know it."""
    s, p = clock_seconds(F.col(time)), F.col("period") - 1
    return df.withColumns(
        {
            "period_seconds": s,
            "period_seconds_remaining": PERIOD_SECONDS - s,
            "game_seconds": s + p * PERIOD_SECONDS,
            "game_seconds_remaining": (3 * PERIOD_SECONDS - s) + (p - 2) * PERIOD_SECONDS,
        }
    )


#: Who plays which part in an event: (part, column of the feed, event types, name of the part).
ROLES: list[tuple[int, str, tuple[str, ...], str]] = [
    (1, "winningPlayerId", ("FACEOFF",), "Winner"),
    (1, "hittingPlayerId", ("HIT",), "Hitter"),
    (1, "scoringPlayerId", ("GOAL",), "Scorer"),
    (1, "shootingPlayerId", ("SHOT", "MISSED_SHOT", "BLOCKED_SHOT"), "Shooter"),
    (1, "committedByPlayerId", ("PENALTY",), "PenaltyOn"),
    (1, "playerId", ("GIVEAWAY", "TAKEAWAY"), "PlayerID"),
    (2, "losingPlayerId", ("FACEOFF",), "Loser"),
    (2, "hitteePlayerId", ("HIT",), "Hittee"),
    (2, "goalieInNetId", ("GOAL", "SHOT", "MISSED_SHOT", "BLOCKED_SHOT"), "Goalie"),
    (2, "drawnByPlayerId", ("PENALTY",), "DrewBy"),
    (3, "assist1PlayerId", ("GOAL",), "Assist"),
    (3, "servedByPlayerId", ("PENALTY",), "ServedBy"),
    (3, "blockingPlayerId", ("BLOCKED_SHOT",), "Blocker"),
    (4, "assist2PlayerId", ("GOAL",), "Assist"),
]


def player_roles(df: DataFrame) -> DataFrame:
    """event_player_1..4 id and type. A goal without a goalie has the type EmptyNet, a turnover a second type without id."""
    new: dict[str, Column] = {}
    for part in (1, 2, 3, 4):
        who, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
        for p, c, events, name in reversed(ROLES):
            if p == part:
                hit = F.col("event_type").isin(*events)
                label = F.when((F.col("event_type") == "GOAL") & F.col(c).isNull(), "EmptyNet").otherwise(name) if name == "Goalie" else F.when(F.col(c).isNotNull(), name) if part > 2 else F.lit(name)
                who, kind = F.when(hit, F.col(c)).otherwise(who), F.when(hit, label).otherwise(kind)
        if part == 2:
            kind = F.when(F.col("event_type").isin("GIVEAWAY", "TAKEAWAY"), "PlayerID").otherwise(kind)
        new[f"event_player_{part}_id"], new[f"event_player_{part}_type"] = F.upper(who) if part == 1 else who, kind
    return df.withColumns(new)


def strength(df: DataFrame, drop_unknown: bool = False) -> DataFrame:
    """Skaters and strength from the situation code, filled forward over each game.

    drop_unknown drops rows without a code before filling, as the strict reading of the feed's filter does.
    """
    if drop_unknown:
        df = df.where(F.col("situationCode").isNotNull())
    running = of_game().rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("situationCode", F.last("situationCode", ignorenulls=True).over(running))
    df = df.where(F.col("situationCode").isNull() | ~F.col("situationCode").isin("0101", "1010"))
    digit = lambda i: F.substring("situationCode", i, 1).try_cast("int")
    df = df.withColumns({"away_en": flag(digit(1) == 0), "away_skaters": digit(2), "home_skaters": digit(3), "home_en": flag(digit(4) == 0)})
    shown = lambda side: F.when(F.col(f"{side}_en") == 1, "E").otherwise(F.col(f"{side}_skaters").cast("string"))
    return df.withColumns(
        {
            "strength_state": F.concat("home_skaters", F.lit("v"), "away_skaters"),
            "true_strength_state": F.concat(shown("home"), F.lit("v"), shown("away")),
        }
    )


def coordinates(df: DataFrame) -> DataFrame:
    """x_abs and y_abs: the shooting team attacks to the right. Unknown sides are told by the zone and the game's mean x."""
    flipped = flag((F.col("event_zone") == "O") & (F.avg("x").over(Window.partitionBy(*GAME)) > 0)) * 2 - 1
    df = df.withColumn("_flip", flipped).withColumn("_flip", F.max("_flip").over(Window.partitionBy(*PERIOD)))
    side, team, zone = (F.col(c) for c in ("homeTeamDefendingSide", "event_team_type", "event_zone"))
    known = F.when(((side == "left") & (team == "home")) | ((side == "right") & (team == "away")), 1).when(side.isin("left", "right") & team.isin("home", "away"), -1)

    def facing(c: Column) -> Column:
        return F.when(side.isNotNull(), c * known).when(zone == "O", F.abs(c)).when(zone == "D", -F.abs(c)).when(zone == "N", c * F.col("_flip"))

    df = df.withColumns({"x_abs": facing(F.col("x")), "y_abs": facing(F.col("y"))}).drop("_flip")
    return to_goal(df, INGEST_GOAL_LINE)


def to_goal(df: DataFrame, goal: float) -> DataFrame:
    x, y = F.col("x_abs"), F.col("y_abs")
    return df.withColumns({"event_distance": distance(x, y, goal), "event_angle": angle(x, y, goal)})


def clean(df: DataFrame) -> DataFrame:
    """Team, zones, distance and angle for the features; a penalty shot is one skater against an empty side."""
    zone = lambda x: F.when(x >= BLUE_LINE, "OZ").when(x <= -BLUE_LINE, "DZ").when(x.isNotNull(), "NZ")
    df = df.withColumns(
        {
            "event_team": F.when(F.col("event_team_type") == "home", F.col("home_abbreviation")).when(F.col("event_team_type") == "away", F.col("away_abbreviation")),
            "event_zone": zone(F.col("x_abs")),
            "home_event_zone": F.when((F.col("event_team_type") == "home") | (F.abs("x_abs") < BLUE_LINE), zone(F.col("x_abs"))).when(F.col("event_team_type") == "away", zone(-F.col("x_abs"))),
        }
    )
    df = to_goal(df, FEATURE_GOAL_LINE)
    lone = lambda team: (F.col("secondary_type") == "Penalty Shot") & (F.col("event_team_type") == team)
    d = F.round("event_distance", 3)
    return df.withColumns(
        {
            "event_distance": F.when(F.col("event_distance") == 0, 0.25).otherwise(d),
            "event_angle": F.round("event_angle", 3),
            "strength_state": F.when(lone("home"), "Ev1").when(lone("away"), "1vE").otherwise(F.col("strength_state")),
            "home_skaters": F.when(lone("home"), 1).when(lone("away"), 0).otherwise(F.col("home_skaters")),
            "away_skaters": F.when(lone("home"), 0).when(lone("away"), 1).otherwise(F.col("away_skaters")),
        }
    )
