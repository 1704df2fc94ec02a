"""Column types of the logical tables, and fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import types as T

# Event and strength sets.
SEQUENCE_EVENTS = ["GOAL", "SHOT", "MISSED_SHOT", "BLOCKED_SHOT", "FACEOFF", "TAKEAWAY", "GIVEAWAY", "HIT"]
UNBLOCKED = ["SHOT", "GOAL", "MISSED_SHOT"]
ATTEMPTS = ["SHOT", "GOAL", "MISSED_SHOT", "BLOCKED_SHOT"]
EVEN = ["5v5", "4v4", "3v3"]
UNEVEN = ["5v4", "4v5", "5v3", "3v5", "4v3", "3v4"]
BOUNDARY_EVENTS = ["GAME_START", "PERIOD_START", "PERIOD_END", "GAME_END"]
#: Strength as (home shooter, away shooter) see it.
POWER_PLAY = (["6v5", "6v4", "5v4", "5v3", "4v3"], ["5v6", "4v6", "4v5", "3v5", "3v4"])
SHORT_HANDED = (["4v5", "3v5", "3v4"], ["5v4", "5v3", "4v3"])
EMPTY_NET = (["5vE", "4vE", "3vE"], ["Ev5", "Ev4", "Ev3"])
#: The goal line at ingest and in the features.
INGEST_GOAL_LINE, FEATURE_GOAL_LINE = 89.0, 89.25
BLUE_LINE = 25.0
PERIOD_SECONDS = 1200

# Recodes of the feed.
EVENT_TYPES = {
    "period-start": "PERIOD_START",
    "period-end": "PERIOD_END",
    "game-end": "GAME_END",
    "shot-on-goal": "SHOT",
    "missed-shot": "MISSED_SHOT",
    "blocked-shot": "BLOCKED_SHOT",
    "goal": "GOAL",
    "faceoff": "FACEOFF",
    "hit": "HIT",
    "giveaway": "GIVEAWAY",
    "takeaway": "TAKEAWAY",
    "penalty": "PENALTY",
    "stoppage": "STOPPAGE",
}
SHOT_TYPES = {"wrist": "Wrist", "slap": "Slap", "snap": "Snap", "backhand": "Backhand", "tip-in": "Tip-In", "deflected": "Deflected", "wrap-around": "Wrap-Around", "poke": "Poked"}
SHOT_COLUMNS = {"wrist_shot": "Wrist", "deflected_shot": "Deflected", "tip_shot": "Tip-In", "slap_shot": "Slap", "backhand_shot": "Backhand", "snap_shot": "Snap", "wrap_shot": "Wrap-Around"}
SEASON_TYPES = {2: "R", 3: "P"}

# Columns of the tables, as the feed and its users name them.
PBP_RAW = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("season", T.IntegerType()),
        T.StructField("gameDate", T.StringType()),
        T.StructField("gameType", T.IntegerType()),
        T.StructField("away_id", T.StringType()),
        T.StructField("away_abbrev", T.StringType()),
        T.StructField("home_id", T.StringType()),
        T.StructField("home_abbrev", T.StringType()),
        T.StructField("eventId", T.IntegerType()),
        T.StructField("sortOrder", T.IntegerType()),
        T.StructField("period", T.IntegerType()),
        T.StructField("periodType", T.StringType()),
        T.StructField("typeCode", T.IntegerType()),
        T.StructField("typeDescKey", T.StringType()),
        T.StructField("timeInPeriod", T.StringType()),
        T.StructField("timeRemaining", T.StringType()),
        T.StructField("situationCode", T.StringType()),
        T.StructField("homeTeamDefendingSide", T.StringType()),
        T.StructField("eventOwnerTeamId", T.StringType()),
        T.StructField("xCoord", T.DoubleType()),
        T.StructField("yCoord", T.DoubleType()),
        T.StructField("zoneCode", T.StringType()),
        T.StructField("shotType", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("secondaryReason", T.StringType()),
        T.StructField("descKey", T.StringType()),
        T.StructField("penaltyTypeCode", T.StringType()),
        T.StructField("duration", T.StringType()),
        T.StructField("scoringPlayerId", T.StringType()),
        T.StructField("shootingPlayerId", T.StringType()),
        T.StructField("goalieInNetId", T.StringType()),
        T.StructField("blockingPlayerId", T.StringType()),
        T.StructField("committedByPlayerId", T.StringType()),
        T.StructField("drawnByPlayerId", T.StringType()),
        T.StructField("servedByPlayerId", T.StringType()),
        T.StructField("hittingPlayerId", T.StringType()),
        T.StructField("hitteePlayerId", T.StringType()),
        T.StructField("winningPlayerId", T.StringType()),
        T.StructField("losingPlayerId", T.StringType()),
        T.StructField("assist1PlayerId", T.StringType()),
        T.StructField("assist2PlayerId", T.StringType()),
        T.StructField("playerId", T.StringType()),
        T.StructField("awayScore", T.DoubleType()),
        T.StructField("homeScore", T.DoubleType()),
    ]
)
SHIFTS = T.StructType(
    [
        T.StructField("game_id", T.IntegerType()),
        T.StructField("team_id", T.StringType()),
        T.StructField("player_id", T.StringType()),
        T.StructField("player_name", T.StringType()),
        T.StructField("team_abbr", T.StringType()),
        T.StructField("period", T.IntegerType()),
        T.StructField("period_start_seconds", T.LongType()),
        T.StructField("period_end_seconds", T.LongType()),
        T.StructField("game_start_seconds", T.LongType()),
        T.StructField("game_end_seconds", T.LongType()),
    ]
)
SCHEDULE = T.StructType(
    [
        T.StructField("game_id", T.IntegerType()),
        T.StructField("season", T.IntegerType()),
        T.StructField("game_date", T.StringType()),
        T.StructField("start_time_ET", T.StringType()),
        T.StructField("season_type", T.StringType()),
        T.StructField("game_schedule_state", T.StringType()),
        T.StructField("away_team_id", T.StringType()),
        T.StructField("away_score", T.IntegerType()),
        T.StructField("away_abbreviation", T.StringType()),
        T.StructField("home_score", T.IntegerType()),
        T.StructField("home_team_id", T.StringType()),
        T.StructField("home_abbreviation", T.StringType()),
        T.StructField("pbp_link", T.StringType()),
        T.StructField("shift_link", T.StringType()),
        T.StructField("start_time_utc", T.TimestampType()),
    ]
)
ROSTER_SLIM = T.StructType(
    [
        T.StructField("player_id", T.StringType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("pos_F", T.IntegerType()),
        T.StructField("pos_D", T.IntegerType()),
        T.StructField("pos_G", T.IntegerType()),
        T.StructField("hand_R", T.IntegerType()),
        T.StructField("hand_L", T.IntegerType()),
    ]
)

# Fields of the feed's documents.
_PERSON = """struct<
    id: string, headshot: string, firstName: struct<default: string>, lastName: struct<default: string>, sweaterNumber: int,
    positionCode: string, shootsCatches: string, heightInInches: int, weightInPounds: int, heightInCentimeters: int,
    weightInKilograms: int, birthDate: string, birthCity: struct<default: string>, birthStateProvince: struct<default: string>,
    birthCountry: string>"""
ROSTER_JSON = f"season long, team string, positions map<string, array<{_PERSON}>>"
PLAYER_JSON = """
    playerId string, currentTeamAbbrev string, headshot string, firstName struct<default: string>, lastName struct<default: string>,
    position string, shootsCatches string, sweaterNumber int, heightInInches int, weightInPounds int, heightInCentimeters int,
    weightInKilograms int, birthDate string, birthCity struct<default: string>, birthStateProvince struct<default: string>,
    birthCountry string"""
_TEAM = """struct<
    id: string, abbrev: string, score: int, placeName: struct<default: string>, odds: array<struct<providerId: int, value: string>>>"""
SCHEDULE_JSON = f"""gameWeek array<struct<date: string, games: array<struct<
    id: int, season: int, gameType: int, startTimeUTC: string, gameState: string, gameScheduleState: string, neutralSite: boolean,
    venue: struct<default: string>, awayTeam: {_TEAM}, homeTeam: {_TEAM}>>>>"""
_DETAILS = """struct<
    eventOwnerTeamId: string, xCoord: double, yCoord: double, zoneCode: string, shotType: string, reason: string,
    secondaryReason: string, descKey: string, typeCode: string, duration: string, scoringPlayerId: string,
    shootingPlayerId: string, goalieInNetId: string, blockingPlayerId: string, committedByPlayerId: string,
    drawnByPlayerId: string, servedByPlayerId: string, hittingPlayerId: string, hitteePlayerId: string,
    winningPlayerId: string, losingPlayerId: string, assist1PlayerId: string, assist2PlayerId: string, playerId: string,
    awayScore: double, homeScore: double>"""
PBP_JSON = f"""
    id int, season int, gameDate string, gameType int, awayTeam struct<id: string, abbrev: string>,
    homeTeam struct<id: string, abbrev: string>, plays array<struct<
    eventId: int, sortOrder: int, typeCode: int, typeDescKey: string, timeInPeriod: string, timeRemaining: string,
    situationCode: string, homeTeamDefendingSide: string, periodDescriptor: struct<number: int, periodType: string>,
    details: {_DETAILS}>>"""
SHIFT_JSON = """data array<struct<
    id: long, gameId: int, teamId: string, teamAbbrev: string, playerId: string, firstName: string, lastName: string, period: int,
    startTime: string, endTime: string, duration: string>>"""
