"""Who is on the playing surface: shifts looked up by interval, and the table that decides between changing lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamestate.functions.core import PERIOD, clock_seconds, joined_ids, padded
from gamestate.schemas import BOUNDARY_EVENTS, PERIOD_SECONDS

KINDS = [("home", 0), ("home", 1), ("away", 0), ("away", 1)]


def normalise_shifts(raw: DataFrame) -> DataFrame:
    """Feed rows (gameId, teamId, playerId, names, period, startTime, endTime) to intervals in seconds.

    Rows without clocks or of no length go; repeated rows count once; of rows that differ in their start alone the
    latest start counts.
    """
    s, e = (clock_seconds(padded(F.col(c))) for c in ("startTime", "endTime"))
    p = F.col("period")
    df = raw.where("startTime <> '' and endTime <> ''").select(
        F.col("gameId").alias("game_id"),
        F.col("teamId").cast("string").alias("team_id"),
        F.col("playerId").cast("string").alias("player_id"),
        F.upper(F.concat("firstName", F.lit(" "), "lastName")).alias("player_name"),
        F.col("teamAbbrev").alias("team_abbr"),
        p.alias("period"),
        s.cast("long").alias("period_start_seconds"),
        e.cast("long").alias("period_end_seconds"),
        (s + (p - 1) * PERIOD_SECONDS).cast("long").alias("game_start_seconds"),
        (e + (p - 1) * PERIOD_SECONDS).cast("long").alias("game_end_seconds"),
    )
    df = df.where("period_end_seconds > period_start_seconds")
    same = [c for c in df.columns if c not in ("period_start_seconds", "game_start_seconds")]
    return df.groupBy(*same).agg(F.max("period_start_seconds").alias("period_start_seconds"), F.max("game_start_seconds").alias("game_start_seconds"))


def intervals(shifts: DataFrame, games: DataFrame, roster: DataFrame) -> DataFrame:
    """Normalised shifts as (season, game_id, period, team_type, player_id, pos_G, start_s, end_s).

    games: season, game_id, home_id, away_id. Shifts of other teams go; players the roster lacks have a null pos_G.
    """
    header = games.select("season", "game_id", F.col("home_id").alias("_home"), F.col("away_id").alias("_away")).distinct()
    side = F.when(F.col("team_id") == F.col("_home"), "home").when(F.col("team_id") == F.col("_away"), "away")
    goalies = roster.select("player_id", "pos_G").distinct()
    df = shifts.join(header, "game_id").withColumn("team_type", side).where("team_type is not null").join(goalies, "player_id", "left")
    return df.select("season", "game_id", "period", "team_type", "player_id", "pos_G", F.col("period_start_seconds").alias("start_s"), F.col("period_end_seconds").alias("end_s")).distinct()


def lists(events: DataFrame, shifts: DataFrame, parts: int | None = None) -> DataFrame:
    """Per event the players whose shift holds (cur), begins at (on) or ends at (off) its second, by side and position.

    One equi-join on game and period with the interval as residual condition, on distinct seconds, and conditional sets.
    parts: how many tasks both sides of either join are dealt to, where the session's number would be too few. The shifts
    are merged, never broadcast: rows that explode from a small table are taken for as small, and the driver would hold them all.
    """
    dealt = lambda df, *keys: df if parts is None else df.repartition(parts, *keys)
    shifts = dealt(shifts, *PERIOD)
    seconds = dealt(events.select(*PERIOD, "period_seconds"), *PERIOD).distinct()
    s, e, t = F.col("start_s"), F.col("end_s"), F.col("period_seconds")
    found = seconds.join(shifts.hint("merge"), PERIOD).where((s <= t) & (t <= e))
    state = {"cur": (s < t) & (t < e), "on": s == t, "off": e == t}
    sets = []
    for side, goalie in KINDS:
        mine = (F.col("team_type") == side) & (F.col("pos_G") == goalie)
        for k, c in state.items():
            sets.append(joined_ids(F.collect_set(F.when(mine & c, F.col("player_id")))).alias(f"{side}_{'goalie' if goalie else 'skater'}_{k}"))
    out = found.groupBy(*PERIOD, "period_seconds").agg(*sets)
    joined = dealt(events, *PERIOD, "period_seconds").join(dealt(out, *PERIOD, "period_seconds"), [*PERIOD, "period_seconds"], "left")
    return joined.fillna("", [c for c in out.columns if c.endswith(("_cur", "_on", "_off"))])


def decide(cur: Column, on: Column, off: Column, last: Column) -> Column:
    """The players who count, by the decision table; an ongoing and a beginning line without an ending one give null."""
    c, n, f = cur != "", on != "", off != ""
    both = lambda a, b: F.concat(a, F.lit(","), b)
    return (
        F.when(c & ~n & ~f, cur)
        .when(~c & n & ~f, on)
        .when(~c & ~n & f, off)
        .when(~c & n & f & last, on)
        .when(~c & n & f & ~last, off)
        .when(c & n & last, both(cur, on))
        .when(c & f & ~last, both(cur, off))
        .when(c & f & last, cur)
    )


def on_ice(events: DataFrame, shifts: DataFrame, parts: int | None = None) -> DataFrame:
    """events with {home,away}_{1..6}_on_id and {home,away}_goalie_on_id; boundary events have none."""
    df = lists(events, shifts, parts)
    boundary = F.col("event_type").isin(BOUNDARY_EVENTS)
    at = Window.partitionBy(*PERIOD, "period_seconds")
    last = F.col("event_idx") == F.max(F.when(~boundary, F.col("event_idx"))).over(at)
    df = df.withColumn("_last", F.coalesce(last, F.lit(False)))
    new: dict[str, Column] = {}
    for side, goalie in KINDS:
        base = f"{side}_{'goalie' if goalie else 'skater'}"
        new[f"_{base}"] = F.when(~boundary, decide(*(F.col(f"{base}_{k}") for k in ("cur", "on", "off")), F.col("_last")))
    df = df.withColumns(new)
    slots: dict[str, Column] = {}
    for side in ("home", "away"):
        ids = F.sort_array(F.split(F.col(f"_{side}_skater"), ","))
        slots |= {f"{side}_{i}_on_id": F.get(ids, F.lit(i - 1)) for i in range(1, 7)}
        slots[f"{side}_goalie_on_id"] = F.get(F.split(F.col(f"_{side}_goalie"), ","), F.lit(0))
    lists_ = [f"{s}_{'goalie' if g else 'skater'}_{k}" for s, g in KINDS for k in ("cur", "on", "off")]
    return df.withColumns(slots).drop("_last", *new, *lists_)
