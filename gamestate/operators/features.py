"""Shot features: indexes of faceoffs, penalties and shifts; the previous event; splits by strength; indicators.

All windows are keyed by game first, so one exchange on the game serves them all; counters restart with each game.
The four splits share one pass: a shot carries a flag for each split it belongs to.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamestate.functions.core import GAME, PERIOD, angle, flag, of_game, one_hots, whole
from gamestate.schemas import EMPTY_NET, EVEN, FEATURE_GOAL_LINE, POWER_PLAY, SEQUENCE_EVENTS, SHORT_HANDED, SHOT_COLUMNS, UNBLOCKED, UNEVEN

SIDES = {"all": ("home", "away"), "home": ("home",), "away": ("away",)}


def eligible() -> Column:
    """Regulation and overtime of the season, anything of the playoffs."""
    return ((F.col("period") < 5) & (F.col("season_type") == "R")) | (F.col("season_type") == "P")


def index(df: DataFrame, on_ice: dict[str, list[str]]) -> DataFrame:
    """Counters per game of faceoffs, penalties and line changes, and each change's first and last second and length.

    on_ice: the columns that say who is on for "home" and "away".
    """
    w = of_game()
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    new = {"face": flag(F.col("event_type") == "FACEOFF"), "pen": flag(F.col("event_type") == "PENALTY")}
    later, started = F.lag(F.lit(1)).over(w).isNotNull(), F.lag("event_type").over(w) == "PERIOD_START"
    for side, teams in SIDES.items():
        who = F.struct(*[c for t in teams for c in on_ice[t]])
        new[f"{side}_shift"] = flag((later & ~who.eqNullSafe(F.lag(who).over(w))) | started)
    df = df.withColumns({f"_{k}": c for k, c in new.items()})
    df = df.withColumns({f"{k}_index": F.sum(f"_{k}").over(running) for k in new}).drop(*[f"_{k}" for k in new])
    times = {}
    for side in SIDES:
        group = whole(*PERIOD, f"{side}_shift_index")
        times[f"{side}_shift_start_seconds"] = F.first("game_seconds").over(group)
        times[f"{side}_shift_end_seconds"] = F.last("game_seconds").over(group)
    df = df.withColumns(times)
    return df.withColumns({f"{s}_shift_length": F.when(eligible(), F.col("game_seconds") - F.col(f"{s}_shift_start_seconds")) for s in SIDES})


def _seen(shooter: tuple[list[str], list[str]], state: str) -> Column:
    home, away = shooter
    return ((F.col("event_team_type") == "home") & F.col(state).isin(home)) | ((F.col("event_team_type") == "away") & F.col(state).isin(away))


def shots(df: DataFrame, goalie_side: str = "own", fill_scores: bool = False) -> DataFrame:
    """Unblocked shots with the event before each, and in_EV, in_PP, in_SH, in_EN.

    goalie_side: whose goalie event_goalie_id names, the shooter's "own" or the "defending" one. fill_scores carries
    the score forward over events that don't report it.
    """
    base = df.where(F.col("event_type").isin(SEQUENCE_EVENTS) & eligible() & F.col("x_abs").isNotNull() & F.col("y_abs").isNotNull())
    if fill_scores:
        run = of_game().rowsBetween(Window.unboundedPreceding, 0)
        base = base.withColumns({c: F.last(c, ignorenulls=True).over(run) for c in ("home_score", "away_score")})
    w = Window.partitionBy(*PERIOD).orderBy("event_idx")
    last = {"event_type_last": "event_type", "event_team_last": "event_team_abbr", "event_strength_last": "strength_state", "x_abs_last": "x_abs", "y_abs_last": "y_abs", "home_score": "home_score", "away_score": "away_score"}
    first = lambda *keys: F.first("game_seconds").over(whole(*keys))
    is_home = F.col("event_team_type") == "home"
    named = is_home if goalie_side == "own" else ~is_home
    skaters = F.col("home_skaters") - F.col("away_skaters")
    power = flag(F.col("strength_state").isin(UNEVEN))
    since_pen = power * (F.col("game_seconds") - first(*GAME, "pen_index"))
    base = base.withColumns(
        {
            **{new: F.lag(old).over(w) for new, old in last.items()},
            "seconds_since_last": F.col("game_seconds") - F.lag("game_seconds").over(w),
            "home_skaters_toi": F.col("game_seconds") - first(*PERIOD, "home_shift_index"),
            "away_skaters_toi": F.col("game_seconds") - first(*PERIOD, "away_shift_index"),
            "event_goalie_id": F.upper(F.when(named, F.col("home_goalie")).otherwise(F.col("away_goalie"))),
            "is_pen": power,
            "is_two_ma": flag(F.abs(skaters) >= 2),
            "pen_seconds_since": F.when(since_pen >= 300, 120).otherwise(since_pen),
        }
    )
    shot = base.where(F.col("event_type").isin(UNBLOCKED) & F.col("x_abs_last").isNotNull() & F.col("y_abs_last").isNotNull())
    same = F.col("event_team_last") == F.col("event_team_abbr")
    facing = lambda c: F.when(same, F.col(c)).otherwise(-F.col(c))
    toi = lambda event, other: F.when(is_home, F.col(event)).when(F.col("event_team_type") == "away", F.col(other))
    shot = shot.withColumns(
        {
            "x_abs_last": facing("x_abs_last"),
            "y_abs_last": facing("y_abs_last"),
            "home_score": F.coalesce("home_score", F.lit(0)),
            "away_score": F.coalesce("away_score", F.lit(0)),
            "same_team_last": flag(same),
            "is_home": flag(is_home),
            "is_overtime": flag(F.col("period") >= 4),
            "is_playoff": flag(F.col("season_type") == "P"),
            "event_team_toi": toi("home_skaters_toi", "away_skaters_toi"),
            "def_team_toi": toi("away_skaters_toi", "home_skaters_toi"),
            "prior_event_EV": flag(F.col("event_strength_last").isin(EVEN)),
            "is_EV": flag(F.col("strength_state").isin([*EVEN, "6v6"])),
            "seconds_since_last": F.when(F.col("seconds_since_last") == 0, 0.5).otherwise(F.col("seconds_since_last").cast("double")),
            "in_EV": flag(F.col("strength_state").isin(EVEN)),
            "in_PP": flag(_seen(POWER_PLAY, "true_strength_state")),
            "in_SH": flag(_seen(SHORT_HANDED, "strength_state")),
            "in_EN": flag(_seen(EMPTY_NET, "true_strength_state")),
        }
    )
    dx, dy = F.col("x_abs") - F.col("x_abs_last"), F.col("y_abs") - F.col("y_abs_last")
    shot = shot.withColumns(
        {
            "event_team_shift_time_diff": F.col("def_team_toi") - F.col("event_team_toi"),
            "score_state": F.when(is_home, F.col("home_score") - F.col("away_score")).otherwise(F.col("away_score") - F.col("home_score")),
            "distance_from_last": F.sqrt(dx * dx + dy * dy),
            "event_angle_last": angle(F.col("x_abs_last"), F.col("y_abs_last"), FEATURE_GOAL_LINE),
        }
    )
    change = F.abs(F.col("event_angle") - F.col("event_angle_last"))
    return shot.withColumns(
        {
            "puck_speed_since_last": F.col("distance_from_last") / F.col("seconds_since_last"),
            "event_angle_change": change,
            "event_angle_change_speed": change / F.col("seconds_since_last"),
        }
    )


def split(shot: DataFrame, name: str) -> DataFrame:
    """The shots of one strength split: EV, PP, SH or EN. A shot can be in more than one."""
    return shot.where(F.col(f"in_{name}") == 1).drop("in_EV", "in_PP", "in_SH", "in_EN").withColumn("strength_type", F.lit(name))


_STATES = {
    "EV": ["5v5", "4v4", "3v3"],
    "PP": ["5v4", "5v3", "4v3", "6v5", "6v4"],
    "SH": ["4v5", "3v5", "3v4"],
    "EN": ["Ev5", "Ev4", "Ev3"],
}
PRIOR = {"shot": "SHOT", "miss": "MISSED_SHOT", "block": "BLOCKED_SHOT", "give": "GIVEAWAY", "take": "TAKEAWAY", "hit": "HIT"}
TURNOVER = ["prior_give_opp", "prior_shot_opp", "prior_miss_opp", "prior_block_opp", "prior_take_same"]


def _mirrored(state: str) -> str:
    a, b = state.split("v")
    return f"{b}v{a}"


def state_flags(name: str) -> dict[str, Column]:
    """state_* seen from the shooter: even states as they are, others mirrored for the away side."""
    out = {}
    for s in _STATES[name]:
        if name == "EV":
            out[f"state_{s}"] = F.col("strength_state") == s
        elif name == "EN":  # the empty net is the other side's
            out[f"state_{s}"] = ((F.col("event_team_type") == "away") & (F.col("true_strength_state") == s)) | ((F.col("event_team_type") == "home") & (F.col("true_strength_state") == _mirrored(s)))
        else:
            col = F.col("true_strength_state" if name == "PP" else "strength_state")
            out[f"state_{s}"] = ((F.col("event_team_type") == "home") & (col == s)) | ((F.col("event_team_type") == "away") & (col == _mirrored(s)))
    return out


def score_flags() -> dict[str, Column]:
    s = F.col("score_state")
    out = {"score_down_4": s <= -4, "score_up_4": s >= 4, "score_even": s == 0}
    return out | {f"score_{'down' if k < 0 else 'up'}_{abs(k)}": s == k for k in (-3, -2, -1, 1, 2, 3)}


def prior_flags() -> dict[str, Column]:
    same, last = F.col("same_team_last") == 1, F.col("event_type_last")
    out = {f"prior_{n}_{who}": (last == e) & (same if who == "same" else ~same) for n, e in PRIOR.items() for who in ("same", "opp")}
    return out | {"prior_face_win": (last == "FACEOFF") & same, "prior_face_lose": (last == "FACEOFF") & ~same}


def sequence_flags() -> dict[str, Column]:
    """Rebounds, set plays and rushes, from the prior flags."""
    on = lambda c: F.col(c) == 1
    within = lambda s: F.col("seconds_since_last") <= s
    turnover = reduce(lambda a, b: a | b, map(on, TURNOVER))
    return {
        "is_rebound": on("prior_shot_same") & within(3),
        "is_post_miss_shot": (on("prior_miss_same") | on("prior_block_same")) & within(3),
        "is_set_play": on("prior_face_win") & (F.col("x_abs_last") > 25) & within(3),
        "is_rush_play": (F.col("x_abs_last") < 0) & within(5) & turnover,
        "is_fast_rush_play": (F.col("x_abs_last") < 25) & within(3) & turnover,
    }


def off_wing() -> Column:
    right, left, y = F.col("hand_R") == 1, F.col("hand_L") == 1, F.col("y_abs")
    return ((right & (y > 0)) | (left & (y < 0))) & (F.col("event_angle") > 10)


def with_roster(shot: DataFrame, roster: DataFrame, goalies: bool = True) -> DataFrame:
    """Shooter's and goalie's hands and positions. The roster is one row per player after distinct."""
    players = roster.select(F.col("player_id").alias("event_player_1_id"), "hand_R", "hand_L", "pos_F", "pos_D", "pos_G").distinct()
    out = shot.join(players, "event_player_1_id", "left")
    if goalies:
        keepers = roster.where("pos_G = 1").select(F.upper("player_id").alias("event_goalie_id"), F.col("hand_R").alias("G_hand_R"), F.col("hand_L").alias("G_hand_L")).distinct()
        out = out.join(keepers, "event_goalie_id", "left")
    return out


def prepare(shot: DataFrame, roster: DataFrame, name: str) -> DataFrame:
    """The model's columns of one split."""
    df = with_roster(shot, roster, goalies=name != "EN")
    first = one_hots({"is_goal": F.col("event_type") == "GOAL", **state_flags(name), **score_flags(), **prior_flags(), "off_wing": off_wing()})
    return df.withColumns(first).withColumns(one_hots(sequence_flags()))


def shot_types(df: DataFrame, column: str = "secondary_type") -> DataFrame:
    return df.withColumns(one_hots({c: F.col(column) == t for c, t in SHOT_COLUMNS.items()}))


def model_columns(name: str) -> list[str]:
    """Numeric inputs of a split's model."""
    base = ["x_abs", "y_abs", "event_distance", "event_angle", "event_angle_change", "event_angle_change_speed", "seconds_since_last", "distance_from_last", "x_abs_last", "y_abs_last", "puck_speed_since_last", "event_team_shift_time_diff", "same_team_last", "is_home", "is_overtime", "is_playoff", "off_wing", "hand_R", "hand_L", "pos_F", "pos_D", "pos_G"]
    own = {"EV": ["event_angle_last"], "PP": ["event_angle_last", "pen_seconds_since", "prior_event_EV", "is_two_ma"], "SH": ["event_angle_last", "pen_seconds_since", "prior_event_EV"], "EN": ["prior_event_EV"]}[name]
    keepers = [] if name == "EN" else ["G_hand_R", "G_hand_L"]
    return [*base, *own, *keepers, *state_flags_names(name), *score_names(), *prior_names(), *SEQUENCES, *SHOT_COLUMNS]


SEQUENCES = ["is_rebound", "is_post_miss_shot", "is_set_play", "is_rush_play", "is_fast_rush_play"]


def state_flags_names(name: str) -> list[str]:
    return [f"state_{s}" for s in _STATES[name]]


def score_names() -> list[str]:
    return ["score_down_4", "score_down_3", "score_down_2", "score_down_1", "score_even", "score_up_1", "score_up_2", "score_up_3", "score_up_4"]


def prior_names() -> list[str]:
    return [*[f"prior_{n}_{w}" for n in PRIOR for w in ("same", "opp")], "prior_face_win", "prior_face_lose"]
