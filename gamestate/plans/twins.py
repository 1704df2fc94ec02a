"""SQL of the steps of the feature pipeline, for the oracle of the registered queries."""

from __future__ import annotations

from gamestate.plans.synthetic import PBP_SQL, ROSTER_SQL, SHIFTS_SQL

_G = "PARTITION BY season, game_id ORDER BY event_idx"
_P = "PARTITION BY season, game_id, period ORDER BY event_idx"
_RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

STRENGTH = f"""st0 AS (SELECT * EXCLUDE ("situationCode"), last_value("situationCode" IGNORE NULLS) OVER ({_G} {_RUN}) AS code FROM syn_pbp),
st1 AS (SELECT *, CAST(code[1] AS INTEGER) AS d0, CAST(code[2] AS INTEGER) AS d1, CAST(code[3] AS INTEGER) AS d2, CAST(code[4] AS INTEGER) AS d3 FROM st0 WHERE code IS NULL OR code NOT IN ('0101', '1010')),
st AS (SELECT * EXCLUDE (d0, d1, d2, d3), CASE WHEN d0 = 0 THEN 1 ELSE 0 END AS away_en, d1 AS away_skaters, d2 AS home_skaters, CASE WHEN d3 = 0 THEN 1 ELSE 0 END AS home_en,
 CAST(d2 AS VARCHAR) || 'v' || CAST(d1 AS VARCHAR) AS strength_state,
 (CASE WHEN d3 = 0 THEN 'E' ELSE CAST(d2 AS VARCHAR) END) || 'v' || (CASE WHEN d0 = 0 THEN 'E' ELSE CAST(d1 AS VARCHAR) END) AS true_strength_state FROM st1)"""


def _facing(c: str) -> str:
    return f"""CASE WHEN "homeTeamDefendingSide" IS NOT NULL THEN {c} * (CASE WHEN ("homeTeamDefendingSide" = 'left') = (event_team_type = 'home') THEN 1 ELSE -1 END)
 WHEN event_zone = 'O' THEN abs({c}) WHEN event_zone = 'D' THEN -abs({c}) WHEN event_zone = 'N' THEN {c} * flip END AS {c}_abs"""


COORDS = f"""co0 AS (SELECT *, CASE WHEN event_zone = 'O' AND avg(x) OVER (PARTITION BY season, game_id) > 0 THEN 1 ELSE -1 END AS f FROM st),
co1 AS (SELECT *, max(f) OVER (PARTITION BY season, game_id, period) AS flip FROM co0),
co AS (SELECT * EXCLUDE (f, flip), {_facing("x")}, {_facing("y")} FROM co1)"""

CLEAN = """cl AS (SELECT * EXCLUDE (event_zone), CASE WHEN event_team_type = 'home' THEN home_abbreviation ELSE away_abbreviation END AS event_team,
 CASE WHEN x_abs >= 25 THEN 'OZ' WHEN x_abs <= -25 THEN 'DZ' WHEN x_abs IS NOT NULL THEN 'NZ' END AS event_zone,
 CASE WHEN abs(x_abs) < 25 THEN 'NZ' WHEN (event_team_type = 'home') = (x_abs > 0) THEN 'OZ' WHEN x_abs IS NOT NULL THEN 'DZ' END AS home_event_zone,
 CASE WHEN sqrt((89.25 - x_abs) * (89.25 - x_abs) + y_abs * y_abs) = 0 THEN 0.25 ELSE round(sqrt((89.25 - x_abs) * (89.25 - x_abs) + y_abs * y_abs), 3) END AS event_distance,
 round(degrees(atan2(abs(y_abs), 89.25 - x_abs)), 3) AS event_angle FROM co)"""

_ELIGIBLE = "((period < 5 AND season_type = 'R') OR season_type = 'P')"
_SIDES = {"all": ["home_on", "away_on"], "home": ["home_on"], "away": ["away_on"]}


def _changed(cols: list[str]) -> str:
    return " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER ({_G})" for c in cols)


INDEX = (
    "ix0 AS (SELECT *, CASE WHEN event_type = 'FACEOFF' THEN 1 ELSE 0 END AS i_face, CASE WHEN event_type = 'PENALTY' THEN 1 ELSE 0 END AS i_pen, "
    + ", ".join(
        f"CASE WHEN (row_number() OVER ({_G}) > 1 AND ({_changed(c)})) OR lag(event_type) OVER ({_G}) = 'PERIOD_START' THEN 1 ELSE 0 END AS i_{s}_shift" for s, c in _SIDES.items()
    )
    + " FROM cl), ix1 AS (SELECT * EXCLUDE (i_face, i_pen, i_all_shift, i_home_shift, i_away_shift), "
    + ", ".join(f"CAST(sum(i_{k}) OVER ({_G} {_RUN}) AS BIGINT) AS {k}_index" for k in ("face", "pen", "all_shift", "home_shift", "away_shift"))
    + " FROM ix0), ix2 AS (SELECT *, "
    + ", ".join(
        f"first(game_seconds ORDER BY event_idx) OVER (PARTITION BY season, game_id, period, {s}_shift_index) AS {s}_shift_start_seconds, last(game_seconds ORDER BY event_idx) OVER (PARTITION BY season, game_id, period, {s}_shift_index) AS {s}_shift_end_seconds"
        for s in _SIDES
    )
    + " FROM ix1), ix AS (SELECT *, "
    + ", ".join(f"CASE WHEN {_ELIGIBLE} THEN game_seconds - {s}_shift_start_seconds END AS {s}_shift_length" for s in _SIDES)
    + " FROM ix2)"
)

SHOTS = f"""ba AS (SELECT * FROM ix WHERE event_type IN ('GOAL', 'SHOT', 'MISSED_SHOT', 'BLOCKED_SHOT', 'FACEOFF', 'TAKEAWAY', 'GIVEAWAY', 'HIT') AND {_ELIGIBLE} AND x_abs IS NOT NULL AND y_abs IS NOT NULL),
ba1 AS (SELECT * REPLACE (lag(home_score) OVER ({_P}) AS home_score, lag(away_score) OVER ({_P}) AS away_score), lag(event_type) OVER ({_P}) AS event_type_last, lag(event_team_abbr) OVER ({_P}) AS event_team_last,
 lag(strength_state) OVER ({_P}) AS event_strength_last, lag(x_abs) OVER ({_P}) AS xl, lag(y_abs) OVER ({_P}) AS yl, game_seconds - lag(game_seconds) OVER ({_P}) AS ssl,
 game_seconds - first(game_seconds ORDER BY event_idx) OVER (PARTITION BY season, game_id, period, home_shift_index) AS htoi, game_seconds - first(game_seconds ORDER BY event_idx) OVER (PARTITION BY season, game_id, period, away_shift_index) AS atoi,
 upper(CASE WHEN event_team_type = 'home' THEN home_goalie ELSE away_goalie END) AS event_goalie_id, CASE WHEN strength_state IN ('5v4', '4v5', '5v3', '3v5', '4v3', '3v4') THEN 1 ELSE 0 END AS is_pen,
 CASE WHEN abs(home_skaters - away_skaters) >= 2 THEN 1 ELSE 0 END AS is_two_ma,
 game_seconds - first(game_seconds ORDER BY event_idx) OVER (PARTITION BY season, game_id, pen_index) AS psp FROM ba),
sh0 AS (SELECT * EXCLUDE (xl, yl, ssl, htoi, atoi, psp) REPLACE (coalesce(home_score, 0) AS home_score, coalesce(away_score, 0) AS away_score),
 CASE WHEN event_team_last = event_team_abbr THEN xl ELSE -xl END AS x_abs_last, CASE WHEN event_team_last = event_team_abbr THEN yl ELSE -yl END AS y_abs_last,
 CASE WHEN event_team_last = event_team_abbr THEN 1 ELSE 0 END AS same_team_last, CASE WHEN event_team_type = 'home' THEN 1 ELSE 0 END AS is_home, CASE WHEN period >= 4 THEN 1 ELSE 0 END AS is_overtime,
 CASE WHEN season_type = 'P' THEN 1 ELSE 0 END AS is_playoff, CASE WHEN is_pen * psp >= 300 THEN 120 ELSE is_pen * psp END AS pen_seconds_since,
 CASE WHEN event_team_type = 'home' THEN htoi ELSE atoi END AS event_team_toi, CASE WHEN event_team_type = 'home' THEN atoi ELSE htoi END AS def_team_toi,
 CASE WHEN event_strength_last IN ('5v5', '4v4', '3v3') THEN 1 ELSE 0 END AS "prior_event_EV", CASE WHEN strength_state IN ('5v5', '4v4', '3v3', '6v6') THEN 1 ELSE 0 END AS "is_EV",
 CASE WHEN ssl = 0 THEN 0.5 ELSE CAST(ssl AS DOUBLE) END AS seconds_since_last,
 CASE WHEN strength_state IN ('5v5', '4v4', '3v3') THEN 1 ELSE 0 END AS "in_EV",
 CASE WHEN (event_team_type = 'home' AND true_strength_state IN ('6v5', '6v4', '5v4', '5v3', '4v3')) OR (event_team_type = 'away' AND true_strength_state IN ('5v6', '4v6', '4v5', '3v5', '3v4')) THEN 1 ELSE 0 END AS "in_PP",
 CASE WHEN (event_team_type = 'home' AND strength_state IN ('4v5', '3v5', '3v4')) OR (event_team_type = 'away' AND strength_state IN ('5v4', '5v3', '4v3')) THEN 1 ELSE 0 END AS "in_SH",
 CASE WHEN (event_team_type = 'home' AND true_strength_state IN ('5vE', '4vE', '3vE')) OR (event_team_type = 'away' AND true_strength_state IN ('Ev5', 'Ev4', 'Ev3')) THEN 1 ELSE 0 END AS "in_EN"
 FROM ba1 WHERE event_type IN ('SHOT', 'GOAL', 'MISSED_SHOT') AND xl IS NOT NULL AND yl IS NOT NULL),
sh1 AS (SELECT *, def_team_toi - event_team_toi AS event_team_shift_time_diff, CASE WHEN event_team_type = 'home' THEN home_score - away_score ELSE away_score - home_score END AS score_state,
 sqrt((x_abs - x_abs_last) * (x_abs - x_abs_last) + (y_abs - y_abs_last) * (y_abs - y_abs_last)) AS distance_from_last, degrees(atan2(abs(y_abs_last), 89.25 - x_abs_last)) AS event_angle_last FROM sh0),
sh AS (SELECT *, distance_from_last / seconds_since_last AS puck_speed_since_last, abs(event_angle - event_angle_last) AS event_angle_change, abs(event_angle - event_angle_last) / seconds_since_last AS event_angle_change_speed FROM sh1)"""


def _flag(cond: str, name: str) -> str:
    return f'CASE WHEN {cond} THEN 1 ELSE 0 END AS "{name}"'


_STATE = {"EV": ["5v5", "4v4", "3v3"], "PP": ["5v4", "5v3", "4v3", "6v5", "6v4"], "SH": ["4v5", "3v5", "3v4"], "EN": ["Ev5", "Ev4", "Ev3"]}


def _states(split: str) -> list[str]:
    out = []
    for s in _STATE[split]:
        m = "v".join(reversed(s.split("v")))
        col = "strength_state" if split in ("EV", "SH") else "true_strength_state"
        home, away = (m, s) if split == "EN" else (s, m)
        cond = f"{col} = '{s}'" if split == "EV" else f"(event_team_type = 'home' AND {col} = '{home}') OR (event_team_type = 'away' AND {col} = '{away}')"
        out.append(_flag(cond, f"state_{s}"))
    return out


def prep(split: str) -> str:
    """CTEs p0 and p: the prepared rows of a split."""
    scores = [_flag("score_state <= -4", "score_down_4"), _flag("score_state >= 4", "score_up_4"), _flag("score_state = 0", "score_even")]
    scores += [_flag(f"score_state = {k}", f"score_{'down' if k < 0 else 'up'}_{abs(k)}") for k in (-3, -2, -1, 1, 2, 3)]
    kinds = {"shot": "SHOT", "miss": "MISSED_SHOT", "block": "BLOCKED_SHOT", "give": "GIVEAWAY", "take": "TAKEAWAY", "hit": "HIT"}
    prior = [_flag(f"event_type_last = '{e}' AND same_team_last = {v}", f"prior_{n}_{w}") for n, e in kinds.items() for w, v in (("same", 1), ("opp", 0))]
    prior += [_flag("event_type_last = 'FACEOFF' AND same_team_last = 1", "prior_face_win"), _flag("event_type_last = 'FACEOFF' AND same_team_last = 0", "prior_face_lose")]
    wing = _flag('((r."hand_R" = 1 AND y_abs > 0) OR (r."hand_L" = 1 AND y_abs < 0)) AND event_angle > 10', "off_wing")
    goalies = ', g."hand_R" AS "G_hand_R", g."hand_L" AS "G_hand_L"' if split != "EN" else ""
    join = 'LEFT JOIN (SELECT DISTINCT upper(player_id) AS id, "hand_R", "hand_L" FROM syn_roster WHERE "pos_G" = 1) g ON g.id = event_goalie_id' if split != "EN" else ""
    turnover = "prior_give_opp + prior_shot_opp + prior_miss_opp + prior_block_opp + prior_take_same > 0"
    seq = [
        _flag("prior_shot_same = 1 AND seconds_since_last <= 3", "is_rebound"),
        _flag("prior_miss_same + prior_block_same > 0 AND seconds_since_last <= 3", "is_post_miss_shot"),
        _flag("prior_face_win = 1 AND x_abs_last > 25 AND seconds_since_last <= 3", "is_set_play"),
        _flag(f"x_abs_last < 0 AND seconds_since_last <= 5 AND {turnover}", "is_rush_play"),
        _flag(f"x_abs_last < 25 AND seconds_since_last <= 3 AND {turnover}", "is_fast_rush_play"),
    ]
    return f"""p0 AS (SELECT sh.*, r."hand_R", r."hand_L", r."pos_F", r."pos_D", r."pos_G"{goalies}, {_flag("event_type = 'GOAL'", "is_goal")}, {", ".join(_states(split) + scores + prior)}, {wing}
 FROM sh LEFT JOIN (SELECT DISTINCT player_id, "hand_R", "hand_L", "pos_F", "pos_D", "pos_G" FROM syn_roster) r ON r.player_id = event_player_1_id {join} WHERE "in_{split}" = 1),
p AS (SELECT *, {", ".join(seq)} FROM p0)"""


def _ids(side: str, goalie: int, cond: str) -> str:
    return f"coalesce(array_to_string(list_sort(list(DISTINCT player_id) FILTER (WHERE team_type = '{side}' AND \"pos_G\" = {goalie} AND {cond})), ','), '')"


_KINDS = [(f"{s}_{'goalie' if g else 'skater'}", s, g) for s in ("home", "away") for g in (0, 1)]
_CONDS = {"cur": "start_s < t AND t < end_s", "on": "start_s = t", "off": "end_s = t"}

LISTS = (
    "sec AS (SELECT DISTINCT season, game_id, period, period_seconds AS t FROM syn_pbp), "
    "li0 AS (SELECT season, game_id, period, t, "
    + ", ".join(f"{_ids(s, g, c)} AS {n}_{k}" for n, s, g in _KINDS for k, c in _CONDS.items())
    + " FROM sec JOIN syn_shifts USING (season, game_id, period) WHERE start_s <= t AND t <= end_s GROUP BY ALL), "
    + "li AS (SELECT e.*, "
    + ", ".join(f"coalesce({n}_{k}, '') AS {n}_{k}" for n, _, _ in _KINDS for k in _CONDS)
    + " FROM syn_pbp e LEFT JOIN li0 ON li0.season = e.season AND li0.game_id = e.game_id AND li0.period = e.period AND li0.t = e.period_seconds)"
)


def _decided(n: str) -> str:
    c, o, f = (f"{n}_{k}" for k in ("cur", "on", "off"))
    return f"""CASE WHEN boundary THEN NULL WHEN {c} <> '' AND {o} = '' AND {f} = '' THEN {c} WHEN {c} = '' AND {o} <> '' AND {f} = '' THEN {o} WHEN {c} = '' AND {o} = '' AND {f} <> '' THEN {f}
 WHEN {c} = '' AND {o} <> '' AND {f} <> '' THEN CASE WHEN lst THEN {o} ELSE {f} END WHEN {c} <> '' AND {o} <> '' AND lst THEN {c} || ',' || {o} WHEN {c} <> '' AND {f} <> '' AND NOT lst THEN {c} || ',' || {f} WHEN {c} <> '' AND {f} <> '' AND lst THEN {c} END"""


ON_ICE = (
    "oi0 AS (SELECT *, event_type IN ('GAME_START', 'PERIOD_START', 'PERIOD_END', 'GAME_END') AS boundary FROM li), "
    "oi1 AS (SELECT *, coalesce(event_idx = max(CASE WHEN NOT boundary THEN event_idx END) OVER (PARTITION BY season, game_id, period, period_seconds), false) AS lst FROM oi0), "
    "oi2 AS (SELECT *, " + ", ".join(f"{_decided(n)} AS d_{n}" for n, _, _ in _KINDS) + " FROM oi1), "
    "oi AS (SELECT *, " + ", ".join(f"list_sort(string_split(d_{s}_skater, ','))[{i}] AS {s}_{i}_on_id" for s in ("home", "away") for i in range(1, 7)) + ", "
    + ", ".join(f"string_split(d_{s}_goalie, ',')[1] AS {s}_goalie_on_id" for s in ("home", "away"))
    + " FROM oi2)"
)

CHAIN = {"pbp": PBP_SQL, "st": STRENGTH, "co": COORDS, "cl": CLEAN, "ix": INDEX, "sh": SHOTS}


def upto(step: str, *more: str) -> str:
    """WITH clause of the pipeline up to a step, and further CTEs."""
    names = list(CHAIN)
    return "WITH " + ",\n".join([CHAIN[n] for n in names[: names.index(step) + 1]] + list(more)) + "\n"


def on_ice(*more: str) -> str:
    return "WITH " + ",\n".join([PBP_SQL, SHIFTS_SQL, LISTS, ON_ICE, *more]) + "\n"


ROSTER = ROSTER_SQL
