"""Hand-built rows for each branch of the event operators."""

import json
import math

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gamestate.functions.core import angle, clock_seconds, distance, padded
from gamestate.operators import features, game, metrics, onice, schedule
from gamestate.schemas import PBP_RAW, SCHEDULE_JSON
from gamestate.sources import landed, sinks
from gamestate.streaming import incremental


def one(df, c):
    return [r[c] for r in df.collect()]


def test_clock_and_padding(spark):
    df = spark.createDataFrame([("5:07",), ("15:07",), ("",), (None,), ("x",)], "c string")
    assert one(df.select(clock_seconds(F.col("c")).alias("s")), "s") == [307, 907, None, None, None]
    assert one(df.select(padded(F.col("c")).alias("s")), "s") == ["05:07", "15:07", "", None, "x"]


def test_recode_and_sides(spark):
    row = {"id": 1, "periodType": "REG", "gameType": 2, "eventOwnerTeamId": "9", "home_id": "9", "away_id": "8", "home_abbrev": "H", "away_abbrev": "A", "typeDescKey": "shot-on-goal", "shotType": "odd"}
    raw = game.conform(spark.createDataFrame([row, row | {"periodType": "SO"}, row | {"gameType": 1}]), PBP_RAW)
    got = game.align(raw).select("event_type", "secondary_type", "event_team_type", "event_team_abbr", "season_type").collect()
    assert [tuple(r) for r in got] == [("SHOT", "odd", "home", "H", "R")]


def test_strength_codes(spark):
    codes = [None, "1551", None, "0651", "1560", "0101", "1010", "0551"]
    df = spark.createDataFrame([(1, 1, i, c) for i, c in enumerate(codes)], "season int, game_id int, event_idx int, situationCode string")
    got = {r["event_idx"]: (r["strength_state"], r["true_strength_state"], r["away_en"], r["home_en"]) for r in game.strength(df).collect()}
    assert got[0] == (None, None, 0, 0)
    assert got[1] == got[2] == ("5v5", "5v5", 0, 0)
    assert got[3] == ("5v6", "5vE", 1, 0)
    assert got[4] == ("6v5", "Ev5", 0, 1)
    assert 5 not in got and 6 not in got
    assert got[7] == ("5v5", "5vE", 1, 0)
    assert len(game.strength(df, drop_unknown=True).collect()) == 4


@pytest.mark.parametrize(("side", "team", "zone", "want"), [("left", "home", "O", 10), ("right", "home", "O", -10), ("left", "away", "D", -10), ("right", "away", "N", 10), (None, "home", "O", 10), (None, "home", "D", -10), (None, "away", "N", -10)])
def test_coordinates(spark, side, team, zone, want):
    df = spark.createDataFrame([(1, 1, 1, 10.0, 5.0, side, team, zone)], "season int, game_id int, period int, x double, y double, homeTeamDefendingSide string, event_team_type string, event_zone string")
    assert game.coordinates(df).first()["x_abs"] == want


def test_geometry_at_the_goal_line(spark):
    df = spark.createDataFrame([(89.25, 0.0), (89.25, 3.0), (95.0, 2.0), (None, 1.0)], "x double, y double").select(distance(F.col("x"), F.col("y"), 89.25).alias("d"), angle(F.col("x"), F.col("y"), 89.25).alias("a"))
    rows = df.collect()
    assert rows[0]["d"] == 0 and rows[1]["a"] == 90 and rows[2]["a"] > 90 and rows[3]["a"] is None


@given(st.floats(-100, 100), st.floats(-43, 43))
def test_geometry_identity(x, y):
    g = 89.25
    if abs(x - g) < 1e-6:
        return
    two = abs(math.degrees(math.atan(y / (g - abs(x) if x >= 0 else abs(x) + g))))
    two = 180 - two if x > g else two
    assert math.isclose(two, math.degrees(math.atan2(abs(y), g - x)), abs_tol=1e-7)


@pytest.mark.parametrize(("cur", "on", "off", "last", "want"), [("a", "", "", False, "a"), ("", "b", "", False, "b"), ("", "", "c", True, "c"), ("", "b", "c", True, "b"), ("", "b", "c", False, "c"), ("a", "b", "c", True, "a,b"), ("a", "b", "c", False, "a,c"), ("a", "", "c", True, "a"), ("a", "b", "", False, None), ("", "", "", True, None)])
def test_decision_table(spark, cur, on, off, last, want):
    df = spark.createDataFrame([(cur, on, off, last)], "c string, n string, f string, l boolean")
    assert df.select(onice.decide(*(F.col(x) for x in "cnfl")).alias("r")).first()["r"] == want


def test_shifts_collapse(spark):
    row = ("1", 1, "7", "AAA", "9", "Ann", "Bee", 2)
    rows = [(*row, "1:00", "02:00"), (*row, "1:00", "02:00"), (*row, "01:30", "02:00"), (*row, "03:00", "03:00"), (*row, "", "04:00")]
    df = spark.createDataFrame([(r[1], r[2], r[3], r[4], r[5], r[6], r[7], r[8], r[9]) for r in rows], "gameId int, teamId string, teamAbbrev string, playerId string, firstName string, lastName string, period int, startTime string, endTime string")
    got = onice.normalise_shifts(df).collect()
    assert [(r["period_start_seconds"], r["period_end_seconds"], r["game_start_seconds"], r["player_name"]) for r in got] == [(90, 120, 1290, "ANN BEE")]


def test_on_ice_keeps_events_without_shifts(spark):
    ev = spark.createDataFrame([(1, 1, 1, 1, 10, "SHOT"), (1, 2, 1, 1, 10, "SHOT")], "season int, game_id int, period int, event_idx int, period_seconds int, event_type string")
    sh = spark.createDataFrame([(1, 1, 1, "home", "p1", 0, 0, 60), (1, 1, 1, "home", "p2", None, 0, 60)], "season int, game_id int, period int, team_type string, player_id string, pos_G int, start_s int, end_s int")
    got = {r["game_id"]: (r["home_1_on_id"], r["home_2_on_id"]) for r in onice.on_ice(ev, sh).collect()}
    assert got == {1: ("p1", None), 2: (None, None)}


def test_penalty_clock(spark):
    base = dict(season=1, game_id=1, period=1, season_type="R", x_abs=50.0, y_abs=0.0, event_team_type="home", event_team_abbr="H", strength_state="5v4", true_strength_state="5v4", home_skaters=5, away_skaters=4, home_score=0, away_score=0, home_goalie="a", away_goalie="b", pen_index=1, home_shift_index=1, away_shift_index=1, event_distance=10.0, event_angle=5.0, event_type="SHOT")
    rows = [base | {"event_idx": i, "game_seconds": s} for i, s in enumerate([0, 0, 299, 300, 500])]
    got = features.shots(spark.createDataFrame(rows)).orderBy("event_idx").select("pen_seconds_since", "seconds_since_last", "in_PP", "event_goalie_id").collect()
    assert [r["pen_seconds_since"] for r in got] == [0, 299, 120, 120]
    assert got[0]["seconds_since_last"] == 0.5 and all(r["in_PP"] == 1 for r in got)
    other = features.shots(spark.createDataFrame(rows), goalie_side="defending").first()
    assert got[0]["event_goalie_id"] == "A" and other["event_goalie_id"] == "B"


def test_prior_flags(spark):
    rows = [(e, s) for e in ("SHOT", "MISSED_SHOT", "BLOCKED_SHOT", "GIVEAWAY", "TAKEAWAY", "HIT", "FACEOFF", None) for s in (1, 0)]
    df = spark.createDataFrame(rows, "event_type_last string, same_team_last int")
    flags = features.prior_flags()
    for r in df.withColumns({k: F.coalesce(c.cast("int"), F.lit(0)) for k, c in flags.items()}).collect():
        assert sum(r[k] for k in flags) == (r["event_type_last"] is not None)


def test_counters_do_not_depend_on_partitioning(spark, tiny):
    from gamestate.plans.domain import ON, placed

    df = game.clean(placed(spark, tiny))
    a = features.index(df, ON).select("game_id", "event_idx", "all_shift_index").orderBy("game_id", "event_idx").collect()
    b = features.index(df.repartition(7), ON).select("game_id", "event_idx", "all_shift_index").orderBy("game_id", "event_idx").collect()
    assert a == b


def test_eastern_over_clock_changes(spark):
    df = spark.sql("select timestamp'2024-03-10 06:59:00' as t union all select timestamp'2024-03-10 07:01:00' union all select timestamp'2024-11-03 06:30:00'")
    assert one(df.select(*schedule.eastern(F.col("t"))), "start_time_ET") == ["01:59", "03:01", "01:30"]


def _landed(tmp_path, docs):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in docs))
    return str(tmp_path / "in")


def test_landed_schedule(spark, tmp_path):
    team = lambda i, a, s: {"id": i, "abbrev": a, "score": s, "odds": [{"providerId": 9, "value": "1.5"}]}
    g = {"id": 5, "season": 20232024, "gameType": 2, "startTimeUTC": "2024-01-02T00:30:00Z", "gameState": "OFF", "gameScheduleState": "Final", "neutralSite": False, "venue": {"default": "V"}, "awayTeam": team("1", "AAA", 2), "homeTeam": team("2", "BBB", 3), "new": 1}
    docs = landed.schedules(spark, _landed(tmp_path, [{"gameWeek": [{"date": "2024-01-01", "games": [g, g | {"gameType": 1}]}]}, "not json"]))
    rows = schedule.games(docs, "p/{}/x", "s/{}").collect()
    assert [(r["game_id"], r["game_date"], r["start_time_ET"], r["season_type"], r["game_schedule_state"], r["pbp_link"]) for r in rows] == [(5, "2024-01-01", "19:30", "R", "OK", "p/5/x")]
    assert schedule.finished(schedule.games(docs, "p/{}", "s/{}")).count() == 1
    assert schedule.with_odds(docs, 9).first()["home_odds"] == 1.5
    assert schedule.with_odds(docs, 8).first()["home_odds"] is None
    assert landed.bad(docs).count() == 1


def test_landed_roster_and_missing(spark, tmp_path):
    p = lambda i, s: {"id": i, "firstName": {"default": "a"}, "lastName": {"default": "b"}, "shootsCatches": s}
    doc = {"season": 20232024, "team": "AAA", "positions": {"forwards": [p("1", "L")], "defensemen": [p("2", "R")], "goalies": [p("3", None)]}}
    full = schedule.roster(landed.rosters(spark, _landed(tmp_path, [doc])))
    got = {r["player_id"]: (r["pos_F"], r["pos_D"], r["pos_G"], r["hand_R"], r["hand_L"], r["sweaterNumber"]) for r in full.collect()}
    assert got == {"1": (1, 0, 0, 0, 1, 100), "2": (0, 1, 0, 1, 0, 100), "3": (0, 0, 1, 0, 0, 100)}
    pbp = spark.createDataFrame([("1", "4", None)], "home_1_on_id string, away_1_on_id string, home_goalie_on_id string")
    assert one(schedule.missing_players(pbp, schedule.slim(full)), "player_id") == ["4"]
    assert schedule.compile_rosters([full, full]).count() == 3


def test_landed_plays(spark, tmp_path):
    doc = {"id": 1, "season": 20232024, "gameDate": "2024-01-01", "gameType": 2, "awayTeam": {"id": "8", "abbrev": "A"}, "homeTeam": {"id": "9", "abbrev": "H"}, "plays": [{"sortOrder": 3, "typeDescKey": "goal", "timeInPeriod": "05:00", "periodDescriptor": {"number": 1, "periodType": "REG"}, "details": {"xCoord": 80, "eventOwnerTeamId": "9", "unknown": 1}}]}
    df = landed.pbp(spark, _landed(tmp_path, [doc]))
    assert df.columns == [f.name for f in PBP_RAW.fields]
    r = game.player_roles(game.clock(game.align(df))).first()
    assert (r["event_type"], r["x"], r["event_team_abbr"], r["game_seconds"], r["event_player_2_type"]) == ("GOAL", 80.0, "H", 300, "EmptyNet")


def test_stream_appends_once(spark, tmp_path):
    src = _landed(tmp_path, [{"gameWeek": [{"games": [{"id": 1}, {"id": 2}]}]}])
    make = lambda b: b.select(F.explode(F.get("gameWeek", F.lit(0))["games"]).alias("g")).select(F.col("g.id").alias("game_id"))
    out = str(tmp_path / "out")
    for n in ("c1", "c2"):
        q = incremental.load(incremental.stream(spark, src, SCHEDULE_JSON), make, out, ["game_id"], str(tmp_path / n))
        q.awaitTermination(60)
    assert spark.read.parquet(out).count() == 2


def test_append_reads_only_the_seasons_of_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 2020, "a"), (2, 2020, "b"), (2, 2020, "c"), (3, 2021, "d")], "id int, season int, v string")
    sinks.append(rows, path, ["season", "id"], "season")
    sinks.append(rows.where("season = 2021").union(spark.createDataFrame([(4, 2021, "e")], rows.schema)), path, ["season", "id"], "season")
    sinks.append(rows.limit(0), path, ["season", "id"], "season")
    assert sorted((r["season"], r["id"]) for r in spark.read.parquet(path).collect()) == [(2020, 1), (2020, 2), (2021, 3), (2021, 4)]


def test_stream_by_season(spark, tmp_path):
    src = _landed(tmp_path, [{"gameWeek": [{"games": [{"id": 1, "season": 2020}, {"id": 2, "season": 2021}]}]}])
    make = lambda b: b.select(F.explode(F.get("gameWeek", F.lit(0))["games"]).alias("g")).select(F.col("g.id").alias("game_id"), F.col("g.season").alias("season"))
    out = str(tmp_path / "out")
    for n in ("c1", "c2"):
        incremental.load(incremental.stream(spark, src, SCHEDULE_JSON), make, out, ["game_id"], str(tmp_path / n), "season").awaitTermination(60)
    assert spark.read.parquet(out).where("season = 2021").count() == 1 and spark.read.parquet(out).count() == 2


def test_replace_while_reading(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace(spark.range(5), path)
    sinks.replace(spark.read.parquet(path).where("id < 3"), path)
    assert spark.read.parquet(path).count() == 3


def test_metrics_on_known_values(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1), (0, 0.7)], "label int, score double")
    assert math.isclose(metrics.auc(df).first()["auc"], (3 + 1.5) / 6)
    assert metrics.youden(df).first()["threshold"] == 0.9  # tpr 1/2, fpr 0
    assert metrics.confusion(df, 0.75).first()["tp"] == 1
    wide = spark.createDataFrame([(1, None, 2.0), (1, "a", 3.0)], "a int, b string, c double")
    assert one(metrics.null_report(wide), "column_name") == ["b"]
    assert metrics.drop_constant(wide, ["a", "c"]).columns == ["b", "c"]
