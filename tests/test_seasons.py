"""From landed documents to scored events."""

import json

from pyspark.sql import functions as F

from gamestate.operators import models
from gamestate.plans import modelling, seasons, synthetic
from gamestate.plans.domain import ON, placed
from gamestate.sources import sinks


def _game(i):
    def play(n, kind, clock, x, team, **more):
        return {"sortOrder": n, "typeDescKey": kind, "timeInPeriod": clock, "situationCode": "1551", "homeTeamDefendingSide": "left", "periodDescriptor": {"number": 1, "periodType": "REG"}, "details": {"xCoord": x, "yCoord": 5, "eventOwnerTeamId": team, "zoneCode": "O"} | more}

    plays = [
        {"sortOrder": 1, "typeDescKey": "period-start", "timeInPeriod": "00:00", "situationCode": "1551", "periodDescriptor": {"number": 1, "periodType": "REG"}},
        play(2, "faceoff", "00:00", 0, "9", winningPlayerId="p1", losingPlayerId="q1"),
        play(3, "shot-on-goal", "00:30", 60, "9", shootingPlayerId="p1", goalieInNetId="g8", shotType="wrist"),
        play(4, "goal", "00:32", 80, "9", scoringPlayerId="p2", goalieInNetId="g8", homeScore=1, awayScore=0),
    ]
    return {"id": i, "season": 20232024, "gameDate": "2024-01-01", "gameType": 2, "awayTeam": {"id": "8", "abbrev": "A"}, "homeTeam": {"id": "9", "abbrev": "H"}, "plays": plays}


def _shifts(i):
    one = lambda p, t, a, b: {"id": 1, "gameId": i, "teamId": t, "teamAbbrev": "X", "playerId": p, "firstName": "a", "lastName": "b", "period": 1, "startTime": a, "endTime": b}
    return {"data": [one("p1", "9", "0:00", "01:00"), one("p2", "9", "0:31", "01:00"), one("g9", "9", "0:00", "20:00"), one("q1", "8", "0:00", "00:00"), one("g8", "8", "0:00", "20:00")]}


def _put(tmp_path, name, docs):
    (tmp_path / name).mkdir(exist_ok=True)
    for k, d in enumerate(docs):
        (tmp_path / name / f"{d.get('id', k)}-{k}.json").write_text(json.dumps(d))
    return str(tmp_path / name)


def test_landed_games_to_frames_and_updates(spark, tmp_path):
    roster = spark.createDataFrame([("p1", 0, 1, 1, 0, 0), ("p2", 0, 0, 0, 1, 0), ("g9", 1, 1, 0, 0, 0), ("g8", 1, 0, 1, 0, 0), ("q1", 0, 0, 1, 1, 0)], "player_id string, pos_G int, hand_R int, hand_L int, pos_F int, pos_D int")
    plays, shifts, table = _put(tmp_path, "plays", [_game(1)]), _put(tmp_path, "shifts", [_shifts(1)]), str(tmp_path / "pbp")
    sinks.by_season(seasons.load_pbp(spark, plays, shifts, roster), table)
    got = spark.read.parquet(table).orderBy("event_idx").collect()
    assert [r["event_type"] for r in got] == ["PERIOD_START", "FACEOFF", "SHOT", "GOAL"]
    assert [r["home_1_on_id"] for r in got] == [None, "p1", "p1", "p1"] and got[3]["home_2_on_id"] == "p2" and got[3]["away_goalie_on_id"] == "g8"
    _put(tmp_path, "plays", [_game(1), _game(2)])
    _put(tmp_path, "shifts", [_shifts(1), _shifts(2)])
    seasons.update_pbp(spark, plays, shifts, roster, table)
    seasons.update_pbp(spark, plays, shifts, roster, table)
    assert spark.read.parquet(table).count() == 8
    ev = seasons.model_frames(spark.read.parquet(table), roster)["EV"].orderBy("game_id", "event_idx").collect()
    assert [(r["game_id"], r["is_goal"], r["is_rebound"], r["prior_face_win"]) for r in ev] == [(1, 0, 0, 1), (1, 1, 1, 0), (2, 0, 0, 1), (2, 1, 1, 0)]


def test_scored_events(spark, tiny):
    pbp = placed(spark, tiny)
    frames = {k: v.withColumn("fold", models.fold(0)) for k, v in seasons.model_frames(pbp, synthetic.roster(spark, tiny), ON).items() if k in ("EV", "EN")}
    cols = ["event_distance", "event_angle", "seconds_since_last"]
    fitted = {k: models.train(v, cols, rounds=2, depth=2) for k, v in frames.items()}
    out = seasons.score_events(pbp, frames, fitted)
    keys = [*models.KEYS, "strength_type"]
    assert out.count() == out.select(*keys).distinct().count() == sum(v.count() for v in frames.values())
    assert out.where((F.col("xG") < 0) | (F.col("xG") > 1)).count() == 0


def test_schedule_update(spark, tmp_path):
    team = lambda i: {"id": i, "abbrev": i, "score": 1}
    g = lambda i, day, state="OFF": {"id": i, "season": 20232024, "gameType": 2, "startTimeUTC": f"2024-01-{day}T23:30:00Z", "gameState": state, "gameScheduleState": "OK", "awayTeam": team("1"), "homeTeam": team("2")}
    path = _put(tmp_path, "in", [{"gameWeek": [{"games": [g(1, "01")]}]}])
    table = str(tmp_path / "schedule")
    sinks.replace(seasons.load_schedule(spark, path), table)
    _put(tmp_path, "in", [{"gameWeek": [{"games": [g(1, "01"), g(2, "02"), g(3, "03", "FUT")]}]}])
    seasons.update_schedule(spark, path, table)
    assert sorted(r["game_id"] for r in spark.read.parquet(table).collect()) == [1, 2]


def test_a_late_game_before_the_latest_date_stays_out_and_nothing_is_rewritten(spark, tmp_path):
    team = lambda i: {"id": i, "abbrev": i, "score": 1}
    g = lambda i, day: {"id": i, "season": 20232024, "gameType": 2, "startTimeUTC": f"2024-01-{day}T23:30:00Z", "gameState": "OFF", "gameScheduleState": "OK", "awayTeam": team("1"), "homeTeam": team("2")}
    path, table = _put(tmp_path, "in", [{"gameWeek": [{"games": [g(1, "05")]}]}]), tmp_path / "schedule"
    seasons.load_schedule(spark, path).write.parquet(str(table))
    before = {f.name for f in table.glob("*.parquet")}
    _put(tmp_path, "in", [{"gameWeek": [{"games": [g(1, "05"), g(2, "04"), g(3, "05"), g(3, "05")]}]}])
    seasons.update_schedule(spark, path, str(table))
    assert sorted(r["game_id"] for r in spark.read.parquet(str(table)).collect()) == [1, 3]
    assert before <= {f.name for f in table.glob("*.parquet")}


def test_an_increment_reads_only_its_seasons(spark, tmp_path):
    table = str(tmp_path / "t")
    spark.createDataFrame([(1, 2022), (2, 2023), (3, None)], "game_id int, season int").write.partitionBy("season").parquet(table)
    known = lambda *years: sinks.within(spark.read.parquet(table), "season", spark.createDataFrame([(y,) for y in years], "season int"))
    assert [r["game_id"] for r in known(2023, 2024).collect()] == [2]
    assert sorted(r["game_id"] for r in known(2022, None).collect()) == [1, 3]
    plan = known(2023)._jdf.queryExecution().executedPlan().toString()
    assert "2023" in plan.split("PartitionFilters:")[1].split("PushedFilters:")[0]


def test_scored_events_of_trained_models(spark, tiny, monkeypatch):
    monkeypatch.setattr(seasons, "SPLITS", ("EV", "EN"))
    frames, fitted = modelling._all_splits(spark, tiny)
    monkeypatch.setattr(modelling, "_all_splits", lambda *_: (frames, fitted))
    got = {(r["season"], r["game_id"], r["event_idx"]): r["xG"] for r in modelling.scored_events(spark, tiny).where("strength_type = 'EV'").collect()}
    alone = models.goals(fitted["EV"], frames["EV"]).collect()
    assert got == {(r["season"], r["game_id"], r["event_idx"]): r["xG"] for r in alone}
    report = {r["strength_type"]: r for r in modelling.xg_report(spark, tiny).collect()}
    valid = [(r["is_goal"], r["xG"]) for r in alone if r["fold"] == "valid"]
    pos, neg = [x for y, x in valid if y], [x for y, x in valid if not y]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    assert report["EV"]["shots"] == len(valid) and abs(report["EV"]["auc"] - wins / (len(pos) * len(neg))) < 1e-9
    assert set(report) == {"EV", "EN"}
