"""Bad records, load counts, player documents, and the models' refit, search and importances."""

import json

import pytest
from pyspark.sql import functions as F

from gamestate.operators import metrics, models, schedule
from gamestate.plans import feeds
from gamestate.sources import landed

PLAYER = {"playerId": 8, "currentTeamAbbrev": "ABC", "firstName": {"default": "Jo"}, "lastName": {"default": "Doe"}, "position": "D", "shootsCatches": "R", "birthCity": {"default": "X"}, "birthCountry": "Y"}


@pytest.fixture
def players(tmp_path):
    lines = [json.dumps(PLAYER), json.dumps(PLAYER | {"playerId": 9, "position": "G", "sweaterNumber": 31, "birthStateProvince": {"default": "Q"}, "unknown": [1]}), "{broken", ""]
    (tmp_path / "players.json").write_text("\n".join(lines))
    return str(tmp_path / "players.json")


def test_player_documents(spark, players):
    got = {r["player_id"]: r for r in schedule.additions(landed.good(landed.players(spark, players)), 2024).collect()}
    assert set(got) == {"8", "9"} and got["8"]["sweaterNumber"] == 100 and got["8"]["birthStateProvince"] == ""
    assert [got["8"][c] for c in ("firstName", "pos_F", "pos_D", "pos_G", "hand_R", "hand_L")] == ["JO", 0, 1, 0, 1, 0]
    assert got["9"]["pos_G"] == 1 and got["9"]["birthStateProvince"] == "Q" and got["9"]["season"] == 2024


def test_bad_records_go_aside_and_are_counted(spark, players, tmp_path):
    docs, seen = landed.counted(landed.players(spark, players), "load")
    docs.write.parquet(str(tmp_path / "all"))
    assert seen.get == {"documents": 3, "bad": 1}
    aside = str(tmp_path / "aside")
    for _ in range(2):
        assert landed.set_aside(spark.read.parquet(str(tmp_path / "all")), aside).count() == 2
    assert [r["_corrupt_record"] for r in spark.read.parquet(aside).collect()] == ["{broken"] * 2


def test_load_speed_of_each_batch(spark, tiny):
    rows = feeds.load_speed(spark, tiny).collect()
    events = spark.read.parquet(f"{tiny}/events.parquet")
    assert len(rows) == 2 and sum(r["rows"] for r in rows) == events.count() and [r["batch"] for r in rows] == [0, 1]
    assert all(r["seconds"] > 0 and r["rows_a_second"] == pytest.approx(r["rows"] / r["seconds"]) and r["games_a_minute"] > 0 and r["query"] == "events" for r in rows)


@pytest.fixture(scope="module")
def frame(spark):
    df = spark.range(2400).select(F.lit(20232024).alias("season"), (F.col("id") % 60).alias("game_id"), F.col("id").alias("event_idx"), ((F.col("id") * 7919) % 101).cast("double").alias("a"), ((F.col("id") * 104729) % 13).cast("double").alias("b"), F.lit(1.0).alias("c"))
    df = df.withColumn("is_goal", F.when((F.col("a") > 60) & (F.col("b") > 3), 1).when(F.col("event_idx") % 17 == 0, 1).otherwise(0))
    return df.withColumn("fold", models.fold(20242025)).cache()


def test_importances_by_gain_weight_and_cover(spark, frame):
    model = models.train(frame, ["a", "b", "c"], rounds=3, depth=2)
    got = {r["feature"]: r for r in models.importance(spark, model, ["a", "b", "c"], None).collect()}
    text = model.stages[-1].toDebugString
    for k, name in enumerate("abc"):
        assert got[name]["weight"] == sum(line.strip().startswith(f"If (feature {k} ") for line in text.split("\n"))
    n = frame.where("fold = 'train'").count()
    assert got["c"]["weight"] == 0 and got["c"]["cover"] == 0 and 0 < got["b"]["cover"] <= n and 0 < got["a"]["cover"] <= n
    assert models.importance(spark, model, ["a", "b", "c"], 2).count() == 2


def test_refit_uses_the_best_rate(spark, frame):
    model, rates = models.refit(frame, ["a", "b"], [0.01, 0.5], rounds=4, depth=2)
    best = max(rates.collect(), key=lambda r: (r["auc"], -r["eta"]))["eta"]
    assert model.stages[-1].getStepSize() == best and model.stages[-1].getNumTrees == 4
    scored = models.score(model, frame.where("fold = 'test'"))
    assert metrics.auc(scored, "is_goal", "xG").first()["auc"] > 0.8


def test_search_over_many_parameters(frame):
    model = models.search(frame, ["a", "b"], maxDepth=[1, 3], maxIter=[2], stepSize=[0.1], subsamplingRate=[1.0], minInstancesPerNode=[1, 20], minInfoGain=[0.0], maxBins=[32])
    assert model.stages[-1].getMaxDepth() == 3


def test_density_has_an_area_of_one(spark, frame):
    df = frame.select("is_goal", (F.col("a") / 100).alias("xG"))
    got = metrics.density(df, "is_goal", "xG", bins=10)
    assert {round(r["area"], 9) for r in got.groupBy("label").agg(F.sum(F.col("density") / 10).alias("area")).collect()} == {1.0}
