"""Boosted trees: against a plain recomputation, with nulls, classes, patience and search."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from gamestate.operators import boosting, features, models, tuning
from gamestate.operators.boosting import Booster, Params
from gamestate.plans import modelling
from gamestate.plans.storage import kept


@pytest.fixture(scope="module")
def frame(spark):
    """Goals follow from a, which is null for a third of the rows (and then tells more than any value), and from c."""
    at = F.col("event_idx")
    noise = lambda k: (F.pmod(F.xxhash64("event_idx", F.lit(k)), F.lit(10_000)) / 10_000).cast("double")
    df = spark.range(6000).select(F.lit(20232024).alias("season"), (F.col("id") % 60).alias("game_id"), F.col("id").alias("event_idx"))
    df = df.withColumns({"a": F.when(at % 3 != 0, noise(1)), "b": noise(2), "c": noise(3), "none": F.lit(None).cast("int")})
    z = F.when(F.col("a").isNull(), 1.5).when(F.col("a") > 0.6, 0.5).otherwise(-2.0) + F.when(F.col("c") > 0.5, 0.7).otherwise(-0.7)
    df = df.withColumn("is_goal", (noise(4) < 1 / (1 + F.exp(-z))).cast("int")).withColumn("fold", models.fold(20242025))
    return df.withColumn("kind", F.when(F.col("a").isNull(), "void").when(F.col("a") > 0.5, "high").otherwise("low")).cache()


COLUMNS = ["a", "b", "c", "none"]


def by_hand(frame, p, rounds):
    """Valid loss by round of depth-1 trees, tried at every edge and either way for nulls."""
    rows = frame.where("fold in ('train', 'valid')").select(*COLUMNS, "is_goal", "fold").toPandas()
    x = rows[COLUMNS].to_numpy(np.float64)
    y, train = rows["is_goal"].to_numpy(), (rows["fold"] == "train").to_numpy()
    edges = modelled_edges(frame)
    rate = y[train].mean()
    margin, losses = np.full(len(y), math.log(rate / (1 - rate))), []
    for _ in range(rounds + 1):
        prob = 1 / (1 + np.exp(-margin))
        losses.append(float(-np.log(np.where(y == 1, prob, 1 - prob))[~train].mean()))
        g, h = prob - y, prob * (1 - prob)
        best = (0, None, None)
        for j, e in enumerate(edges):
            for cut in e:
                for nulls_left in (False, True):
                    left = np.where(np.isnan(x[:, j]), nulls_left, x[:, j] <= cut)
                    sums = [(g[train & s].sum(), h[train & s].sum()) for s in (left, ~left)]
                    if min(s[1] for s in sums) < p.min_child_weight:
                        continue
                    gain = sum(a * a / (b + p.lam) for a, b in sums) - g[train].sum() ** 2 / (h[train].sum() + p.lam)
                    if gain > best[0] + 1e-6:
                        best = (gain, left, [-p.eta * a / (b + p.lam) for a, b in sums])
        margin = margin + np.where(best[1], *best[2])
    return losses


def modelled_edges(frame):
    return boosting.bin_rows(frame, COLUMNS, "is_goal", models.KEYS, kept).edges


def test_rounds_equal_a_plain_recomputation(frame):
    p = Params(eta=0.3, depth=1, rounds=4)
    (model,) = models.boosted(frame, COLUMNS, kept, [p])
    assert [c[2] for c in model.curve] == pytest.approx(by_hand(frame, p, 4), abs=1e-5)


def test_every_row_is_scored_and_nulls_have_a_direction(frame):
    (model,) = models.boosted(frame, COLUMNS, kept, [Params(rounds=15)])
    got = models.goals(model, frame)
    assert got.count() == frame.count() and got.where("xG is null or xG not between 0 and 1").count() == 0
    means = {r["void"]: r["m"] for r in got.groupBy(F.col("a").isNull().alias("void")).agg(F.avg("xG").alias("m")).collect()}
    assert means[True] > means[False] + 0.2
    valid = got.where("fold = 'valid'").agg(F.avg(-F.log(F.when(F.col("is_goal") == 1, F.col("xG")).otherwise(1 - F.col("xG"))))).first()[0]
    assert valid == pytest.approx(model.curve[model.best][2], abs=1e-5)


def test_trees_do_not_depend_on_how_rows_are_dealt(frame, monkeypatch):
    p = Params(rounds=3, subsample=0.7, colsample=0.5)
    (one,) = models.boosted(frame.coalesce(1), COLUMNS, kept, [p])
    monkeypatch.setattr(boosting, "TASKS", 0)  # sums through a shuffle
    (two,) = models.boosted(frame.repartition(7), COLUMNS, kept, [p])
    assert [c[:3] for c in one.curve] == [c[:3] for c in two.curve]


def test_patience_keeps_the_best_round(spark, frame):
    every = models.boosted(frame, COLUMNS, kept, [Params(eta=e, rounds=60, patience=3) for e in (1.5, 0.3)])
    assert len(every[0].curve) < 60
    for m in every:
        losses = [c[2] for c in m.curve]
        assert m.best == losses.index(min(losses)) and len(losses) in (m.best + 4, 61)
    table = boosting.curve(spark, every)
    assert table.columns == ["eta", "iteration", "train_logloss", "valid_logloss", "seconds", "best"]
    assert table.where("best").count() == 2


def test_softmax_beats_a_forest_on_held_out_rows(frame):
    fifth = "pmod(xxhash64(season, game_id, event_idx), 5) = 0"
    df = frame.withColumn("secondary_type", F.when(F.col("event_idx") % 11 != 0, F.when(F.col("event_idx") % 50 == 1, "Poked").otherwise(F.col("kind"))))
    out, model = models.impute_types(df, ["a", "b", "c"], kept)
    assert out.count() == df.count() and out.columns == [*df.columns, "event_detail"]
    rare = out.where("secondary_type = 'Poked'")
    assert rare.count() > 50 and rare.where("event_detail = 'Poked' or event_detail is null").count() == 0
    assert out.where("secondary_type <> 'Poked' and secondary_type <> event_detail").count() == 0
    known = df.where("secondary_type in ('void', 'high', 'low')").na.fill(0, ["a"])
    known = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(StringIndexer(inputCol="secondary_type", outputCol="label").fit(known).transform(known))
    forest = RandomForestClassifier(numTrees=20, maxDepth=6, seed=66).fit(known.where(f"not {fifth}"))
    loss = MulticlassClassificationEvaluator(metricName="logLoss").evaluate(forest.transform(known.where(fifth)))
    assert model.curve[model.best][2] < loss


def test_no_known_type_and_one_class(frame):
    out, model = models.impute_types(frame.withColumn("secondary_type", F.lit(None).cast("string")), ["a"], kept)
    assert model is None and out.where("event_detail is not null").count() == 0
    (model,) = models.boosted(frame.withColumn("is_goal", F.lit(0)), ["a"], kept, [Params()])
    assert models.goals(model, frame).where("xG <> 0").count() == 0
    with pytest.raises(ValueError, match="no classes"):
        models.boosted(frame.limit(0), ["a"], kept, [Params()])


def test_saved_models_score_alike(spark, frame, tmp_path):
    (model,) = models.boosted(frame, COLUMNS, kept, [Params(rounds=3)])
    boosting.save(spark, model, str(tmp_path / "m"))
    again = boosting.load(spark, str(tmp_path / "m"))
    a, b = (models.goals(m, frame).agg(F.sum("xG")).first()[0] for m in (model, again))
    assert a == pytest.approx(b)
    gains = {r["feature"]: r for r in boosting.importance(spark, model).collect()}
    assert sum(r["gain"] for r in gains.values()) == pytest.approx(1) and gains["a"]["gain"] > gains["b"]["gain"] and gains["none"]["weight"] == 0


def test_spark_ml_pipelines_keep_rows_with_nulls(frame):
    model = models.train(frame, ["a", "c"], rounds=2, depth=2)
    got = models.score(model, frame)
    assert got.count() == frame.count() and set(got.columns) == {*frame.columns, "xG"}


@pytest.mark.parametrize("name", ["EV", "PP", "SH", "EN"])
def test_all_rows_of_a_split_are_scored(spark, tiny, name):
    df = features.prepare(features.split(modelling.shots(spark, tiny), name), modelling.synthetic.roster(spark, tiny), name)
    query = {"EV": modelling.xg_train_score, "PP": modelling.xg_train_score_pp, "SH": modelling.xg_train_score_sh, "EN": modelling.xg_train_score_en}[name]
    got = query(spark, tiny)
    assert got.count() == df.count() and got.where("xG is null").count() == 0


def toy(p):
    return (math.log10(p["alpha"]) + 1) ** 2 + (p["depth"] - 5) ** 2 / 4 + 10 * (p["subsample"] - 0.72) ** 2 + (0.5 if p["coarse"] else 0)


def test_sampler_beats_random_trials_on_a_fixed_objective():
    def least(first, seed):
        s = tuning.Sampler(tuning.TREES, seed, first)
        for _ in range(60):
            p = s.ask()
            s.tell(p, toy(p))
        return min(v for _, v in s.seen)

    adaptive, random = (np.mean([least(first, seed) for seed in range(8)]) for first in (10, 1000))
    assert adaptive < 0.75 * random
    for seed in range(20):
        p = tuning.Sampler(tuning.TREES, seed).ask()
        assert 3 <= p["depth"] <= 7 and 0.001 <= p["alpha"] <= 10 and isinstance(p["depth"], int)


def test_search_prunes_and_respects_its_time_box():
    def fake(chosen, stop, left):
        out = []
        for m, p in enumerate(chosen):
            b = Booster([], [], [], [0.0], Params())
            for i in range(20):
                b.curve.append((i, 0.0, toy(p) + 1 / (i + 1), 0.01 * i))
                b.best = i
                if stop(m, b.curve):
                    b.state = "pruned"
                    break
            out.append(b)
        return out

    best, trials = tuning.search(fake, tuning.TREES, 24, together=4)
    assert len(trials) == 24 and any(t.state == "pruned" for t in trials)
    assert min(t.loss for t in trials) == best.curve[best.best][2]
    assert len(tuning.search(fake, tuning.TREES, 24, together=4, seconds=0.0)[1]) == 4


def test_tuned_models(frame):
    best, trials = models.tuned(frame, ["a", "c"], kept, 4, together=2, params=Params(rounds=4))
    assert len(trials) == 4 and best.curve[best.best][2] == min(t.loss for t in trials)
    late, _ = models.tuned(frame, ["a", "c"], kept, 4, together=2, seconds=0.0, params=Params(rounds=4))
    assert late.state == "timeout"
