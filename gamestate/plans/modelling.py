"""Model queries: imputed shot types, a model of each split, learning curves, search, importances. No SQL says the same.

A split's frame is written once and read by each fit; the models take all numeric columns of their split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestate.operators import boosting, features, metrics, models
from gamestate.operators.boosting import Params
from gamestate.plans import seasons, synthetic
from gamestate.plans.domain import KEYS, placed, shots
from gamestate.plans.registry import dealt, parts, query
from gamestate.plans.storage import kept
from gamestate.session import together

ETAS = [0.02, 0.05, 0.1, 0.3]


def columns_of(name: str) -> list[str]:
    return features.model_columns(name)


_SHOWN = ["strength_type", "secondary_type", "is_goal", "event_distance", "event_angle"]


def _shaped(spark: SparkSession, sf_dir: str, name: str, shot: DataFrame) -> DataFrame:
    """A split's frame before shot types are imputed, of no more columns than what follows reads; made inside of `dealt`."""
    df = features.prepare(features.split(shot, name), synthetic.roster(spark, sf_dir), name)
    return kept(df.select(*dict.fromkeys([*KEYS, *_SHOWN, *_inputs(name)])))


def _inputs(name: str) -> list[str]:
    return [c for c in columns_of(name) if c not in features.SHOT_COLUMNS]


def _imputed(df: DataFrame, name: str) -> tuple[DataFrame, boosting.Booster | None]:
    df, model = models.impute_types(df, _inputs(name), kept)
    return kept(features.shot_types(df, "event_detail").withColumn("fold", models.fold(20242025))), model


def _framed(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, boosting.Booster | None]:
    """A split's frame, and the model that imputed its shot types."""
    with dealt(spark, parts(spark, sf_dir)):
        df = _shaped(spark, sf_dir, name, shots(spark, sf_dir))
    return _imputed(df, name)


def prepared(spark: SparkSession, sf_dir: str, name: str = "EV") -> DataFrame:
    """The frame of a split as a table: every fit, and every round of one, reads it again."""
    return _framed(spark, sf_dir, name)[0]


@query()
def impute_shot_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir).select(*KEYS, "secondary_type", "event_detail")


@query()
def impute_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loss of softmax boosting on its train and held-out rows by round."""
    return boosting.curve(spark, [_framed(spark, sf_dir, "EV")[1]]).drop("seconds")


def _scored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = prepared(spark, sf_dir, name)
    (model,) = models.boosted(df, columns_of(name), kept, [Params()])
    return models.goals(model, df)


@query()
def xg_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, "EV").select(*KEYS, "fold", "is_goal", "xG")


@query()
def xg_train_score_pp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, "PP").select(*KEYS, "fold", "is_goal", "xG")


@query()
def xg_train_score_sh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, "SH").select(*KEYS, "fold", "is_goal", "xG")


@query()
def xg_train_score_en(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, "EN").select(*KEYS, "fold", "is_goal", "xG")


def _all_splits(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, boosting.Booster]]:
    """The frame and the model of each split. The splits are trained at once: most passes don't fill the cores."""
    with dealt(spark, parts(spark, sf_dir)):
        shot = kept(shots(spark, sf_dir).where(" or ".join(f"in_{s} = 1" for s in seasons.SPLITS)))
        shaped = dict(zip(seasons.SPLITS, together(spark, lambda s: _shaped(spark, sf_dir, s, shot), seasons.SPLITS), strict=True))

    def trained(name: str) -> tuple[DataFrame, boosting.Booster]:
        df, _ = _imputed(shaped[name], name)
        return df, models.boosted(df, columns_of(name), kept, [Params()])[0]

    found = dict(zip(seasons.SPLITS, together(spark, trained, seasons.SPLITS), strict=True))
    return {s: df for s, (df, _) in found.items()}, {s: m for s, (_, m) in found.items()}


@query()
def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the xG of each split that a shot belongs to, by models of all four splits."""
    return seasons.score_events(placed(spark, sf_dir), *_all_splits(spark, sf_dir))


@query()
def xg_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC and log loss of each split's model on its valid rows; null where a split has no valid rows of both kinds."""
    out = None
    frames, fitted = _all_splits(spark, sf_dir)
    scored = together(spark, lambda s: kept(models.goals(fitted[s], frames[s].where("fold = 'valid'")).select("is_goal", "xG")), frames)
    for name, valid in zip(frames, scored, strict=True):
        row = metrics.auc(valid, "is_goal", "xG").crossJoin(metrics.logloss(valid, "is_goal", "xG")).crossJoin(valid.agg(F.count("*").alias("shots")))
        row = row.select(F.lit(name).alias("strength_type"), "shots", "auc", "logloss")
        out = row if out is None else out.union(row)
    return out


@query()
def importance_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    (model,) = models.boosted(prepared(spark, sf_dir), columns_of("EV"), kept, [Params()])
    return boosting.importance(spark, model).orderBy(F.desc("gain"), "feature").limit(10)


@query()
def eta_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learning curves of several rates, trained in the same passes; a rate ends when its valid loss stops falling."""
    every = models.boosted(prepared(spark, sf_dir), columns_of("EV"), kept, [Params(eta=e) for e in ETAS])
    return boosting.curve(spark, every)


@query()
def refit_best_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC of each learning rate on the valid rows, and on the test rows that of the model refitted at the best one."""
    df = prepared(spark, sf_dir)
    model, every, aucs = models.refit_boosted(df, columns_of("EV"), kept, ETAS)
    rates = spark.createDataFrame([(m.params.eta, a, m.best) for m, a in zip(every, aucs, strict=True)], "eta double, auc double, rounds int")
    scored = models.goals(model, df.where("fold = 'test'")).select("is_goal", "xG")
    return rates.crossJoin(metrics.auc(scored, "is_goal", "xG").withColumnRenamed("auc", "test_auc"))


@query()
def tuning_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trials of an adaptive search over seven parameters of the trees, at a fixed rate."""
    _, trials = models.tuned(prepared(spark, sf_dir), columns_of("EV"), kept, 16, together=4, params=Params(eta=0.3, rounds=40, patience=5))
    shown = "trial int, coarse boolean, depth int, min_child_weight int, max_delta_step int, subsample double, colsample double, alpha double, valid_logloss double, rounds int, state string, seconds double"
    return spark.createDataFrame([(t.number, *(t.params[k] for k in ("coarse", "depth", "min_child_weight", "max_delta_step", "subsample", "colsample", "alpha")), t.loss, t.rounds, t.state, t.seconds) for t in trials], shown)


@query()
def xg_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plotted tables of a model: the density of xG by outcome."""
    return metrics.density(_scored(spark, sf_dir, "EV"), "is_goal", "xG")
