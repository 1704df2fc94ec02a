"""Models of goal probability: folds, imputed shot types, boosted trees, rates with early stopping, search, scoring.

Two kinds of trees: those of `boosting` (nulls with a direction of their own, softmax, stop after patience) are what the
registered queries take; Spark ML's stay for users of its pipelines. Neither drops a row: Spark ML's vectors get a second
column for each input, which says where it is null.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestate.operators import boosting, metrics, tuning
from gamestate.operators.boosting import Booster, Params
from gamestate.session import together

KEYS = ["season", "game_id", "event_idx"]


def fold(current_season: int, seed: int = 66) -> Column:
    """'current', or 'test', 'valid' or 'train' by arithmetic on the keys: the same rows in any partitioning."""
    h = F.col("game_id") * 7919 + F.col("event_idx") * 104729
    return (
        F.when(F.col("season") == current_season, "current")
        .when((h + seed) % 100 >= 80, "test")
        .when((h + seed + 1) % 1009 % 100 >= 80, "valid")
        .otherwise("train")
    )


#: Shot types too rare to learn; they are imputed like missing ones.
RARE = ["Poked", "Batted", "Between Legs"]


def impute_types(df: DataFrame, columns: list[str], keep: Callable[[DataFrame], DataFrame], target: str = "secondary_type", params: Params | None = None) -> tuple[DataFrame, Booster | None]:
    """df with event_detail, the target where known and not RARE, else the likeliest class of softmax boosting; and the model.

    Equal probabilities give the first class by name. A fifth of the known rows, by a hash of the keys, stops the rounds. If
    no row has a known type, event_detail is null and there is no model.
    """
    known = F.when(~F.col(target).isin(RARE), F.col(target))
    df = df.withColumn("_y", known)
    if df.where("_y is not null").isEmpty():
        return df.withColumn("event_detail", F.lit(None).cast("string")).drop("_y"), None
    fifth = f"pmod(xxhash64({', '.join(KEYS)}), 5) = 0"
    binned = boosting.bin_rows(df, columns, "_y", KEYS, keep, train=f"not {fifth}", valid=fifth)
    (model,) = boosting.fit(binned, [params or Params(rounds=60, patience=5)])
    named = F.array(*[F.lit(c) for c in model.classes])
    out = boosting.predict(model, df, "_p").withColumn("event_detail", F.coalesce("_y", F.element_at(named, F.array_position("_p", F.array_max("_p")).cast("int"))))
    return out.drop("_p", "_y"), model


def boosted(df: DataFrame, columns: list[str], keep: Callable[[DataFrame], DataFrame], every: list[Params], **options: object) -> list[Booster]:
    """A model of is_goal for each of the parameters, trained on the fold train and stopped by the fold valid, in the same passes."""
    return boosting.fit(boosting.bin_rows(df, columns, "is_goal", KEYS, keep), every, **options)


def goals(model: Booster, df: DataFrame) -> DataFrame:
    """df with xG, the probability of a goal; every row gets one."""
    if 1 not in model.classes:
        return df.withColumn("xG", F.lit(0.0))
    return boosting.predict(model, df, "_p").withColumn("xG", F.col("_p")[model.classes.index(1)]).drop("_p")


def refit_boosted(df: DataFrame, columns: list[str], keep: Callable[[DataFrame], DataFrame], etas: list[float], params: Params | None = None) -> tuple[Booster, list[Booster], list[float]]:
    """A model for each rate, their AUC on the valid rows, and first one of the best rate refitted on train and valid rows.

    It takes as many rounds as were best for that rate. Its rows are binned while the rates are trained.
    """
    spark = df.sparkSession
    first = lambda: boosted(df, columns, keep, [replace(params or Params(), eta=e) for e in etas])
    second = lambda: boosting.bin_rows(df, columns, "is_goal", KEYS, keep, train="fold in ('train', 'valid')", valid="false")
    models, both = together(spark, lambda f: f(), [first, second])
    valid = df.where("fold = 'valid'")
    for i, m in enumerate(models):
        valid = goals(m, valid).withColumnRenamed("xG", f"_xG_{i}")
    valid = keep(valid.select("is_goal", *[f"_xG_{i}" for i in range(len(models))]))  # scored once, by all rates
    aucs = together(spark, lambda i: metrics.auc(valid, "is_goal", f"_xG_{i}").first()[0] or 0.0, range(len(models)))
    best = max(range(len(etas)), key=lambda i: (aucs[i], -etas[i]))
    (model,) = boosting.fit(both, [replace(models[best].params, rounds=max(models[best].best, 1))])
    return model, models, aucs


def tuned(df: DataFrame, columns: list[str], keep: Callable[[DataFrame], DataFrame], trials: int, together: int = 4, seconds: float | None = None, params: Params | None = None, seed: int = 71) -> tuple[Booster, list[tuning.Trial]]:
    """The best model of an adaptive search over seven parameters of the trees, and all trials."""
    base = params or Params()
    binned = boosting.bin_rows(df, columns, "is_goal", KEYS, keep)
    return tuning.search(lambda chosen, stop, left: boosting.fit(binned, [replace(base, **c) for c in chosen], stop, left), tuning.TREES, trials, together, seconds, seed)


_SOURCE = "_filled_"
_VOID = "_null_"


def _assembled(columns: list[str]) -> list[SQLTransformer | VectorAssembler]:
    """Stages that make features of the columns, nulls as 0, followed by a column for each that is 1 where it is null."""
    shown = ", ".join(f"coalesce(cast(`{c}` as double), 0d) as `{_SOURCE}{c}`, cast(`{c}` is null as double) as `{_VOID}{c}`" for c in columns)
    inputs = [f"{kind}{c}" for kind in (_SOURCE, _VOID) for c in columns]
    return [SQLTransformer(statement=f"select *, {shown} from __THIS__"), VectorAssembler(inputCols=inputs, outputCol="features")]


def goal_pipeline(columns: list[str], eta: float = 0.1, rounds: int = 20, depth: int = 4, seed: int = 66) -> Pipeline:
    """Boosted trees over the columns; rows with valid = true stop the boosting early."""
    trees = GBTClassifier(labelCol="is_goal", stepSize=eta, maxIter=rounds, maxDepth=depth, seed=seed, validationIndicatorCol="valid")
    return Pipeline(stages=[*_assembled(columns), trees])


def train(df: DataFrame, columns: list[str], **params: float) -> PipelineModel:
    """df has fold; train and valid rows are used."""
    both = df.where(F.col("fold").isin("train", "valid")).withColumn("valid", F.col("fold") == "valid")
    return goal_pipeline(columns, **params).fit(both)


def sweep(df: DataFrame, columns: list[str], etas: list[float], **params: float) -> DataFrame:
    """AUC on the valid rows for each learning rate; one row each."""
    rows = []
    for eta in etas:
        scores = score(train(df, columns, eta=eta, **params), df.where("fold = 'valid'"))
        auc = BinaryClassificationEvaluator(labelCol="is_goal", rawPredictionCol="xG").evaluate(scores)
        rows.append((eta, float(auc)))
    return df.sparkSession.createDataFrame(rows, "eta double, auc double")


def refit(df: DataFrame, columns: list[str], etas: list[float], **params: float) -> tuple[PipelineModel, DataFrame]:
    """The sweep's table, and a model of the best rate fitted on the train and valid rows alike, none of which stop it early."""
    rates = sweep(df, columns, etas, **params)
    best = rates.agg(F.max_by("eta", F.struct("auc", -F.col("eta")))).first()[0]  # one row for each rate
    rows = df.where(F.col("fold").isin("train", "valid"))
    kept = {"rounds": "maxIter", "depth": "maxDepth", "seed": "seed"}
    trees = GBTClassifier(labelCol="is_goal", stepSize=best, **{kept[k]: v for k, v in params.items()})
    return Pipeline(stages=[*_assembled(columns), trees]).fit(rows), rates


def search(df: DataFrame, columns: list[str], seed: int = 66, **values: list[float]) -> PipelineModel:
    """The best of a grid by AUC on a held-out fifth.

    values: candidates by parameter of the trees: maxDepth, maxIter, stepSize, subsamplingRate, minInstancesPerNode,
    minInfoGain, maxBins.
    """
    pipe = goal_pipeline(columns, seed=seed)
    trees = pipe.getStages()[-1]
    grid = ParamGridBuilder()
    for name, candidates in values.items():
        grid = grid.addGrid(trees.getParam(name), candidates)
    tune = TrainValidationSplit(estimator=pipe, estimatorParamMaps=grid.build(), evaluator=BinaryClassificationEvaluator(labelCol="is_goal"), trainRatio=0.8, seed=seed, parallelism=2)
    return tune.fit(df.where("fold <> 'current'").withColumn("valid", F.col("fold") == "valid")).bestModel


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """df with xG, the probability of a goal, between 0 and 1."""
    df = df if "valid" in df.columns else df.withColumn("valid", F.lit(False))
    out = model.transform(df).withColumn("xG", vector_to_array("probability")[1])
    made = [c for c in out.columns if c.startswith((_SOURCE, _VOID))]
    return out.drop("features", "rawPrediction", "probability", "prediction", "valid", *made)


def importance(spark: SparkSession, model: PipelineModel, columns: list[str], top: int | None = 10) -> DataFrame:
    """feature, gain (Spark's importance), weight (splits on it in all trees) and cover (mean training rows at these splits)."""
    trees = model.stages[-1]
    splits: dict[int, list[float]] = {}
    for k in range(trees.getNumTrees):  # nodes of the model, of a size set by rounds and depth
        nodes = [trees._call_java("trees")[k].rootNode()]
        while nodes:
            n = nodes.pop()
            if n.subtreeDepth() > 0:
                splits.setdefault(n.split().featureIndex() % len(columns), []).append(float(n.impurityStats().count()))
                nodes += [n.leftChild(), n.rightChild()]
    gain = trees.featureImportances.toArray().reshape(2, -1).sum(0)  # of a column and of its nulls
    rows = [(c, float(g), len(x := splits.get(i, [])), sum(x) / len(x) if x else 0.0) for i, (c, g) in enumerate(zip(columns, gain, strict=True))]
    out = spark.createDataFrame(rows, "feature string, gain double, weight long, cover double").orderBy(F.desc("gain"), "feature")
    return out if top is None else out.limit(top)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def final_join(events: DataFrame, features: DataFrame, predictions: DataFrame) -> DataFrame:
    """Events with features and xG. Splits overlap, so strength_type is part of the key of the second join."""
    return events.join(features, KEYS).join(predictions.select(*KEYS, "strength_type", "xG"), [*KEYS, "strength_type"])
