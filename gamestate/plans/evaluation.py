"""Evaluation queries: reports, ROC, AUC, losses, over a deterministic score of the synthetic shots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestate.operators import features, metrics
from gamestate.plans import twins
from gamestate.plans.domain import shots
from gamestate.plans.registry import query, rounded, sql_rounded, table

_SCORED = "sc AS (SELECT season, game_id, event_idx, CASE WHEN event_type = 'GOAL' THEN 1 ELSE 0 END AS label, CAST(1 + (game_id * 7919 + event_idx * 104729) % 997 AS DOUBLE) / 1000 AS score FROM sh)"
_BY = """by0 AS (SELECT score, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(1 - label) AS DOUBLE) AS neg FROM sc GROUP BY score),
tot AS (SELECT CAST(sum(label) AS DOUBLE) AS p, CAST(sum(1 - label) AS DOUBLE) AS n FROM sc),
cu AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM by0)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = (1 + (F.col("game_id") * 7919 + F.col("event_idx") * 104729) % 997).cast("double") / 1000
    return shots(spark, sf_dir).select("season", "game_id", "event_idx", F.when(F.col("event_type") == "GOAL", 1).otherwise(0).alias("label"), s.alias("score"))


def _with(*ctes: str) -> str:
    return twins.upto("sh", _SCORED, *ctes)


@query(_with(_BY) + f"SELECT {sql_rounded('sum(pos * (n - fp + neg / 2)) / max(p * n)', 'auc')} FROM cu, tot")
def auc_ranksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.auc(scored(spark, sf_dir)).select(rounded("auc"))


@query(
    _with()
    + f"""SELECT label, bin, {sql_rounded('bin / 50.0', 'from')}, {sql_rounded('n * 50.0 / sum(n) OVER (PARTITION BY label)', 'density')}
    FROM (SELECT label, CAST(least(floor(score * 50), 49) AS INTEGER) AS bin, count(*) AS n FROM sc GROUP BY ALL)"""
)
def score_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.density(scored(spark, sf_dir)).select("label", "bin", rounded("from"), rounded("density"))


@query(
    _with()
    + f"""SELECT label, round(i / 100.0, 2) AS "at", {sql_rounded('sum(n * exp(-0.5 * power((i / 100.0 - bin / 1000.0) / h, 2)) / (total * h * sqrt(2 * pi())))', 'density')}
    FROM (SELECT label, CAST(round(score * 1000) AS INTEGER) AS bin, CAST(count(*) AS DOUBLE) AS n FROM sc GROUP BY ALL) JOIN (SELECT label, count(*) AS total, stddev_samp(score) * power(count(*), -0.2) AS h FROM sc GROUP BY label) USING (label), range(0, 101) AS g(i) GROUP BY label, i"""
)
def kernel_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.kde(scored(spark, sf_dir)).select("label", F.round("at", 2).alias("at"), rounded("density"))


@query(_with() + f"SELECT {sql_rounded('-avg(label * ln(score) + (1 - label) * ln(1 - score))', 'logloss')} FROM sc")
def logloss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.logloss(scored(spark, sf_dir)).select(rounded("logloss"))


@query(_with() + f"SELECT {sql_rounded('1 - sum((label - score) * (label - score)) / (var_pop(label) * count(*))', 'r2')} FROM sc")
def r2_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.r2(scored(spark, sf_dir)).select(rounded("r2"))


@query(_with(_BY) + f"SELECT score AS threshold, {sql_rounded('tp / p', 'tpr')}, {sql_rounded('fp / n', 'fpr')} FROM cu, tot")
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.roc(scored(spark, sf_dir)).select("threshold", rounded("tpr"), rounded("fpr"))


@query(_with(_BY) + f"SELECT score AS threshold, {sql_rounded('tp / p - fp / n', 'j')} FROM cu, tot ORDER BY round(tp / p - fp / n, 12) DESC, score DESC LIMIT 1")
def roc_youden(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.youden(scored(spark, sf_dir)).select("threshold", rounded("j"))


@query(
    _with("co1_ AS (SELECT CAST(count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS BIGINT) AS tp, CAST(count(*) FILTER (WHERE score >= 0.5 AND label = 0) AS BIGINT) AS fp, CAST(count(*) FILTER (WHERE score < 0.5 AND label = 1) AS BIGINT) AS fn, CAST(count(*) FILTER (WHERE score < 0.5 AND label = 0) AS BIGINT) AS tn FROM sc)")
    + f"SELECT tp, fp, fn, tn, {sql_rounded('tp / CAST(tp + fp AS DOUBLE)', 'precision')}, {sql_rounded('tp / CAST(tp + fn AS DOUBLE)', 'recall')}, {sql_rounded('2 * tp / CAST(2 * tp + fp + fn AS DOUBLE)', 'f1')}, {sql_rounded('(tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE)', 'accuracy')} FROM co1_"
)
def confusion_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(scored(spark, sf_dir), 0.5).select("tp", "fp", "fn", "tn", *map(rounded, ("precision", "recall", "f1", "accuracy")))


@query(_with() + "SELECT season, game_id, event_idx, CAST(least(greatest(score * 2 - 0.5, 0), 1) AS DOUBLE) AS clipped FROM sc")
def clip_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamestate.functions.core import clip

    return scored(spark, sf_dir).select("season", "game_id", "event_idx", clip(F.col("score") * 2 - 0.5, 0.0, 1.0).alias("clipped"))


@query(
    "WITH c AS (SELECT event_type, CAST(count(*) AS BIGINT) AS count FROM events GROUP BY event_type) SELECT event_type, count, round(count * 100.0 / (SELECT sum(count) FROM c), 2) AS percent, format('{:,}', count) || ' (' || printf('%.2f', CAST(round(count * 100.0 / (SELECT sum(count) FROM c), 2) AS DOUBLE)) || '%)' AS label FROM c"
)
def value_counts_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.shares(table(spark, sf_dir, "events"), "event_type")


@query(
    twins.upto("sh")
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM sh HAVING count(*) FILTER (WHERE {c} IS NULL) > 0" for c in ("secondary_type", "event_team_toi", "home_score", "event_strength_last"))
)
def null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.null_report(shots(spark, sf_dir).select("secondary_type", "event_team_toi", "home_score", "event_strength_last"))


@query(
    twins.upto("sh")
    + " UNION ALL ".join(f'SELECT \'{c}\' AS column_name FROM sh WHERE "in_EV" = 1 HAVING stddev_samp("{c}") = 0' for c in ("is_pen", "is_two_ma", "x_abs", "is_home", "in_EV"))
)
def constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.constant_columns(shots(spark, sf_dir).where("in_EV = 1"), ["is_pen", "is_two_ma", "x_abs", "is_home", "in_EV"])


@query(twins.upto("sh") + "SELECT season, game_id, event_idx, secondary_type FROM sh WHERE secondary_type IS NOT NULL AND event_strength_last IS NOT NULL")
def dropna_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = shots(spark, sf_dir).select("season", "game_id", "event_idx", "secondary_type", "event_strength_last")
    return df.na.drop("any").drop("event_strength_last")


@query("SELECT user_id, max(value) AS best_value, arg_max(event_id, value) AS best_event FROM events GROUP BY user_id")
def argmax_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event of a user's largest value; of equal ones the first by id, in any partitioning. Events without an id are no answer."""
    at = F.when(F.col("event_id").isNotNull(), F.col("value"))
    by = F.when(at.isNotNull(), F.struct(at, -F.col("event_id")))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("value").alias("best_value"), F.max_by("event_id", by).alias("best_event"))


@query(
    _with()
    + "SELECT season, game_id, event_idx, CASE WHEN season = 20242025 THEN 'current' WHEN (game_id * 7919 + event_idx * 104729 + 66) % 100 >= 80 THEN 'test' WHEN (game_id * 7919 + event_idx * 104729 + 67) % 1009 % 100 >= 80 THEN 'valid' ELSE 'train' END AS fold FROM sc"
)
def train_valid_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamestate.operators.models import fold

    return scored(spark, sf_dir).select("season", "game_id", "event_idx", fold(20242025).alias("fold"))


@query(
    twins.upto("sh", _SCORED)
    + 'SELECT e.season, e.game_id, e.event_idx, e.event_type, s.strength_state, c.score AS xg FROM st e JOIN (SELECT season, game_id, event_idx, strength_state FROM sh WHERE "in_EV" = 1) s ON e.season = s.season AND e.game_id = s.game_id AND e.event_idx = s.event_idx JOIN sc c ON e.season = c.season AND e.game_id = c.game_id AND e.event_idx = c.event_idx'
)
def score_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gamestate.plans.domain import state

    keys = ["season", "game_id", "event_idx"]
    ev = features.split(shots(spark, sf_dir), "EV").select(*keys, "strength_state")
    return state(spark, sf_dir).select(*keys, "event_type").join(ev, keys).join(scored(spark, sf_dir).select(*keys, F.col("score").alias("xg")), keys)
