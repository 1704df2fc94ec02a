"""Findings of the third review: ties, work that follows the input in every task, and what goes to the driver."""

from dataclasses import replace

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gamestate.operators import boosting, models
from gamestate.plans import domain, evaluation, modelling, registry
from gamestate.plans.registry import SQL
from gamestate.plans.storage import kept


def test_best_event_of_equal_values_is_the_first(spark, tmp_path):
    """One row group, so DuckDB reads it in order and its arg_max keeps the first of equal values."""
    rows = [(i + 1000 * k, i % 5, float(i % 3)) for k in range(4) for i in range(60)]
    rows += [(None, 7, 9.0), (1, 7, 2.0), (2, 7, 2.0), (3, 8, None), (4, 9, float("nan")), (5, 9, 1.0)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, value double")
    df.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    db = duckdb.connect(config={"threads": 1})
    db.sql(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    want = sorted(map(str, db.sql(SQL["argmax_by"]).fetchall()))
    assert sorted(str(tuple(r)) for r in evaluation.argmax_by(spark, str(tmp_path)).collect()) == want
    df.orderBy(F.desc("event_id")).repartition(7).write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    assert sorted(str(tuple(r)) for r in evaluation.argmax_by(spark, str(tmp_path)).collect()) == want


def tasks_of(spark, run):
    """What `run` returns, and the number of tasks of each stage that it ran."""
    tracker, group = spark.sparkContext.statusTracker(), "round_three"
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return out, [s.numTasks for s in stages if s is not None]


def test_tasks_follow_the_events(spark, tmp_path, monkeypatch):
    """With a share of 50 events for a task, 400 and 1,600 events are dealt to 8 and 32 tasks, which no merging undoes."""
    monkeypatch.setattr(registry.parts, "__defaults__", (50,))
    monkeypatch.setattr(domain, "SHARE", 50)
    spark.read.parquet("/root/testdata/sf0.001/customer.parquet").write.parquet(f"{tmp_path}/customer.parquet")
    for n in (400, 1600):
        ev = spark.range(n).select(F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), (F.col("id") % 97).alias("user_id"), F.element_at(F.array(*map(F.lit, ("purchase", "click", "view", "error"))), (F.col("id") % 4 + 1).cast("int")).alias("event_type"), F.lit(1.0).alias("value"), F.format_string('{"k": %d}', F.col("id") * 13 % 100).alias("props"))
        ev.write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
        for query in ("split_ev", "onice_slots", "onice_slots_in_place"):
            _, seen = tasks_of(spark, lambda: registry.QUERIES[query](spark, str(tmp_path)).count())  # noqa: B023
            assert n // 50 in seen, (query, n, seen)


def test_driver_gets_a_split_for_a_node_and_no_sums(spark, monkeypatch):
    """Ten columns of many values make thousands of sums; what a pass brings to the driver has a row for each node and the losses."""
    df = spark.range(4000).select(F.lit(20232024).alias("season"), F.lit(1).alias("game_id"), F.col("id").alias("event_idx"), *[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)).cast("double").alias(f"c{i}") for i in range(10)])
    df = df.withColumns({"is_goal": (F.col("c0") > 500).cast("int"), "fold": models.fold(20242025)})
    cls, brought = type(df), []
    plain = cls.toArrow

    def seen(self):
        brought.append(plain(self))
        return brought[-1]

    monkeypatch.setattr(cls, "toArrow", seen)
    models.boosted(df, [f"c{i}" for i in range(10)], kept, [boosting.Params(rounds=2, depth=3)])
    assert brought and max(t.num_rows for t in brought) <= 4 + 1 and max(t.nbytes for t in brought) < 2_000


def test_edges_of_bins_are_exact_however_rows_are_dealt(spark):
    """So many rows that an approximate percentile leaves values out; one column has few values, one nulls and NaN, one nothing."""
    value = F.pmod(F.xxhash64("id"), F.lit(1 << 40)).cast("double")
    df = spark.range(150_000).select(value.alias("many"), F.pmod("id", F.lit(3)).alias("few"), F.when(F.col("id") % 7 == 0, float("nan")).when(F.col("id") % 5 != 0, -value).alias("some"), F.lit(None).cast("int").alias("none"))
    df = df.withColumns({"y": F.lit(1), "fold": F.lit("train")})
    rows = df.toPandas()
    want = []
    for c in ("many", "few", "some", "none"):
        x = np.sort(rows[c].dropna().to_numpy(np.float64))
        want.append(sorted({float(x[-(-i * len(x) // boosting.BINS) - 1]) for i in range(1, boosting.BINS)}) if len(x) else [])
    for dealt in (df.coalesce(1), df.repartition(3), df.repartition(13)):
        assert boosting.bin_rows(dealt, ["many", "few", "some", "none"], "y", ["many"], kept).edges == want


def test_model_frames_are_dealt_by_the_events(spark, tmp_path, monkeypatch):
    """With a share of 50 events for a task, 400 and 1,600 events make frames in 8 and 32 tasks."""
    monkeypatch.setattr(registry.parts, "__defaults__", (50,))
    monkeypatch.setattr(models, "impute_types", lambda df, columns, keep: (df.withColumn("event_detail", F.col("secondary_type")), None))
    spark.read.parquet("/root/testdata/sf0.001/customer.parquet").write.parquet(f"{tmp_path}/customer.parquet")
    for n in (400, 1600):
        ev = spark.range(n).select(F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), (F.col("id") % 97).alias("user_id"), F.element_at(F.array(*map(F.lit, ("purchase", "click", "view", "error"))), (F.col("id") % 4 + 1).cast("int")).alias("event_type"), F.lit(1.0).alias("value"), F.format_string('{"k": %d}', F.col("id") * 13 % 100).alias("props"))
        ev.write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
        for name in ("EV",) if n == 400 else ("EV", "PP", "SH"):
            _, seen = tasks_of(spark, lambda: modelling.prepared(spark, str(tmp_path), name))  # noqa: B023
            assert n // 50 in seen, (name, n, seen)


@pytest.mark.parametrize("query", ["impute_shot_type", "xg_train_score", "xg_train_score_pp", "xg_train_score_sh", "eta_curve", "importance_topk"])
def test_model_queries_make_their_frame_in_tasks_of_a_share(spark, tmp_path, monkeypatch, query):
    """With a share of 200 events for a task, a whole query over 2,400 events has 12 tasks for its frame, none with more rows than its games have."""
    fit, frames = boosting.fit, []
    monkeypatch.setattr(registry.parts, "__defaults__", (200,))
    monkeypatch.setattr(boosting, "fit", lambda binned, every, *a, **k: fit(binned, [replace(p, rounds=1) for p in every], *a, **k))
    monkeypatch.setattr(modelling, "kept", lambda df: frames.append(kept(df)) or frames[-1])
    spark.read.parquet("/root/testdata/sf0.001/customer.parquet").write.parquet(f"{tmp_path}/customer.parquet")
    kinds = F.element_at(F.array(*map(F.lit, ("purchase", "click", "view", "error"))), (F.col("id") % 4 + 1).cast("int"))
    ev = spark.range(2400).select(F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("ts"), (F.col("id") % 97).alias("user_id"), kinds.alias("event_type"), F.lit(1.0).alias("value"), F.format_string('{"k": %d}', F.pmod(F.xxhash64("id"), F.lit(100))).alias("props"))
    ev.write.parquet(f"{tmp_path}/events.parquet")
    _, seen = tasks_of(spark, lambda: registry.QUERIES[query](spark, str(tmp_path)).count())
    assert 12 in seen, seen
    written = frames[0].groupBy(F.input_file_name()).agg(F.count("*").alias("rows"), F.countDistinct("game_id").alias("games")).collect()
    assert len(written) > 6 and max(r["rows"] for r in written) <= max(r["games"] for r in written) * 25 and max(r["games"] for r in written) < 97 // 3


@pytest.mark.parametrize("query", ["onice_decision_table", "onice_slots", "onice_interval_lists"])
def test_shifts_are_not_broadcast(spark, tiny, query):
    """They explode from the games, so a plan takes them for as small as these and would put them all on the driver."""
    plan = registry.QUERIES[query](spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
