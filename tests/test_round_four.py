"""Findings of the fourth review: the time that models take."""

import threading

import numpy as np
from pyspark.sql import functions as F

from gamestate.operators import boosting, models
from gamestate.plans import modelling, seasons
from gamestate.plans.storage import kept


def test_columns_of_few_values_are_counted_together():
    """40 flags, one of them empty and one with nulls, and two wide columns: the same sums as column by column, in few counts."""
    rng = np.random.default_rng(4)
    columns = np.stack([*rng.integers(1, 3, (38, 5000)), np.ones(5000), rng.integers(0, 3, 5000), *rng.integers(0, 66, (2, 5000))]).astype(np.uint8)
    bins = [4] * 40 + [66] * 2
    starts = np.concatenate([[0], np.cumsum(bins)]).astype(int)
    weight = np.rint(rng.normal(size=5000) * boosting.SCALE)
    got = np.zeros(starts[-1])
    found = boosting._bundles(columns, starts, boosting.JOINT)
    for u in found:
        n = np.bincount(u.code, weight, u.size)
        got[u.cells] += n if u.share is None else n @ u.share
    assert len(found) <= 8 and max(u.size for u in found) <= boosting.JOINT
    assert (got == np.concatenate([np.bincount(c, weight, n) for c, n in zip(columns, bins, strict=True)])).all()
    assert all(u.share is None or u.size > 1 for u in boosting._bundles(columns, starts, 1))


def test_nodes_of_rows_by_whole_columns():
    """Trees with nodes that end early, nulls to either side: as a walk of each row from the root."""
    rng = np.random.default_rng(5)
    codes = np.asfortranarray(rng.integers(0, 6, (300, 4)).astype(np.uint8))
    for depth in (1, 3, 9):
        t = boosting.Tree.of_depth(depth)
        inner = 2**depth - 1
        t.feature[:inner] = np.where(rng.random(inner) < 0.25, -1, rng.integers(0, 4, inner))
        t.feature[0] = 0
        t.bin[:], t.null_left[:] = rng.integers(1, 5, len(t.bin)), rng.random(len(t.bin)) < 0.5

        def walk(row, steps, t=t):
            at = 0
            for _ in range(steps):
                if t.feature[at] >= 0:
                    c = row[t.feature[at]]
                    at = 2 * at + (1 if (t.null_left[at] if c == 0 else c <= t.bin[at]) else 2)
            return at

        for steps in range(depth + 1):
            assert t.nodes(codes, steps).tolist() == [walk(r, steps) for r in codes.tolist()]
        assert t.nodes(codes).tolist() == t.nodes(codes, depth).tolist()


def test_splits_are_trained_at_once(spark, tiny, monkeypatch):
    """Each split's training waits until the other one's has begun."""
    met, boosted = threading.Barrier(2, timeout=120), models.boosted
    monkeypatch.setattr(seasons, "SPLITS", ("EV", "EN"))
    monkeypatch.setattr(models, "impute_types", lambda df, columns, keep: (df.withColumn("event_detail", F.col("secondary_type")), None))
    monkeypatch.setattr(models, "boosted", lambda df, columns, keep, every: met.wait() >= 0 and boosted(df, columns, keep, [boosting.Params(rounds=1, depth=1)]))
    frames, fitted = modelling._all_splits(spark, tiny)
    assert list(frames) == list(fitted) == ["EV", "EN"] and frames["EN"].first()["strength_type"] == "EN"


def test_rows_of_the_refit_are_binned_while_rates_are_trained(spark, monkeypatch):
    binned, bin_rows, fit, ended = threading.Event(), boosting.bin_rows, boosting.fit, []

    def rows(*args, **options):
        out = bin_rows(*args, **options)
        if options.get("valid") == "false":
            binned.set()
        return out

    def fitted(b, every, **options):
        if len(every) > 1:
            ended.append(binned.wait(120))
        return fit(b, every, **options)

    monkeypatch.setattr(boosting, "bin_rows", rows)
    monkeypatch.setattr(boosting, "fit", fitted)
    df = spark.range(600).select(F.lit(20232024).alias("season"), F.lit(1).alias("game_id"), F.col("id").alias("event_idx"), (F.col("id") % 7).alias("x"))
    df = df.withColumns({"is_goal": (F.col("x") > 4).cast("int"), "fold": models.fold(20242025)})
    model, every, aucs = models.refit_boosted(df, ["x"], kept, [0.1, 0.3], boosting.Params(rounds=2, depth=2))
    assert ended == [True] and len(every) == len(aucs) == 2 and len(model.trees) >= 1
