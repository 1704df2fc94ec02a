"""Running sums over ranges, snapshots, variants, tables by game, the source of lines, state that forgets, densities."""

import json
import os
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from gamestate.operators import metrics, onice
from gamestate.operators.running import running
from gamestate.plans import synthetic
from gamestate.plans.storage import clean, folder, kept
from gamestate.sources import landed, layout, snapshots, variants
from gamestate.sources.lines import register
from gamestate.streaming import incremental


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_running_sums_over_many_ranges(spark):
    n = 5000
    df = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(10**6)).alias("a"), "id", F.when(F.col("id") % 7 != 0, F.col("id") % 5).alias("v")).repartition(3)
    got = running(df, ["a", "id"], kept, {"s": F.col("v"), "n": F.lit(1).cast("long")}, {"last": "v"}, parts=13)
    rows = sorted(got.collect(), key=lambda r: (r["a"], r["id"]))
    total, last = 0, None
    for i, r in enumerate(rows):
        total += r["v"] or 0
        assert (r["s"], r["n"], r["last"]) == (total, i + 1, last)
        last = r["v"]
    assert running(df.limit(0), ["a"], kept, {"s": F.col("v")}, {"last": "v"}).count() == 0
    skewed = running(df.withColumn("a", F.lit(1)), ["a", "id"], kept, {"n": F.lit(1).cast("long")}, parts=5)
    assert sorted(r["n"] for r in skewed.collect()) == list(range(1, n + 1))


def test_running_sums_use_no_window_over_all_rows(spark):
    got = running(spark.range(100), ["id"], kept, {"s": F.col("id")}, parts=4)
    spread = [line for line in plan_of(got).split("\n") if "Window" in line and "_range" not in line]
    assert not spread


@pytest.fixture
def at(tmp_path):
    return str(tmp_path / "t")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_snapshots_keep_old_versions(spark, at):
    for _ in range(3):
        snapshots.update(spark, at, lambda old: spark.range(2) if old is None else old.select(F.col("id") + 1).toDF("id"))
    assert snapshots.versions(spark, at) == [1, 2, 3]
    assert [ids(snapshots.read(spark, at, v)) for v in (1, 2, 3)] == [[0, 1], [1, 2], [2, 3]]
    snapshots.update(spark, at, lambda old: spark.range(9, 10).withColumn("more", F.lit("x")), append=True)
    assert ids(snapshots.read(spark, at)) == [2, 3, 9] and snapshots.read(spark, at).where("more is null").count() == 2
    snapshots.vacuum(spark, at, keep=1)
    assert snapshots.versions(spark, at) == [4] and ids(snapshots.read(spark, at)) == [2, 3, 9]
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, at, 1)


def test_a_writer_that_dies_leaves_the_old_table(spark, at, monkeypatch):
    snapshots.update(spark, at, lambda old: spark.range(3))

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(snapshots, "_put", dies)
        with pytest.raises(KeyboardInterrupt):
            snapshots.update(spark, at, lambda old: spark.range(7))
    assert ids(snapshots.read(spark, at)) == [0, 1, 2]
    assert snapshots.update(spark, at, lambda old: spark.range(7)) == 2
    snapshots.vacuum(spark, at, keep=1)
    assert len(os.listdir(f"{at}/data")) == 1


def test_of_two_writers_the_second_tries_again(spark, at):
    snapshots.update(spark, at, lambda old: spark.range(1))
    seen = []

    def slow(old):
        seen.append(ids(old))
        if len(seen) == 1:  # while this one works, another commits
            snapshots.update(spark, at, lambda o: o.union(spark.range(5, 6)))
        return old.union(spark.range(8, 9))

    assert snapshots.update(spark, at, slow) == 3
    assert seen == [[0], [0, 5]] and ids(snapshots.read(spark, at)) == [0, 5, 8]
    with pytest.raises(snapshots.Taken):
        snapshots.commit(spark.range(1), at, 2, append=False)


def test_writers_at_once_lose_nothing(spark, at):
    def add(k):
        snapshots.update(spark, at, lambda old: spark.range(k, k + 1), append=True, tries=20)

    threads = [threading.Thread(target=add, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert ids(snapshots.read(spark, at)) == [0, 1, 2, 3] and snapshots.versions(spark, at) == [1, 2, 3, 4]


def test_variants_keep_keys_nobody_declared(spark, tmp_path):
    docs = [{"id": 1, "a": {"x": 1, "new": "s"}, "items": [{"n": 1, "odd": 2.5}, {"n": 2}, 7]}, {"id": 2, "a": None, "items": {"no": "array"}, "extra": [1]}, {"id": 3, "a": "text", "extra": None}]
    (tmp_path / "d.json").write_text("\n".join([*map(json.dumps, docs), "{broken", "", "[1, 2]"]))
    found = variants.documents(spark, str(tmp_path / "d.json"))
    assert found.count() == 5 and found.where("doc is null").count() == 1
    declared = spark.createDataFrame([], "id long, a struct<x:int>, items array<struct<n:int>>").schema
    got = {r["path"]: (r["kind"], r["documents"]) for r in variants.undeclared(found, declared).collect()}
    assert got == {"a.new": ("STRING", 1), "items[].odd": ("DECIMAL(2,1)", 1), "extra": ("ARRAY<BIGINT>", 2)}
    assert found.select(variants.get("a.new", "string").alias("v")).where("v is not null").first()["v"] == "s"
    assert "extra: ARRAY<BIGINT>" in variants.schema(found.where(F.schema_of_variant("doc").startswith("OBJECT")))


def test_on_ice_over_tables_by_game_moves_no_row(spark, tiny):
    names = ["pbp_by_game", "shifts_by_game"]
    with layout.in_place(spark):
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            events = layout.by_game(synthetic.pbp(spark, tiny), names[0], 3, ["event_idx"])
            shifts = layout.by_game(synthetic.shifts(spark, tiny), names[1], 3, ["period", "start_s"])
            assert "Exchange" not in plan_of(onice.on_ice(events, shifts))
            assert "Exchange" in plan_of(onice.on_ice(synthetic.pbp(spark, tiny), synthetic.shifts(spark, tiny)))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
            for n in names:
                spark.sql(f"drop table {n}")


def play(game, k):
    return {"id": game, "season": 20232024, "gameDate": "2024-01-01", "gameType": 2, "awayTeam": {"id": 1, "abbrev": "A"}, "homeTeam": {"id": 2, "abbrev": "H"}, "plays": [{"eventId": k, "sortOrder": k, "typeDescKey": "goal", "periodDescriptor": {"number": 1}, "details": {"xCoord": 3.0}}]}


def test_source_of_lines_in_batches_and_as_a_stream(spark, tmp_path):
    register(spark)
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(3):
        (folder / f"{k}.json").write_text("\n".join(json.dumps(play(k, j)) for j in range(3)) + ("\n" if k else "\n{broken"))
        os.utime(folder / f"{k}.json", (1000 + k, 1000 + k))
    (folder / "_ignored").write_text("x")
    lines = spark.read.format("landed").load(str(folder))
    assert lines.count() == 10 and {r["line"] for r in lines.collect()} == {0, 1, 2, 3}
    want = sorted(map(str, landed.pbp(spark, str(folder)).collect()))
    rows = lambda df: landed.plays(landed.parsed(df, landed.PBP_JSON))
    assert sorted(map(str, rows(lines).collect())) == want

    def run():
        q = rows(spark.readStream.format("landed").load(str(folder))).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    assert sorted(map(str, run().collect())) == want
    (folder / "9.json").write_text(json.dumps(play(9, 1)))
    assert run().where("id = 9").count() == 1 and run().count() == len(want) + 1


def test_state_forgets_keys_and_drops_repeats(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    seen = []

    def batch(*rows):
        (folder / f"{len(seen)}.json").write_text("\n".join(json.dumps({"k": k, "t": t, "v": v}) for k, t, v in rows))
        docs = incremental.once(incremental.stream(spark, str(folder), "k string, t timestamp, v int"), ["k"], "t", "10 minutes")
        q = docs.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).option("path", out).trigger(availableNow=True).start()
        q.awaitTermination()
        seen.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
        return sorted((r["k"], r["v"]) for r in spark.read.schema("k string, t timestamp, v int").parquet(out).collect())

    assert batch(("a", "2024-01-01T00:00:00", 1), ("b", "2024-01-01T00:01:00", 1), ("a", "2024-01-01T00:02:00", 2)) == [("a", 1), ("b", 1)]
    assert batch(("b", "2024-01-01T00:05:00", 3), ("c", "2024-01-01T00:06:00", 1)) == [("a", 1), ("b", 1), ("c", 1)]
    for k in range(6):  # time passes; the state doesn't grow with all keys
        batch((f"n{k}", f"2024-01-01T0{k + 1}:00:00", 1))
    assert max(seen) <= 4 and seen[-1] <= 2
    got = batch(("a", "2024-01-01T00:03:00", 9), ("b", "2024-01-01T06:00:00", 9))
    assert ("a", 9) not in got and ("b", 9) in got  # too late; and after the delay, new again


def test_kernel_density(spark):
    rng = np.random.default_rng(3)
    x = np.clip(rng.beta(2, 5, 4000), 0, 1).round(4)
    df = spark.createDataFrame([(0, float(v)) for v in x] + [(1, 0.25)] * 3 + [(2, 0.5), (2, None)], "label int, score double")
    got = {(r["label"], round(r["at"], 2)): r["density"] for r in metrics.kde(df).collect()}
    h = x.std(ddof=1) * len(x) ** -0.2
    for g in (0.0, 0.2, 0.5, 0.9):
        exact = np.exp(-0.5 * ((g - x) / h) ** 2).sum() / (len(x) * h * np.sqrt(2 * np.pi))
        assert got[0, g] == pytest.approx(exact, abs=2e-3)
    assert sum(got[0, round(i / 100, 2)] for i in range(101)) / 100 == pytest.approx(1, abs=0.03)
    assert got[1, 0.25] > 100 and got[2, 0.5] > 100


def test_what_queries_write_can_be_removed(spark):
    kept(spark.range(3))
    top = os.path.dirname(folder(spark).removeprefix("file:"))
    assert os.listdir(top)
    clean(spark)
    assert not os.path.exists(top)
