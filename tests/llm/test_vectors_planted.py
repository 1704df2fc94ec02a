"""Links of planted pairs at several sizes and dimensions, and vectors of odd kinds."""

import numpy as np
import pytest

from gamestate.llm import embeddings


def planted(rng, n, d, per):
    """n vectors in groups of per, near 0.9: some pairs above, some below."""
    base = rng.normal(size=(n // per, d))
    base /= np.linalg.norm(base, axis=1)[:, None]
    return np.vstack([base + rng.uniform(0.15, 0.45) * rng.normal(size=base.shape) / np.sqrt(d) for _ in range(per)]).astype(np.float32)


@pytest.mark.parametrize(("n", "d", "per"), [(3000, 64, 3), (3000, 256, 3), (2000, 16, 4)])
def test_recall_of_planted_pairs(spark, n, d, per):
    v = planted(np.random.default_rng(d), n, d, per)
    got = {r["vec_id"]: r for r in embeddings.near_vectors(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>"), 0.9).collect()}
    u = v.astype(np.float64)
    u /= np.linalg.norm(u, axis=1)[:, None]
    near = (u @ u.T >= 0.9) & ~np.eye(len(u), dtype=bool)
    links = np.array([got[i]["n_links"] for i in range(len(u))])
    assert near.sum() > 200 and (links <= near.sum(1)).all()
    recall = links.sum() / near.sum()
    print(f"recall {recall:.4f} of {near.sum() // 2} pairs, {len(u)} vectors of {d}")
    assert recall >= 0.97


def test_every_dimension_has_its_index(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(40)] + [(100, [1.0, 2.0]), (101, [2.0, 4.0]), (102, [3.0]), (103, [0.5]), (104, [-1.0]), (105, [1.0, 0.0, 0.0, 0.0])]
    got = {r["vec_id"]: r for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 0.9).collect()}
    assert got[100]["n_links"] == got[101]["n_links"] == 1 and got[101]["component_id"] == 100
    assert got[102]["n_links"] == got[103]["n_links"] == 1 and got[103]["component_id"] == 102
    assert got[104]["n_links"] == got[105]["n_links"] == 0 and len(got) == len(rows)


def test_doubles_beyond_floats(spark):
    rows = [(1, [1e300, 1e300], "a"), (2, [1e-300, 1e-300], "b"), (3, [1e300, -1e300], "c"), (4, [float("inf"), 1.0], "d"), (5, [-0.0, 1.0], None), (6, [0.0, 1.0], None)]
    got = {r["vec_id"]: r for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string"), 0.9).collect()}
    assert [got[i]["n_links"] for i in range(1, 7)] == [1, 1, 0, 0, 1, 1] and got[2]["component_id"] == 1 and got[6]["component_id"] == 5
    whole = spark.createDataFrame([(1, [1, 2]), (2, [2, 4])], "vec_id long, embedding array<int>")
    assert {r["n_links"] for r in embeddings.near_vectors(whole).collect()} == {1}
