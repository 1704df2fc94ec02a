"""Fingerprints where null ids or one id hold a third of all rows, and pivots of vectors in a cone."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gamestate.llm import embeddings, fingerprints


@pytest.mark.parametrize("hot", [None, 0, 777, 10**12])
def test_a_hot_id_is_cut_by_its_texts(spark, hot):
    rows = [(hot if k % 3 == 0 else k, f"text number {k} with a few words {k * k}") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    cuts, heavy = fingerprints._cut_points(docs, 12)
    placed = docs.withColumn("b", fingerprints._place(F.col("doc_id"), fingerprints._text_hash(), cuts, heavy))
    assert max(r["count"] for r in placed.groupBy("b").count().collect()) < 200
    # the order that ranges keep is the order of the rows
    order = placed.select("doc_id", fingerprints._text_hash().alias("h"), "text", "b").collect()
    order = sorted(order, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["h"]))
    assert [r["b"] for r in order] == sorted(r["b"] for r in order)
    got = {(r["doc_id"], r["edited_sha256"]) for r in fingerprints.edited_fingerprints(docs, buckets=12).collect()}
    texts = [r["text"] for r in order]
    want = set()
    for r, following in zip(order, [*texts[1:], texts[0]], strict=True):
        t = r["text"]
        half = len(t) // 2
        want.add((r["doc_id"], hashlib.sha256((t[: len(t) - half] + following[:half]).encode()).hexdigest()))
    assert got == want


def test_repeated_rows_are_one_guest(spark):
    docs = spark.createDataFrame([(5, "same text again")] * 300 + [(k, f"other {k} words") for k in range(600)], "doc_id long, text string")
    assert fingerprints.edited_fingerprints(docs, buckets=9).count() == 900


def cone(n, d, spread, seed=5):
    rng = np.random.default_rng(seed)
    axis = np.ones(d) / np.sqrt(d)
    x = axis + spread * rng.normal(size=(n, d)) / np.sqrt(d)
    x[: n // 4] = x[n // 4 : 2 * (n // 4)] + 0.1 * spread * rng.normal(size=(n // 4, d)) / np.sqrt(d)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("spread", [0.25, 0.4])
def test_vectors_in_a_cone_get_their_pivots(spread):
    assert len(embeddings.choose_pivots(cone(2000, 32, spread), 256)) > 200


def test_recall_in_a_cone(spark):
    x = cone(1500, 32, 0.7)
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_vectors(df, 0.9).collect()}
    want = ((x @ x.T >= 0.9).sum(1) - 1).tolist()
    assert all(got[i] <= want[i] for i in range(len(x)))
    assert sum(got.values()) >= 0.9 * sum(want) > 0
