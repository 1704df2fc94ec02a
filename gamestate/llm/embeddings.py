"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by the ordered list of its NEAREST reference points (pivots). Pivot lists are inverted:
the list of a pivot holds the vectors that name it. Two vectors are candidates when they share at least SHARED pivots;
every candidate pair is verified by its cosine in double precision. Lists are compared in blocks of bounded size, a
pair only under the smallest pivot it shares, and a block pair gives sums and a spanning forest, never its pairs.

The pivots come from a bounded sample (SAMPLE_PER_PIVOT times their number, those with the smallest id hashes), of
which mutually close ones, by the sample's own cosines, are passed over; their number follows the square root of the number of vectors, up to
MAX_PIVOTS. Every vector is indexed, each dimension among pivots of its own, so vectors of different dimensions never meet.
Components are kept as floats or doubles, as they come; lengths are taken out by the largest component first, so tiny and
huge ones count.

Defined results: equal vectors form one class and link with each other; vectors that are null, empty, zero or hold null
or non-finite components link with nothing; rows that repeat a vec_id are one vector
(the least of its embeddings); a row with a null vec_id has no links, a null component and is kept. Columns besides
vec_id and embedding are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamestate.llm.common import components, in_blocks, materialize

NEAREST = 8
SHARED = 2
SAMPLE_PER_PIVOT = 4
MAX_PIVOTS = 4096
APART = 0.8
BLOCK = 1024


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """The first n vectors of the sample that are not close to one chosen before.

    How close that is follows from the sample: vectors that all lie in a cone are told apart by what they differ in.
    """
    some = sample[:512]
    usual = float(np.median((some @ some.T)[np.triu_indices(len(some), 1)])) if len(some) > 1 else 0.0
    apart = 1 - (1 - max(usual, 0.0)) * (1 - APART)
    chosen = np.empty((0, sample.shape[1]))
    for x in sample:
        if not len(chosen) or (chosen @ x).max() < apart:
            chosen = np.vstack([chosen, x])
        if len(chosen) == n:
            break
    return chosen


def _orders(vectors: DataFrame, pivots: dict[int, tuple[int, np.ndarray]], kind: str) -> DataFrame:
    """vectors and the ordered numbers of their nearest pivots. pivots: by dimension, the first number and the vectors."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for d, own in part.groupby(part["embedding"].str.len()):
                base, p = pivots[d]
                near = _unit(np.vstack(own["embedding"].to_numpy()).astype(np.float64)) @ p.T
                order = np.argsort(-near, 1, kind="stable")[:, : min(NEAREST, len(p))]
                yield own.assign(pivots=list((order + base).astype(np.int32)))

    return vectors.mapInPandas(run, f"rep long, n long, embedding {kind}, pivots array<int>")


def pivots_of(classes: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """Pivots of every dimension, from a sample of at most some SAMPLE_PER_PIVOT times as many vectors."""
    d = F.size("embedding").alias("d")
    counts = {r["d"]: r["count"] for r in classes.groupBy(d).count().collect()}  # one row for each dimension
    want = {k: min(MAX_PIVOTS, max(16, 2 ** round(math.log2(2 * math.sqrt(n) + 1)))) for k, n in counts.items()}
    out, base, wide = {}, 0, 1 << 53
    if not counts:
        return out
    shares = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(min(1.0, SAMPLE_PER_PIVOT * want[k] / n) * wide))])
    order = F.xxhash64("rep", F.lit(11))
    rows = classes.where(F.pmod(order, F.lit(wide)) < F.element_at(shares, d)).select(d, order.alias("o"), "rep", "embedding").toPandas()
    for k, own in rows.sort_values(["d", "o", "rep"]).groupby("d"):
        chosen = choose_pivots(_unit(np.vstack(own["embedding"].to_numpy()).astype(np.float64)), want[k])
        out[k] = (base, chosen)
        base += len(chosen)
    for k in counts.keys() - out.keys():  # the hash has chosen none of a small dimension
        x = classes.where(d == k).orderBy(order, "rep").limit(1).toPandas()
        out[k] = (base, _unit(np.vstack(x["embedding"].to_numpy()).astype(np.float64)))
        base += 1
    return out


def _compare(least: float, shared: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        pivot, same = int(group["pivot"].iat[0]), group["bi"].iat[0] == group["bj"].iat[0]
        a = group[group["side"] == 0]
        b = a if same else group[group["side"] == 1]
        least_shared = min(shared, len(group["pivots"].iat[0]))
        names = np.unique(np.concatenate([np.concatenate(x["pivots"].to_numpy()) for x in (a, b)]))

        def lists(x: pd.DataFrame) -> np.ndarray:
            m, at = np.zeros((len(x), len(names)), np.float32), np.searchsorted(names, np.vstack(x["pivots"].to_numpy()))
            m[np.arange(len(x))[:, None], at] = 1
            return m

        la, lb = lists(a), lists(b)
        before = int(np.searchsorted(names, pivot))
        ok = (la @ lb.T >= least_shared) & (la[:, :before] @ lb[:, :before].T == 0)
        va, vb = (_unit(np.vstack(x["embedding"].to_numpy()).astype(np.float64)) for x in (a, b))
        ok &= va @ vb.T >= least
        ra, rb = a["rep"].to_numpy(), b["rep"].to_numpy()
        ok &= ra[:, None] != rb[None, :]
        i, j = np.flatnonzero(ok.any(1)), np.flatnonzero(ok.any(0))
        ok, ra, rb, na, nb = ok[np.ix_(i, j)], ra[i], rb[j], a["n"].to_numpy()[i], b["n"].to_numpy()[j]
        root_a, far = ra.copy(), np.iinfo(np.int64).max
        while len(ra):
            root_b = np.where(ok, root_a[:, None], far).min(0)
            if same:  # rows and columns are the same vectors
                root_b = np.minimum(root_b, root_a)
            now = np.minimum(root_a, np.where(ok, root_b[None, :], far).min(1))
            if (now == root_a).all():
                break
            root_a = now
        out = [pd.DataFrame({"rep": ra, "links": ok.astype(np.int64) @ nb, "root": root_a})]
        if len(ra) and not same:
            out.append(pd.DataFrame({"rep": rb, "links": ok.T.astype(np.int64) @ na, "root": root_b}))
        return pd.concat(out)

    return run


def near_vectors(vectors: DataFrame, least: float = 0.9, shared: int = SHARED) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest vec_id reachable by links of cosine >= least), kept."""
    kind = "array<float>" if dict(vectors.dtypes)["embedding"] == "array<float>" else "array<double>"
    every = vectors.select("vec_id", F.col("embedding").cast(kind).alias("embedding"))
    good = F.coalesce(
        (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    named = every.where("vec_id is not null").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    named = materialize(named.withColumn("good", good), "vectors")
    plus = F.transform("embedding", lambda x: x + F.lit(0.0).cast(kind[6:-1]))  # -0.0 becomes 0.0
    classes = named.where("good").groupBy(plus.alias("embedding")).agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    classes = materialize(classes.select("rep", "n", "embedding"), "classes")

    index = materialize(_orders(classes, pivots_of(classes), kind), "orders").withColumn("pivot", F.explode("pivots"))
    found = in_blocks(index, "pivot", "rep", BLOCK).groupBy("pivot", "bi", "bj")
    found = materialize(found.applyInPandas(_compare(least, shared), "rep long, links long, root long"), "links")
    comp = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    by_class = classes.join(links, "rep", "left").join(comp.withColumnsRenamed({"node": "rep"}), "rep", "left")
    by_class = by_class.select(
        "embedding",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    linked = named.where("good").select("vec_id", plus.alias("embedding")).join(by_class, "embedding")
    alone = named.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return _finish(linked.select("vec_id", "n_links", "component_id").union(alone), every)


def _finish(out: DataFrame, every: DataFrame) -> DataFrame:
    unnamed = every.where("vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"))
    return out.union(unnamed).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
