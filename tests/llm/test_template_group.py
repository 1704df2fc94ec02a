"""Near-dedup of documents that share a template, most of them alike below the threshold."""

import random

import numpy as np

from gamestate.llm import minhash


def test_marks_never_count_too_low():
    rng = np.random.default_rng(3)
    marks = minhash._Marks()
    pool = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    one = np.unique(rng.choice(pool, 800))
    many = [np.unique(rng.choice(pool, n)) for n in (1, 40, 900, 3000)]
    exact = np.array([len(np.intersect1d(one, m)) for m in many])
    assert (marks.shared(one, many) >= exact).all()
    assert (marks.shared(one, many) - exact <= 20).all()
    assert not marks.table.any()


def test_template_group_against_brute_force(spark):
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(120):
        words = list(base)
        for at in rnd.sample(range(150), 1 + i % 4):
            words[at] = f"x{i}_{at}"
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(146)} for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert 1 < len(set(root)) < len(texts)
    got = minhash.near_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == dict(enumerate(root))
