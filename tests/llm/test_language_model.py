"""Language-model scores against a plain recomputation, odd rows, and a held-out comparison."""

import math
from collections import Counter, defaultdict

import pytest

from gamestate.llm import common, lm

END = object()


def tokens(text):
    return [*(text or "").encode().lower().split(), END]


def brute(docs):
    """doc -> (n_tokens, n_known, train_tokens, base, score), in plain dictionaries."""
    single, pairs = Counter(), Counter()
    for i, text in docs:
        if not lm.held_out(i):
            last = None
            for w in tokens(text):
                single[w] += 1
                pairs[last, w] += 1
                last = w
    n, v, kinds = sum(single.values()), len(single), len(pairs)
    total, seen, before = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (u, w), c in pairs.items():
        total[u] += c
        seen[u][min(c, 3) - 1] += 1
        before[w] += 1
    of = lambda counts: lm.discounts([sum(x == k for x in counts.values()) for k in (1, 2, 3, 4)])
    high, low = of(pairs), of(before)
    less = lambda c, d: max(c - d[min(c, 3) - 1], 0) if c else 0
    rest = sum(low[min(c, 3) - 1] for c in before.values()) / kinds if kinds else 1

    def p(u, w):
        lower = (less(before[w], low) / kinds if kinds else 0) + rest / (v + 1)
        if not total[u]:
            return lower
        return (less(pairs[u, w], high) + sum(a * b for a, b in zip(high, seen[u], strict=True)) * lower) / total[u]

    out = []
    for i, text in docs:
        t = tokens(text)
        base = sum(math.log10((single[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        out.append((i, lm.held_out(i), len(t), sum(single[w] > 0 for w in t), n, base, sum(math.log10(p(u, w)) for u, w in zip([None, *t], t, strict=False))))
    return out, p, single


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want, strict=True):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("size", [2_000_000, 5000])
def test_scores_equal_a_plain_recomputation(spark, tiny, monkeypatch, size):
    monkeypatch.setattr(lm, "ENTRIES", size)  # one shard, or many
    docs = common.table(spark, tiny, "documents")
    want, p, single = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sum(p(b"the", w) for w in [*single, "unseen"]) == pytest.approx(1)
    got = lm.score_documents(docs).collect()
    same(got, want)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_odd_rows(spark):
    rows = [(None, "a b"), (1, None), (2, ""), (3, " \t\n"), (4, "A b a b c"), (4, "A b a b c"), (7, "x " * 60_000), (2**60 + 1, "İ ß　x")]
    docs = spark.createDataFrame([(i, t, 9, "z") for i, t in rows], "doc_id long, text string, block int, kind string")
    same(lm.score_documents(docs).collect(), brute(rows)[0])


def test_empty_and_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score_documents(empty).count() == 0
    out = next(i for i in range(99) if lm.held_out(i))
    (row,) = lm.score_documents(spark.createDataFrame([(out, "a b")], "doc_id long, text string")).collect()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (3, 0, 0, 0.0, 0.0)


def test_hot_first_word_is_dealt_to_many_shards(spark, monkeypatch):
    import numpy as np

    u = np.full(50_000, 12345, np.uint64)
    w = lm._mix(np.arange(50_000, dtype=np.uint64))
    hot = (np.array([7, 12345], np.uint64), np.array([2, 40], np.uint64))
    assert np.bincount(lm._pair_shard(u, w, 64, hot)).max() < 5000
    monkeypatch.setattr(lm, "ENTRIES", 300)
    rows = [(i, " ".join(f"the w{i * 31 + k}" for k in range(40))) for i in range(60)]
    same(lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect(), brute(rows)[0])


def test_packed_keys():
    import numpy as np

    keys = np.unique(lm._mix(np.arange(5000, dtype=np.uint64)) >> np.uint64(16))
    assert (lm._unpacked(lm._packed(keys)) == keys).all() and (lm._unpacked(lm._packed(keys[::-1], False), False) == keys[::-1]).all()
    for v in ([], [0, 255], [3, 70_000], [2**40, 1]):
        b, size = lm._narrow(np.array(v, np.int64))
        assert lm._wide(b, size).tolist() == v


def test_perplexity():
    assert lm.perplexity(-2.0, 2) == pytest.approx(10)
