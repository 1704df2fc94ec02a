"""Conversations packed under three limits, and examples with odd columns."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gamestate.llm import bpe, common, packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn int, role string, text string, tokens string, start int"


def check(pieces, turns, limit=2048, segments=8, most_loss=1280):
    """All turns lie in pieces exactly once, and no sequence exceeds a limit; returns tokens, segments and loss by sequence."""
    t = Tokenizer.from_file(PATH)
    n = [(c, k, len(t.encode(s or "", add_special_tokens=False).ids) + 1, r == "assistant") for c, k, r, s in turns]
    seqs, whole, single = {}, {}, {}
    for p in pieces:
        assert not p["oversize"]
        seqs.setdefault(p["sequence_id"], []).append(p)
        if p["turn"] is None and p["conv_id"] is not None and p["turns"] > 0 and p["start"] == 0 and p["conv_id"] not in single:
            whole.setdefault(p["conv_id"], []).append(p)
    total = {c: [sum(x) for x in zip(*[(m, m * b, 1) for d, _, m, b in n if d == c], strict=True)] for c in {x[0] for x in n}}
    fits = {c for c, (a, b, k) in total.items() if c is not None and a <= limit and b <= most_loss and k <= segments}
    for c in fits:
        own = [p for p in pieces if p["conv_id"] == c]
        assert [(p["length"], p["loss_length"], p["turns"], p["turn"]) for p in own] == [(total[c][0], total[c][1], total[c][2], None)]
    rest = sorted((str(c), str(k), m, m * b) for c, k, m, b in n if c not in fits)
    cut = {}
    for p in sorted((p for p in pieces if p["conv_id"] not in fits), key=lambda p: (str(p["conv_id"]), str(p["turn"]), p["start"])):
        cut.setdefault((str(p["conv_id"]), str(p["turn"])), []).append(p)
    assert {k: (sum(p["length"] for p in x), sum(p["loss_length"] for p in x)) for k, x in cut.items()} == {
        k: (sum(m for a, b, m, _ in rest if (a, b) == k), sum(w for a, b, _, w in rest if (a, b) == k)) for k in {(a, b) for a, b, _, _ in rest}
    }
    used = []
    for x in seqs.values():
        at = 0
        for p in sorted(x, key=lambda p: (p["offset"], p["length"])):
            assert p["offset"] == at
            at += p["length"]
        used.append((at, sum(p["turns"] for p in x), sum(p["loss_length"] for p in x)))
        assert used[-1][0] <= limit and used[-1][1] <= segments and used[-1][2] <= most_loss
    return np.array(used)


def test_all_three_limits_bind(spark):
    sf = "/root/testdata/sf0.01"
    turns = [tuple(r) for r in common.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    used = check(queries.conversation_packing(spark, sf).collect(), turns)
    assert (used[:, 0] >= 2000).any() and (used[:, 1] == 8).any() and (used[:, 2] >= 1250).any()
    best = np.array([sum(x) for x in used.T]) / (2048, 8, 1280)
    assert len(used) <= 1.35 * best.max() + 2


def test_odd_conversations(spark):
    long = "word " * 6000
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 1, "assistant", "yes"), (2, 0, "assistant", long), (2, 1, "user", long), (2**60 + 1, 0, None, None), (None, None, "assistant", "alone"), (None, 3, "user", "")]
    turns += [(3, k, "user", "x") for k in range(30)]
    df = spark.createDataFrame([(*t, "x", 1) for t in turns], SCHEMA)
    check(packing.pack_conversations(df, PATH).collect(), turns)
    assert packing.pack_conversations(df.limit(0), PATH).count() == 0


def test_examples_with_nulls_and_clashing_names(spark):
    rows = [(2**60 + 1, None, None, "a", 1), (None, 100, None, "b", 2), (7, 100, 60, None, 3), (7, 100, 60, None, 3), (8, 5000, 10, "c", 4), (9, 10, 500, "d", 5)]
    ex = spark.createDataFrame(rows, "example_id long, tokens int, loss_tokens int, `a.b` string, offset int").coalesce(1)
    got = packing.pack_examples(ex, 200, 3, 100, pool=4).collect()
    assert sorted((str(r["example_id"]), r["length"], r["loss_length"], r["oversize"]) for r in got) == sorted([(str(2**60 + 1), 0, 0, False), ("None", 100, 0, False), ("7", 100, 60, False), ("7", 100, 60, False), ("8", 5000, 10, True), ("9", 10, 500, True)])
    assert len({r["sequence_id"] for r in got if r["oversize"]}) == 2 and {r["a.b"] for r in got} == {"a", "b", None, "c", "d"}
    assert packing.pack_examples(ex.limit(0)).count() == 0


def test_pools_go_on_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        ex = spark.range(400).selectExpr("id as example_id", "20 as tokens", "10 as loss_tokens").coalesce(1)
        assert packing.pack_examples(ex, 200, 256, 200).select("sequence_id").distinct().count() == 40
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("bound", [0, 5, 10**9])
def test_both_encoders_give_the_same_ids(monkeypatch, bound):
    monkeypatch.setattr(packing, "LONG", bound)
    rng = np.random.default_rng(3)
    letters = [*" \n\t  ab'sé12,x\x1c\x85日🙂", "<|endoftext|>", " the", "'ll", "aaaaaaaa", "        "]
    ids, t = packing.ids_of(PATH), bpe.encoder(PATH)
    for _ in range(1500):
        s = "".join(rng.choice(letters, rng.integers(0, 16)))
        assert ids(s).tolist() == t.encode(s)
