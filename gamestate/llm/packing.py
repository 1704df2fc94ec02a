"""Packing token sequences into fixed lengths by vector bin packing with the dot-product heuristic.

Every example demands three resources at once: tokens, segments, and loss-bearing tokens. The open sequence takes
the example whose demand has the largest weighted dot product with what the sequence has left, among those that fit;
weights are the mean demands in units of capacity. Examples that may be cut and are longer than a sequence give full
sequences first. When nothing fits any more, the longest example left that may be cut is cut to fill the sequence.

Plain documents bear loss on every token, so their second and third demand follow from the first. Conversations bear it on
what the assistant says: pack_conversations() packs whole ones, a segment for each turn, under all three limits.

Tasks read their rows as a stream and pack pools of bounded size, so ids never leave the task, memory is
bounded and nothing is shuffled; each pool leaves few sequences that may not be full. A sequence id holds the number of
its task and its place there, which a task that runs again repeats.

Defined results: a null text counts as empty and has the end id alone; repeated rows are packed each; a null doc_id
stays null; a null number of tokens, loss-bearing tokens or segments is 0, 0 or 1; a turn with a null role bears no loss;
turns without a conv_id, and those of conversations beyond a limit, are packed one by one and may be cut; an empty table
gives no rows; columns besides those named are not looked at.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamestate.llm.bpe import PATTERN, byte_letters, encoder, named_texts, own_id
from gamestate.llm.common import materialize

POOL_TOKENS = 4_000_000
SEGMENTS = 256  # of examples; documents have no limit of their own, as a sequence can't hold more than it has tokens
END = 1
#: Above so many characters a text is encoded by bpe.Encoder, whose results are the same; tiktoken's pattern engine can give up.
LONG = 200_000


@lru_cache(maxsize=2)
def ids_of(path: str):
    """A function from text to ids, as the vocabulary file at path defines them; special strings give their ids."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    back = {c: b for b, c in byte_letters().items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(back[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special}
    fast = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(text: str) -> np.ndarray:
        if len(text) > LONG:
            return np.array(encoder(path).encode(text), "<u4")
        return fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)

    return ids


def pack(
    tokens: np.ndarray, loss: np.ndarray, capacity: tuple[int, int, int], cut: bool | np.ndarray, segments: np.ndarray | None = None
) -> list[tuple[int, int, int, int, int]]:
    """Pieces (example, start, length, sequence, offset) of a pool of examples.

    capacity: tokens, segments and loss-bearing tokens of a sequence. An example that may be cut takes a segment with each
    piece, and a piece bears loss on all its tokens as long as its example has loss-bearing ones left. One that may not be
    cut and exceeds the capacity by itself raises ValueError.
    """
    limit, most_segments, most_loss = capacity
    cut = np.broadcast_to(cut, len(tokens))
    segments = np.ones(len(tokens), np.int64) if segments is None else segments
    if len(tokens) and (~cut & ((tokens > limit) | (loss > most_loss) | (segments > most_segments))).any():
        raise ValueError("an example exceeds the capacity of a sequence")
    pieces, sequence = [], 0
    stacks: dict[tuple[int, int, int, bool], list[tuple[int, int]]] = {}
    for k, (n, bears, seg, may) in enumerate(zip(tokens.tolist(), loss.tolist(), segments.tolist(), cut.tolist(), strict=True)):
        start = 0
        while may and n - start >= (most := min(limit, most_loss) if bears > start else limit):
            pieces.append((k, start, most, sequence, 0))
            start, sequence = start + most, sequence + 1
        if n - start or not n:
            stacks.setdefault((n - start, min(max(bears - start, 0), n - start) if may else bears, 1 if may else seg, may), []).append((k, start))
    if not stacks:
        return pieces
    kinds = sorted(stacks, reverse=True)
    t, el, sg, may = (np.array([x[i] for x in kinds], np.float64) for i in range(4))
    left = np.array([len(stacks[x]) for x in kinds])
    size = np.array(capacity, np.float64)
    weight = np.array([(t * left).sum(), (sg * left).sum(), (el * left).sum()]) / size / left.sum()
    free = size.copy()
    gain = np.stack([t, sg, el], 1) / size * weight / size
    offset, remain = 0, int(left.sum())

    def place(k: int, start: int, n: int, seg: int, bears: int) -> None:
        nonlocal offset
        pieces.append((k, start, n, sequence, offset))
        offset += n
        free[:] -= (n, seg, bears)

    while remain:
        fits = (left > 0) & (t <= free[0]) & (sg <= free[1]) & (el <= free[2])
        if fits.any():
            at = int(np.argmax(np.where(fits, gain @ free, -1.0)))
            k, start = stacks[kinds[at]].pop()
            left[at] -= 1
            remain -= 1
            place(k, start, int(t[at]), int(sg[at]), int(el[at]))
            continue
        room = np.where(el > 0, min(free[0], free[2]), free[0])
        able = (left > 0) & (may > 0) & (room > 0)
        if free[1] >= 1 and able.any():
            at = int(np.argmax(able))
            k, start = stacks[kinds[at]].pop()
            left[at] -= 1
            n, bears, take = int(t[at]), int(el[at]), int(min(room[at], t[at]))
            place(k, start, take, 1, min(bears, take))
            rest = (n - take, max(bears - take, 0), 1, True)
            if rest not in stacks:
                stacks[rest] = []
                kinds.append(rest)
                t, el, sg, may, left = (np.append(x, v) for x, v in ((t, rest[0]), (el, rest[1]), (sg, 1), (may, 1), (left, 0)))
                gain = np.vstack([gain, np.array([rest[0], 1, rest[1]]) / size * weight / size])
            stacks[rest].append((k, start + take))
            left[kinds.index(rest)] += 1
        sequence, offset = sequence + 1, 0
        free[:] = size
    return pieces


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, path: str, limit: int = 2048, segments: int | None = None, most_loss: int | None = None) -> DataFrame:
    """Pieces of every document's ids and the end id, in sequences of at most `limit` tokens."""
    capacity = (limit, segments or limit, most_loss or limit)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, base = ids_of(path), TaskContext.get().partitionId() << 36
        names: list = []
        pool: list[np.ndarray] = []
        held = 0

        def flush() -> pd.DataFrame:
            nonlocal base
            n = np.array([len(x) for x in pool])
            found = pack(n, n, capacity, cut=True)
            f = pd.DataFrame(found, columns=["k", "start", "length", "sequence_id", "offset"])
            f["ids_crc32"] = [zlib.crc32(pool[k][a : a + m]) for k, a, m in zip(f["k"], f["start"], f["length"], strict=True)]
            f["doc_id"], f["no_id"] = ([names[k][i] for k in f["k"]] for i in (0, 1))
            f["doc_tokens"] = n[f["k"]]
            f["sequence_id"] += base
            base = int(f["sequence_id"].max()) + 1
            return f.drop(columns="k")

        for part in parts:
            for name, text in zip(zip(part["doc_id"], part["no_id"], strict=True), part["text"], strict=True):
                pool.append(np.append(ids(text), np.uint32(END)).astype("<u4"))
                names.append(name)
                held += len(pool[-1])
                if held >= POOL_TOKENS:
                    yield flush()
                    pool, names, held = [], [], 0
        if pool:
            yield flush()

    out = named_texts(docs).mapInPandas(run, f"{SCHEMA}, no_id boolean")
    return out.select(own_id(), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


PIECE = "start long, length long, loss_length long, sequence_id long, offset long, oversize boolean"


def pack_examples(examples: DataFrame, limit: int = 2048, segments: int = SEGMENTS, most_loss: int = 2048, pool: int = 50_000) -> DataFrame:
    """The pieces of examples (tokens, loss_tokens, segments, cut, and columns that name them, which are kept).

    Without a column segments an example has one; without a column cut examples stay whole. A whole example that exceeds a
    limit by itself gets a sequence of its own and is marked oversize. Columns with the names of the results give way.
    """
    named = [c for c in examples.columns if c not in ("tokens", "loss_tokens", "segments", "cut", "start", "length", "loss_length", "sequence_id", "offset", "oversize")]
    number = lambda c, d: (F.coalesce(F.col(c).cast("long"), F.lit(d)) if c in examples.columns else F.lit(d).cast("long")).alias(c)
    cut = (F.coalesce("cut", F.lit(False)) if "cut" in examples.columns else F.lit(False)).alias("cut")
    keys = [f"_k{i}" for i in range(len(named))]  # mapInArrow takes no names with dots
    rows = examples.select(*[F.col(f"`{c}`").alias(k) for k, c in zip(keys, named, strict=True)], number("tokens", 0), number("loss_tokens", 0), number("segments", 1), cut)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 36
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal base
            rows = pa.Table.from_batches(held)
            t, el, sg, may = (rows[c].to_numpy() for c in ("tokens", "loss_tokens", "segments", "cut"))
            over = ~may & ((t > limit) | (el > most_loss) | (sg > segments))
            inside = np.flatnonzero(~over)
            found = np.array(pack(t[inside], el[inside], (limit, segments, most_loss), may[inside], sg[inside]), np.int64).reshape(-1, 5)
            k, start, length, sequence, offset = found.T
            alone = np.flatnonzero(over)
            after = int(sequence.max()) + 1 if len(sequence) else 0
            nil = np.zeros(len(alone), np.int64)
            at = np.concatenate([inside[k], alone])
            start, length, offset = (np.concatenate(x) for x in ((start, nil), (length, t[alone]), (offset, nil)))
            sequence = np.concatenate([sequence, after + np.arange(len(alone))]) + base
            base = int(sequence.max()) + 1 if len(sequence) else base
            loss = np.where(may[at], np.clip(el[at] - start, 0, length), el[at])
            out = rows.select(keys).take(pa.array(at))
            for name, values in (("start", start), ("length", length), ("loss_length", loss), ("sequence_id", sequence), ("offset", offset), ("oversize", over[at])):
                out = out.append_column(name, pa.array(values))
            yield from out.combine_chunks().to_batches()

        for batch in batches:
            while batch.num_rows:
                room = pool - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == pool:
                    yield from flush()
                    held = []
        if held:
            yield from flush()

    kept = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.select(*keys).schema)
    return rows.mapInArrow(run, kept + PIECE).withColumnsRenamed(dict(zip(keys, named, strict=True)))


def turn_tokens(turns: DataFrame, path: str, speaker: str = "assistant") -> DataFrame:
    """conv_id, turn, tokens and loss_tokens of every turn: its ids and the end id, loss-bearing if the speaker says it."""
    rows = turns.select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("role") == speaker, F.lit(False)).alias("bears"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_of(path)
        for batch in batches:
            n = np.array([len(ids(t)) + 1 for t in batch["text"].to_pylist()], np.int64)
            loss = np.where(batch["bears"].to_numpy(zero_copy_only=False), n, 0)
            yield pa.RecordBatch.from_arrays([batch["conv_id"], batch["turn"], pa.array(n), pa.array(loss)], names=["conv_id", "turn", "tokens", "loss_tokens"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, tokens long, loss_tokens long")


def pack_conversations(turns: DataFrame, path: str, limit: int = 2048, segments: int = 8, most_loss: int = 1280) -> DataFrame:
    """The pieces of all conversations: conv_id, turn (null for a whole conversation), turns and the columns of PIECE.

    Sums by conversation are all that is shuffled, so no task holds the turns of a hot one.
    """
    spoken = materialize(turn_tokens(turns, path), "turns")
    sums = spoken.where("conv_id is not null").groupBy("conv_id").agg(F.sum("tokens").alias("tokens"), F.sum("loss_tokens").alias("loss_tokens"), F.count("*").alias("segments"))
    sums = sums.withColumn("fits", (F.col("tokens") <= limit) & (F.col("loss_tokens") <= most_loss) & (F.col("segments") <= segments))
    no_turn = F.lit(None).cast(dict(spoken.dtypes)["turn"]).alias("turn")
    whole = sums.where("fits").select("conv_id", no_turn, F.col("segments").alias("turns"), "tokens", "loss_tokens", "segments", F.lit(False).alias("cut"))
    single = spoken.join(sums.where("not fits").select("conv_id"), "conv_id", "left_semi").unionByName(spoken.where("conv_id is null"))
    one = F.lit(1).cast("long")
    single = single.select("conv_id", "turn", one.alias("turns"), "tokens", "loss_tokens", one.alias("segments"), F.lit(True).alias("cut"))
    return pack_examples(whole.union(single), limit, segments, most_loss)
