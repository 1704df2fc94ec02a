"""Language-model scoring: an interpolated modified Kneser-Ney model of word pairs, counted in Spark.

Texts are cut into blocks once: a block keeps the hashes of its words and each text as places in that list, so
later steps never see texts again. Training sums the pairs of all blocks by shards of the pair's hash space and leaves
each shard as one row of sorted hashes with counts. A shard also says how many different words go before a word, and
for each first word how often it came and how many of its pairs came once, twice or more; these sums by word form the
second table of the model, in shards of its own. Discounts follow from the counts of counts of all shards.

Scoring sends each block's distinct pairs and words to the shards that know them, not texts: every shard meets its
lookups in one task, which spools the shard to a file without a name, maps it into memory and searches it; so memory
doesn't grow with a shard, and no worker needs the whole model. The answers return to their block, where each token's
probability is (max(c - D(c), 0) + gamma * lower) / total, as usual.

A pair's key is 48 bits of its hash: a shard holds about ENTRIES of them, so a pair that never came is taken for another
with a chance of some 10^-9, at any size of the corpus. Keys move and lie sorted, their upper parts apart from the lower.

The pairs of a frequent first word are dealt over several shards by their second word, as many as its count asks for, so
a word that holds a third of all tokens fills no shard alone; counts of a block are summed before they move.

Defined results: a null or empty text is its end token alone. Rows that repeat an id are texts of their own. A null id counts
as the text ''. Words are compared by 48-bit hashes; of a billion words some two thousand share theirs with another.
A word without count is one unknown class, which shares the mass that discounts leave to the uniform distribution. Without
training texts every token has probability 1 (the only class). A text of any length lies in one block.
"""

from __future__ import annotations

import hashlib
import math
import tempfile
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamestate.llm.common import Stages, materialize

TOKENS = 1_500_000  # tokens of a block
DOCS = 50_000  # texts of a block
ENTRIES = 1_000_000  # tokens for each shard of pairs, and for each of words; a word with more is a frequent one
FIELDS = 6  # of a word: count, different words before, count as first word, its pairs seen once, twice, more often



def _hash(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=6).digest(), "little")


_END, _BEGIN = _hash(b"\n"), _hash(b"\n\n")  # no word holds a line end
_ROW = "kind string, shard int, block long, keys binary, values binary, n1 long, n2 long, n3 long, n4 long, n long"
_NAMES = [f.split()[0] for f in _ROW.split(", ")]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pair(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return _mix(u * np.uint64(0x9E3779B97F4A7C15) + w)


def _key(pair: np.ndarray) -> np.ndarray:
    return pair >> np.uint64(16)


def _planes(values: np.ndarray, size: int) -> bytes:
    """Integers of so many bytes, the lowest byte of all first: high bytes that are mostly 0 shrink to nothing."""
    return np.ascontiguousarray(values.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T).tobytes()


def _of_planes(b: bytes, size: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(f"<u{size}").ravel()


def _packed(keys: np.ndarray, ascending: bool = True) -> bytes:
    """48-bit keys; of ascending ones the upper parts' differences."""
    high = (keys >> np.uint64(32)).astype(np.uint16)
    return _planes(np.diff(high, prepend=np.uint16(0)) if ascending else high, 2) + keys.astype("<u4").tobytes()


def _unpacked(b: bytes, ascending: bool = True) -> np.ndarray:
    n = len(b) // 6
    high = _of_planes(b[: 2 * n], 2)
    high = np.cumsum(high, dtype=np.uint64) if ascending else high.astype(np.uint64)
    return (high << np.uint64(32)) | np.frombuffer(b, "<u4", n, 2 * n)


def _narrow(values: np.ndarray) -> tuple[bytes, int]:
    """Non-negative integers in as few bytes each as they need, and that number."""
    most = int(values.max(initial=0))
    size = next(k for k in (1, 2, 4, 8) if most < 1 << 8 * k)
    return _planes(values.ravel(), size), size


def _wide(values: bytes, size: int) -> np.ndarray:
    return _of_planes(values, size).astype(np.int64)


Hot = tuple[np.ndarray, np.ndarray]  # sorted hashes of frequent words, and over how many shards the pairs of each are dealt


def _pair_shard(u: np.ndarray, w: np.ndarray, shards: int, hot: Hot) -> np.ndarray:
    at = _mix(u)
    if len(hot[0]):
        k = np.minimum(np.searchsorted(hot[0], u), len(hot[0]) - 1)
        at = at + np.where(hot[0][k] == u, _mix(w) % hot[1][k], np.uint64(0))
    return (at % np.uint64(shards)).astype(np.int64)


def _word_shard(w: np.ndarray, shards: int) -> np.ndarray:
    return (_mix(w) % np.uint64(shards)).astype(np.int64)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(_NAMES)
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary()] + [pa.int64()] * 5
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, kinds, strict=True)], names=_NAMES)


def _row(kind: str, shard: int, block: int, keys: bytes, values: bytes, n: tuple = (0,) * 5) -> tuple:
    return (kind, int(shard), int(block), keys, values, *(int(x) for x in n))


def _dealt(shards: np.ndarray, keys: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that occurs, with the places where it does, in order (of the keys, if there are any)."""
    order = np.argsort(shards, kind="stable") if keys is None else np.lexsort((keys, shards))
    s = shards[order]
    cuts = np.flatnonzero(np.diff(s)) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(shards[part[0]]), part


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


_BLOCK = "block long, ids binary, no_id binary, out binary, lengths binary, words binary, places binary, tokens long, learned long"


def blocks(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) in blocks: ids, whether held out, numbers of tokens, word hashes, and the tokens' places there.

    The most frequent words come first, and the places lie byte by byte, so that they shrink well.
    """

    def block(number: int, known: dict[bytes, int], seq: array, ids: list, lengths: list[int]) -> pa.RecordBatch:
        h = np.array([_END, *map(_hash, known)], np.uint64)
        tokens = np.frombuffer(seq, np.uint32)
        often = np.argsort(-np.bincount(tokens, minlength=len(h)), kind="stable")  # frequent words get small places
        place = np.empty(len(h), np.uint32)
        place[often] = np.arange(len(h), dtype=np.uint32)
        out = np.array([held_out(i) for i in ids], np.uint8)
        n = np.array(lengths, np.int64)
        none = np.array([i is None for i in ids], np.uint8)
        values = [np.array([i or 0 for i in ids], np.int64), none, out, n]
        parts = [*(v.tobytes() for v in values), _packed(h[often], False), _planes(place[tokens], 4)]
        cols = [pa.array([number], pa.int64()), *(pa.array([v], pa.binary()) for v in parts)]
        cols += [pa.array([int(x)], pa.int64()) for x in (n.sum(), n[out == 0].sum())]
        return pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in _BLOCK.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        new = lambda: ({}, array("I"), [], [])
        known, seq, ids, lengths = state = new()
        for b in batches:
            for i, text in zip(b.column(0), b.column(1), strict=True):
                t = (text.as_py() or "").encode("utf-8", "surrogatepass").lower().split()
                seq.extend([known.setdefault(w, len(known) + 1) for w in t])
                seq.append(0)  # the end token
                ids.append(i.as_py())
                lengths.append(len(t) + 1)
                if len(seq) >= TOKENS or len(ids) >= DOCS:
                    yield block(number, *state)
                    known, seq, ids, lengths = state = new()
                    number += 1
        if ids:
            yield block(number, *state)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _BLOCK)


class _Block:
    """A row of blocks(): `u` and `w` are the places of each token and of the one before it, len(words) standing for a text's begin."""

    def __init__(self, b: pa.RecordBatch | pa.Table, i: int) -> None:
        get = lambda c, t: np.frombuffer(b[c][i].as_py(), t)
        self.number = b["block"][i].as_py()
        self.ids, self.no_id, self.out, self.lengths = get("ids", "<i8"), get("no_id", "u1"), get("out", "u1"), get("lengths", "<i8")
        self.words = _unpacked(b["words"][i].as_py(), False)
        self.w = _of_planes(b["places"][i].as_py(), 4).astype(np.int64)
        self.ends = np.cumsum(self.lengths)
        self.u = np.empty_like(self.w)
        self.u[1:] = self.w[:-1]
        self.u[self.ends - self.lengths] = len(self.words)

    def hashes(self) -> np.ndarray:
        return np.append(self.words, np.uint64(_BEGIN))

    def lookups(self, shards: int, hot: Hot) -> tuple[np.ndarray, Iterator[tuple[int, np.ndarray]]]:
        """The keys of the block's distinct pairs, and by shard their places in the order of the keys."""
        codes = self.pairs()[0]
        u, w = self.hashes()[codes // len(self.words)], self.words[codes % len(self.words)]
        keys = _key(_pair(u, w))
        return keys, _dealt(_pair_shard(u, w, shards, hot), keys)

    def pairs(self, chosen: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct codes of pairs among the chosen tokens, their numbers, and of each token its code's place."""
        codes, inverse, n = np.unique(self.u[chosen] * len(self.words) + self.w[chosen], return_inverse=True, return_counts=True)
        return codes, n, inverse


def _of_words(shard: int, block: int, keys: np.ndarray, fields: np.ndarray) -> tuple:
    """A row of words (ascending) and their fields, field by field."""
    values, size = _narrow(np.ascontiguousarray(fields.T))
    return _row("words", shard, block, _packed(keys), values, (size, 0, 0, 0, 0))


@dataclass
class Model:
    """pairs and words hold a row for each shard (keys: sorted hashes; values, whose bytes each are in block); tokens N, distinct words V and discounts."""

    pairs: DataFrame
    words: DataFrame
    pair_shards: int
    word_shards: int
    tokens: int
    distinct: int
    kinds: int  # different pairs
    pair_discounts: list[float]
    word_discounts: list[float]
    hot: Hot
    rest: float  # the mass that the discounts of single words leave to the uniform distribution


def discounts(n: list[int]) -> list[float]:
    """D1, D2 and D3+ from the numbers of n-grams seen once, twice, three and four times; 0.5, 1 and 1.5 where one is missing."""
    if min(n) == 0:
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.0), float(k)) for k in (1, 2, 3)]


def _less(c: np.ndarray, d: list[float]) -> np.ndarray:
    """max(c - D(c), 0)."""
    return np.maximum(c - np.array([0.0, *d])[np.minimum(c, 3)], 0.0)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their rows of values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first, axis=0)


def train(cut: DataFrame, st: Stages) -> Model:
    """A model of the blocks' texts that are not held out; its tables are stages of st."""
    learned = cut.agg(F.sum("learned")).first()[0] or 0
    pair_shards = word_shards = max(1, -(-learned // ENTRIES))
    hot: Hot = (np.empty(0, np.uint64), np.empty(0, np.uint64))

    def counted_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                x = _Block(b, i)
                codes, n, _ = x.pairs(np.repeat(x.out == 0, x.lengths))
                u, w = x.hashes()[codes // len(x.words)], x.words[codes % len(x.words)]
                out = []
                for s, at in _dealt(_pair_shard(u, w, pair_shards, hot)):
                    # codes are in the order of their first words, so each first word comes once, with the number of its pairs
                    begin = np.flatnonzero(np.concatenate([[True], u[at][1:] != u[at][:-1]]))
                    runs, wide = _narrow(np.diff(begin, append=len(at)))
                    values, size = _narrow(n[at])
                    out.append(_row("pairs", s, x.number, _packed(w[at], False), values + runs + _packed(u[at][begin], False), (size, wide, len(at), len(begin), 0)))
                yield _rows(out)

    def counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                x = _Block(b, i)
                c = np.bincount(x.w[np.repeat(x.out == 0, x.lengths)], minlength=len(x.words))
                there = np.flatnonzero(c)
                fields = np.zeros((len(there), FIELDS), np.int64)
                fields[:, 0] = c[there]
                h = x.words[there]
                yield _rows([_of_words(s, x.number, h[at], fields[at]) for s, at in _dealt(_word_shard(h, word_shards), h)])

    def merged_pairs(key: tuple, group: pa.Table) -> pa.Table:
        us, ws, ns = [], [], []
        for k, v, size, wide, many, first in zip(*(group[c] for c in ("keys", "values", "n1", "n2", "n3", "n4")), strict=True):
            v, size, wide, many, first = (x.as_py() for x in (v, size, wide, many, first))
            ends = np.cumsum([size * many, wide * first])
            ns.append(_wide(v[: ends[0]], size))
            us.append(np.repeat(_unpacked(v[ends[1] :], False), _wide(v[ends[0] : ends[1]], wide)))
            ws.append(_unpacked(k.as_py(), False))
        u, w, n = (np.concatenate(x) for x in (us, ws, ns))
        h = _pair(u, w)
        order = np.argsort(h, kind="stable")
        h, u, w, n = h[order], u[order], w[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        h, u, w, c = h[first], u[first], w[first], np.add.reduceat(n, first)
        shard = key[0].as_py()
        values, size = _narrow(c)
        out = [_row("pairs", shard, size, _packed(_key(h)), values, (*((c == k).sum() for k in (1, 2, 3, 4)), len(c)))]
        one = np.zeros((2 * len(c), FIELDS), np.int64)
        one[: len(c), 1] = 1  # u goes before w
        one[len(c) :, 2] = c
        for k in (1, 2):
            one[len(c) :, 2 + k] = c == k
        one[len(c) :, 5] = c >= 3
        keys, fields = _summed(np.concatenate([w, u]), one)
        out += [_of_words(s, 0, keys[at], fields[at]) for s, at in _dealt(_word_shard(keys, word_shards))]
        return pa.Table.from_batches([_rows(out)])

    def merged_words(key: tuple, group: pa.Table) -> pa.Table:
        keys = np.concatenate([_unpacked(k.as_py()) for k in group["keys"]])
        fields = np.concatenate([_wide(v.as_py(), k.as_py()).reshape(FIELDS, -1).T for v, k in zip(group["values"], group["n1"], strict=True)])
        keys, fields = _summed(keys, fields)
        return pa.Table.from_batches([_rows([_of_words(key[0].as_py(), 0, keys, fields)])])

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of merged words with the number of bytes of a value in block, and the counts of counts."""
        for b in batches:
            for shard, k, v, n in zip(b["shard"], b["keys"], b["values"], b["n1"], strict=True):
                fields = _wide(v.as_py(), n.as_py()).reshape(FIELDS, -1)
                many = (*((fields[1] == c).sum() for c in (1, 2, 3, 4)), (fields[0] > 0).sum())
                yield _rows([_row("words", shard.as_py(), n.as_py(), k.as_py(), v.as_py(), many)])

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, v, n in zip(b["keys"], b["values"], b["n1"], strict=True):
                count = _wide(v.as_py(), n.as_py()).reshape(FIELDS, -1)[0]
                at = np.flatnonzero(count > ENTRIES)
                yield pa.RecordBatch.from_arrays([pa.array(_unpacked(k.as_py())[at].astype(np.int64)), pa.array(count[at])], names=["word", "n"])

    counts = st.keep(cut.mapInArrow(counted_words, _ROW).groupBy("shard").applyInArrow(merged_words, _ROW), "lm-counts")
    often = counts.mapInArrow(frequent, "word long, n long").orderBy("word").toArrow()  # fewer words than shards
    if often.num_rows:
        hot = (often["word"].to_numpy().astype(np.uint64), (-(-often["n"].to_numpy() // ENTRIES)).astype(np.uint64))
    pairs = st.keep(cut.mapInArrow(counted_pairs, _ROW).groupBy("shard").applyInArrow(merged_pairs, _ROW), "lm-pairs")
    words = counts.union(pairs.where("kind = 'words'")).groupBy("shard").applyInArrow(merged_words, _ROW)
    words = st.keep(words.mapInArrow(finished, _ROW), "lm-words")
    pairs = pairs.where("kind = 'pairs'")
    n = [F.coalesce(F.sum(c), F.lit(0)) for c in _NAMES[-5:]]
    of_pairs, of_words = pairs.agg(*n).first(), words.agg(*n).first()
    d = discounts(of_words[:4])
    kinds = of_pairs[4]
    more = of_words[4] - of_words[0] - of_words[1]
    rest = (d[0] * of_words[0] + d[1] * of_words[1] + d[2] * more) / kinds if kinds else 1.0
    return Model(pairs, words, pair_shards, word_shards, learned, of_words[4], kinds, discounts(of_pairs[:4]), d, hot, rest)


def _mapped(parts: list[bytes], kind: str) -> np.ndarray:
    """The parts as one array, mapped from a file without a name: its pages come and go, and it ends with the array."""
    if not sum(map(len, parts)):
        return np.empty(0, kind)
    with tempfile.TemporaryFile() as f:
        for p in parts:
            f.write(p)
        f.flush()
        return np.memmap(f, dtype=kind, mode="r")


def look_up(cut: DataFrame, model: Model, st: Stages) -> DataFrame:
    """What the model's shards know of the pairs and words of each block."""
    pair_shards, word_shards, hot = model.pair_shards, model.word_shards, model.hot

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                x = _Block(b, i)
                keys, dealt = x.lookups(pair_shards, hot)
                yield _rows([_row("pairs", s, x.number, _packed(keys[at]), b"") for s, at in dealt])
                h = x.hashes()
                yield _rows([_row("words", s, x.number, _packed(h[at]), b"") for s, at in _dealt(_word_shard(h, word_shards), h)])

    def answered(key: tuple, lookups: pa.Table, shard: pa.Table) -> pa.Table:
        kind, number = (x.as_py() for x in key)
        wide = 1 if kind == "pairs" else FIELDS
        rows = list(zip(shard["keys"], shard["values"], shard["size"], strict=True))  # one, or none
        keys = _mapped([_unpacked(k.as_py()).tobytes() for k, _, _ in rows], "<u8")
        values = _mapped([_wide(v.as_py(), n.as_py()).tobytes() for _, v, n in rows], "<i8").reshape(wide, -1)
        out = []
        for block, k in zip(lookups["block"], lookups["keys"], strict=True):
            q = _unpacked(k.as_py())
            found = np.zeros((wide, len(q)), np.int64)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
                hit = keys[at] == q
                found[:, hit] = values[:, at[hit]]
            small, size = _narrow(found)
            out.append(_row(kind, number, block.as_py(), b"", small, (size, 0, 0, 0, 0)))
        return pa.Table.from_batches([_rows(out)])

    shards = model.pairs.union(model.words).select(F.col("kind").alias("k"), F.col("shard").alias("s"), F.col("block").alias("size"), "keys", "values")
    lookups = cut.mapInArrow(asked, _ROW).groupBy("kind", "shard")
    return st.keep(lookups.cogroup(shards.groupBy("k", "s")).applyInArrow(answered, _ROW), "lm-answers")


def combine(cut: DataFrame, answers: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each text of the blocks."""
    pair_shards, word_shards, hot = model.pair_shards, model.word_shards, model.hot
    tokens, distinct, kinds, rest = model.tokens, model.distinct, model.kinds, model.rest
    d_pair, d_word = model.pair_discounts, model.word_discounts
    result = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    names = [f.split()[0] for f in result.split(", ")]

    def scored(key: tuple, own: pa.Table, answers: pa.Table) -> pa.Table:
        x = _Block(own, 0)
        codes, _, inverse = x.pairs()
        h = x.hashes()
        c = np.zeros(len(codes), np.int64)
        fields = np.zeros((FIELDS, len(h)), np.int64)
        places = {
            "pairs": dict(x.lookups(pair_shards, hot)[1]),
            "words": dict(_dealt(_word_shard(h, word_shards), h)),
        }
        for kind, shard, v, width in zip(*(answers[k] for k in ("kind", "shard", "values", "n1")), strict=True):
            got = _wide(v.as_py(), width.as_py())
            at = places[kind.as_py()][shard.as_py()]
            if kind.as_py() == "pairs":
                c[at] = got
            else:
                fields[:, at] = got.reshape(FIELDS, -1)
        count, before, total, once, twice, often = fields
        single = _less(before[:-1], d_word) / max(kinds, 1) + rest / (distinct + 1)
        u, w = codes // len(x.words), codes % len(x.words)
        gamma = d_pair[0] * once + d_pair[1] * twice + d_pair[2] * often
        seen = total[u] > 0
        p = np.where(seen, (_less(c, d_pair) + gamma[u] * single[w]) / np.maximum(total[u], 1), single[w])
        base = np.log10((count[:-1] + 0.5) / (tokens + 0.5 * (distinct + 1)))
        starts = x.ends - x.lengths
        add = lambda v: np.add.reduceat(v, starts)
        n_known, base_score, full = add((count[:-1] > 0)[x.w].astype(np.int64)), add(base[x.w]), add(np.log10(p)[inverse])
        ids = pa.array(x.ids, pa.int64(), mask=x.no_id.astype(bool))
        cols = [ids, pa.array(x.out.astype(bool)), x.lengths, n_known, np.full(len(x.ids), tokens), base_score, full]
        return pa.table(dict(zip(names, cols, strict=True)))

    own = cut.select(*cut.columns)
    of_block = answers.select(F.col("block").alias("b"), "kind", "shard", "values", "n1").groupBy("b")
    return own.groupBy("block").cogroup(of_block).applyInArrow(scored, result)


def score_documents(docs: DataFrame) -> DataFrame:
    """Each text of docs under a model of those that are not held out."""
    with Stages() as st:
        cut = st.keep(blocks(docs), "lm-blocks")
        with Stages() as own:  # the model goes once it has been asked
            model = train(cut, own)
            answers = look_up(cut, model, st)
        return materialize(combine(cut, answers, model), "lm-scores")


def perplexity(log10_probability: float, tokens: int) -> float:
    return math.inf if not tokens else 10 ** (-log10_probability / tokens)
