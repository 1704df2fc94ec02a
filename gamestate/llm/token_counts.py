"""Token counts without ids: pieces are counted once per distinct pre-token and joined to the documents' frequencies.

Tasks turn their rows into blocks: for each pre-token of a block one row that lists which of the block's documents
hold it and how often. These rows meet the table of distinct pre-tokens and their piece counts in one join, are summed
to a number per document inside each task, and are added up by block. A pre-token thus travels once per block and
not once per occurrence, and a frequent one is many rows of bounded size.

Defined results: a null text counts as empty; special strings inside a text count as one token each, as the library has
it by default; repeated rows are counted each; a null doc_id stays null; columns besides doc_id and text are not
looked at.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamestate.llm.common import materialize

BLOCK_BYTES = 32_000_000
BLOCK_DOCS = 60_000
HELD = 4_000_000
_SUM = np.dtype([("doc", "<u2"), ("n", "<u4")])
_HEAD = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n_bytes", "<i8"), ("special", "<i8")])
#: White space to str.split() but not to the pattern.
_SEPARATORS = re.compile("[\x1c-\x1f]")


class _Places(dict):
    def __missing__(self, key: str) -> int:
        self[key] = place = len(self)
        return place


@lru_cache(maxsize=2)
def rules(path: str) -> tuple:
    """The file's special strings and pre-token pattern. Only lower-casing files with a removing split are known here."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    split = spec["pre_tokenizer"]["pretokenizers"][0]
    kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
    if kinds != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or not split["invert"]:
        raise ValueError(f"{path}: another kind of tokenizer")
    special = [t["content"] for t in spec["added_tokens"]]
    return re.compile("|".join(map(re.escape, special))), regex.compile(split["pattern"]["Regex"])


def normalised(text: str) -> str:
    """NFC, then each character's lower case by itself."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def _words(text: str) -> list[str]:
    return regex.findall(r"\S+", text) if _SEPARATORS.search(text) else text.split()


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of up to 35 bits, seven to a byte, the last byte of each below 128; and where each begins, and the end."""
    width = np.ones(len(values), np.int8)
    for k in range(1, 5):
        width += values >= 1 << 7 * k
    ends = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
    out = np.empty(ends[-1], np.uint8)
    for k in range(5):
        some = width > k
        out[ends[:-1][some] + k] = values[some] >> 7 * k & 127 | np.where(width[some] > k + 1, 128, 0)
    return out, ends


def from_varints(coded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values and where each ends."""
    ends = np.flatnonzero(coded < 128) + 1
    begin = np.concatenate([[0], ends[:-1]])
    value = np.zeros(len(ends), np.int64)
    for k in range(5):
        some = begin + k < ends
        value[some] |= (coded[begin[some] + k].astype(np.int64) & 127) << 7 * k
    return value, ends


def _block(texts: list[str], special: re.Pattern, pattern: regex.Pattern) -> tuple[list[str], np.ndarray, np.ndarray, list[int]]:
    """Pre-tokens, where each one's postings begin, the postings, and each document's special strings.

    Postings are pairs of the gap to the document before and the frequency.
    """
    words, found, times, specials = _Places(), [], [], []
    for text in texts:
        n = len(special.findall(text)) if "<|" in text else 0
        parts = special.split(text) if n else [text]
        places = np.array([words[w] for part in parts for w in _words(normalised(part))], np.int32)
        places, often = np.unique(places, return_counts=True)
        found.append(places)
        times.append(often.astype(np.int32))
        specials.append(n)
    tokens, of_word, ends = _Places(), [], []
    for w in words:
        of_word += map(tokens.__getitem__, pattern.findall(w))
        ends.append(len(of_word))
    names = sorted(tokens)  # neighbours that are alike take less room in files and shuffles
    rank = np.empty(len(names), np.int64)
    rank[[tokens[x] for x in names]] = np.arange(len(names))
    n_docs, width = max(1, len(texts)), np.diff(np.array(ends, np.int32), prepend=0)
    first = np.array(ends, np.int32) - width
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), [len(x) for x in found])
    word = np.concatenate([*found, np.empty(0, np.int32)])
    many = width[word]
    # the tokens of a document's words: a run of of_word for each word
    run = np.arange(many.sum(), dtype=np.int32) + np.repeat(first[word] - (np.cumsum(many, dtype=np.int32) - many), many)
    key = rank[np.array(of_word, np.int64)][run] * n_docs + np.repeat(doc, many)
    total = np.repeat(np.concatenate([*times, np.empty(0, np.int32)]), many)
    del found, times, doc, word, run, many, of_word, words, tokens
    order = np.argsort(key)
    key, total = key[order], total[order]
    begin = np.flatnonzero(np.diff(key, prepend=-1))
    key, total = key[begin], np.add.reduceat(total, begin).astype(np.int64) if len(begin) else np.empty(0, np.int64)
    del order
    begin = np.searchsorted(key // n_docs, np.arange(len(names) + 1))
    doc = key % n_docs
    gap = np.diff(doc, prepend=0)
    gap[begin[:-1]] = doc[begin[:-1]]
    coded, ends = varints(np.stack([gap, total], 1).ravel())
    return names, ends[2 * begin], coded, specials


def postings(docs: DataFrame, path: str) -> DataFrame:
    """(token, block, payload): the postings of a pre-token in a block; for the null token the block's documents."""
    schema = pa.schema([("token", pa.string()), ("block", pa.int64()), ("payload", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special, pattern = rules(path)
        block = TaskContext.get().partitionId() << 28

        def out(ids: list, texts: list[str]) -> Iterator[pa.RecordBatch]:
            tokens, begin, posts, specials = _block(texts, special, pattern)
            head = np.empty(len(ids), _HEAD)
            head["null"] = [x is None for x in ids]
            head["doc_id"] = [x or 0 for x in ids]
            head["n_bytes"] = [len(t.encode()) for t in texts]
            head["special"] = specials
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([block], pa.int64()), pa.array([head.tobytes()], pa.binary())], schema=schema)
            for a in range(0, len(tokens), 20_000):
                b = min(len(tokens), a + 20_000)
                lo, hi = begin[a], begin[b]
                ends = (begin[a : b + 1] - lo).astype("<i4")
                payload = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(posts[lo:hi].tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(tokens[a:b], pa.string()), pa.array(np.full(b - a, block)), payload], schema=schema)

        ids, texts, held = [], [], 0
        for part in parts:
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(text or "")
                held += len(texts[-1])
                if held >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                    yield from out(ids, texts)
                    ids, texts, held, block = [], [], 0, block + 1
        if ids:
            yield from out(ids, texts)

    return docs.select("doc_id", "text").mapInArrow(run, "token string, block long, payload binary")


@lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_tokens, over_limit."""

    @F.pandas_udf("long")
    def pieces(tokens: pd.Series) -> pd.Series:
        found = _library(path).encode_batch_fast(tokens.tolist(), add_special_tokens=False)
        return pd.Series([len(x) for x in found])

    base = materialize(postings(docs, path), "postings")
    posts = base.where("token is not null")
    counts = posts.select("token").distinct().withColumn("n", pieces("token"))
    joined = posts.join(counts, "token").select("block", "payload", "n")

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums, held = [], [], 0
        places, blocks = _Places(), []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            key, back = np.unique(np.concatenate(keys), return_inverse=True)
            return key, np.bincount(back, np.concatenate(sums), len(key))

        def out() -> Iterator[pa.RecordBatch]:
            key, total = merged()
            place = key >> 16
            begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            for a, b in zip(begin, [*begin[1:], len(key)], strict=True):
                s = np.empty(b - a, _SUM)
                s["doc"], s["n"] = key[a:b] & 65535, total[a:b]
                yield pa.RecordBatch.from_arrays([pa.array([blocks[place[a]]], pa.int64()), pa.array([s.tobytes()], pa.binary())], names=["block", "payload"])

        for part in parts:
            if not part.num_rows:
                continue
            payload = [x.as_py() for x in part.column(1)]
            values, ends = from_varints(np.frombuffer(b"".join(payload), np.uint8))
            rows = np.searchsorted(ends, np.cumsum([len(x) for x in payload])) // 2 + 1
            many = np.diff(rows, prepend=0)
            doc = np.cumsum(values[::2])
            doc -= np.repeat(np.concatenate([[0], doc[rows[:-1] - 1]]), many)
            place = np.array([places[x] for x in part.column(0).to_pylist()], np.int64)
            blocks = list(places)
            key = np.repeat(place << 16, many) | doc
            keys.append(key)
            sums.append(values[1::2] * np.repeat(part.column(2).to_numpy(), many))
            held += len(key)
            if held >= HELD:
                key, total = merged()
                keys, sums, held = [key], [total], len(key)
                if held >= HELD // 2:
                    yield from out()
                    keys, sums, held = [], [], 0
        if keys:
            yield from out()

    partial = joined.mapInArrow(add, "block long, payload binary").withColumn("head", F.lit(False))
    heads = base.where("token is null").select("block", "payload", F.lit(True).alias("head"))

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        head = np.frombuffer(group.loc[group["head"], "payload"].iat[0], _HEAD)
        total = head["special"].copy()
        for p in group.loc[~group["head"], "payload"]:
            s = np.frombuffer(p, _SUM)
            np.add.at(total, s["doc"], s["n"])
        ids = pd.array(head["doc_id"], "Int64")
        ids[head["null"] == 1] = pd.NA
        return pd.DataFrame({"doc_id": ids, "n_bytes": head["n_bytes"], "n_tokens": total, "over_limit": total > limit})

    return partial.unionByName(heads).groupBy("block").applyInPandas(finish, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
