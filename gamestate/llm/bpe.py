"""Byte-level BPE: encoding by a queue of merge ranks over a doubly linked symbol list, decoding by concatenation.

The vocabulary file is one of the public tokenizers' JSON files; its path is a parameter. Pieces of text that recur are
encoded once per task and remembered in a bounded memory. Results equal those of the tokenizers library without added
special tokens, truncation or padding; strings of special tokens inside a text become their ids, as there.

Defined results: a null text counts as empty and has no tokens; rows are treated one by one, so repeated rows repeat
their result; columns besides doc_id and text are not looked at. A text of any length is encoded whole, in a time that
grows with its length (and, within one pre-token, with its logarithm).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The pattern that cuts a text into pre-tokens before byte-level merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBER = 200_000
#: Longer pieces hardly come again; they are made anew, so that the memory is bounded in bytes too.
LONGEST_KNOWN = 64


def byte_letters() -> dict[int, str]:
    """The printable letter that vocabulary files write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Memory(dict):
    """Values by piece; at the bound the older half is forgotten."""

    def __init__(self, make, bound: int = REMEMBER):
        super().__init__()
        self.make, self.bound, self.old = make, bound, {}

    def __missing__(self, piece):
        if len(piece) > LONGEST_KNOWN:
            return self.make(piece)
        value = self.old.get(piece)
        if value is None:
            value = self.make(piece)
        if len(self) >= self.bound:
            self.old = dict(self)
            self.clear()
        self[piece] = value
        return value


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        vocab = spec["model"]["vocab"]
        self.bytes_of = [b""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for s, i in vocab.items():
            if all(c in back for c in s):
                self.bytes_of[i] = bytes(back[c] for c in s)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for s, i in self.special.items():
            self.bytes_of[i] = s.encode()
        self.byte_id = [vocab[letters[b]] for b in range(256)]
        self.rank, self.made = {}, []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocab[a] << 20 | vocab[b]] = rank
            self.made.append(vocab[a + b])
        self.cut = regex.compile(PATTERN)
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.remembered = Memory(self.piece)

    def merge_all(self, piece: str) -> tuple[int, ...]:
        """Ids of one pre-token: the pair of lowest rank, leftmost first, is merged until none is left.

        The queue holds rank << 32 | place. An entry is stale if the pair that now begins at its place has another rank.
        """
        byte_id = self.byte_id
        ids = [byte_id[b] for b in piece.encode()]
        n = len(ids)
        if n == 1:
            return (ids[0],)
        rank, made, push, pop = self.rank.get, self.made, heapq.heappush, heapq.heappop
        queue = [r << 32 | i for i in range(n - 1) if (r := rank(ids[i] << 20 | ids[i + 1])) is not None]
        if not queue:
            return tuple(ids)
        heapq.heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            top = pop(queue)
            i, r = top & 0xFFFFFFFF, top >> 32
            j, left = after[i], ids[i]
            if left < 0 or j >= n or rank(left << 20 | ids[j]) != r:
                continue
            new = ids[i] = made[r]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank(new << 20 | ids[k])
                if r is not None:
                    push(queue, r << 32 | i)
            h = before[i]
            if h >= 0:
                r = rank(ids[h] << 20 | new)
                if r is not None:
                    push(queue, r << 32 | h)
        return tuple([x for x in ids if x >= 0])

    def piece(self, piece: str) -> tuple[tuple[int, ...], str, bytes]:
        """Ids of a pre-token, the same as decimal text, and the vocabulary strings of the ids put together."""
        ids = self.merge_all(piece)
        return ids, ",".join(map(str, ids)), b"".join([self.bytes_of[i] for i in ids])

    def pieces(self, text: str) -> list[tuple[tuple[int, ...], str, bytes]]:
        """The encoded pre-tokens of a text, in order."""
        found = []
        for k, part in enumerate(self.split_special.split(text)):
            if k % 2:
                i = self.special[part]
                found.append(((i,), str(i), self.bytes_of[i]))
            else:
                found += map(self.remembered.__getitem__, self.cut.findall(part))
        return found

    def encode(self, text: str) -> list[int]:
        return [i for p in self.pieces(text) for i in p[0]]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def named_texts(docs: DataFrame) -> DataFrame:
    """doc_id, no_id and text. Pandas would turn ids beside a null into floats, so nulls are marked apart."""
    return docs.select(F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), F.coalesce("text", F.lit("")).alias("text"))


def own_id() -> Column:
    return F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id")


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array<int>) and the text decoded from them, for every row."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(path)
        for part in parts:
            ids = [e.encode(t) for t in part["text"]]
            yield pd.DataFrame({"doc_id": part["doc_id"], "no_id": part["no_id"], "ids": ids, "decoded": [e.decode(x) for x in ids]})

    out = named_texts(docs).mapInPandas(run, "doc_id long, no_id boolean, ids array<int>, decoded string")
    return out.select(own_id(), "ids", "decoded")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row; ids stay inside the task."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(path)
        for part in parts:
            out = []
            for text in part["text"]:
                p = e.pieces(text)
                ids, decoded = ",".join([x[1] for x in p]), b"".join([x[2] for x in p]).decode("utf-8", "replace")
                n = sum([len(x[0]) for x in p])
                out.append((n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
            f = pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            f["doc_id"], f["no_id"] = part["doc_id"].to_numpy(), part["no_id"].to_numpy()
            yield f

    out = named_texts(docs).mapInPandas(run, "doc_id long, no_id boolean, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.select(own_id(), "n_tokens", "ids_sha256", "decoded_sha256")
