"""Ranked lexical search over a two-level quantised index.

The index is cut into segments of bounded size, each built inside one task, so building shuffles nothing. A row of it is a
term of a segment with three parallel arrays: places of the documents, one byte of impact, and the exact count. The impact
of a term in a document, (10^9 * tf) div (1000 * tf + 20 * m), is rounded up to a multiple of STEP, so that a byte bounds
it from above and the byte before it from below.

A search joins the terms of the queries to their rows and works on one segment and block of queries at a time. The first
level adds weighted bytes: an upper and a lower bound of every document. Each document whose upper bound reaches the k-th
lower bound of its segment is then scored by the second level, in exact integers; no other can be among the first k. The
first k of the segments meet in two windows.

A query is all rows of one item_id (its terms count once); items without terms return nothing. A document is a row: rows
that repeat a doc_id are ranked each by itself, and a row with a null doc_id is ranked with a null id, after equal scores
with one. Null and empty texts hold no term; they aren't counted and never returned. A text of any length is one document
of one segment. Equal scores rank by ascending doc_id, then by the place in the index. Columns besides those named are not
looked at.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gamestate.llm.common import SALTS, Stages, broadcast_if, materialize

STEP = 3922  # impacts are below 10^6, so 255 steps cover them
DOCS = 65_536  # documents of a segment
TOKENS = 4_000_000  # terms with repeats after which a segment ends
ITEMS = 256  # queries of a block
TERMS = 100_000  # terms of queries up to which they are broadcast

_KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: A-Z lower-cased, bytes that no term holds to blanks.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or c in _KEEP else 32 for c in range(256))


def _found(text: str | None) -> list[bytes]:
    """The maximal runs of digits, letters and characters beyond ASCII, only A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


@dataclass
class Index:
    """postings (segment, term, df, docs, impacts, counts), docs (segment, ids, no_id, rel) and N documents with L terms."""

    postings: DataFrame
    docs: DataFrame
    n: int
    total: int


_POSTINGS = "segment long, term string, df int, docs binary, impacts binary, counts binary, ids binary, no_id binary, rel binary"


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of values, cut at ends (numbers of values), as one Arrow array without a copy for each row."""
    cuts = np.concatenate([[0], ends]).astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def _lengths(docs: DataFrame) -> tuple[int, int]:
    """The documents with a term and their terms with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = total = 0
        for b in batches:
            for t in b.column(0):
                k = len(_found(t.as_py()))
                n, total = n + (k > 0), total + k
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "total": pa.array([total], pa.int64())})

    found = docs.select("text").mapInArrow(run, "n long, total long").agg(F.sum("n"), F.sum("total")).first()
    return found[0] or 0, found[1] or 0


def build(docs: DataFrame, st: Stages) -> Index:
    """The index of the texts of docs (doc_id, text), in tables of the shared folder."""
    n, total = _lengths(docs)

    def segment(number: int, vocabulary: dict[bytes, int], places: array, ts: array, tfs: array, ids: list, sizes: list[int]) -> Iterator[pa.RecordBatch]:
        rel = [100 - 50 + (50 * s * n) // total for s in sizes]
        m = np.array([min(r, 2**62 // 20) for r in rel], np.int64)
        t, d, f = (np.frombuffer(x, np.int64) for x in (ts, places, tfs))
        order = np.argsort(t, kind="stable")  # documents stay in order within a term
        t, d, f = t[order], d[order], f[order]
        impact = 1_000_000_000 * f // (1000 * f + 20 * m[d])
        words = list(vocabulary)
        ends = np.searchsorted(t, np.arange(len(words)), "right")
        step = 100_000
        for at in range(0, len(words), step):
            cut = slice(ends[at - 1] if at else 0, ends[min(at + step, len(words)) - 1])
            own = ends[at : at + step] - cut.start
            names = pa.array([w.decode("utf-8", "surrogatepass") for w in words[at : at + step]], pa.string())
            none = pa.nulls(len(own), pa.binary())
            df = pa.array(np.diff(np.concatenate([[0], own])).astype(np.int32))
            arrays = [_binary(v, own) for v in (d[cut].astype("<u4"), (-(-impact[cut] // STEP)).astype(np.uint8), f[cut].astype("<u4"))]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), number, np.int64)), names, df, *arrays, none, none, none], names=_NAMES)
        known = np.array([0 if i is None else i for i in ids], np.int64)
        void = np.array([i is None for i in ids], np.uint8)
        one = [pa.array([x], k) for x, k in ((number, pa.int64()), (None, pa.string()), (len(ids), pa.int32()), *[(None, pa.binary())] * 3, *[(x.tobytes(), pa.binary()) for x in (known, void, m)])]
        yield pa.RecordBatch.from_arrays(one, names=_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        new = lambda: ({}, array("q"), array("q"), array("q"), [], [])
        vocabulary, places, ts, tfs, ids, sizes = state = new()
        held = 0
        for b in batches:
            for i, text in zip(b.column(0), b.column(1), strict=True):
                counts = Counter(words := _found(text.as_py()))
                if not words:
                    continue
                places.extend([len(ids)] * len(counts))
                ts.extend([vocabulary.setdefault(w, len(vocabulary)) for w in counts])
                tfs.extend(counts.values())
                ids.append(i.as_py())
                sizes.append(len(words))
                held += len(words)
                if held >= TOKENS or len(ids) >= DOCS:
                    yield from segment(number, *state)
                    vocabulary, places, ts, tfs, ids, sizes = state = new()
                    number, held = number + 1, 0
        if ids:
            yield from segment(number, *state)

    rows = st.keep(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _POSTINGS), "search-index")
    postings = rows.where("term is not null").select("segment", "term", "df", "docs", "impacts", "counts")
    return Index(postings, rows.where("term is null").select("segment", "ids", "no_id", "rel"), n, total)


_NAMES = [f.split()[0] for f in _POSTINGS.split(", ")]


def _asked(items: DataFrame, index: Index, st: Stages) -> tuple[DataFrame, int]:
    """(block, term, w, asks), a term of a block of queries with its weight and the queries that ask for it, and the number of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(i.as_py(), w.decode("utf-8", "surrogatepass")) for i, t in zip(b.column(0), b.column(1), strict=True) for w in set(_found(t.as_py()))]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())], names=["item_id", "term"])

    pairs = items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(run, "item_id long, term string").distinct()
    pairs = st.keep(pairs, "search-items")
    # items fall into blocks by hash, and so a block holds about ITEMS of them
    blocks = max(1, -(-pairs.select("item_id").distinct().count() // ITEMS))
    block = F.pmod(F.xxhash64(F.coalesce("item_id", F.lit(0)), F.lit(11)), F.lit(blocks)).cast("int")
    few = broadcast_if(pairs.select("term").distinct(), TERMS, "search-terms")
    df = index.postings.select("term", "df").join(few, "term", "left_semi").groupBy("term").agg(F.sum("df").cast("long").alias("df"))
    w = F.floor(1000 * F.log((F.lit(2.0 * index.n) + 2) / (2.0 * F.col("df") + 1))).cast("long").alias("w")
    asked = pairs.join(df.select("term", w), "term").where("w > 0")
    asks = F.collect_list(F.coalesce(F.col("item_id").cast("string"), F.lit(""))).alias("asks")
    return st.keep(asked.groupBy(block.alias("block"), "term", "w").agg(asks), "search-asked"), blocks


def search(index: Index, items: DataFrame, k: int, st: Stages) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest score above 0 of each query."""
    asked, blocks = _asked(items, index, st)
    if asked.count() <= TERMS:
        rows = index.postings.join(F.broadcast(asked), "term")
    else:  # a term has a row in each segment: these are dealt over copies of the query's row
        salted = asked.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = index.postings.withColumn("_s", F.pmod(F.xxhash64("segment"), F.lit(SALTS)).cast("int")).join(salted, ["term", "_s"]).drop("_s")
    rows = rows.select("segment", "block", "w", "asks", "docs", "impacts", "counts")

    def best(key: tuple, rows: pd.DataFrame, about: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(about):
            ids, void, m = (np.frombuffer(about[c].iat[0], t) for c, t in (("ids", "<i8"), ("no_id", "u1"), ("rel", "<i8")))
            size = len(ids)
            post = [(int(w), np.frombuffer(d, "<u4"), np.frombuffer(q, "u1"), np.frombuffer(f, "<u4")) for w, d, q, f in zip(rows["w"], rows["docs"], rows["impacts"], rows["counts"], strict=True)]
            of: dict[str, list[int]] = {}
            for at, asks in enumerate(rows["asks"]):
                for item in asks:
                    of.setdefault(item, []).append(at)
            for item, ats in of.items():
                upper, slack = np.zeros(size, np.int64), np.zeros(size, np.int64)
                for at in ats:
                    w, d, q, _ = post[at]
                    upper[d] += (w * STEP) * q.astype(np.int64)
                    slack[d] += w * (STEP - 1) * (q > 0)
                lower = upper - slack
                live = np.flatnonzero(upper > 0)
                if len(live) > k:
                    kth = np.partition(lower[live], len(live) - k)[len(live) - k]
                    live = live[upper[live] >= kth]
                exact = np.zeros(size, np.int64)
                chosen = np.zeros(size, bool)
                chosen[live] = True
                for at in ats:
                    w, d, _, f = post[at]
                    on = chosen[d]
                    d, f = d[on], f[on].astype(np.int64)
                    exact[d] += w * (1_000_000_000 * f // (1000 * f + 20 * m[d]))
                live = live[exact[live] > 0]
                live = live[np.lexsort((live, ids[live], void[live], -exact[live]))][:k]
                out += [(item, int(key[0]), int(p), None if void[p] else int(ids[p]), int(exact[p])) for p in live]
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        return pa.table({"item": pa.array(cols[0], pa.string()), **{c: pa.array(v, pa.int64()) for c, v in zip(("segment", "place", "doc_id", "score"), cols[1:], strict=True)}})

    def arrow(key: tuple, rows: pa.Table, about: pa.Table) -> pa.Table:
        return best([x.as_py() for x in key], rows.to_pandas(), about.to_pandas())

    about = index.docs.select(F.col("segment").alias("s"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), "ids", "no_id", "rel")
    found = rows.groupBy("segment", "block").cogroup(about.groupBy("s", "b")).applyInArrow(arrow, "item string, segment long, place long, doc_id long, score long")
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), "segment", "place"]
    part = F.pmod(F.xxhash64("segment"), F.lit(SALTS))
    first = found.withColumn("_r", F.row_number().over(Window.partitionBy("item", part).orderBy(*order))).where(F.col("_r") <= k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order)).alias("rank")
    ranked = first.select(F.when(F.col("item") != "", F.col("item").cast("long")).alias("item_id"), rank, "doc_id", "score")
    return ranked.where(F.col("rank") <= k)


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The first k documents of docs for each item, through an index of all of them."""
    with Stages() as st:
        return materialize(search(build(docs, st), items, k, st), "search")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def oracle(k: int = 50) -> str:
    return f"""
with found as (select doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from documents),
tf as (select doc_id, term, count(*)::bigint as tf from found group by all),
len as (select doc_id, sum(tf)::bigint as n from tf group by all),
stats as (select count(*)::bigint as docs, sum(n)::bigint as total from len),
df as (select term, count(*)::bigint as df from tf group by all),
asked as (select distinct item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from benchmark),
weighed as (select item_id, term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w from asked join df using (term), stats),
scored as (
    select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::bigint as score
    from weighed join tf using (term) join len using (doc_id), stats group by all
)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
from scored where score > 0
qualify rank <= {k}
"""
