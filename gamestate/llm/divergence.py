"""Source divergence audit: how the word use of each source of a language departs from the language and its other sources.

Counts leave a task summed by (lang, source, term). A language keeps the terms that at least LEAST of its documents hold;
all arithmetic on them is exact: p = 1 + floor(10^9 * (count + 1) / (N + V)), f = floor((p - q)^2 / q).

Terms of a group: terms with about the same count in the group form a bucket, whose largest p and smallest probability in
the language bound f from above. The buckets are taken best first until they hold the wanted number of terms; the last of
the best so far is a bar that the final list can't fall below. Then all buckets whose bound reaches the bar are evaluated;
those strictly below it never are.

Pairs of sources: the sum of f over all kept terms splits into sums that follow from one group's counts alone (all terms,
as if the other group had none) and corrections for terms that both hold. The latter come from the postings of the terms,
in blocks of terms and of sources; sums leave a task, never pairs.

Defined results: null text, lang and source count as ''. Rows that repeat a document are documents of their own. A group
without kept terms (also one whose texts are all empty) has counts of 0 and N 0. With V 0 all values of pairs are 0 and
there are no terms. Equal values rank by the item's bytes. Long texts are read whole. Other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gamestate.llm.common import SALTS, Stages, broadcast_if, materialize

LEAST = 3
TOP = 200
HELD = 500_000  # different (lang, source, term) that a task holds before it hands them on
GROUPS = 100_000  # groups of sources up to which their sums are broadcast
SOURCES = 256  # sources of a block of the pairs
POSTINGS = 250_000  # postings of a block of terms
PAIRS = 2_000_000  # pairs that a task looks at together

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, c, d): occurrences and documents; a row without a term for each task's groups."""

    def flush(found: dict[tuple, dict[bytes, int]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), words in found.items():
            n = len(words) + 1
            both = np.fromiter(words.values(), np.int64, n - 1)
            terms = pa.array([None, *words], pa.binary()).cast(pa.string())
            names = [pa.DictionaryArray.from_arrays(np.zeros(n, np.int32), pa.array([x])).cast(pa.string()) for x in (lang, source)]
            counts = [pa.array(np.concatenate([[0], x])) for x in (both >> 32, both & 0xFFFFFFFF)]
            yield pa.RecordBatch.from_arrays([*names, terms, *counts], names=["lang", "source", "term", "c", "d"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # occurrences and documents of a word in one number, the former above 32 bits
        found: dict[tuple, dict[bytes, int]] = {}
        held = read = 0
        for b in batches:
            for text, lang, source in zip(*(b.column(k) for k in range(3)), strict=True):
                words = found.setdefault((lang.as_py(), source.as_py()), {})
                before = len(words)
                terms = text.as_py().encode("utf-8", "surrogatepass").translate(_TABLE).split()
                for w, c in Counter(terms).items():
                    words[w] = words.get(w, 0) + (c << 32) + 1
                held, read = held + len(words) - before, read + len(terms)
                if held >= HELD or read >= 1 << 30:
                    yield from flush(found)
                    found, held, read = {}, 0, 0
        yield from flush(found)

    rows = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    return rows.mapInArrow(run, "lang string, source string, term string, c long, d long").groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))


def _p(c: Column, n: Column, v: Column) -> Column:
    """1 + floor(10^9 * (c + 1) / (n + v)), exact also beyond 64 bits."""
    whole = (c + 1).cast("decimal(38,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    small = F.lit(1_000_000_000) * (c + 1)
    return F.when(c < 9_000_000_000, F.call_function("div", small, n + v)).otherwise(F.call_function("div", whole.cast("decimal(38,0)"), (n + v).cast("decimal(20,0)"))) + 1


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _bucket(c: Column) -> Column:
    """The count below 1024, then ranges of the same first ten bits."""
    bits = F.floor(F.log2(c.cast("double"))).cast("int")
    wide = F.greatest(bits - 9, F.lit(0))
    return F.when(c < 1024, c).otherwise(wide.cast("long") * 4096 + F.floor(c / F.pow(F.lit(2.0), wide)).cast("long"))


def _terms(kept: DataFrame, top: int, st: Stages) -> DataFrame:
    """The part `term` from kept (lang, source, term, c, p, q): best buckets first, up to the bar."""
    group = ["lang", "source"]
    above = kept.where("c > 0 and p > q").select(*group, "term", "p", "q", _bucket(F.col("c")).alias("bucket"))
    above = st.keep(above, "divergence-terms")
    bounds = above.groupBy(*group, "bucket").agg(F.count("*").alias("n"), _f(F.max("p"), F.min("q")).alias("bound"))
    before = F.sum("n").over(Window.partitionBy(*group).orderBy(F.desc("bound"), "bucket").rowsBetween(Window.unboundedPreceding, -1))
    bounds = st.keep(bounds.withColumn("before", F.coalesce(before, F.lit(0))), "divergence-buckets")

    def evaluated(chosen: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64("term"), F.lit(SALTS))
        order = [F.desc("value"), "term"]
        some = above.join(chosen.select(*group, "bucket"), [*group, "bucket"]).select(*group, "term", _f(F.col("p"), F.col("q")).alias("value"))
        some = some.withColumn("_r", F.row_number().over(Window.partitionBy(*group, part).orderBy(*order))).where(F.col("_r") <= top).drop("_r")
        return some.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= top)

    bar = evaluated(bounds.where(F.col("before") < top)).where(F.col("rank") == top).select(*group, F.col("value").alias("bar"))
    open_ = bounds.join(bar, group, "left").where(F.coalesce("bar", F.lit(-1)) <= F.col("bound"))
    return evaluated(open_).select(*group, F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _both(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, other, more): for pairs of sources the sum over terms that both hold of what one-sided sums get wrong."""
    blocks = groups.groupBy("lang").agg(F.ceil(F.count("*") / F.lit(SOURCES)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    parts = max(64, kept.count() // POSTINGS)
    rows = kept.where("c > 0").join(blocks, "lang").withColumn("i", own).withColumn("t", F.pmod(F.xxhash64("term", F.lit(3)), F.lit(parts)).cast("int"))
    to = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("i", j).alias("bi"), F.greatest("i", j).alias("bj")))).alias("b")
    rows = rows.select("lang", "t", "source", "term", "p", "p0", "i", to).select("lang", "t", "b.bi", "b.bj", "i", "source", "term", "p", "p0")

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) * (p - q) // q

    def sums(key: tuple, group: pa.Table) -> pa.Table:
        lang, _, bi, bj = (x.as_py() for x in key)
        source = group["source"].combine_chunks().dictionary_encode()
        names, s = source.dictionary.to_pylist(), source.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        term = group["term"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        i, p, p0 = (group[c].to_numpy() for c in ("i", "p", "p0"))
        order = np.argsort(term, kind="stable")
        s, i, p, p0, term = s[order], i[order], p[order], p0[order], term[order]
        lo, hi = np.searchsorted(term, term), np.searchsorted(term, term, "right")
        size = len(names)
        total = np.zeros(size * size, np.int64)
        ends = np.cumsum(hi - lo)
        at = 0
        while at < len(term):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
            n = (hi - lo)[at:to]
            a = np.repeat(np.arange(at, to), n)
            b = np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + lo[a]
            ok = (s[a] != s[b]) & ((i[a] != i[b]) if bi != bj else True)
            a, b = a[ok], b[ok]
            more = f(p[a], p[b]) - f(p[a], p0[b]) - f(p0[a], p[b]) + f(p0[a], p0[b])
            np.add.at(total, s[a] * size + s[b], more)
            at = to
        found = np.flatnonzero(total)
        return pa.table({"lang": pa.array([lang] * len(found), pa.string()), "source": pa.array([names[x // size] for x in found], pa.string()), "other": pa.array([names[x % size] for x in found], pa.string()), "more": pa.array(total[found], pa.int64())})

    summed = rows.groupBy("lang", "t", "bi", "bj").applyInArrow(sums, "lang string, source string, other string, more long")
    return summed.groupBy("lang", "source", "other").agg(F.sum("more").alias("more"))


def _pairs(kept: DataFrame, groups: DataFrame, few: bool, st: Stages) -> DataFrame:
    """The part `pair` of each group with each other source of its language."""
    hint = F.broadcast if few else (lambda df: df)
    histogram = st.keep(kept.where("c > 0").groupBy("lang", "source", "p").agg(F.count("*").alias("n")), "divergence-histogram")
    other = hint(groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0")))
    # a distinct count of a group meets each other source once, as the result has each pair of them
    alone = histogram.join(other, "lang").where("source <> other")
    q0, p, n = F.col("q0"), F.col("p"), F.col("n")
    held = groups.select("lang", "source", "p0", "v").join(histogram.groupBy("lang", "source").agg(F.sum("n").alias("held")), ["lang", "source"], "left")
    held = held.select("lang", "source", "p0", "v", F.coalesce("held", F.lit(0)).alias("held"))
    one = alone.groupBy("lang", "source", "other").agg(F.sum(n * _f(p, q0)).alias("as_p"))
    two = alone.groupBy("lang", F.col("other").alias("source"), F.col("source").alias("other")).agg(F.sum(n * _f(q0, p)).alias("as_q"))
    pairs = held.join(hint(held.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"), F.col("held").alias("held_q"))), "lang").where("source <> other")
    key = ["lang", "source", "other"]
    pairs = pairs.join(one, key, "left").join(two, key, "left").join(_both(kept, groups), key, "left")
    none = (F.col("v") - F.col("held") - F.col("held_q")) * _f(F.col("p0"), F.col("q0"))
    value = F.when(F.col("v") == 0, 0).otherwise(none + sum(F.coalesce(F.col(c), F.lit(0)) for c in ("as_p", "as_q", "more")))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other"))
    valued = pairs.select("lang", "source", "other", value.cast("long").alias("value"))
    return valued.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", rank.alias("rank"))


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of docs (text, lang, source): other sources, and the terms a source has too often."""
    with Stages() as st:
        counts = st.keep(_counts(docs), "divergence-counts")
        words = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("c").alias("cl"), F.sum("d").alias("dl")).where(F.col("dl") >= least)
        kept = st.keep(counts.where("term is not null").join(words.drop("dl"), ["lang", "term"]).select("lang", "source", "term", "c", "cl"), "divergence-kept")
        langs = kept.groupBy("lang", "term").agg(F.first("cl").alias("cl")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("cl").alias("nl"))
        sizes = kept.groupBy("lang", "source").agg(F.sum("c").alias("n"))
        groups = counts.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
        groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "nl")])
        p0 = F.when(F.col("v") > 0, _p(F.lit(0).cast("long"), F.col("n"), F.col("v")))
        groups = st.keep(groups.withColumn("p0", p0), "divergence-groups")
        few = groups.count() <= GROUPS
        sized = kept.join(F.broadcast(groups) if few else groups, ["lang", "source"])
        sized = sized.select("lang", "source", "term", "c", "p0", _p(F.col("c"), F.col("n"), F.col("v")).alias("p"), _p(F.col("cl"), F.col("nl"), F.col("v")).alias("q"))
        sized = st.keep(sized, "divergence-sized")
        return materialize(_pairs(sized, groups, few, st).union(_terms(sized, top, st)), "divergence")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def oracle(least: int = LEAST, top: int = TOP) -> str:
    return f"""
with d as (select row_number() over () as id, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
words as (select id, lang, source, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from d),
counts as (select lang, source, term, count(*)::bigint as c from words group by all),
kept as (select lang, term, count(*)::bigint as cl from words group by all having count(distinct id) >= {least}),
langs as (select lang, count(*)::bigint as v, sum(cl)::bigint as nl from kept group by all),
groups as (select distinct lang, source from d),
sizes as (select lang, source, sum(c)::bigint as n from counts join kept using (lang, term) group by all),
g as (select lang, source, coalesce(n, 0) as n, coalesce(v, 0) as v, coalesce(nl, 0) as nl from groups left join sizes using (lang, source) left join langs using (lang)),
every as (
    select lang, source, term, coalesce(c, 0) as c,
        1 + (1000000000 * (coalesce(c, 0) + 1)) // (n + v) as p, 1 + (1000000000 * (cl + 1)) // (nl + v) as q
    from g join kept using (lang) left join counts using (lang, source, term)
),
pairs as (
    select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::bigint as value
    from every a join every b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
),
valued as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0) as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
    union all
    select lang, source, 'term', term, ((p - q) * (p - q)) // q from every where c > 0 and p > q
)
select lang, source, part, item, value, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank
from valued qualify part = 'pair' or rank <= {top}
"""
