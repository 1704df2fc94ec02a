"""MinHash near-dedup by min-max hashing.

A document's set holds its distinct word shingles. Every permutation of the hash space gives two values of the
signature, the smallest and the largest image, so half as many hash evaluations fill it. Bands of the signature
propose pairs; full sets confirm them. The number of bands follows from the threshold: a pair exactly at the
threshold is missed with a probability below MISS.

Buckets are never expanded into all their pairs. Equal sets are one class from the start. In each bucket all members
are first tested against two centres, and confirmed links are joined into components. What is left are pairs of
members that still lie in different components. Blocks of bounded size compare them by signature and give the members
that any pair may link, not the pairs, where members of the centre's component aren't compared with each other; only these are fetched with their texts, in blocks again, where a pair is looked
at in one bucket and passed over if it has become connected meanwhile; only links leave the task. So each candidate pair
ends linked, tested or already connected.

Texts move twice: to their requests and to the centre that tests them. A centre with many candidates is sent to several
tasks, once to each, so no task takes all candidates of one. Sizes and signatures sort out pairs before texts move.

Defined results: a null or blank text has an empty set, links with nothing and is kept; a text with fewer words than
a shingle is one shingle; rows that repeat a doc_id are one document in near_groups (if their texts differ, the one with
the least set digest stands for it) and, in kept_rows, one for each text; a row with a null doc_id gets n_shingles, a
null component and is kept; columns besides doc_id and text are not looked at.

Shingles are compared as 64-bit hashes of whole sets, never samples.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamestate.llm.common import SALTS, Stages, components, in_blocks, materialize

MISS = 1e-6
ROWS = 4  # signature values in a band: the minima and maxima of two permutations
BLOCK = 1_000_000  # shingles of a block of a bucket
MEMBERS = 16_384  # members of a block of a bucket, whose signatures are compared
HOT = 1024  # members of a bucket above which no join may bring it to one task
FAN = 256  # candidates that a centre tests in one task
NAMES = 1_000_000  # names of documents, of 8 bytes, up to which they are broadcast; more are joined by a shuffle


def bands_for(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - similarity**rows))


def least_equal(values: int, similarity: float, miss: float = MISS / 10) -> int:
    """The number of equal signature values that a pair at the threshold falls short of with a probability below miss."""
    total, k = 0.0, 0
    while k < values:
        total += math.comb(values, k) * similarity**k * (1 - similarity) ** (values - k)
        if total > miss:
            break
        k += 1
    return k


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class _Words(dict):
    """Hashes of the words seen, bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 64:  # longer ones hardly come again, and would fill the memory
            self[word] = h
        return h


_words = _Words()


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; only A-Z are lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    k = min(width, n)
    acc = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        acc = _mix(acc + h[j : n - k + 1 + j]) + np.uint64(j + 1)
    return np.unique(acc)


def _signature(s: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """16 bits of each minimum and maximum, mixed before as extreme values share their leading bits."""
    low = np.full(len(mul), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(mul), np.uint64)
    for at in range(0, len(s), 4096):
        v = mul[:, None] * s[None, at : at + 4096] + add[:, None]
        np.minimum(low, v.min(1), out=low)
        np.maximum(high, v.max(1), out=high)
    return (_mix(np.stack([low, high], 1).ravel()) & np.uint64(0xFFFF)).astype("<u2")


def _text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("key")


def signatures(docs: DataFrame, width: int, bands: int) -> DataFrame:
    """(doc_id, no_id, key, n_shingles, digest, sig) of every row: key names the text, digest the set; rows without an id have no sig."""
    rng = np.random.default_rng(20240229)
    perms = bands * ROWS // 2
    mul = rng.integers(1, 2**63, perms, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2**63, perms, dtype=np.uint64)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for no_id, text in zip(part["no_id"], part["text"], strict=True):
                s = shingle_set(text, width)
                if no_id or not len(s):
                    out.append((len(s), None, None))
                else:
                    out.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), _signature(s, mul, add).tobytes()))
            f = pd.DataFrame(out, columns=["n_shingles", "digest", "sig"])
            yield pd.concat([part[["doc_id", "no_id", "key"]].reset_index(drop=True), f], axis=1)

    # nulls apart, as pandas would turn ids beside a null into floats
    rows = docs.select(F.coalesce("doc_id", F.lit(0)).cast("long").alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), _text_key(), "text")
    return rows.mapInPandas(run, "doc_id long, no_id boolean, key long, n_shingles long, digest binary, sig binary")


def _buckets(classes: DataFrame, bands: int) -> DataFrame:
    """(h, b, size, c1, n1, c2, n2, c, n): the members c of each bucket h of band b with more than one, and its two centres."""
    hashes = [F.struct(F.lit(b).alias("b"), F.xxhash64(F.lit(b), F.substring("sig", 2 * ROWS * b + 1, 2 * ROWS)).alias("h")) for b in range(bands)]
    shown = classes.select("c", "n", F.explode(F.array(*hashes)).alias("s")).select("c", "n", "s.b", "s.h")
    this = F.struct("c", "n")
    shared = shown.groupBy("h").agg(
        F.count("*").alias("size"), F.min("b").alias("b"), F.min(this).alias("first"), F.min_by(this, F.xxhash64("c", F.lit(3))).alias("second")
    )
    shared = shared.where("size > 1").select("h", "b", "size", F.col("first.c").alias("c1"), F.col("first.n").alias("n1"), F.col("second.c").alias("c2"), F.col("second.n").alias("n2"))
    return shown.drop("b").join(shared, "h")


def _alike(a: DataFrame, sigs: DataFrame, least: int) -> DataFrame:
    """The pairs (x, y) with at least that many equal signature values."""
    sx, sy = (sigs.select(F.col("c").alias(k), F.col("sig").alias(f"sig_{k}")) for k in "xy")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                u, v = (np.frombuffer(b"".join(part[c]), "<u2").reshape(len(part), -1) for c in ("sig_x", "sig_y"))
                yield part.loc[(u == v).sum(1) >= least, ["x", "y"]]

    return a.join(sy, "y").join(sx, "x").select("x", "y", "sig_x", "sig_y").mapInPandas(run, "x long, y long")


def _only(docs: DataFrame, wanted: DataFrame, st: Stages) -> DataFrame:
    """(doc_id, key, text) of the rows of docs whose (doc_id, key) wanted names; a row that repeats both comes once.

    Rows are sorted out before any text moves: where few are wanted, their names reach the scan as one number each.
    """
    texts = docs.where("doc_id is not null").select("doc_id", _text_key(), "text")
    name = F.xxhash64("doc_id", "key").alias("_name")
    names = st.keep(wanted.select(name).distinct(), "wanted")
    names = F.broadcast(names) if names.count() <= NAMES else names
    there = texts.withColumn("_name", name).join(names, "_name", "left_semi").drop("_name")
    one = there.groupBy("doc_id", "key").agg(F.first("text").alias("text"))
    return one.join(wanted.distinct(), ["doc_id", "key"], "left_semi")


def _texts(requests: DataFrame, docs: DataFrame, classes: DataFrame, st: Stages) -> DataFrame:
    """requests (with a class c) and the text of a document of that class."""
    named = requests.join(classes.select("c", "doc_id", "key"), "c")
    wanted = classes.join(requests.select("c").distinct(), "c", "left_semi").select("doc_id", "key")
    return named.join(_only(docs, wanted, st), ["doc_id", "key"]).drop("doc_id", "key")


def _confirm(pairs: DataFrame, docs: DataFrame, classes: DataFrame, st: Stages, width: int, percent: int) -> DataFrame:
    """The pairs (x: centre, y: candidate) whose whole sets have 100 * intersection >= percent * union, as (u, v)."""
    degree = pairs.groupBy("x").agg(F.ceil(F.count("*") / F.lit(FAN)).cast("int").alias("parts"))
    dealt = pairs.join(degree, "x").select("x", F.pmod(F.xxhash64("y", F.lit(5)), F.col("parts")).cast("int").alias("k"), "y")
    centres = degree.select("x", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("k"), F.lit(-1).cast("long").alias("y"))
    asked = dealt.withColumn("c", F.col("y")).union(centres.withColumn("c", F.col("x")))
    rows = _texts(asked, docs, classes, st).select("x", "k", "y", "text").repartition("x", "k").sortWithinPartitions("x", "k", "y")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = np.empty(0, np.uint64)
        for part in parts:
            found = []
            for x, y, text in zip(part["x"], part["y"], part["text"], strict=True):
                if y < 0:  # the centre comes before its candidates
                    a = shingle_set(text, width)
                    continue
                b = shingle_set(text, width)
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    found.append((min(x, y), max(x, y)))
            yield pd.DataFrame(found, columns=["u", "v"]).astype("int64")

    return rows.mapInPandas(run, "u long, v long")


def _candidates(a: pd.DataFrame, b: pd.DataFrame, la: np.ndarray, lb: np.ndarray, one_block: bool, least: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each row of a with the rows of b in other components that its signature may be linked with, in the first band they share.

    la and lb are the components of the rows; the caller may join some while it takes the candidates.
    """
    band = int(a["b"].iat[0])
    sa, sb = (np.frombuffer(b"".join(x["sig"]), "<u2").reshape(len(x), -1) for x in (a, b))
    ba, bb = (np.ascontiguousarray(x.view("<u8")[:, :band]) for x in (sa, sb))  # values of an earlier band as one number
    ca, cb, na, nb = (x[c].to_numpy() for c in ("c", "n") for x in (a, b))
    for i in range(len(a)):
        ok = (lb != la[i]) & (100 * np.minimum(nb, na[i]) >= percent * np.maximum(nb, na[i]))
        at = np.flatnonzero(ok & (cb > ca[i]) if one_block else ok)
        if band:
            at = at[~(bb[at] == ba[i]).any(1)]
        at = at[(sb[at] == sa[i]).sum(1, dtype=np.uint16) >= least]
        if len(at):
            yield i, at


class _Marks:
    """A table of marked shingles that shows, for many sets at once, how many shingles each can share with one set.

    A shingle's place is the low bits of its hash, so a count is never too low; the few pairs that pass are compared whole.
    """

    BITS = 20

    def __init__(self) -> None:
        self.table = np.zeros(1 << self.BITS, np.uint8)

    def shared(self, one: np.ndarray, many: list[np.ndarray]) -> np.ndarray:
        low = np.uint64(len(self.table) - 1)
        places = np.concatenate(many)
        places &= low
        here = (one & low).view(np.int64)
        self.table[here] = 1
        starts = np.cumsum([0, *map(len, many[:-1])])
        counts = np.add.reduceat(self.table[places.view(np.int64)], starts, dtype=np.int64)
        self.table[here] = 0
        return counts


def _sides(group: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, bool]:
    one_block = bool(group["bi"].iat[0] == group["bj"].iat[0])
    group = group.sort_values("c", kind="stable")
    a = group[group["side"] == 0]
    return a, a if one_block else group[group["side"] == 1], one_block


def _classes(docs: DataFrame, st: Stages, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The signatures of all rows, and by digest the smallest doc_id reachable by links and the text's key there."""
    bands = bands_for(percent / 100)
    least = least_equal(bands * ROWS, percent / 100)
    sig = st.keep(signatures(docs, width, bands), "minmax")
    first = F.min(F.struct("doc_id", "key")).alias("first")
    by_set = sig.where("not no_id and n_shingles > 0").groupBy("digest").agg(first, F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    classes = st.keep(by_set.select(F.monotonically_increasing_id().alias("c"), "digest", "n", "sig", "first.*"), "classes")
    sigs = classes.select("c", "sig")

    members = st.keep(_buckets(classes, bands), "members")
    centre = F.explode(F.array(F.struct(F.col("c1").alias("x"), F.col("n1").alias("nx")), F.struct(F.col("c2").alias("x"), F.col("n2").alias("nx")))).alias("s")
    pairs = members.select(F.col("c").alias("y"), "n", centre).select("s.x", "y", "n", "s.nx")
    pairs = pairs.where("x <> y").where(100 * F.least("n", "nx") >= percent * F.greatest("n", "nx")).select("x", "y").distinct()
    pairs = st.keep(_alike(pairs, sigs, least), "pairs")
    links = st.keep(_confirm(pairs, docs, classes, st, width, percent), "links")
    comp = components(links)
    st.frames.append(comp)

    # a bucket of two has had its only pair tested
    lab = members.where("size > 2").select("h", "b", "size", "c", "n").join(comp.withColumnRenamed("node", "c"), "c", "left")
    lab = st.keep(lab.select("h", "b", "size", "c", "n", F.coalesce("component", "c").alias("label")), "labels")
    open_ = lab.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min_by("label", "c").alias("of_centre"), F.min("size").alias("size"))
    open_ = open_.where("lo <> hi").select("h", "of_centre", "size")
    cold = lab.where(F.col("size") <= HOT).join(open_.where(F.col("size") <= HOT).drop("size"), "h")
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s")
    hot = lab.where(F.col("size") > HOT).withColumn("_s", F.pmod(F.xxhash64("c", F.lit(9)), F.lit(SALTS)).cast("int"))
    hot = hot.join(open_.where(F.col("size") > HOT).select("h", "of_centre", salt), ["h", "_s"]).drop("_s")
    lab = cold.unionByName(hot)
    lab = st.keep(lab.select("h", "b", "c", "n", "label", (F.col("label") == F.col("of_centre")).alias("main")), "open")

    def may_link(group: pd.DataFrame) -> pd.DataFrame:
        a, b, one_block = _sides(group)
        if not len(a) or not len(b):
            return pd.DataFrame({"h": [], "c": []}, dtype="int64")
        found_a, found_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        for i, at in _candidates(a, b, a["label"].to_numpy(), b["label"].to_numpy(), one_block, least, percent):
            found_a[i] = True
            found_b[at] = True
        found = np.union1d(a["c"].to_numpy()[found_a], b["c"].to_numpy()[found_b])
        return pd.DataFrame({"h": group["h"].iat[0], "c": found}, columns=["h", "c"]).astype("int64")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        a, b, one_block = _sides(group)
        found = []
        if len(a) and len(b):
            ca, cb, na, nb, ta, tb = (x[k].to_numpy() for k in ("c", "n", "text") for x in (a, b))
            la = a["label"].to_numpy().copy()
            lb = la if one_block else b["label"].to_numpy().copy()
            marks, sets = _Marks(), {}

            def whole(c: int, text: str) -> np.ndarray:
                if c not in sets:
                    sets[c] = shingle_set(text, width)
                return sets[c]

            for i, at in _candidates(a, b, la, lb, one_block, least, percent):
                u = whole(ca[i], ta[i])
                most = marks.shared(u, [whole(cb[j], tb[j]) for j in at])
                for j in at[100 * most >= percent * (na[i] + nb[at] - most)]:
                    x, y = la[i], lb[j]
                    if x == y:
                        continue
                    v = whole(cb[j], tb[j])
                    both = len(np.intersect1d(u, v, assume_unique=True))
                    if 100 * both >= percent * (len(u) + len(v) - both):
                        for of in (la, lb):
                            of[of == max(x, y)] = min(x, y)
                        found.append((min(ca[i], cb[j]), max(ca[i], cb[j])))
        return pd.DataFrame(found, columns=["u", "v"]).astype("int64")

    seen = in_blocks(lab, "h", "c", MEMBERS, main="main").join(sigs, "c").groupBy("h", "bi", "bj")
    worth = st.keep(seen.applyInPandas(may_link, "h long, c long").distinct(), "worth")
    if not worth.isEmpty():
        weight = F.greatest("n", F.lit(BLOCK // 4096)).alias("weight")
        blocks = st.keep(in_blocks(lab.join(worth, ["h", "c"]).select("*", weight), "h", "c", BLOCK, "weight", "main"), "blocks")
        whole = _texts(blocks, docs, classes, st).join(sigs, "c")
        more = st.keep(whole.groupBy("h", "bi", "bj").applyInPandas(compare, "u long, v long").distinct(), "links")
        comp = components(links.union(more))
        st.frames.append(comp)

    reached = classes.select("c", "digest", "doc_id", "key").join(comp.withColumnRenamed("node", "c"), "c", "left")
    reached = reached.select("digest", "doc_id", "key", F.coalesce("component", "c").alias("root"))
    # roots that stand for more than one class
    first = reached.groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("first"))
    decided = reached.join(first, "root").select("digest", F.col("first.doc_id").alias("component_id"), F.col("first.key").alias("component_key"))
    return sig, st.keep(decided, "decided")


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept."""
    with Stages() as st:
        sig, decided = _classes(docs, st, width, percent)
        of_text = sig.where("not no_id").select("doc_id", "n_shingles", "digest").join(decided, "digest", "left")
        one = F.min(F.struct((F.col("n_shingles") == 0).alias("empty"), "digest", "n_shingles", "component_id")).alias("s")
        named = of_text.groupBy("doc_id").agg(one).select("doc_id", "s.n_shingles", F.coalesce("s.component_id", "doc_id").alias("component_id"))
        none = F.lit(None).cast("long")
        unnamed = sig.where("no_id").select(none.alias("doc_id"), "n_shingles", none.alias("component_id"))
        out = named.union(unnamed).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        return materialize(out, "near-groups")


def kept_rows(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs that stay: of each group of near copies the text of the smallest doc_id (then of the smallest hash).

    Every text is judged by itself, also where texts share a doc_id. Of rows that repeat id and text one stays, chosen by a
    hash of its columns; texts without words and rows without an id stay.
    """
    with Stages() as st:
        sig, decided = _classes(docs, st, width, percent)
        linked = decided.select(F.col("component_id").alias("doc_id"), F.col("component_key").alias("key")).distinct()
        rows = sig.where("not no_id").groupBy("doc_id", "key").agg(F.count("*").alias("rows"), F.first("n_shingles").alias("n"))
        rows = rows.join(linked.withColumn("linked", F.lit(True)), ["doc_id", "key"], "left")
        stays = F.coalesce("linked", F.lit(False)) | (F.col("n") == 0)
        # all but the rows that stay as they are: those that go, and those that repeat id and text
        names = materialize(rows.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), stays.alias("stays"), (F.col("rows") > 1).alias("repeated")).where("repeated or not stays"), "kept")
    marked = docs.where("doc_id is not null").withColumns({"_id": F.col("doc_id"), "_key": _text_key()})
    few = F.broadcast if names.count() <= NAMES else (lambda df: df)
    single = marked.join(few(names), ["_id", "_key"], "left_anti").drop("_id", "_key")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if f.dataType.typeName() not in ("map", "variant")])
    again = marked.join(few(names.where("repeated and stays")), ["_id", "_key"], "left_semi")
    one = again.groupBy("_id", "_key").agg(F.min_by(row, order).alias("_row")).select("_row.*")
    return single.unionByName(one).unionByName(docs.where("doc_id is null"))
