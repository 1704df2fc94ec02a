"""Document fingerprints: bottom-k sketches of word-shingle hashes, in DataFrame functions alone.

The sketch of a text is the sorted array of the K smallest distinct shingle hashes (HASH_BITS bits each). The sketch of
a whole is the K smallest of the union of its parts' sketches, so sketches merge across parts. Two sketches estimate
resemblance and containment from the K smallest of their union, and one sketch the number of distinct shingles.

Defined results: a null or blank text has no shingles and an empty sketch; a text with fewer words than a shingle is
one shingle; two empty sketches are alike (1.0) and an empty one is unlike (0.0) any other. Words end at ASCII white
space. A text of any length is sketched whole, in one row's memory. The next document of several with one doc_id is that of
the next text hash; rows that repeat id and text follow each other.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 128
WIDTH = 5
HASH_BITS = 48


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value evaluated once however often `then` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Hashes of the word shingles of a text, with repeats."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def shingles(h: Column) -> Column:
        n = F.size(h)
        many = F.transform(F.sequence(F.lit(1), n - (width - 1)), lambda i: F.xxhash64(F.slice(h, i, F.lit(width))))
        return F.when(n >= width, many).when(n > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    return _once(F.transform(words, lambda w: F.xxhash64(w)), shingles)


def sketch(text: Column, width: int = WIDTH, k: int = K) -> Column:
    cut = F.transform(shingle_hashes(text, width), lambda h: F.shiftrightunsigned(h, 64 - HASH_BITS))
    return F.slice(F.sort_array(F.array_distinct(cut)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_all(parts: DataFrame, keys: list[str], column: str, k: int = K) -> DataFrame:
    """The sketch of each group's parts. Only hashes that can be among the k smallest of a group are gathered."""
    h = parts.select(*keys, F.explode(column).alias("_h")).distinct()
    low = h.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_h"))).where(F.col("_r") <= k)
    return low.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets."""

    def share(low: Column) -> Column:
        shared = F.size(F.array_intersect(low, F.array_intersect(a, b)))
        return F.when(F.size(low) == 0, 1.0).otherwise(shared / F.greatest(F.size(low), F.lit(1)))

    return _once(merge(a, b, k), share)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    last = F.element_at(a, F.greatest(F.size(a), F.lit(1)))
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * float(2**HASH_BITS) / (last + 1))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too."""
    union = distinct_shingles(merge(a, b, k), k)
    share = resemblance(a, b, k) * union / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(share, F.lit(1.0)))


def as_text(a: Column) -> Column:
    """Fixed-width hexadecimal of the sketch."""
    digits = HASH_BITS // 4
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), digits, "0")), "")


SUB = 8192  # numbers of ranges within one id


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")), F.lit(17))


def _cut_points(docs: DataFrame, buckets: int) -> tuple[list[int], dict[int | None, int]]:
    """Ids at which ranges begin, and the ids (None: the null ids) so frequent that their texts' hashes cut them again, with the number of cuts."""
    if buckets < 2:
        return [], {}
    shares = F.expr(f"array({', '.join(f'{i / buckets}D' for i in range(1, buckets))})")
    found = docs.agg(F.percentile_approx("doc_id", shares, F.lit(20 * buckets)).alias("p"), F.count_if(F.col("doc_id").isNull()).alias("void"), F.count("*").alias("n")).first()
    points = found["p"] or []
    heavy: dict[int | None, int] = {i: n + 1 for i, n in Counter(points).items() if n > 1}
    void = math.ceil(buckets * found["void"] / max(found["n"], 1))
    return sorted(set(points)), {k: min(v, SUB - 2) for k, v in {**heavy, None: void}.items() if v > 1}


def _place(doc_id: Column, text_hash: Column, cuts: list[int], heavy: dict[int | None, int]) -> Column:
    """The number of a row's range, in the order of doc_id (nulls first) and of the text's hash where an id is frequent."""
    base = F.lit(0)
    if cuts:
        step = max(1, int(len(cuts) ** 0.5))
        longs = lambda values: F.expr(f"array({', '.join(f'{c}L' for c in values)})")
        coarse = F.size(F.filter(longs(cuts[::step]), lambda c: c <= doc_id))
        lo = F.greatest((coarse - 1) * step, F.lit(0))
        base = 1 + lo + F.size(F.filter(F.slice(longs(cuts), lo + 1, F.lit(step)), lambda c: c <= doc_id))
    share = F.shiftrightunsigned(text_hash.bitwiseXOR(F.lit(-(2**63))), 33)  # 31 bits, in the order of the hash
    part = lambda n: F.shiftright(share * F.lit(n).cast("long"), 31).cast("int")
    named = {k: v for k, v in heavy.items() if k is not None}
    sub = F.lit(0)
    if named:
        pieces = F.create_map(*[F.lit(x) for k, v in named.items() for x in (k, v)])
        own = F.element_at(pieces, doc_id)
        # ids beyond a frequent one, in the range that it begins, come after its last part
        starts = F.element_at(pieces, F.element_at(F.expr(f"array({', '.join(f'{c}L' for c in cuts)})"), F.greatest(base - 1, F.lit(1))))
        sub = F.when(own.isNotNull(), part(1) + F.shiftright(share * own, 31).cast("int")).otherwise(F.when(base > 1, F.coalesce(starts, F.lit(0))).otherwise(0))
    void = part(heavy[None]) if None in heavy else F.lit(0)
    return F.when(doc_id.isNull(), void).otherwise(SUB + base * SUB + sub).cast("int")


def edited_fingerprints(docs: DataFrame, width: int = WIDTH, k: int = K, buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose second half gives way to the next document's beginning.

    Documents are dealt out in ranges of doc_id, so that the next document is a neighbour in its range; the first row
    of each range is copied to the one before. Rows with equal or null doc_ids are ordered by their texts' hashes, and an id
    that many rows share is cut into ranges by them, so no range takes all of it.
    """
    spark = docs.sparkSession
    buckets = buckets or min(4096, 3 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), _text_hash().alias("h"))
    cuts, heavy = _cut_points(docs, buckets)
    placed = own.withColumn("bucket", _place(F.col("doc_id"), F.col("h"), cuts, heavy))
    order = F.struct(F.col("doc_id").isNotNull(), F.coalesce("doc_id", F.lit(0)), "h")
    firsts = placed.groupBy("bucket").agg(F.min_by(F.struct("doc_id", "h"), order).alias("first"))
    # one row a range: its first document is wanted by the range before it, round to the last
    ring = sorted((r for r in firsts.collect()), key=lambda r: r["bucket"])
    guests = [(*r["first"], ring[i - 1]["bucket"], i == 0) for i, r in enumerate(ring)]
    ghost = spark.createDataFrame(guests, "g long, gh long, bucket int, wraps boolean")
    # rows that repeat a guest's id and text are one guest; names are looked at before texts are grouped
    copies = own.join(F.broadcast(ghost), F.col("doc_id").eqNullSafe(F.col("g")) & (F.col("h") == F.col("gh")))
    copies = copies.groupBy("doc_id", "h", "bucket", "wraps").agg(F.first("text").alias("text"))
    every = placed.select("doc_id", "h", "text", "bucket", F.lit(0).alias("guest")).union(
        copies.select("doc_id", "h", "text", "bucket", F.when(F.col("wraps"), 2).otherwise(1))
    )
    every = every.repartition("bucket").withColumn("sketch", sketch(F.col("text"), width, k))
    # guests stand last: the next range's first row, or the very first row behind the last
    w = Window.partitionBy("bucket").orderBy("guest", F.asc_nulls_first("doc_id"), "h", "text")
    every = every.withColumns({"next_text": F.lead("text").over(w), "next_sketch": F.lead("sketch").over(w)}).where("guest = 0")
    edited = F.concat(F.expr("left(text, char_length(text) - char_length(text) div 2)"), F.expr("left(next_text, cast(char_length(text) div 2 as int))"))
    out = every.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    out = out.withColumn("edited_sketch", sketch(F.col("edited"), width, k))
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("distinct_shingles"),
        containment(F.col("edited_sketch"), F.col("sketch"), k).alias("edited_in_text"),
    )
