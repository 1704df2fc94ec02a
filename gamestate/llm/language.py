"""Language identification by Bayesian evidence fusion.

Four pieces of evidence are put together: the likelihood of the text's letter trigrams under each language, the
declared markup language given each language, and the prior of the address, smoothed from all addresses to the address
suffix, from the suffix to the domain and from the domain to the host. Counts of the prior and of the declarations are
soft: sums of the text posteriors by grouped aggregation over all rows. A row's own contribution is taken out of its
host's counts. Trigrams depend on each other, so their log likelihood counts as that of at most TEXT_WEIGHT of them.

Every label that a text with letters has is a class. The trigram model is fitted on about MAX_LABELLED distinct labelled
texts, chosen by a hash within each language: the languages share that number evenly, what a small one leaves over goes
to the others, and none has less than LEAST_LABELLED or all its texts. An extra class, UNKNOWN, finds every trigram
equally likely; text in another language or script lands there.

A row is accepted if it has letters, its language is known and its posterior is at least ACCEPT. Defined results: null,
empty or letterless text is UNKNOWN and not accepted; a null or malformed address has the empty host, domain and
suffix; a missing or foreign declaration counts as such; the labels "", "?" and UNKNOWN are none; repeated rows repeat; of
equal posteriors the first class by name counts. Texts and pages are read whole in a time in proportion to their length.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamestate.llm.common import broadcast_if, materialize

UNKNOWN = "und"
MAX_LABELLED = 20_000
LEAST_LABELLED = 50
BUCKETS = 1 << 15
TEXT_WEIGHT = 40.0
SMOOTH = 8.0
ACCEPT = 0.5
#: Priors of so many hosts at most (of some 300 bytes each) are broadcast.
MANY_HOSTS = 20_000

_HASHES = 1 << 53
_LETTER = "[\\p{L}\\p{Nl}\\p{No}]"  # what _GAP leaves of a text
_GAP = re.compile(r"[\W\d_]+")
_OPEN = re.compile(r"<!--|<(script|style)\b", re.I)
_CLOSE = {k: re.compile(rf"</{k}\s*>", re.I) for k in ("script", "style")} | {None: re.compile("-->")}
_TAG = re.compile(r"<[^>]*>")
_HTML = re.compile(r"<html\b", re.I)
_LANG = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z]{2,3})", re.I)


def _shown(page: str) -> str:
    """A page without comments, scripts and styles; what is never closed stays. One pass: a kind without an end is looked for once."""
    out, kept, at, lost = [], 0, 0, set()
    while m := _OPEN.search(page, at):
        kind = m[1] and m[1].lower()
        end = None if kind in lost else _CLOSE[kind].search(page, m.end())
        if end is None:
            lost.add(kind)
            at = m.end()
            continue
        out.append(page[kept : m.start()])
        kept = at = end.end()
    return " ".join([*out, page[kept:]])


def page_text(page: str) -> str:
    """The text of a page, in a time that its length bounds: tags are looked for up to the last one's end."""
    shown = _shown(page)
    end = shown.rfind(">") + 1
    return html_lib.unescape(_TAG.sub(" ", shown[:end]) + shown[end:])


def declared_in(page: str) -> str | None:
    """The language that an html tag declares; a tag is looked at once, up to its end."""
    at = 0
    while m := _HTML.search(page, at):
        at = page.find(">", m.end())
        at = len(page) if at < 0 else at
        if found := _LANG.search(page, m.end(), at):
            return found[1].lower()
    return None


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the letters of a text, words set apart by one space."""
    letters = _GAP.sub(" ", f" {text.lower()} ")
    a = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    if len(a) < 3:
        return np.empty(0, np.int64)
    h = (a[:-2] * np.uint32(0x9E3779B1)) ^ (a[1:-1] * np.uint32(0x85EBCA77)) ^ (a[2:] * np.uint32(0xC2B2AE3D))
    h ^= h >> np.uint32(15)
    return ((h * np.uint32(0x2C1B3C6D)) >> np.uint32(17)).astype(np.int64)


def shares(counts: dict[str, int], bound: int) -> dict[str, float]:
    """The share of each language's texts that fits the bound: small languages whole, the others alike in number."""
    out, left = {}, float(bound)
    for k, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        taken = min(n, max(LEAST_LABELLED, left / (len(counts) - k)))
        out[lang], left = taken / max(1, n), left - taken
    return out


def fit(labelled: DataFrame, bound: int = MAX_LABELLED) -> tuple[list[str], np.ndarray]:
    """Languages and log probabilities (class, bucket) from (text, lang); the last class is UNKNOWN."""
    rows = labelled.select("text", F.lower("lang").alias("lang")).where(F.col("text").rlike(_LETTER) & ~F.col("lang").isin("", "?", UNKNOWN))
    # one row for each language
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("text", 0.01).alias("n")).collect()}
    if counts:
        below = F.create_map(*[F.lit(x) for lang, share in shares(counts, bound).items() for x in (lang, int(share * _HASHES))])
        rows = rows.where(F.pmod(F.xxhash64("text", F.lit(5)), F.lit(_HASHES)) < F.element_at(below, F.col("lang")))
    rows = rows.distinct()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for part in parts:
            for text, lang in zip(part["text"], part["lang"], strict=True):
                sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                sums[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": n[at]})

    # at most BUCKETS rows for each language
    found = rows.mapInPandas(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(found["lang"].unique())
    logs = np.full((len(langs) + 1, BUCKETS), -np.log(BUCKETS))
    for k, lang in enumerate(langs):
        n = np.full(BUCKETS, 0.02)
        own = found[found["lang"] == lang]
        n[own["bucket"].to_numpy()] += own["n"].to_numpy()
        logs[k] = np.log(n / n.sum())
    return [*langs, UNKNOWN], logs.astype(np.float32)


def text_posterior(logs: np.ndarray, texts: Callable[[str], str] = str):
    """A function of a text column: the log posterior of each class under equal priors; null without letters."""
    table = np.ascontiguousarray(logs.T)

    @F.pandas_udf("array<double>")
    def posterior(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            out: list[np.ndarray | None] = []
            for t in s:
                g = trigrams(texts(t)) if t else ()
                if not len(g):
                    out.append(None)
                    continue
                x = table[g].mean(0, dtype=np.float64) * (len(g) * TEXT_WEIGHT / (len(g) + TEXT_WEIGHT))
                x -= x.max()
                out.append(x - np.log(np.exp(x).sum()))
            yield pd.Series(out, dtype=object)

    return posterior


def address(url: Column) -> dict[str, Column]:
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))
    return {
        "host": host,
        "domain": F.regexp_extract(host, "([^.]+\\.[^.]+)$", 1),
        "suffix": F.regexp_extract(host, "([^.]+)$", 1),
    }


def _sums(classes: list[str]) -> list[Column]:
    return [F.sum(F.exp(F.col("_ll")[i])).alias(f"s{i}") for i in range(len(classes))]


def _smoothed(level: DataFrame, key: str, up: DataFrame, classes: list[str], link: list[str]) -> DataFrame:
    """Prior of each value of a level: its counts and SMOOTH times the prior of the level above."""
    n = sum((F.col(f"s{i}") for i in range(1, len(classes))), F.col("s0"))
    p = [((F.col(f"s{i}") + SMOOTH * F.col("_up")[i]) / (n + SMOOTH)) for i in range(len(classes))]
    joined = level.join(up, link) if link else level.crossJoin(F.broadcast(up))
    return joined.select(*level.columns, F.array(*p).alias("_p")).withColumnRenamed("_p", f"p_{key}")


def host_priors(light: DataFrame, classes: list[str]) -> DataFrame:
    """host, domain, suffix, the host's soft counts, and the prior of its domain (p_domain)."""
    hosts = light.where("_ll is not null").groupBy("host", "domain", "suffix").agg(*_sums(classes))
    every = [f"s{i}" for i in range(len(classes))]
    add = [F.sum(c).alias(c) for c in every]
    n = sum((F.coalesce(F.sum(c), F.lit(0.0)) for c in every[1:]), F.coalesce(F.sum(every[0]), F.lit(0.0)))
    top = hosts.agg(F.array(*[(F.coalesce(F.sum(c), F.lit(0.0)) + 1) / (n + len(classes)) for c in every]).alias("_up"))
    suffixes = _smoothed(hosts.groupBy("suffix").agg(*add), "suffix", top, classes, [])
    up = suffixes.select("suffix", F.col("p_suffix").alias("_up"))
    domains = _smoothed(hosts.groupBy("domain", "suffix").agg(*add), "domain", up, classes, ["suffix"])
    up = domains.select("domain", "suffix", "p_domain")
    return hosts.join(up, ["domain", "suffix"]).select("host", F.array(*every).alias("_n"), "p_domain")


def declarations(light: DataFrame, classes: list[str]) -> dict[str, list[float]]:
    """log P(declared | class) for each declared class, "" for none and "?" for others: a table of bounded size."""
    known = [*classes[:-1], "?", ""]
    rows = {r["_decl"]: r for r in light.where("_ll is not null").groupBy("_decl").agg(*_sums(classes)).collect()}
    count = np.array([[rows[d][f"s{i}"] if d in rows else 0.0 for i in range(len(classes))] for d in known])
    base = np.full(count.shape, 0.1)
    for i in range(len(classes) - 1):
        base[i, i] = 1.0
    base /= base.sum(0)
    p = (count + SMOOTH * base) / (count.sum(0) + SMOOTH)
    return {d: np.log(p[k]).tolist() for k, d in enumerate(known)}


def identify(rows: DataFrame, classes: list[str]) -> DataFrame:
    """rows (with _ll, declared, host, domain, suffix) and lang_found, confidence, text_lang, accepted.

    rows are read three times and should be files: the counts read their light columns only.
    """
    known = F.lower("declared").isin(classes[:-1])
    decl = F.when(F.col("declared").isNull() | (F.col("declared") == ""), "").when(known, F.lower("declared")).otherwise("?")
    rows = rows.withColumn("_decl", decl)
    logs = declarations(rows, classes)
    table = F.create_map(*[x for d, v in logs.items() for x in (F.lit(d), F.array(*map(F.lit, v)))])
    priors = broadcast_if(host_priors(rows, classes), MANY_HOSTS, "host-priors")
    out = rows.join(priors, "host", "left").withColumn("_d", F.element_at(table, F.col("_decl")))
    score = []
    for i in range(len(classes)):
        own = F.greatest(F.col("_n")[i] - F.exp(F.col("_ll")[i]), F.lit(0.0))
        score.append(F.col("_ll")[i] + F.col("_d")[i] + F.log(own + SMOOTH * F.col("p_domain")[i]))
    out = out.withColumn("_s", F.when(F.col("_ll").isNotNull(), F.array(*score)))
    best = F.array_max("_s")
    total = F.aggregate("_s", F.lit(0.0), lambda acc, x: acc + F.exp(x - best))
    name = lambda column: F.get(F.array(*map(F.lit, classes)), (F.array_position(column, F.array_max(column)) - 1).cast("int"))
    out = out.withColumns(
        {
            "lang_found": F.coalesce(name(F.col("_s")), F.lit(UNKNOWN)),
            "text_lang": F.coalesce(name(F.col("_ll")), F.lit(UNKNOWN)),
            "confidence": F.coalesce(F.lit(1.0) / total, F.lit(0.0)),
        }
    )
    out = out.withColumn("accepted", (F.col("lang_found") != UNKNOWN) & (F.col("confidence") >= ACCEPT))
    return out.drop("_s", "_d", "_n", "p_domain", "_decl", "_ll")


def identify_pages(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """One row per page: page_id, host, declared, text_lang, lang, confidence, accepted."""
    classes, logs = fit(labelled)
    posterior = text_posterior(logs, page_text)
    declared = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), "(?i)<html\\b[^>]*?\\blang\\s*=\\s*[\"']?([A-Za-z]{2,3})", 1))
    light = pages.select("page_id", declared.alias("declared"), *[c.alias(n) for n, c in address(F.col("url")).items()], posterior("html").alias("_ll"))
    out = identify(materialize(light, "page-language"), classes)
    return out.select("page_id", "host", "declared", "text_lang", F.col("lang_found").alias("lang"), "confidence", "accepted")


def identify_documents(docs: DataFrame) -> DataFrame:
    """docs with lang_found, text_lang, confidence and accepted; source stands for the host, lang is the declaration.

    Columns of docs with these four names give way; all others are kept.
    """
    classes, logs = fit(docs)
    posterior = text_posterior(logs)
    names = {"declared": F.col("lang"), "host": F.coalesce("source", F.lit("")), "domain": F.lit(""), "suffix": F.lit("")}
    own = {n: f"_own_{n}" for n in (*names, "_ll", "_decl", "_s", "_d", "_n", "p_domain") if n in docs.columns}  # columns of the caller with names used here
    rows = docs.withColumnsRenamed(own).withColumns({**names, "_ll": posterior("text")})
    out = identify(materialize(rows, "document-language"), classes)
    kept = [F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns if c not in ("lang_found", "text_lang", "confidence", "accepted")]
    return out.select(*kept, "lang_found", "text_lang", "confidence", "accepted")
