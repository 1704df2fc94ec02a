"""The fusion of evidence against an independent recomputation, page by page, in plain Python."""

import math
import re

import numpy as np

from gamestate.llm import common, language, queries


def recomputed(pages, classes, logs):
    """The posterior of every page from its definition: soft counts of all other rows by host, domain and suffix."""
    n = len(classes)

    def text_log(html):
        g = language.trigrams(language.page_text(html)) if html else ()
        if not len(g):
            return None
        x = sum(logs[:, k].astype(float) for k in g) / len(g) * (len(g) * 40.0 / (len(g) + 40.0))
        return x - x.max() - math.log(sum(math.exp(v - x.max()) for v in x))

    rows = []
    for i, url, html in pages:
        m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", url or "")
        host = m[1].lower() if m else ""
        parts = host.split(".")
        domain = ".".join(parts[-2:]) if len(parts) > 1 and all(parts[-2:]) else ""
        suffix = parts[-1]
        said = re.search(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", html or "", re.I)
        declared = said[1].lower() if said else ""
        rows.append((i, host, domain, suffix, declared if declared in (*classes[:-1], "") else "?", text_log(html)))

    def counts(key, value):
        return sum((np.exp(r[5]) for r in rows if r[5] is not None and r[key] == value), np.zeros(n))

    def smooth(c, up):
        return (c + 8 * up) / (c.sum() + 8)

    every = counts(0, None) + sum((np.exp(r[5]) for r in rows if r[5] is not None), np.zeros(n))
    top = (every + 1) / (every.sum() + n)
    known = [*classes[:-1], "?", ""]
    decl = np.array([counts(4, d) for d in known])
    base = np.full(decl.shape, 0.1)
    base[range(n - 1), range(n - 1)] = 1
    base /= base.sum(0)
    decl = (decl + 8 * base) / (decl.sum(0) + 8)
    out = {}
    for i, host, domain, suffix, declared, ll in rows:
        if ll is None:
            out[i] = (language.UNKNOWN, 0.0)
            continue
        own = counts(1, host) - np.exp(ll)
        prior = np.maximum(own, 0) + 8 * smooth(counts(2, domain), smooth(counts(3, suffix), top))
        s = ll + np.log(decl[known.index(declared)]) + np.log(prior)
        p = np.exp(s - s.max())
        out[i] = (classes[int(np.argmax(s))], float((p / p.sum()).max()))
    return out


def test_posteriors_follow_from_their_definition(spark, tiny):
    docs, pages = common.table(spark, tiny, "documents"), common.table(spark, tiny, "pages")
    odd = [(-1, None, None), (-2, "not an address", "<p>der die das und nicht der heit ung mit ihrem haus"), (-3, "https://A.b.example.FR:80/x", "<html lang=zz>le la les et dans une maison avec"), (-4, "http://x.de/", "<p>1 2 3"), (-5, "http://localhost/", "<html lang='en'>the house and the river were with them")]
    every = pages.select("page_id", "url", "html").union(spark.createDataFrame([*odd, odd[1]], "page_id long, url string, html string"))
    classes, logs = language.fit(docs)
    want = recomputed([tuple(r) for r in every.collect()], classes, logs)
    got = language.identify_pages(every, docs).collect()
    assert len(got) == every.count()
    for r in got:
        lang, p = want[r["page_id"]]
        assert r["lang"] == lang and abs(r["confidence"] - p) < 1e-6
        assert r["accepted"] == (lang != language.UNKNOWN and p >= 0.5)


def test_priors_decide_where_the_text_cannot(spark, tiny):
    docs = common.table(spark, tiny, "documents")
    german = [(i, f"http://news.example.de/{i}", f"<p>der die das und nicht mit ihrem haus morgen {i}") for i in range(60)]
    short = [(900, "http://news.example.de/z", "<p>in"), (901, "http://other.example.de/z", "<p>in")]
    got = {r["page_id"]: r for r in language.identify_pages(spark.createDataFrame(german + short, "page_id long, url string, html string"), docs).collect()}
    assert got[900]["lang"] == got[901]["lang"] == "de" and got[900]["confidence"] >= got[901]["confidence"]


def test_many_hosts_give_the_same_rows_without_a_broadcast(spark, tiny, monkeypatch):
    want = sorted(map(str, queries.op10_language_fusion(spark, tiny).collect()))
    monkeypatch.setattr(language, "MANY_HOSTS", 0)
    got = sorted(map(str, queries.op10_language_fusion(spark, tiny).collect()))
    assert [x.split("confidence")[0] for x in got] == [x.split("confidence")[0] for x in want]
