"""Ranked search and the divergence audit against SQL, on odd rows, with segments, blocks and buckets made small."""

import duckdb
import pytest
from pyspark.sql import functions as F

from gamestate.llm import common, divergence, queries, search

DOCS = "doc_id long, text string, lang string, source string, term string, segment int"


def twin(sql, **tables):
    c = duckdb.connect()
    for name, df in tables.items():
        c.register(name, df.toArrow())
    return c.sql(sql)


def rows(df):
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    return sorted((tuple(r) for r in df), key=key)


@pytest.mark.parametrize("name", ["op12_source_divergence", "op13_ranked_search"])
def test_queries_equal_their_sql(spark, tiny, name):
    got = queries.queries()[name](spark, tiny)
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"create view {t} as select * from '{tiny}/{t}.parquet'")
    want = c.sql(queries.oracle_sql()[name])
    assert rows(got.collect()) == rows(want.select(", ".join(got.columns)).fetchall())


def test_search_in_many_segments_and_blocks(spark, tiny, monkeypatch):
    monkeypatch.setattr(search, "DOCS", 7)
    monkeypatch.setattr(search, "ITEMS", 5)
    monkeypatch.setattr(search, "TERMS", 10)  # the join of many query terms
    docs, items = common.table(spark, tiny, "documents"), common.table(spark, tiny, "benchmark")
    got = search.ranked_documents(docs, items, 5)
    want = twin(search.oracle(5), documents=docs, benchmark=items)
    assert rows(got.collect()) == rows(want.select(", ".join(got.columns)).fetchall())


def test_search_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "Wolf wolf FOX", "", "", "x", 1), (2, "wolf\x7ffox é9", "", "", "x", 1), (3, None, "", "", "x", 1), (4, "", "", "", "x", 1), (5, "..!", "", "", "x", 1), (6, "fox " * 50_000, "", "", "x", 1), (7, "Wolf wolf FOX", "", "", "x", 1), (None, "wolf", "", "", "x", 1)],
        DOCS,
    )
    items = spark.createDataFrame([(1, "wolf fox WOLF", "s"), (1, "é9", "s"), (2, None, "s"), (3, "absent", "s"), (None, "fox", "s")], "item_id long, text string, source string")
    got = search.ranked_documents(docs, items, 4).collect()
    of = {i: [(r["doc_id"], r["rank"]) for r in sorted(got, key=lambda r: r["rank"]) if r["item_id"] == i] for i in (1, 2, 3, None)}
    assert of[1][0] == (2, 1) and len(of[1]) == 4 and of[2] == of[3] == []
    assert sorted(i for i, _ in of[None]) == [1, 2, 6, 7]
    tied = [r for r in got if r["item_id"] is None and r["doc_id"] in (1, 7)]
    assert len({r["score"] for r in tied}) == 1 and [r["doc_id"] for r in sorted(tied, key=lambda r: r["rank"])] == [1, 7]
    assert search.ranked_documents(docs.limit(0), items, 3).count() == 0
    assert search.ranked_documents(docs, items.limit(0), 3).count() == 0


def test_every_document_above_the_kth_bound_is_rescored(spark):
    # documents whose bytes are equal though their exact impacts are not
    docs = spark.createDataFrame([(i, "needle " + f"w{i} " * (200 + i)) for i in range(300)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "needle")], "item_id long, text string")
    got = search.ranked_documents(docs, items, 50)
    want = twin(search.oracle(50), documents=docs, benchmark=items)
    assert rows(got.collect()) == rows(want.select(", ".join(got.columns)).fetchall())


def test_divergence_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 5)
    monkeypatch.setattr(divergence, "PAIRS", 3)
    monkeypatch.setattr(divergence, "SOURCES", 2)
    text = ["a b c", "A b", "a a b é", None, "", "12 3", "c c c", "b É é", "a b c", "a b c", "é é é a", "b"]
    docs = spark.createDataFrame(
        [(i, text[i % len(text)], (None, "en", "de", "lone")[i % 4 if i < 60 else 1], (None, "s1", "s2", "s3", "s4")[i * 7 % 5], "x", 1) for i in range(120)] + [(999, None, "xx", "only", "x", 1), (998, "q", "xx", "two", "x", 1)], DOCS
    )
    got = divergence.audit(docs, top=2)
    want = twin(divergence.oracle(top=2), documents=docs)
    assert rows(got.collect()) == rows(want.select(", ".join(got.columns)).fetchall())
    assert divergence.audit(docs.limit(0)).count() == 0
    assert {r["value"] for r in got.where(F.col("lang") == "xx").collect()} == {0}


def test_buckets_bound_large_counts(spark):
    c = [1, 1023, 1024, 5000, 123_456, 2**33]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in c], "c long").select(divergence._bucket(F.col("c"))).collect()]
    assert got == sorted(set(got))
