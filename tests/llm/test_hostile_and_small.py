"""Hostile pages, interrupted and concurrent maps, and many tiny documents."""

import os
import re
import threading
import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gamestate.llm import language, packing, sharding

SKIP = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>", re.S | re.I)


@pytest.mark.parametrize("unit", ["<!--", "<script ", "<", "<html ", "<style><!--", "</script ", "lang ", "<script></scrip"])
def test_hostile_pages_take_no_time(unit):
    page = "<p>words here</p>" + unit * (2_000_000 // len(unit))
    began = time.perf_counter()
    assert "words here" in language.page_text(page)
    language.declared_in(page)
    assert time.perf_counter() - began < 2


@pytest.mark.parametrize(
    "page",
    ["a<!-- x -->b", "a<script>x</script >b<style>y</STYLE>c", "a<script>x<!-- </script> -->b", "<!--a<!--b-->c-->d", "<script>a", "a<b c", "a<!-->b-->c", "<scripty>a</scripty>", "<style><script></style></script>z", "x > y < z > w"],
)
def test_page_text_is_that_of_the_plain_patterns(page):
    assert language.page_text(page) == re.sub(r"<[^>]*>", " ", SKIP.sub(" ", page))


def test_declared_language():
    assert language.declared_in("<html class=x LANG='DE-at'>") == "de"
    assert language.declared_in("<html><p lang=fr>") is None
    assert language.declared_in("<html a><html lang=es") == "es"


def sizes(spark, k=1):
    return spark.range(64).select(F.col("id").cast("int").alias("virtual_slot"), ((F.col("id") * k) % 7 + 1).alias("slot_bytes"), F.lit(1).cast("long").alias("slot_rows"))


def test_a_map_half_written_is_passed_over(spark, tmp_path):
    path = str(tmp_path / "map")
    os.makedirs(f"{path}/version=1/_temporary")
    first = sharding.rebalance(spark, sizes(spark), 4, path)
    assert {r["version"] for r in first.collect()} == {2} and first.count() == 64
    os.makedirs(f"{path}/_new-left/_temporary")
    again = sharding.rebalance(spark, sizes(spark, 3), 4, path)
    assert {r["version"] for r in again.collect()} == {3}
    assert {r["version"] for r in sharding.versions(spark, path).select("version").distinct().collect()} == {2, 3}


def test_two_runs_over_one_map(spark, tmp_path):
    path, got = str(tmp_path / "map"), []
    threads = [threading.Thread(target=lambda k=k: got.append(sharding.rebalance(spark, sizes(spark, k), 4, path).collect())) for k in (1, 2, 3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(got) == 3 and all(len(g) == 64 for g in got)
    assert sorted({r["version"] for g in got for r in g}) == [1, 2, 3]
    assert not [n for n in os.listdir(path) if n.startswith("_new")]


def test_many_tiny_documents_leave_little_padding(spark):
    docs = spark.range(10_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "").otherwise("a b c").alias("text")).coalesce(1)
    got = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    tokens, sequences = got.agg(F.sum("length"), F.count_distinct("sequence_id")).first()
    assert got.select("doc_id").distinct().count() == 10_000
    assert sequences * 2048 < tokens + 2048
