"""The labelled sample of language identification above its bound."""

import numpy as np

from gamestate.llm import language

WORDS = {"en": "the house and river were with their morning", "de": "das haus und der fluss waren mit ihrem morgen", "qq": "zuqo xiqa woqu vaqi yoqe juqa kiqo"}


def rows(lang: str, n: int) -> list[tuple[str, str]]:
    words = WORDS[lang].split()
    return [(" ".join([*(words[(i * k + k) % len(words)] for k in range(1, 9)), f"{lang}{i:x}".translate(str.maketrans("0123456789", "ghijklmnop"))]), lang) for i in range(n)]


def test_rare_language_is_a_class_above_the_bound(spark):
    table = spark.createDataFrame(rows("en", 1500) + rows("de", 700) + rows("qq", 3), "text string, lang string")
    classes, logs = language.fit(table, bound=150)
    assert classes == ["de", "en", "qq", language.UNKNOWN]
    found = table.where("lang = 'qq'").select(language.text_posterior(logs)("text").alias("p")).collect()
    assert [int(np.argmax(r["p"])) for r in found] == [2, 2, 2]


def test_copies_of_a_hot_text_weigh_once(spark):
    once = rows("en", 900) + rows("de", 900)
    table = lambda r: spark.createDataFrame(r, "text string, lang string")
    plain, hot = language.fit(table(once), bound=400), language.fit(table(once + once[:40] * 25), bound=400)
    assert plain[0] == hot[0] and np.array_equal(plain[1], hot[1])


def test_rare_language_is_accepted_in_a_large_table(spark):
    docs = [(i, t, lang, f"s{i % 7}") for i, (t, lang) in enumerate(rows("en", 16_000) + rows("de", 8_000) + rows("qq", 20))]
    out = language.identify_documents(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"))
    got = out.where("lang = 'qq'").select("lang_found", "accepted").collect()
    assert len(got) == 20 and all(tuple(r) == ("qq", True) for r in got)


def test_small_tables_are_used_whole():
    assert language.shares({"en": 15_000, "de": 4_000, "qq": 3}, 20_000) == {"en": 1.0, "de": 1.0, "qq": 1.0}
    got = language.shares({"en": 9_000_000, "de": 3_000_000, "qq": 3}, 20_000)
    assert got["qq"] == 1.0 and abs(got["en"] * 9_000_000 - got["de"] * 3_000_000) < 2
    assert all(language.shares({str(k): 10**6 for k in range(1000)}, 100)[str(k)] * 10**6 >= language.LEAST_LABELLED - 1e-6 for k in range(1000))


def test_labels_that_are_none(spark):
    table = spark.createDataFrame([(0, "the house and river", "en", "s"), (1, "das haus", "", "s"), (2, "der fluss", "und", "s"), (3, "12 34", "zz", "s"), (4, "fin", "?", None)], "doc_id long, text string, lang string, source string")
    assert language.fit(table)[0] == ["en", language.UNKNOWN]
    assert language.identify_documents(table).count() == 5
