"""Collocations against a plain count, and what the scans count when."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import phrases
from tests.compare import connect, difference
from tests.llm import plain


def frame(spark, rows):
    """Documents with columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, 1, 2) for r in rows],
                                 "doc_id long, text string, lang string, h int, shard int").repartition(5)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def some_documents(rnd, n):
    words = ["the", "The", "a", "of", "x", "é", "ß", "new", "york", "city", "12", " ", "z\x1c"]
    blanks = [" ", "  ", "\t", " ", " ", ". ", "\n", ",", "\r\n", "! "]
    out = []
    for i in range(n):
        own = [rnd.choice(words[:rnd.choice([3, 6, 13])]) for _ in range(rnd.randrange(60))]
        out.append((i, "".join(w + rnd.choice(blanks) for w in own), rnd.choice(["en", "de", None])))
    return out


@pytest.mark.parametrize("seed, least, shards", [(1, 5, 4), (3, 30, 1), (4, 3, 7)])
def test_collocations(spark, seed, least, shards):
    docs = some_documents(random.Random(seed), 150)
    got = rows_of(phrases.collocations(frame(spark, docs), least, shards=shards))
    assert got == plain.collocations(docs, least) and len(got) > 10


def test_late_phrases_are_counted_in_all_shards(spark):
    """Words that reach the threshold in the last shard only: their phrases take a further cycle."""
    docs = [(k, "p q r s", "en") for k in range(40)]
    dealt = phrases.tokens(frame(spark, docs), 4)
    order = [r.shard for r in dealt.groupBy("shard").agg(F.sum("n_words")).collect()]
    assert len(order) == 4
    assert [r[2:4] for r in rows_of(phrases.collocations(frame(spark, docs), 40))] == [("p q r s", 40)]
    assert phrases.collocations(frame(spark, docs), 41).collect() == []


def test_a_full_filter_changes_nothing(spark):
    """Phrases the filter lets through by chance are counted whole."""
    docs = some_documents(random.Random(7), 200)
    dealt = phrases.tokens(frame(spark, docs), 3).cache()
    exact = {tuple(r) for r in phrases.counts(dealt, 18, 8, 4, 3)[0].collect()}
    assert {tuple(r) for r in phrases.counts(dealt, 6, 8, 4, 3)[0].collect()} == exact and len(exact) > 100


def test_defined_cases(spark):
    rows = [(None, "a b. a b\na b", None), (1, None, "en"), (2, "", "en"), (3, "A B " * 60_000, "en"), (3, "x", "en"),
            (4, "c d," * 3, "en"), (4, "c d," * 3, "en"), (5, "e f!" * 6, "en"), (6, ". , \t", "fr")]
    got = rows_of(phrases.collocations(frame(spark, rows), 3))
    assert got == plain.collocations(rows, 3)
    # Equal scores and counts: by phrase.
    assert [r[2] for r in got if r[3] == 6] == ["c d", "e f"]
    assert [r[:6] for r in got if r[0] == "und"] == [("und", 1, "a b", 3, 3, 3)]
    assert phrases.collocations(frame(spark, []), 3).collect() == []


def test_first_rows_of_a_language(spark):
    docs = some_documents(random.Random(3), 150)
    got = rows_of(phrases.collocations(frame(spark, docs), 4, top=7))
    assert got == plain.collocations(docs, 4, 7) and len(got) == 21


def test_products_beyond_64_bits(spark):
    big = 1 << 62
    rows = spark.createDataFrame([(1, "en", "a b", big, [2], [3], [])],
                                 "h long, lang string, phrase string, a long, lefts array<long>, rights array<long>, inner array<long>")
    known = spark.createDataFrame([(2, big), (3, big + 5)], "h long, n long")
    assert phrases.scored(rows, known).first().score == 2000000 * big // (2 * big + 5)


def test_filter_is_read_as_written(spark):
    ids = spark.range(-50, 50).withColumn("id", F.xxhash64("id"))
    bitmap = phrases.marked(ids, "id", 18, hashed=False)
    own = np.array([r.id for r in ids.collect()], np.int64).view(np.uint64)
    assert phrases._in(bitmap, own).all()
    assert phrases._in(bitmap, own + np.uint64(1 << 9)).mean() < 0.1


def test_query_equals_sql(spark):
    from roadpulse.llm.queries import ORACLES, QUERIES
    name = "op11_collocations"
    sf = "/root/testdata/sf0.001"
    assert difference(spark, connect(sf), sf, QUERIES[name], ORACLES[name]) is None
