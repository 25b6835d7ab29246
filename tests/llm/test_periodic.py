"""Periodic runs against a plain search of all lags."""

import random

import numpy as np
import pyarrow as pa
import pytest

from roadpulse.llm import periodic, queries
from roadpulse.llm.words import Words
from tests.llm import plain


def runs_of(words):
    column = Words(pa.array([" ".join(words)]))
    ends = np.cumsum(column.counts)
    found = periodic.scan(column.hashes, *periodic.split_by_frequency(column.hashes, ends - column.counts, ends))
    return sorted((s, e - s, q) for s, e, q in found)


def some_words(rnd):
    """Stretches that repeat, some with an error, among others of few or many different words."""
    out = []
    for _ in range(rnd.randrange(1, 6)):
        own = [rnd.choice("abcdefgh"[:rnd.choice([1, 2, 3, 8])]) for _ in range(rnd.randrange(1, 12))]
        out += own * rnd.randrange(1, 9) + own[:rnd.randrange(len(own))]
        if rnd.random() < 0.5:
            out[rnd.randrange(len(out))] = "z"
        out += [f"u{rnd.randrange(40)}" for _ in range(rnd.choice([0, 1, 20]))]
    return out


@pytest.mark.parametrize("seed", range(300))
def test_runs_equal_the_plain_search(seed):
    words = some_words(random.Random(seed))
    assert runs_of(words) == plain.periodic_runs(words)


def test_long_runs_of_every_period():
    for q in [*range(1, 40), 64, 127, 128, 129]:
        own = [f"w{k}" for k in range(q)]
        for more in {0, 1, q - 1}:
            words = ["x"] + own * max(4, -(-6 // q)) + own[:more] + ["y"]
            assert runs_of(words) == [(1, len(words) - 2, q)]
        assert runs_of(own * 4 if q > 1 else own * 5) == ([(0, 4 * q, q)] if q > 1 else [])
        assert runs_of((own * 4)[:-1]) == []


def test_a_long_text_without_rare_words():
    rnd = random.Random(5)
    words = [rnd.choice("abc") for _ in range(3_000)] + list("abcab") * 400 + ["a"] * 2_000
    assert runs_of(words) == plain.periodic_runs(words)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_defined_cases(spark, texts):
    rows = [(None, "a a a a a a"), (1, None), (2, ""), (3, "b\tb\nb b  b\x0bb c"), (3, "b\tb\nb b  b\x0bb c"),
            (4, "w " * 100_000), (5, "é é é é é é é")]
    got = rows_of(periodic.find_runs(texts(rows, "runs").repartition(3)))
    assert [(d, [tuple(r) for r in runs], c) for d, runs, c in got] == sorted([
        (1, [], ""), (2, [], ""), (3, [(0, 6, 1)], "b c"), (3, [(0, 6, 1)], "b c"), (4, [(0, 100_000, 1)], "w"),
        (5, [(0, 7, 1)], "é"), (None, [(0, 6, 1)], "a")], key=repr)
    assert periodic.digest(periodic.find_runs(periodic.with_planted_runs(texts([])))).collect() == []
    # Ids whose crc32 ends in 0 are changed; those without words, and no id, are not.
    odd = [(k, t) for k in range(40) for t in ("", "a", "a b c d e f g h i j k l", None)]
    got = rows_of(periodic.digest(periodic.find_runs(periodic.with_planted_runs(texts(odd, "_words")))))
    assert got == sorted((plain.periodic_digest(*r) for r in odd), key=repr)


def test_query_equals_the_plain_search(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = rows_of(queries.op13_periodic_runs(spark, sf_dir))
    assert got == sorted((plain.periodic_digest(*d) for d in docs), key=repr)
    assert sum(r[1] > 0 for r in got) > 5
