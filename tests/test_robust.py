import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.operators import robust

# Median 20; the deviations' median is 6.
SAMPLE = [2., 11., 13., 14., 14., 17., 19., 20., 20.5, 21., 23., 26., 41., 70., 300.]


def bounds(spark, rows, **options):
    df = spark.createDataFrame(rows, "id string, data double")
    return {r.id: r for r in robust.mad_bounds(df, ["id"], "data", **options).collect()}


def test_known_sample(spark):
    row = bounds(spark, [("a", v) for v in SAMPLE])["a"]
    assert (row.median, row.n) == (20.0, 15)
    assert row.mad == pytest.approx(6 * 1.4826)
    assert row.upper_threshold == pytest.approx(20 + 18 * 1.4826)
    assert row.lower_threshold == pytest.approx(20 - 18 * 1.4826)
    assert row["mean"] == pytest.approx(np.mean(SAMPLE))
    assert bounds(spark, [("a", v) for v in SAMPLE], scale=1.0)["a"].mad == 6.0


def test_missing_values(spark):
    rows = [("empty", None), ("some", None), ("some", 4.0), ("nan", float("nan")), ("nan", 1.0),
            (None, 5.0), (None, 7.0)]
    got = bounds(spark, rows)
    assert got["empty"].n == 0
    assert got["empty"].median is None and got["empty"].lower_threshold is None
    assert (got["some"].median, got["some"].mad, got["some"].n) == (4.0, 0.0, 1)
    assert got["nan"].lower_threshold is None and got["nan"].mad is None
    assert got[None].median == 6.0


def test_single_precision(spark):
    row = bounds(spark, [("a", 0.1), ("a", 0.1), ("a", 0.4)], single_precision=True)["a"]
    assert row.median == float(np.float32(0.1))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_group_size(spark, seed):
    rnd = random.Random(seed)
    groups = {
        "hot": [rnd.lognormvariate(2, 1.5) for _ in range(901)],
        "narrow": [1e6 + rnd.random() * 1e-3 for _ in range(200)],
        "signs": [rnd.uniform(-1e-6, 1e-6) for _ in range(75)],
        "even": [float(rnd.randrange(6)) for _ in range(300)],
        "pair": [1.0, 2.0], "gap": [-5.0, -5.0, 1e9, 1e9], "one": [3.5],
        "wide": [rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-300, 300) for _ in range(60)],
    }
    got = bounds(spark, [(k, v) for k, vs in groups.items() for v in vs])
    for key, values in groups.items():
        median = np.median(values)
        mad = 1.4826 * np.median(np.abs(np.array(values) - median))
        assert got[key].median == pytest.approx(median, rel=1e-14)
        assert got[key].mad == pytest.approx(mad, rel=1e-12)


def test_deviations_keep_every_row(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 6.0), ("b", None)],
                               "id string, data double")
    rows = robust.deviations(df, ["id"], "data").collect()
    assert sorted((r.id, r.data, r.deviation) for r in rows if r.id == "a") == [
        ("a", 1.0, 1.0), ("a", 2.0, 0.0), ("a", 6.0, 4.0)]
    assert [r.deviation for r in rows if r.id == "b"] == [None]


def test_no_rows(spark):
    empty = spark.createDataFrame([], "id string, data double")
    assert robust.mad_bounds(empty, ["id"], "data").collect() == []
    counts = robust.sliced(robust.value_counts(empty, ["id"], "data"), ["id"])
    assert robust.weighted_median(counts, ["id"]).count() == 0


def test_hot_key_lies_in_several_slices(spark):
    """No task holds a key whole: its values are cut into ranges, and few are ranked."""
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    session.conf.set("spark.sql.shuffle.partitions", "8")
    df = session.range(20_000).select(F.lit("hot").alias("id"), (F.col("id") * 7 % 20_000).cast("double")
                                      .alias("data")).union(session.range(9).select(
                                          F.lit("cold"), F.col("id").cast("double")))
    counts = robust.sliced(robust.value_counts(df, ["id"], "data"), ["id"])
    slices = {r.id: r["count"] for r in
              counts.select("id", "_slice").distinct().groupBy("id").count().collect()}
    assert slices["hot"] >= 7 and slices["cold"] <= 2
    sizes = [r["count"] for r in counts.groupBy("_slice").count().collect()]
    assert max(sizes) < 20_009 / 3
    got = {r.id: r["median"] for r in robust.weighted_median(counts, ["id"]).collect()}
    assert got == {"hot": 9999.5, "cold": 4.0}
