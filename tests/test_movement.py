import random

import pytest

from roadpulse.operators import movement
from roadpulse.plans.jobs import train

EDGES = [(7, 100.0), (8, 50.0)]


def brute(points):
    out = []
    for uuid in sorted({p[0] for p in points}):
        own = sorted((t, e) for u, t, e in points if u == uuid)
        out += [(uuid, b[0], b[1], b[0] - a[0]) for a, b in zip(own, own[1:]) if b[0] > a[0]]
    return sorted(out)


@pytest.mark.parametrize("slice_bits", [0, 2, 5, 20])
def test_moves_equal_brute_force(spark, slice_bits):
    rnd = random.Random(slice_bits)
    points = [(rnd.choice("aaaab"), rnd.randrange(-40, 400), rnd.randrange(9)) for _ in range(300)]
    points += [("single", 5, 1)]
    df = spark.createDataFrame(points, "uuid string, tick bigint, edge_id bigint")
    got = movement.moves(df, slice_bits).collect()
    assert sorted(map(tuple, got)) == brute(points)


def test_first_of_equal_ticks_takes_the_speed(spark):
    df = spark.createDataFrame([("a", 10, 7), ("a", 20, 8), ("a", 20, 7), ("a", 30, 8)],
                               "uuid string, tick int, edge_id bigint")
    edges = spark.createDataFrame(EDGES, "edge_id bigint, length double")
    rows = sorted(tuple(r) for r in movement.edge_speeds(df, edges).collect())
    assert rows == [("a", 20, 7, 100.0, 10, 10.0), ("a", 30, 8, 50.0, 10, 5.0)]


def test_unknown_edge_keeps_row_and_precedes(spark):
    df = spark.createDataFrame([("a", 10, 7), ("a", 20, 99), ("a", 30, 8)],
                               "uuid string, tick int, edge_id bigint")
    edges = spark.createDataFrame(EDGES, "edge_id bigint, length double")
    model = {r.edge_id: r for r in train(df, edges).collect()}
    assert model[99].median is None and model[99].lower_threshold is None
    assert model[8].median == 5.0  # 50 / (30 - 20)


def test_flatten_and_clean(spark):
    from roadpulse.schemas import HISTORIES
    rows = [("u1", {"current_location": [
        {"date": "d", "nodeID": 12.0, "tick": "5.0"}, {"date": "d", "nodeID": 13.0, "tick": "x"}]}),
        ("u2", {"current_location": []}), ("u3", {"current_location": None})]
    points = movement.flatten_histories(spark.createDataFrame(rows, HISTORIES))
    good, bad = movement.clean_positions(points)
    assert [tuple(r) for r in good.collect()] == [("u1", 5, 12)]
    assert [(r.uuid, r.reason) for r in bad.collect()] == [("u1", "no tick")]
