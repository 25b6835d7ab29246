import math
import random

import pytest
from pyspark.sql import functions as F

from roadpulse.functions.geo import great_circle, with_grid, with_latlon
from roadpulse.operators.spatial import nearest_node, within_radius

POINTS = [
    (1492963064, 2819047.8169967565, 7207524.748861773, -23.55857329, -46.66861573),
    (28149752, 2819667.100838852, 7207723.5201618755, -23.55606326, -46.66330097),
    (1819616337, 2819912.724556382, 7207521.449929407, -23.55741375, -46.66077483),
    (142788951, 2818843.058536206, 7208116.730843136, -23.55390990, -46.67135198),
    (4258014904, 2818694.112620861, 7206797.441784771, -23.56513331, -46.67073763),
    (931131905, 2817199.9615978533, 7206903.68044798, -23.56629619, -46.68443472),
]


def nodes(spark):
    return spark.createDataFrame([p[:3] for p in POINTS], "node_id bigint, x double, y double")


def haversine(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = (math.sin((q - p) / 2) ** 2
         + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2)
    return 2 * 6371008.8 * math.asin(min(1, math.sqrt(h)))


def test_latlon_of_known_points(spark):
    got = {r.node_id: r for r in with_latlon(nodes(spark)).collect()}
    for node_id, _, _, lat, lon in POINTS:
        assert got[node_id].lat == pytest.approx(lat, abs=6e-9)
        assert got[node_id].lon == pytest.approx(lon, abs=6e-9)


def test_central_meridian_and_equator(spark):
    df = spark.createDataFrame([(500000.0, 10000000.0)], "x double, y double")
    row = with_latlon(df).first()
    assert (row.lat, row.lon) == pytest.approx((0.0, -69.0), abs=1e-12)


def test_projection_round_trip(spark):
    back = with_grid(with_latlon(nodes(spark)), x="x2", y="y2")
    worst = back.select(F.max(F.abs(F.col("x") - F.col("x2")) + F.abs(F.col("y") - F.col("y2"))))
    assert worst.first()[0] < 1e-6


def test_distances(spark):
    a = with_latlon(nodes(spark)).select("node_id", "lat", "lon")
    first = a.where("node_id = 1492963064").select(F.col("lat").alias("lat0"),
                                                  F.col("lon").alias("lon0"))
    rows = (a.join(first).select("node_id", great_circle("lat0", "lon0", "lat", "lon").alias("d"))
            .collect())
    got = {r.node_id: round(r.d) for r in rows}
    assert [got[p[0]] for p in POINTS[1:]] == [609, 810, 589, 761, 1827]


@pytest.mark.parametrize("centre, spread, radius", [
    ((-23.5, -46.6), 0.05, 1000), ((-23.5, -46.6), 0.02, 700), ((0.0, 179.99), 0.05, 1500),
    ((89.95, 10.0), 0.05, 2000), ((-89.99, 0.0), 0.02, 3000), ((60.0, -179.999), 0.1, 5000)])
def test_within_radius_equals_brute_force(spark, centre, spread, radius):
    rnd = random.Random(5)

    def place():
        lat = max(-90.0, min(90.0, centre[0] + rnd.uniform(-spread, spread)))
        lon = centre[1] + rnd.uniform(-spread, spread) * (400 if abs(centre[0]) > 89 else 1)
        return lat, (lon + 180) % 360 - 180

    a = [(i, *place()) for i in range(150)]
    b = [(i, *place()) for i in range(60)]
    got = within_radius(spark.createDataFrame(a + [(999, None, None)], "p int, lat double, lon double"),
                        spark.createDataFrame(b + [(999, None, None)], "s int, lat double, lon double"),
                        float(radius)).collect()
    expected = {(p[0], s[0]) for p in a for s in b if haversine(p[1:], s[1:]) <= radius}
    assert len(got) == len({(r.p, r.s) for r in got})
    assert {(r.p, r.s) for r in got} == expected
    assert expected


@pytest.mark.parametrize("leaf", [1, 16, 10**9])
def test_nearest_node_equals_brute_force(spark, leaf):
    rnd = random.Random(9)
    # Half of the nodes sit in one small cluster; some share a place.
    nodes = [(i, rnd.uniform(0, 5000), rnd.uniform(0, 300)) for i in range(150)]
    nodes += [(150 + i, 4000 + rnd.uniform(0, 2), 100 + rnd.uniform(0, 2)) for i in range(150)]
    nodes += [(1000 + i, *nodes[i][1:]) for i in range(20)]
    points = [(i, rnd.uniform(-2000, 7000), rnd.uniform(-500, 900)) for i in range(80)]
    points += [(80 + i, *nodes[i * 7][1:]) for i in range(20)] + [(100, *points[0][1:])]
    got = nearest_node(spark.createDataFrame(points, "p int, x double, y double"),
                       spark.createDataFrame(nodes, "node_id bigint, x double, y double"), leaf)
    got = {r.p: (r.node_id, r.distance) for r in got.collect()}
    for p, x, y in points:
        d, node = min(((n[1] - x) ** 2 + (n[2] - y) ** 2, n[0]) for n in nodes)
        assert got[p][0] == node
        assert got[p][1] == pytest.approx(math.sqrt(d))


def test_nearest_node_without_nodes(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0)], "p int, x double, y double")
    none = spark.createDataFrame([], "node_id bigint, x double, y double")
    assert nearest_node(points, none).first().node_id is None
