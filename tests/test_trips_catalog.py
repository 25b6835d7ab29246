import re

from roadpulse.operators import catalog, compare, lookup, trips
from roadpulse.sinks.files import register

TRIP = "name string, origin string, destination string, link_origin string, count int, start int, mode string"


def test_split_is_inclusive_and_halves_upwards(spark):
    rows = [("t", "o", "d", "l", c, s, "car") for c, s in
            [(1, 599), (3, 600), (4, 900), (0, 1200), (5, 1201)]]
    got = trips.split_trips(spark.createDataFrame(rows, TRIP), 600, 1200).collect()
    assert [(r["count"], r.start) for r in got] == [(2, 0), (2, 300), (0, 600)]


def expand(spark, rows, **options):
    return trips.expand_trips(spark.createDataFrame(rows, TRIP), **options).collect()


def test_expand(spark):
    rows = [("t1", "o", "d", "l", 3, 100, "car"), ("t1", "o", "d", "l", 2, 100, "car"),
            ("t2", "o", "d", "l", 0, 0, "car"), ("t3", "o", None, "l", -4, 0, "car"),
            ("t4", "o", None, "l", 9000, 50, "bus")]
    got = expand(spark, rows, seed="s", chunk=1000)
    count = {n: sum(r.name == n for r in got) for n in ("t1", "t2", "t3", "t4")}
    assert count == {"t1": 5, "t2": 0, "t3": 0, "t4": 9000}
    assert len({r.uuid for r in got}) == 9005
    assert all(re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-a[0-9a-f]{3}-[0-9a-f]{12}",
                            r.uuid) for r in got)
    assert {r.start for r in got if r.name == "t4"} == set(range(50, 76))
    assert {r["count"] for r in got} == {1}
    assert sorted(map(tuple, expand(spark, rows, seed="s")), key=repr) == \
        sorted(map(tuple, got), key=repr)
    first, second = expand(spark, rows[:1]), expand(spark, rows[:1])
    assert {r.uuid for r in first}.isdisjoint(r.uuid for r in second)


def test_absent_takes_each_uuid_once(spark):
    wanted = catalog.cars(spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)],
                                                "uuid string"))
    present = catalog.cars(spark.createDataFrame([("a",), ("a",)], "uuid string"))
    rows = catalog.absent(wanted, present).collect()
    assert sorted(r.uuid for r in rows) == ["b", "c"]
    assert tuple(rows[0])[1:] == ("Car", ["current_location"], "active", -23.0, -46.0)


def test_register_twice(spark, tmp_path):
    path = f"{tmp_path}/catalog"
    for names in (["a", "b"], ["b", "b", "c"], ["c"]):
        register(catalog.cars(spark.createDataFrame([(n,) for n in names], "uuid string")), path)
    assert sorted(r.uuid for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]


def test_capability_selection(spark):
    cars = catalog.cars(spark.createDataFrame([("a",)], "uuid string"))
    boards = catalog.boards(spark.createDataFrame([(5, 1.0, 2.0)],
                                                  "node_id bigint, lat double, lon double"))
    rows = catalog.having(cars.unionByName(boards), catalog.BOARD).collect()
    assert [tuple(r) for r in rows] == [("board-5", "5", ["traffic_board"], "active", 1.0, 2.0)]


def test_last_write_wins(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 2, "c"), (1, 1, "b"), (2, 0, None)],
                               "id int, pos int, v string")
    assert sorted(map(tuple, lookup.last_write_wins(df, ["id"], "pos").select("id", "v").collect())) \
        == [(1, "c"), (2, None)]


LOG = "last_tick bigint, last_link bigint, duration double, distance double"


def test_compare_means_of_means(spark):
    base = spark.createDataFrame([(10, 16, 4.0, 1.0), (10, 3, 2.0, 3.0), (12, 3, 4.0, 5.0),
                                  (9, None, 1.0, 1.0)], LOG)
    events = spark.createDataFrame([(10, 16, 8.0, 2.0), (10, 56, 1.0, 7.0)], LOG)
    rows = {(r.last_link, r.has_event): (r.distance, r.duration)
            for r in compare.compare(base, events).collect()}
    assert rows == {(3, False): (2.5, 3.5), (3, True): (2.0, 8.0), (20, True): (7.0, 1.0)}
    side = {r.last_link: tuple(r)[1:] for r in
            compare.overlay(compare.compare(base, events)).collect()}
    assert side == {3: (2.5, 2.0, 3.5, 8.0), 20: (None, 7.0, None, 1.0)}
    assert [r.first_tick for r in compare.with_first_tick(base).collect()] == [6.0, 8.0, 8.0, 8.0]

