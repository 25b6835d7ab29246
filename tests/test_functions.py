from pyspark.sql import functions as F

from roadpulse.functions import arrays, messages


def one(spark, row, schema, column):
    return spark.createDataFrame([row], schema).select(column).first()[0]


def test_consecutive_pairs(spark):
    for points, expected in [([40, 10, 30, 30], [(40, 10), (10, 30), (30, 30)]),
                             ([], []), ([9], [(9, 9)]), ([7, 8], [(7, 8)])]:
        got = one(spark, (points,), "a array<int>", arrays.consecutive_pairs(F.col("a")))
        assert [tuple(p) for p in got] == expected


def test_absolute_deviations(spark):
    assert one(spark, ([-4, 0, 11, 6], 6), "a array<int>, m int",
               arrays.absolute_deviations(F.col("a"), F.col("m"))) == [10, 6, 5, 0]


def test_array_median(spark):
    many = [31, 2, 18.5, 7, 7, 90, 24, 11.5, 3, 60]
    for values, expected in [([8, 6, 7], 7), (many, 15), ([], None), ([2, None, 5], 3.5)]:
        row = ([None if v is None else float(v) for v in values],)
        assert one(spark, row, "a array<double>", arrays.array_median(F.col("a"))) == expected


def test_json_fields(spark):
    df = spark.createDataFrame([('{"edge": 17, "note": "a \\"b\\""}',), ('{"note": null}',), ("no json",),
                                (None,)], "value string")
    rows = df.select(messages.json_fields(["edge", "note"])).collect()
    assert [tuple(r) for r in rows] == [("17", 'a "b"'), *[(None, None)] * 3]


def test_ids_and_numbers(spark):
    df = spark.createDataFrame([("12",), ("12.0",), ("4258014904",), ("9007199254740993",),
                                ("x",), (None,), ("12.7",)], "t string")
    rows = df.select(messages.to_id(F.col("t")), messages.to_number(F.col("t"))).collect()
    assert [r[0] for r in rows] == [12, 12, 4258014904, 9007199254740993, None, None, None]
    assert [r[1] for r in rows][:2] == [12.0, 12.0]


def test_message_texts(spark):
    assert one(spark, (7, 2.5), "e bigint, s double",
               messages.speed_message(F.col("e"), F.col("s"))) == '{"edge_id":7,"avg_speed":2.5}'
    assert one(spark, (7,), "e bigint", messages.anomaly_message(F.col("e"))) == '{"edgeId":"7"}'
    text = messages.sign_text(F.col("b"), F.col("f"), F.col("t"))
    assert one(spark, ("b1", 2, 3), "b string, f bigint, t bigint", text) == "b1.2.3"
    assert one(spark, (None, 2, 3), "b string, f bigint, t bigint", text) is None


def test_routing_pattern(spark):
    keys = ["car.current_location.simulated", ".current_location.simulated",
            "a.b.current_location.simulated", "car.current_location.simulated.x",
            "carXcurrent_location.simulated", "car.current_location.real"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    kept = df.where(messages.routing_matches(F.col("k"), "*.current_location.simulated"))
    assert [r.k for r in kept.collect()] == keys[:1]
