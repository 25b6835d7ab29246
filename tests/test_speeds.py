"""The keyed speed rule: batch replay and stream against a plain model."""

import json
import random

import pytest

from roadpulse.operators.replay import last_ticks, replay_speeds
from roadpulse.sinks.streams import to_files
from roadpulse.sources.streams import file_messages, positions
from roadpulse.streaming.speeds import SPEEDS, speed_records, speed_stream

LENGTHS = {7: 100.0, 8: 50.0}
TRACE = [("a", 0, 10, 7), ("a", 1, 20, 8), ("a", 2, 30, 99), ("a", 3, 40, 8), ("a", 4, 35, 7),
         ("a", 5, 36, 99), ("a", 6, 50, 7), ("b", 7, 5, 99), ("b", 8, 5, 99), ("b", 9, 9, 8)]
EXPECTED = [("a", 1, 20, 8, 5.0), ("a", 3, 40, 8, 2.5), ("a", 6, 50, 7, 100 / 15),
            ("b", 9, 9, 8, 12.5)]


def model(points, held=None):
    held, out = {} if held is None else held, []
    for uuid, seq, tick, edge in sorted(points, key=lambda p: p[1]):
        before, length = held.get(uuid), LENGTHS.get(edge)
        if before is not None and tick > before:
            if length is None:
                continue
            out.append((uuid, seq, tick, edge, length / (tick - before)))
        held[uuid] = tick
    return sorted(out)


def edges(spark):
    return spark.createDataFrame(list(LENGTHS.items()), "edge_id bigint, length double")


def arrivals(spark, points):
    return spark.createDataFrame(points, "uuid string, seq bigint, tick bigint, edge_id bigint")


def test_trace(spark):
    assert model(TRACE) == EXPECTED
    assert sorted(map(tuple, replay_speeds(arrivals(spark, TRACE), edges(spark)).collect())) \
        == EXPECTED


def disordered(seed, n):
    rnd = random.Random(seed)
    return [(rnd.choice("aaaabc"), i, max(0, i + rnd.randrange(-12, 12)),
             rnd.choice([7, 8, 8, 99, 99, 98])) for i in range(n)]


@pytest.mark.parametrize("slice_bits", [0, 1, 3, 20])
def test_replay_equals_model_across_slices(spark, slice_bits):
    points = disordered(slice_bits, 400)
    got = replay_speeds(arrivals(spark, points), edges(spark), slice_bits).collect()
    assert sorted(map(tuple, got)) == model(points)


def write_messages(spark, points, path):
    rows = [("car.current_location.simulated",
             json.dumps({"uuid": u, "tick": t, "nodeID": e}), s) for u, s, t, e in points]
    rows += [("car.current_location.real", '{"uuid":"a","tick":1,"nodeID":7}', -1),
             ("car.current_location.simulated", "no json", -2)]
    spark.createDataFrame(rows, "key string, value string, seq bigint").write.mode("append").parquet(path)


def run(spark, folder, start=None):
    points = positions(file_messages(spark, f"{folder}/in"))
    speeds = speed_stream(points, edges(spark), start)
    to_files(speeds, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return sorted(map(tuple, spark.read.schema(SPEEDS).parquet(f"{folder}/out").collect()))


def test_stream_equals_model_over_restarts(spark, tmp_path):
    """State outlives the query: three runs over one growing folder."""
    points = TRACE + [(u + "x", s + 100, t, e) for u, s, t, e in disordered(1, 150)]
    for upto, since in ((4, 0), (60, 4), (len(points), 60)):
        write_messages(spark, points[since:upto], f"{tmp_path}/in")
        assert run(spark, tmp_path) == model(points[:upto])


def test_bulk_stream_equals_model_over_restarts(spark, tmp_path):
    from roadpulse.streaming.bulk import start_bulk_speeds
    points = TRACE + [(u + "x", s + 100, t, e) for u, s, t, e in disordered(3, 150)]
    for upto, since in ((4, 0), (60, 4), (110, 60), (len(points), 110)):
        write_messages(spark, points[since:upto], f"{tmp_path}/in")
        query = start_bulk_speeds(
            positions(file_messages(spark, f"{tmp_path}/in")), edges(spark), f"{tmp_path}/state",
            lambda df, i: df.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={i}"),
            f"{tmp_path}/checkpoint")
        query.awaitTermination()
        assert query.exception() is None
        got = spark.read.schema(SPEEDS).parquet(f"{tmp_path}/out").drop("batch").collect()
        assert sorted(map(tuple, got)) == model(points[:upto])


def test_repeated_bulk_batch_starts_from_the_same_state(spark, tmp_path):
    """The state before a batch survives a failure between its two writes."""
    from roadpulse.streaming.bulk import start_bulk_speeds
    points = disordered(4, 90)
    failures = []

    def write(df, batch_id):
        df.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={batch_id}")
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise RuntimeError("lost")

    for upto, since in ((40, 0), (90, 40), (90, 90)):
        if upto > since:
            write_messages(spark, points[since:upto], f"{tmp_path}/in")
        query = start_bulk_speeds(
            positions(file_messages(spark, f"{tmp_path}/in")), edges(spark),
            f"{tmp_path}/state", write, f"{tmp_path}/checkpoint")
        try:
            query.awaitTermination()
        except Exception as error:
            assert "lost" in str(error)
    assert failures == [1]
    got = spark.read.schema(SPEEDS).parquet(f"{tmp_path}/out").drop("batch").collect()
    assert sorted(map(tuple, got)) == model(points)


def test_stream_goes_on_from_a_replay(spark, tmp_path):
    points = TRACE + disordered(2, 120)[10:]
    early, late = points[:70], points[70:]
    held = {}
    model(early, held)
    start = last_ticks(arrivals(spark, early), edges(spark), 3)
    assert {r.uuid: r.tick for r in start.collect()} == held
    replayed = replay_speeds(arrivals(spark, late), edges(spark), 3, start).collect()
    assert sorted(map(tuple, replayed)) == model(late, dict(held))
    after = dict(held)
    model(late, after)
    end = last_ticks(arrivals(spark, late), edges(spark), 3, start).collect()
    assert {r.uuid: r.tick for r in end} == after
    write_messages(spark, late, f"{tmp_path}/in")
    assert run(spark, tmp_path, start) == model(late, held)


def test_state_is_handed_over(spark, tmp_path):
    """The state in a checkpoint is that of the plain model, and starts another query."""
    from roadpulse.streaming.speeds import held_ticks
    points = TRACE + disordered(6, 150)[10:]
    early, late, held = points[:90], points[90:], {}
    write_messages(spark, early, f"{tmp_path}/a/in")
    assert run(spark, f"{tmp_path}/a") == model(early, held)
    ticks = held_ticks(spark, f"{tmp_path}/a/checkpoint")
    assert {r.uuid: r.tick for r in ticks.collect()} == held
    write_messages(spark, late, f"{tmp_path}/b/in")
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "3")
    assert run(session, f"{tmp_path}/b", held_ticks(session, f"{tmp_path}/a/checkpoint")) == model(late, held)


def test_positions_need_their_order(spark):
    rows = [("car.current_location.simulated", '{"uuid": "a", "tick": 1, "nodeID": 7.0}', None)]
    messages = spark.createDataFrame(rows, "key string, value string, seq bigint")
    with pytest.raises(Exception, match="without seq"):
        positions(messages).collect()


def test_speed_records(spark):
    speeds = spark.createDataFrame([EXPECTED[0]], SPEEDS)
    assert speed_records(speeds).first().value == '{"edge_id":8,"avg_speed":5.0}'
