"""Messages of the streaming queries are dealt to all cores, a part to a micro-batch."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadpulse.operators.replay import replay_speeds
from roadpulse.plans import handover
from roadpulse.plans import tables as T


@pytest.fixture
def tables(spark, tmp_path):
    """Tables of so many events of five users on three edges, one of them unknown."""
    def make(ids):
        first = datetime(2024, 1, 1)
        rows = [(i, first + timedelta(seconds=i * 7919 % 5000), i % 5, "view", 1.0, f'{{"k": {i % 3}}}') for i in ids]
        spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, "
                              "props string").write.parquet(f"{tmp_path}/events.parquet")
        spark.createDataFrame([(0, 1, 10.0), (1, 1, 20.0), (2, 50, 30.0)], "p_partkey long, p_size int, "
                              "p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
        return str(tmp_path)
    return make


def test_state_has_as_many_partitions_as_the_session(spark, tables, tmp_path, monkeypatch):
    sf_dir, paths = tables(range(400)), []

    def noted(session, name):
        paths.append(f"{tmp_path}/{name}-{len(paths)}")
        return paths[-1]

    monkeypatch.setattr(handover, "fresh_path", noted)
    made = handover.stream_state_handover(spark, sf_dir)
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stores = [len([d for d in os.listdir(f"{p}/state/0") if d.isdigit()]) for p in paths if "checkpoint" in p]
    assert stores == [wide, 2 * wide]
    files = [len([f for f in os.listdir(p) if f.endswith(".parquet")]) for p in paths if "positions" in p]
    assert files == [wide, wide]
    plain = replay_speeds(T.arrivals(spark, sf_dir), T.lengths(spark, sf_dir))
    rounded = F.round("avg_speed", 9)
    rows = [sorted(map(tuple, f.select("uuid", "seq", "tick", "edge_id", rounded).collect())) for f in (made, plain)]
    assert rows[0] == rows[1] and rows[0]


def test_a_micro_batch_is_a_part_however_small(spark, tables, tmp_path):
    sf_dir = tables([0, 1, 2, 5])  # by the arrival sequence one event in each part
    session = handover.streaming_session(spark)
    stream = handover.position_stream(session, sf_dir)
    query = (stream.writeStream.format("parquet").option("path", f"{tmp_path}/out")
             .option("checkpointLocation", f"{tmp_path}/at").trigger(availableNow=True).start())
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1, 1]
    assert spark.read.parquet(f"{tmp_path}/out").count() == 4
