import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from roadpulse.functions.geo import with_latlon
from roadpulse.operators import catalog, detect, signs
from roadpulse.sinks.streams import sign_records, to_files
from roadpulse.sources.streams import file_messages
from roadpulse.streaming import alerts
from tests.test_geo import POINTS

SPEED_MESSAGES = ['{"edge_id": 1, "avg_speed": 3.50}', '{"edge_id": "2.0", "avg_speed": 0.5}',
                  '{"edge_id": 1, "avg_speed": 4}', '{"edge_id": 3, "avg_speed": 0}',
                  '{"edge_id": 4, "avg_speed": 0}', '{"edge_id": 77, "avg_speed": 0}',
                  '{"edge_id": 1}', "no json"]


def model(spark):
    rows = [(1, 4.0), (2, 1.0), (3, float("nan")), (4, None)]
    return spark.createDataFrame(rows, "edge_id bigint, lower_threshold double")


def messages(spark, texts):
    return spark.createDataFrame([(None, t, i) for i, t in enumerate(texts)],
                                 "key string, value string, seq bigint")


def road(spark):
    nodes = spark.createDataFrame([p[:3] for p in POINTS], "node_id bigint, x double, y double")
    edges = spark.createDataFrame(
        [(1, 1492963064, 28149752, 10.0), (2, 931131905, 28149752, 10.0), (3, 5, 6, 1.0)],
        "edge_id bigint, from_node bigint, to_node bigint, length double")
    return edges, nodes, catalog.boards(with_latlon(nodes))


def test_only_slower_than_a_known_lower_bound(spark):
    speeds = detect.parse_speeds(messages(spark, SPEED_MESSAGES))
    found = detect.anomaly_messages(detect.anomalies(speeds, model(spark)))
    assert sorted(r.value for r in found.collect()) == ['{"edgeId":"1"}', '{"edgeId":"2.0"}']
    flags = detect.flag(speeds, model(spark)).groupBy("is_anomaly").count().collect()
    assert {r.is_anomaly: r["count"] for r in flags} == {True: 2, False: 6}


def sign_bodies(frame):
    return sorted(r.body for r in frame.collect())


def test_signs_by_radius(spark):
    found = spark.createDataFrame([(1,)], "edge_id bigint")
    near = {28149752, 1819616337, 142788951, 4258014904, 1492963064}
    assert sign_bodies(signs.sign_messages(found, *road(spark))) == sorted(
        f"{b}.1492963064.28149752" for b in near)
    assert sign_bodies(signs.sign_messages(found, *road(spark), radius=700.0)) == sorted(
        f"{b}.1492963064.28149752" for b in (28149752, 142788951, 1492963064))


@pytest.mark.parametrize("edge, reason", [(None, "no edge id"), (77, "unknown edge"),
                                          (3, "unknown node")])
def test_unusable_anomalies(spark, edge, reason):
    edges, nodes, boards = road(spark)
    found = spark.createDataFrame([(2,), (edge,)], "edge_id bigint")
    with pytest.raises(Exception, match=reason):
        signs.sign_messages(found, edges, nodes, boards).collect()
    assert sign_bodies(signs.sign_messages(found, edges, nodes, boards, strict=False)) == [
        "931131905.931131905.28149752"]
    with pytest.raises(Exception, match=reason):
        signs.sign_messages(found, edges, nodes, boards.where("status = 'gone'")).collect()
    rejected = signs.rejected_anomalies(found, edges, nodes).collect()
    assert [(r.edge_id, r.reason) for r in rejected] == [(edge, reason)]


def test_board_without_description(spark):
    edges, nodes, boards = road(spark)
    nameless = boards.withColumn("description", F.lit(None).cast("string"))
    found = spark.createDataFrame([(1,)], "edge_id bigint")
    with pytest.raises(Exception, match="board without description"):
        signs.sign_messages(found, edges, nodes, nameless).collect()
    assert signs.sign_messages(found, edges, nodes, nameless, strict=False).count() == 0


def test_stream_to_two_sinks_and_on_to_signs(spark, tmp_path):
    messages(spark, SPEED_MESSAGES).write.parquet(f"{tmp_path}/speeds")
    as_record = [F.lit(None).cast("string").alias("key"), "value",
                 F.lit(0).cast("bigint").alias("seq")]

    def send(frame, checkpoint):
        return to_files(frame.select(*as_record), f"{tmp_path}/anomalies", checkpoint)

    queries = alerts.start_alerts(file_messages(spark, f"{tmp_path}/speeds"), model(spark), send,
                                  f"{tmp_path}/checkpoint", show_every=None)
    for query in queries:
        query.awaitTermination()
        assert query.exception() is None
    found = [r.value for r in spark.read.parquet(f"{tmp_path}/anomalies").collect()]
    assert sorted(found) == ['{"edgeId":"1"}', '{"edgeId":"2.0"}']

    sent = alerts.signs(file_messages(spark, f"{tmp_path}/anomalies"), *road(spark))
    to_files(sent, f"{tmp_path}/signs", f"{tmp_path}/signs-checkpoint").awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/signs").collect()
    batch = sign_records(signs.sign_messages(
        spark.createDataFrame([(1,), (2,)], "edge_id bigint"), *road(spark))).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, batch))
    assert len(rows) == 6 and {r.key for r in rows} == {"#"}


def test_console_brings_only_the_rows_it_shows(tmp_path):
    """Over a driver that takes a megabyte of results, a micro-batch of eight is worked out and shown."""
    script = f"""
from pyspark.sql import functions as F
from roadpulse.session import build_session
from roadpulse.sinks.streams import to_console
spark = build_session("console", "local[2]", {{
    "spark.driver.maxResultSize": "1m", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    "spark.driver.host": "127.0.0.1", "spark.sql.warehouse.dir": "{tmp_path}/tables"}})
seen = spark.sparkContext.accumulator(0)
rows = spark.range(0, 8000, 1, 2).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
rows.write.parquet("{tmp_path}/rows")
stream = spark.readStream.schema(rows.schema).parquet("{tmp_path}/rows")

def count(batches):
    for batch in batches:
        seen.add(batch.num_rows)
        yield batch

query = to_console(stream.mapInArrow(count, rows.schema), every=None)
query.awaitTermination()
print("seen", seen.value)
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=os.path.dirname(os.path.dirname(__file__)),
                          capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
    shown = [line for line in done.stdout.splitlines() if "xxx" in line]
    ids = [int(line.split("|")[1]) for line in shown]
    assert "Batch: 0" in done.stdout and ids == [*range(ids[0], ids[0] + 20)]
    assert "seen 8000" in done.stdout
