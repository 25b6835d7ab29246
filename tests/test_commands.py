"""The commands, end to end, on files."""

import json

from pyspark.sql import functions as F

from roadpulse.__main__ import main
from roadpulse.sources import files as src
from tests.test_files import MAP


def lines(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_from_histories_to_signs(spark, tmp_path):
    root = str(tmp_path)
    (tmp_path / "map.xml").write_text(MAP)

    def run(*args):
        main([str(a) for a in args], spark)

    # Each trip takes 5 ticks along edge 1; the last vehicle needs 50.
    histories = [{"uuid": f"v{i}", "capabilities": {"current_location": [
        {"date": "d", "nodeID": 2.0, "tick": "0"},
        {"date": "d", "nodeID": 1.0, "tick": str(5 + i % 2)}]}} for i in range(20)]
    lines(tmp_path / "histories.json", histories)
    run("train-model", f"{root}/histories.json", f"{root}/map.xml", f"{root}/model", "--inspect")
    model = src.read_model(spark, f"{root}/model").collect()
    assert [r.edge_id for r in model] == [1]
    assert 0 < model[0].lower_threshold < 12.5 / 6

    run("publish-board", 28149752, 2819667.100838852, 7207723.5201618755,
        f"{root}/resources", f"{root}/capabilities")
    positions = [("car.current_location.simulated",
                  json.dumps({"uuid": "v", "tick": t, "nodeID": e}), i)
                 for i, (t, e) in enumerate([(0, 2), (50, 1), (55, 1)])]
    positions.append(("car.current_location.simulated", '{"uuid": "v", "tick": 60, "nodeID": 1.7}', 9))
    spark.createDataFrame(positions, "key string, value string, seq bigint") \
        .write.parquet(f"{root}/positions")
    run("derive-speeds", f"{root}/map.xml", "--input", f"{root}/positions",
        "--output", f"{root}/speeds", "--checkpoint", f"{root}/c1", "--rejects", f"{root}/bad-points")
    assert [(r.seq, r.reason) for r in spark.read.json(f"{root}/bad-points").collect()] == [(9, "no edge")]
    run("derive-speeds", f"{root}/map.xml", "--replay", "--input", f"{root}/positions",
        "--output", f"{root}/replayed", "--checkpoint", f"{root}/c4")
    assert sorted(r.value for r in spark.read.parquet(f"{root}/replayed").collect()) == sorted(
        r.value for r in spark.read.parquet(f"{root}/speeds").collect())
    # Another query goes on where the first one stopped.
    later = [("car.current_location.simulated", json.dumps({"uuid": "v", "tick": 60, "nodeID": 1}), 10)]
    spark.createDataFrame(later, "key string, value string, seq bigint").write.parquet(f"{root}/later")
    run("derive-speeds", f"{root}/map.xml", "--take-over", f"{root}/c1", "--input", f"{root}/later",
        "--output", f"{root}/later-speeds", "--checkpoint", f"{root}/c5")
    assert [r.value for r in spark.read.parquet(f"{root}/later-speeds").collect()] == ['{"edge_id":1,"avg_speed":2.5}']
    speeds = spark.read.parquet(f"{root}/speeds").select(
        F.lit(None).cast("string").alias("key"), "value", F.lit(0).cast("bigint").alias("seq"))
    bad = spark.createDataFrame([(None, '{"edge_id": "1.5", "avg_speed": 3}', 0)], speeds.schema)
    speeds.union(bad).write.parquet(f"{root}/sent")
    run("detect-anomalies", f"{root}/model", "--input", f"{root}/sent",
        "--output", f"{root}/anomalies", "--checkpoint", f"{root}/c2", "--rejects", f"{root}/bad-speeds")
    assert [r.reason for r in spark.read.json(f"{root}/bad-speeds").collect()] == ["no edge id"]
    run("detect-anomalies", f"{root}/model", "--fan-out", "--input", f"{root}/sent",
        "--output", f"{root}/anomalies-too", "--checkpoint", f"{root}/c6", "--rejects", f"{root}/bad-speeds-too")
    assert [r.value for r in spark.read.parquet(f"{root}/anomalies-too").collect()] == ['{"edgeId":"1"}']
    # Lenient signs list the anomaly of an edge that the map lacks.
    found = spark.read.parquet(f"{root}/anomalies").select(
        F.lit(None).cast("string").alias("key"), "value", F.lit(0).cast("bigint").alias("seq"))
    found.union(spark.createDataFrame([(None, '{"edgeId": "99"}', 0)], found.schema)) \
        .write.parquet(f"{root}/found")
    run("publish-signs", f"{root}/map.xml", f"{root}/resources", "--input", f"{root}/found",
        "--output", f"{root}/signs", "--checkpoint", f"{root}/c3", "--lenient",
        "--rejects", f"{root}/bad-signs")
    assert [r.reason for r in spark.read.json(f"{root}/bad-signs").collect()] == ["unknown edge"]
    assert [r.value for r in spark.read.parquet(f"{root}/speeds").orderBy("value").collect()] == [
        '{"edge_id":1,"avg_speed":0.25}', '{"edge_id":1,"avg_speed":2.5}']
    assert [r.value for r in spark.read.parquet(f"{root}/anomalies").collect()] == [
        '{"edgeId":"1"}']
    assert [tuple(r) for r in spark.read.parquet(f"{root}/signs").select("key", "value").collect()] \
        == [("#", "28149752.1492963064.28149752")]
    run("health-check", "--input", f"{root}/positions")
