"""Unusable lines and elements, observed numbers, sketches, pruned registration, one read for all sinks."""

import random
import re

import pytest
from pyspark.sql import functions as F

from roadpulse.__main__ import main
from roadpulse.operators import catalog, sketches
from roadpulse.operators.movement import edge_speeds
from roadpulse.plans import handover, jobs
from roadpulse.sinks import files as out
from roadpulse.sources import files as src
from roadpulse.streaming import alerts
from roadpulse.streaming.metrics import Totals

SF_DIR = "/root/testdata/sf0.001"
GOOD = '{"uuid":"a","capabilities":{"current_location":[{"date":"d","nodeID":7.0,"tick":"%d"}]}}'
HISTORY = [GOOD % 3, '{"uuid":"a","capabilities":', "lost", "", "[]", GOOD % 9,
           '{"uuid":"c","capabilities":{"current_location":[{"date":"d","nodeID":"x","tick":"3"}]}}']
MODEL = ["mad,upper_threshold,lower_threshold,edgeId", "1,2,3,7", "x3.0,1,2,8", "1,2,3", ",,,9", "1,2,3,", "NaN,1,2,4",
         "1,2,3,4,5"]
VEHICLES = ["n;1;2;7;1;600;car;u1", "n;1;2;7;1;600;car;", "n;1;2;7;one;600;car;u2", "n;1"]
LOG = ["7;0;100;car;c1;16;40;10", "7;0;soon;car;c1;16;40;10", "7;0;100;car"]


def put(folder, name, lines):
    (folder / name).write_text("\n".join(lines) + "\n")
    return f"{folder}/{name}"


@pytest.mark.parametrize("scan, lines, bad", [
    (src.scan_histories, HISTORY, {HISTORY[1], "lost", "[]", HISTORY[6]}),
    (src.scan_model, MODEL, {"x3.0,1,2,8", "1,2,3", "1,2,3,", "1,2,3,4,5"}),
    (src.scan_vehicles, VEHICLES, {*VEHICLES[1:]}), (src.scan_trip_log, LOG, {*LOG[1:]})])
def test_no_line_vanishes(spark, tmp_path, scan, lines, bad):
    found = scan(spark, put(tmp_path, "in.txt", lines))
    assert {r.line for r in found.rejects.collect()} == bad
    some = [x for x in lines if x and not x.startswith("mad,")]
    assert found.rows.count() + found.rejects.count() == len(some)
    with pytest.raises(Exception, match="unreadable|no uuid|no edge id"):
        found.strict.collect()
    good = scan(spark, put(tmp_path, "good.txt", [x for x in lines if x not in bad]))
    assert repr(good.strict.collect()) == repr(found.rows.collect()) and good.rejects.count() == 0


def test_narrow_reads_reject_the_same_lines(spark, tmp_path):
    """A reader that needs one column only still leaves out a line whose other columns are broken."""
    found = src.scan_model(spark, put(tmp_path, "model.csv", MODEL))
    assert sorted(r.edge_id for r in found.rows.select("edge_id").collect()) == [4, 7, 9]
    assert found.rejects.select("reason").distinct().count() == 2


def sections(text, tag):
    """Elements outside comments and CDATA sections, by a walk through the text."""
    parts = re.compile(r"(?s)<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<" + tag + r"\s[^>]*>")
    return [m for m in parts.findall(text) if m.startswith(f"<{tag}")]


@pytest.mark.parametrize("seed", range(6))
def test_sections_over_splits(spark, tmp_path, seed):
    """Marks inside the other kind of section mean nothing, wherever the splits of the file lie."""
    rnd = random.Random(seed)
    parts = []
    for i in range(300):
        parts.append(rnd.choice([f'<link id="{i}" from="1" to="2" length="1"/>'] * 4 + [
            "<!--", "-->", "<![CDATA[", "]]>", "<!-- x -->", "<b>", "text", "<!-- ]]>", "<![CDATA[ -->"]))
    text = "<links>" + "\n".join(parts)
    (tmp_path / "map.xml").write_text(text)
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", rnd.choice(["700", "2500", "100000"]))
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    got = sorted(r.edge_id for r in src.scan_links(session, f"{tmp_path}/map.xml").rows.collect())
    assert got == sorted(int(re.search(r'id="(\d+)"', e)[1]) for e in sections(text, "link"))


def test_unreadable_elements(spark, tmp_path):
    path = put(tmp_path, "map.xml", [
        '<network><link id="x" from="1" to="2" length="3"/>', '<link id="1" from="1" to="2" length="far"/>',
        '<link id="2" from=1 to="2" length="3"/>', '<link id="3" from="1" to="2"/>', '<link id="4.0" from="1" to="2" length="5" n="a > b">t > u</link>',
        '<link id="5" from="1" to="2" length="3" length="4"/>', '<node id="6" x="1" y="here"/><node id="7" x="1" y="2"/></network>',
        '<link id="8" from="1"'])
    found = src.scan_links(spark, path)
    assert {r.edge_id: r.length for r in found.rows.collect()} == {3: None, 4: 5.0}
    assert sorted(r.reason for r in found.rejects.collect()) == ["length is no number", "no id", *["unreadable"] * 3]
    nodes = src.scan_nodes(spark, path)
    assert [r.reason for r in nodes.rejects.collect()] == ["y is no number"] and nodes.rows.count() == 1
    with pytest.raises(Exception, match="no id|is no number|unreadable"):
        src.read_links(spark, path).collect()


TRIPS = ['<scsimulator_matrix>', '<trip name="a" count="3" start="10.0" origin="1" destination="2" link_origin="1" mode="car"/>',
         '<trip name="b" count="3" start="10.5" origin="1" destination="2" link_origin="1" mode="car"/>',
         '<trip name="c" start="10" origin="1" destination="2" link_origin="1" mode="car"/>',
         '<trip name="d" count=3/>', '</scsimulator_matrix>']


def test_trips_without_numbers(spark, tmp_path):
    path = put(tmp_path, "trips.xml", TRIPS)
    with pytest.raises(Exception, match="unreadable|without start or count"):
        jobs.split_trip_file(spark, path, 0, 99, f"{tmp_path}/cut")
    main(["split-trips", path, "0", "99", f"{tmp_path}/cut", "--rejects", f"{tmp_path}/bad"], spark)
    assert [(r.name, r.start, r["count"]) for r in src.read_trips(spark, f"{tmp_path}/cut").collect()] == [("a", "10", "2")]
    assert sorted((r.name, r.reason) for r in spark.read.json(f"{tmp_path}/bad").collect()) == [
        ("b", "no start"), ("c", "no count")]
    assert [r.reason for r in spark.read.json(f"{tmp_path}/bad-elements").collect()] == ["unreadable"]
    main(["expand-trips", path, f"{tmp_path}/vehicles", "--seed", "s", "--rejects", f"{tmp_path}/bad2"], spark)
    assert src.read_vehicles(spark, f"{tmp_path}/vehicles").count() == 3


def test_training_reports_what_it_saw(spark, tmp_path):
    put(tmp_path, "histories.json", [*HISTORY, GOOD.replace("7.0", "8.0") % 12, GOOD.replace("7.0", "99") % 20, GOOD.replace("%d", "no")])
    put(tmp_path, "map.xml", ['<link id="7" from="1" to="2" length="6"/><link id="8" from="1" to="2" length="9"/>'])
    arguments = ["train-model", f"{tmp_path}/histories.json", f"{tmp_path}/map.xml", f"{tmp_path}/model"]
    with pytest.raises(Exception, match="unreadable"):
        main(arguments, spark)
    main([*arguments, "--rejects", f"{tmp_path}/bad", "--metrics", f"{tmp_path}/numbers"], spark)
    numbers = {r.metric: r.number for r in spark.read.json(f"{tmp_path}/numbers").collect()}
    assert numbers == {"points": 5, "points with no uuid": 0, "points with no tick": 1, "points with no edge": 0,
                       "moves": 3, "moves on unknown edges": 1}
    assert spark.read.json(f"{tmp_path}/bad-lines").count() == 4 and spark.read.json(f"{tmp_path}/bad").count() == 1
    assert {r.edge_id: r.mad for r in src.read_model(spark, f"{tmp_path}/model").collect()} == {7: 0.0, 8: 0.0, 99: None}


def test_sketches_of_days(spark, tmp_path):
    """More speeds than a sketch holds, in three loads, one of which is repeated."""
    n, k = 60_000, 200
    positions = spark.range(n).select(
        (F.col("id") % 7).cast("string").alias("uuid"),
        (F.col("id") * 5 + F.pmod(F.xxhash64("id"), F.lit(5))).alias("tick"), (F.col("id") % 2).alias("edge_id"))
    edges = spark.createDataFrame([(0, 90.0), (1, 40.0)], "edge_id bigint, length double")
    day = F.floor(F.col("tick") / 20_000)
    path, carried = f"{tmp_path}/sketches", None
    for low, high in ((0, 4), (4, 11), (11, 99)):
        for _ in range(2 if low == 4 else 1):
            sketches.add_days(path, positions.where((day >= low) & (day < high)), edges, carried, k, 20_000)
        carried = sketches.last_points(positions.where(day < high))
    speeds = edge_speeds(positions, edges)
    bounds = sketches.sketched_bounds(sketches.read_sketches(spark, path))
    total = {r.edge_id: r.n for r in speeds.groupBy("edge_id").agg(F.count("kmh").alias("n")).collect()}
    assert {r.edge_id: r.n for r in bounds.collect()} == total
    for row in sketches.rank_errors(bounds, speeds).collect():
        assert row.median_error < sketches.rank_error(k) * 2 and row.mad_error < sketches.deviation_error(k) * 2
    sizes = sketches.read_sketches(spark, path).select(F.max(F.octet_length("sketch"))).first()[0]
    assert sizes < 8_000


def cars(spark, ids):
    return catalog.cars(spark.createDataFrame([(str(i),) for i in ids], "uuid string"))


def test_registration_reads_and_writes_touched_partitions_only(spark, tmp_path):
    path = f"{tmp_path}/catalog"
    out.register(cars(spark, range(500)), path)
    before = {r.file: r.modified for r in spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified")).collect()}
    wanted = cars(spark, [3, 3, 9001])
    out.register(wanted, path)
    after = {r.file for r in spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file")).collect()}
    assert len(before) == catalog.BUCKETS and len(set(before) - after) == 1
    for _ in range(2):  # a repeated run changes nothing
        out.register(wanted, path)
    ids = [r.uuid for r in src.read_catalog(spark, path).collect()]
    assert len(ids) == len(set(ids)) == 501
    assert src.read_catalog(spark, path).columns == ["uuid", "description", "capabilities", "status", "lat", "lon"]


def test_absent_scans_only_the_buckets_of_the_wanted(spark, tmp_path):
    path = f"{tmp_path}/catalog"
    out.register(cars(spark, range(500)), path)
    wanted = catalog.with_bucket(cars(spark, [7, 9001]))
    present = src.in_buckets(spark, path, wanted.drop(catalog.BUCKET).schema, wanted)
    text = catalog.absent(wanted, present)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*bucket#\d+ IN \(", text)
    assert present.select(catalog.BUCKET).distinct().count() <= 2
    assert [r.uuid for r in catalog.absent(wanted, present).collect()] == ["9001"]


def test_one_read_feeds_all_sinks(spark, tmp_path):
    """Two queries over one detection read every message twice; the fan-out reads it once."""
    session = handover.streaming_session(spark)
    source = handover._speed_files(session, SF_DIR)
    model = handover._low_model(session, SF_DIR)
    expected = session.read.parquet(source).count()

    def rows_of(query):
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    from roadpulse.sinks.streams import to_files
    from roadpulse.sources.streams import file_messages
    twice = alerts.start_alerts(file_messages(session, source), model,
                                lambda frame, at: to_files(frame, f"{tmp_path}/two", at), f"{tmp_path}/c2", None)
    assert sum(rows_of(q) for q in twice) == 2 * expected
    seen, totals = [], Totals("speeds")
    session.streams.addListener(totals)
    query = alerts.start_fan_out(file_messages(session, source, per_trigger=1), model, [
        lambda found, i: seen.append((i, found.count())), lambda found, i: seen.append((i, found.count()))], f"{tmp_path}/c1")
    assert rows_of(query) == expected
    assert totals.get()["messages"] == totals.rows == expected
    session.streams.removeListener(totals)
    assert len(seen) == 6 and seen[::2] == seen[1::2]
    assert sum(n for _, n in seen) == 2 * spark.read.parquet(f"{tmp_path}/two").count()
