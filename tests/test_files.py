import pytest

from roadpulse.plans import jobs
from roadpulse.sinks import files as out
from roadpulse.sources import files as src

MAP = """<?xml version="1.0"?>
<network><nodes>
  <node id="1492963064" x="2819047.8169967565" y="7207524.748861773"/>
  <node id="28149752"
        x="2819667.100838852" y="7207723.5201618755"></node>
  <node id="5" x="1" y="2"/><node id="5" x="3" y="4.5" note="a &gt; b"/>
</nodes>
<links capperiod="01:00:00">
  <link id="1" from="1492963064" to="28149752" length="12.5" modes="car">
    <attr a="1"/></link>
  <link id="2" from="28149752" to="5" length="7"/>
  <link id="2" from="28149752" to="5" length="9"/>
</links></network>
"""

TRIPS = """<scsimulator_matrix>
  <trip name="a" origin="1" destination="2" link_origin="7" count="3" start="600" mode="car" extra="x"/>
  <trip name="b" origin="1" destination="2" link_origin="7" count="2" start="1300" mode="car"/>
  <trip name="c" origin="1" destination="2" link_origin="7" count="0" start="700" mode="bus"/>
</scsimulator_matrix>
"""


@pytest.fixture
def road_map(tmp_path):
    (tmp_path / "map.xml").write_text(MAP)
    return f"{tmp_path}/map.xml"


def test_road_map(spark, road_map):
    links = {r.edge_id: tuple(r)[1:] for r in src.read_links(spark, road_map).collect()}
    assert links == {1: (1492963064, 28149752, 12.5), 2: (28149752, 5, 9.0)}
    nodes = {r.node_id: tuple(r)[1:] for r in src.read_nodes(spark, road_map).collect()}
    assert nodes == {1492963064: (2819047.8169967565, 7207524.748861773),
                     28149752: (2819667.100838852, 7207723.5201618755), 5: (3.0, 4.5)}


def test_parallel_scan_splits_one_file(spark, tmp_path):
    rows = "".join(f'<link id="{i % 900}" from="{i}" to="{i + 1}" length="{i}"/>\n'
                   for i in range(1000))
    (tmp_path / "big.xml").write_text(f"<links>{rows}</links>")
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    text = session.read.option("lineSep", "<").text(f"{tmp_path}/big.xml")
    assert text.rdd.getNumPartitions() > 5
    expected = {i % 900: float(i) for i in range(1000)}
    split = src.read_links(session, f"{tmp_path}/big.xml")
    assert {r.edge_id: r.length for r in split.collect()} == expected


def test_comments_over_several_splits(spark, tmp_path):
    """Elements inside comments do not count, wherever the splits of the file lie."""
    link = '<link id="{0}" from="1" to="2" length="{0}"/>\n'.format
    parts = [link(i) for i in range(100)]
    parts += ["<!-- gone: <b> > ", *map(link, range(100, 300)), link(7).replace('th="7"', 'th="1"'), "-->\n"]
    parts += [*map(link, range(300, 320)), "<!--", link(400), "--><!-- x -->", link(401), "<!---->", link(402)]
    (tmp_path / "map.xml").write_text(f"<links>{''.join(parts)}</links>")
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    links = {r.edge_id: r.length for r in src.read_links(session, f"{tmp_path}/map.xml").collect()}
    assert links == {i: float(i) for i in [*range(100), *range(300, 320), 401, 402]}


def test_trip_split_keeps_unknown_attributes(spark, tmp_path):
    (tmp_path / "trips.xml").write_text(TRIPS)
    jobs.split_trip_file(spark, f"{tmp_path}/trips.xml", 600, 1200, f"{tmp_path}/cut")
    rows = {r.name: r.asDict() for r in src.read_trips(spark, f"{tmp_path}/cut").collect()}
    assert {n: (r["count"], r["start"], r["extra"]) for n, r in rows.items()} == {
        "a": ("2", "0", "x"), "c": ("0", "100", None)}


def test_all_attributes_are_read(spark, tmp_path):
    (tmp_path / "trips.xml").write_text(TRIPS)
    found = src.read_trips(spark, f"{tmp_path}/trips.xml")
    assert sorted(found.columns) == sorted(
        ["name", "origin", "destination", "link_origin", "count", "start", "mode", "extra"])
    assert sorted(map(tuple, found.select("name", "count", "start", "extra").collect())) == [
        ("a", "3", "600", "x"), ("b", "2", "1300", None), ("c", "0", "700", None)]


def test_expand_and_register_cars(spark, tmp_path):
    (tmp_path / "trips.xml").write_text(TRIPS)
    jobs.expand_trip_file(spark, f"{tmp_path}/trips.xml", f"{tmp_path}/vehicles", "s")
    lines = [r.value for r in spark.read.text(f"{tmp_path}/vehicles").collect()]
    assert len(lines) == 5 and all(len(line.split(";")) == 8 for line in lines)
    vehicles = src.read_vehicles(spark, f"{tmp_path}/vehicles").collect()
    for _ in range(2):
        jobs.register_cars(spark, f"{tmp_path}/vehicles", f"{tmp_path}/resources",
                           f"{tmp_path}/capabilities")
    resources = src.read_catalog(spark, f"{tmp_path}/resources").collect()
    assert sorted(r.uuid for r in resources) == sorted(r.uuid for r in vehicles)
    assert [r.name for r in spark.read.parquet(f"{tmp_path}/capabilities").collect()] == [
        "current_location"]


def test_model_file(spark, tmp_path):
    bounds = spark.createDataFrame([(7, 1.5, 9.0, 0.25), (8, None, None, None)],
                                   "edge_id bigint, mad double, upper_threshold double, "
                                   "lower_threshold double")
    out.write_model(bounds, f"{tmp_path}/model")
    header = spark.read.text(f"{tmp_path}/model").collect()
    assert "mad,upper_threshold,lower_threshold,edgeId" in {r.value for r in header}
    assert sorted(map(tuple, src.read_model(spark, f"{tmp_path}/model").select(
        "edge_id", "mad", "upper_threshold", "lower_threshold").collect()), key=repr) == [
        (7, 1.5, 9.0, 0.25), (8, None, None, None)]


def test_trip_logs(spark, tmp_path):
    (tmp_path / "base.csv").write_text("7;0;100;car;c1;16;40;10\n7;1;110;car;c2;9;30;20\n")
    (tmp_path / "events.csv").write_text("7;0;120;car;c1;16;60;12\n")
    jobs.compare_trip_logs(spark, f"{tmp_path}/base.csv", f"{tmp_path}/events.csv", f"{tmp_path}/out")
    rows = spark.read.option("header", True).csv(f"{tmp_path}/out").collect()
    assert {r.last_link: tuple(r)[1:] for r in rows} == {
        "3": ("10.0", "12.0", "40.0", "60.0"), "9": ("20.0", None, "30.0", None)}


def test_every_destination_is_compared(spark, tmp_path):
    (tmp_path / "log.csv").write_text("".join(f"7;0;100;car;c;{k};40;10\n" for k in range(2500)))
    from roadpulse.__main__ import main
    main(["compare-trips", f"{tmp_path}/log.csv", f"{tmp_path}/log.csv", f"{tmp_path}/out"], spark)
    rows = spark.read.option("header", True).csv(f"{tmp_path}/out")
    # Two destinations have the label of another one.
    assert rows.count() == rows.select("last_link").distinct().count() >= 2490


def test_converted_nodes(spark, road_map, tmp_path):
    jobs.convert_nodes(spark, road_map, f"{tmp_path}/nodes")
    rows = spark.read.format("xml").option("rowTag", "node").load(f"{tmp_path}/nodes").collect()
    node = {r["_id"]: r for r in rows}[1492963064]
    assert (node["_lat"], node["_lon"]) == pytest.approx((-23.55857329, -46.66861573), abs=1e-8)


def test_kafka_needs_only_the_connector(spark):
    """The connector is a package given at submit time; here it is absent."""
    from roadpulse.sources.streams import kafka_messages
    with pytest.raises(Exception, match="kafka"):
        kafka_messages(spark, "broker:9092", "data_stream")
