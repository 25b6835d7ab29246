"""Files the jobs read: road map, trips, histories, model, trip logs.

Every source is scanned once: its usable rows, and the lines or elements that are not
usable, with the reason. Nothing vanishes: usable and rejected lines together are all lines.
`read_*` give the rows alone and fail at the first unusable line.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse import schemas
from roadpulse.functions.messages import once, to_id, to_number
from roadpulse.operators.catalog import BUCKET
from roadpulse.operators.lookup import last_write_wins
from roadpulse.session import exists, settle

# The name of an attribute and its value as written.
_ATTRIBUTE = r"""([^\s=/"']+)\s*=\s*("[^"]*"|'[^']*')"""
# A tag up to its ">", which may stand in a quoted value too.
_HEAD = r"""(?s)^([^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)>"""
# The whole text of a record that could not be read goes to this column.
_UNREAD = "_unread"
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _UNREAD}
UNREADABLE = "unreadable"


@dataclass(frozen=True)
class Scan:
    """What a source holds: `rows`, `rejects` (line, reason), and `strict`, the rows of a
    source without rejects, which is an error to read from any other."""

    rows: DataFrame
    rejects: DataFrame
    strict: DataFrame


def _scan(judged: DataFrame, finish: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Scan:
    """`judged`: rows with the `_line` they come from and the `_reason` to reject it, if any."""
    reason = F.col("_reason")
    told = F.raise_error(F.concat(reason, F.lit(": "), F.substring("_line", 1, 1000)))
    checked = judged.where(F.when(reason.isNull(), F.lit(True)).otherwise(told.cast("boolean")))
    return Scan(finish(judged.where(reason.isNull()).drop("_line", "_reason")),
                judged.where(reason.isNotNull()).select(F.col("_line").alias("line"), reason.alias("reason")),
                finish(checked.drop("_line", "_reason")))


def _reason(*cases: tuple[Column, str]) -> Column:
    """The first reason that applies; unreadable text comes before all others."""
    out = F.when(F.col(_UNREAD).isNotNull(), UNREADABLE)
    for applies, reason in cases:
        out = out.when(applies, reason)
    return out.alias("_reason")


def _lines(spark: SparkSession, path: str, parsed: Column, header: str | None = None) -> DataFrame:
    """`_line` of text files, without empty ones and headers, and the fields it is parsed to, once."""
    value = F.col("value")
    lines = spark.read.text(path).where(F.trim(value) != "")
    if header:
        lines = lines.where(F.translate(value, '" ', "") != header)
    return lines.select(once(value.alias("_line"), parsed.alias("read"))).select("_line", "read.*")


def _csv(spark: SparkSession, path: str, schema: str, sep: str, header: str | None = None) -> DataFrame:
    parsed = F.from_csv("value", f"{schema}, {_UNREAD} string", {**_PERMISSIVE, "sep": sep})
    return _lines(spark, path, parsed, header)


# --- XML ------------------------------------------------------------------------

def _pieces(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """The files cut at every "<": pieces that begin an element `tag`, or begin or end a comment
    or a CDATA section that reaches over several pieces; with their `position`. Written once.
    """
    value = F.col("value")
    element = value.rlike(rf"^{tag}[\s/>]")
    closes = {"comment": value.contains("-->"), "cdata": value.contains("]]>")}
    opens = (F.when(value.startswith("!--") & ~closes["comment"], "comment")
             .when(value.startswith("![CDATA[") & ~closes["cdata"], "cdata"))
    head = F.regexp_extract(value, _HEAD, 1)
    # A tag that does not end is left as it is, and cannot be read.
    written = F.when(head == "", F.concat(F.lit("<"), value)).otherwise(
        F.concat(F.lit("<"), F.regexp_replace(head, r"/$", ""), F.lit("/>")))
    pieces = (spark.read.option("lineSep", "<").text(path)
              .where(element | opens.isNotNull() | closes["comment"] | closes["cdata"])
              .select(F.col("_metadata.file_path").alias("path"),
                      F.struct(F.col("_metadata.file_block_start").alias("block"),
                               F.monotonically_increasing_id().alias("place")).alias("position"),
                      F.when(element, written).alias("element"), opens.alias("opens"),
                      closes["comment"].alias("comment"), closes["cdata"].alias("cdata")))
    return settle(pieces, f"{tag}-pieces")


def _hidden(marks: DataFrame) -> DataFrame:
    """(path, begin, end): comments and CDATA sections, from the piece that opens one to the one that
    ends it. An opening inside another section does not count.

    The pieces that open or end sections are put in order per file; elements are not.
    """
    in_file = Window.partitionBy("path").orderBy("position")
    # In descending order: a frame that grows is added to, one that shrinks is computed anew per row.
    behind = Window.partitionBy("path").orderBy(F.desc("position")).rowsBetween(Window.unboundedPreceding, -1)
    ahead = in_file.rowsBetween(Window.unboundedPreceding, -1)
    end = F.when(F.col("opens") == "comment", F.min(F.when(F.col("comment"), F.col("position"))).over(behind)).otherwise(
        F.min(F.when(F.col("cdata"), F.col("position"))).over(behind))
    # One that does not end reaches to the end of the file.
    last = F.struct(F.lit(1 << 62).alias("block"), F.lit(1 << 62).alias("place"))
    opened = (marks.withColumn("end", end).where(F.col("opens").isNotNull())
              .withColumn("end", F.coalesce("end", last)))
    # An opening behind the ends of all before it lies outside; only those up to the next
    # such one can lie inside each other, and are walked through.
    reach = F.max("end").over(ahead)
    outside = F.coalesce(F.col("position") > reach, F.lit(True))
    span = F.struct(F.col("position").alias("begin"), F.col("end").alias("end"))
    groups = (opened.withColumn("outside", outside)
              .withColumn("group", F.sum(F.col("outside").cast("int")).over(in_file))
              .groupBy("path", "group").agg(F.sort_array(F.collect_list(span)).alias("spans")))
    walked = F.aggregate("spans", F.slice("spans", 1, 1), lambda done, s: F.when(
        s["begin"] > F.element_at(done, -1)["end"], F.concat(done, F.array(s))).otherwise(done))
    return groups.select("path", F.explode(walked).alias("s")).select("path", "s.*")


def _tags(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """`element`, one XML element `tag` without what it holds, and its `position` in the documents.

    The files are cut at every "<", so large ones are read by many tasks. Elsewhere
    "<" is always escaped, but in comments and CDATA sections: elements inside
    these do not count. Where such sections lie is told by the pieces that open and end them; a
    split of a file learns from the splits before it whether it begins inside one.
    """
    pieces = _pieces(spark, path, tag)
    position = F.struct("path", "position").alias("position")
    marks = pieces.where("opens IS NOT NULL OR comment OR cdata")
    if marks.where("opens IS NOT NULL").isEmpty():
        return pieces.where("element IS NOT NULL").select("element", position)
    hidden = _hidden(marks)
    steps = hidden.select("path", F.explode(F.array(
        F.struct(F.col("begin").alias("position"), F.lit(1).alias("step")),
        F.struct(F.col("end").alias("position"), F.lit(-1).alias("step")))).alias("s")).select("path", "s.*")
    rows = pieces.join(steps, ["path", "position"], "left").withColumn("block", F.col("position.block"))
    split = Window.partitionBy("path", "block").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (steps.groupBy("path", F.col("position.block").alias("block")).agg(F.sum("step").alias("step"))
              .unionByName(pieces.select("path", F.col("position.block").alias("block"), F.lit(0).cast("bigint").alias("step")).distinct())
              .groupBy("path", "block").agg(F.sum("step").alias("step"))
              .select("path", "block", F.coalesce(F.sum("step").over(before), F.lit(0)).alias("open")))
    inside = F.coalesce(F.sum("step").over(split), F.lit(0)) + F.col("open")
    return (rows.join(splits, ["path", "block"]).withColumn("inside", inside)
            .where((F.col("inside") == 0) & F.col("element").isNotNull()).select("element", position))


def _elements(spark: SparkSession, path: str, tag: str, names: list[str]) -> DataFrame:
    """`_line`, the element; its named attributes as text; `position`."""
    schema = ", ".join(f"`_{n}` string" for n in names) + f", {_UNREAD} string"
    read = F.from_xml("element", schema, _PERMISSIVE)
    tags = _tags(spark, path, tag).select(once(F.col("element").alias("_line"), "position", read.alias("read")))
    return tags.select("_line", "position", F.col(f"read.{_UNREAD}").alias(_UNREAD),
                       *(F.col(f"read.`_{n}`").alias(n) for n in names))


def _numbers(elements: DataFrame, ids: dict[str, str], numbers: dict[str, str]) -> DataFrame:
    """Attributes as numbers under new names. An id that is missing or no whole number, and a
    number that is there but none, are reasons to reject the element."""
    cases = [(to_id(F.col(a)).isNull(), f"no {a}") for a in ids]
    cases += [(F.col(a).isNotNull() & to_number(F.col(a)).isNull(), f"{a} is no number") for a in numbers]
    return elements.select("_line", "position", *(to_id(F.col(a)).alias(n) for a, n in ids.items()),
                           *(to_number(F.col(a)).alias(n) for a, n in numbers.items()), _reason(*cases))


def scan_links(spark: SparkSession, path: str) -> Scan:
    """edge_id, from_node, to_node, length; of a repeated id the last one counts."""
    ids, numbers = {"id": "edge_id", "from": "from_node", "to": "to_node"}, {"length": "length"}
    links = _numbers(_elements(spark, path, "link", [*ids, *numbers]), ids, numbers)
    return _scan(links, lambda rows: last_write_wins(rows, ["edge_id"], "position").select(
        "edge_id", "from_node", "to_node", "length"))


def scan_nodes(spark: SparkSession, path: str, latlon: bool = False) -> Scan:
    """node_id, x, y, and with `latlon` lat, lon; of a repeated id the last one counts."""
    names = ["x", "y", *(["lat", "lon"] if latlon else [])]
    nodes = _numbers(_elements(spark, path, "node", ["id", *names]), {"id": "node_id"}, {n: n for n in names})
    return _scan(nodes, lambda rows: last_write_wins(rows, ["node_id"], "position").select("node_id", *names))


def scan_trips(spark: SparkSession, path: str) -> Scan:
    """All attributes of every <trip>, as text, under their own names.

    The names are gathered first; there are as many as the result has columns.
    """
    tags = settle(_tags(spark, path, "trip").select("element"), "trips")
    names = [r[0] for r in tags.select(F.explode(F.regexp_extract_all(
        "element", F.lit(_ATTRIBUTE), F.lit(1))).alias("name")).distinct().orderBy("name").collect()] or ["name"]
    schema = ", ".join(f"`_{n}` string" for n in names) + f", {_UNREAD} string"
    read = F.from_xml("element", schema, _PERMISSIVE)
    trips = tags.select(once(F.col("element").alias("_line"), read.alias("read")))
    return _scan(trips.select("_line", F.col(f"read.{_UNREAD}").alias(_UNREAD),
                              *(F.col(f"read.`_{n}`").alias(n) for n in names))
                 .withColumn("_reason", _reason()).drop(_UNREAD))


# --- lines ----------------------------------------------------------------------

def scan_histories(spark: SparkSession, path: str) -> Scan:
    """Landed vehicle histories, one JSON object per line."""
    schema = T.StructType([*schemas.HISTORIES.fields, T.StructField(_UNREAD, T.StringType())])
    parsed = F.from_json("value", schema, _PERMISSIVE)
    return _scan(_lines(spark, path, parsed).withColumn("_reason", _reason()).drop(_UNREAD))


def scan_model(spark: SparkSession, path: str) -> Scan:
    """Bounds per edge; an empty field is a bound that is not known."""
    rows = _csv(spark, path, schemas.MODEL, ",", schemas.MODEL_HEADER)
    rows = rows.withColumn("_reason", _reason((F.col("edgeId").isNull(), "no edge id")))
    return _scan(rows.drop(_UNREAD).withColumnRenamed("edgeId", "edge_id"))


def scan_trip_log(spark: SparkSession, path: str) -> Scan:
    return _scan(_csv(spark, path, schemas.TRIP_LOG, ";").withColumn("_reason", _reason()).drop(_UNREAD))


def scan_vehicles(spark: SparkSession, path: str) -> Scan:
    """Expanded trips, one row per vehicle, `uuid` last."""
    rows = _csv(spark, path, schemas.TRIPS_CSV, ";")
    return _scan(rows.withColumn("_reason", _reason((F.col("uuid").isNull(), "no uuid"))).drop(_UNREAD))


def read_links(spark: SparkSession, path: str) -> DataFrame:
    return scan_links(spark, path).strict


def read_nodes(spark: SparkSession, path: str, latlon: bool = False) -> DataFrame:
    return scan_nodes(spark, path, latlon).strict


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    return scan_trips(spark, path).strict


def read_histories(spark: SparkSession, path: str) -> DataFrame:
    return scan_histories(spark, path).strict


def read_model(spark: SparkSession, path: str) -> DataFrame:
    return scan_model(spark, path).strict


def read_trip_log(spark: SparkSession, path: str) -> DataFrame:
    return scan_trip_log(spark, path).strict


def read_vehicles(spark: SparkSession, path: str) -> DataFrame:
    return scan_vehicles(spark, path).strict


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a catalog, without the partition they lie in."""
    names = [c.name for c in T.StructType.fromDDL(schemas.CATALOG)]
    return spark.read.schema(f"{schemas.CATALOG}, {BUCKET} int").parquet(path).select(*names)


def in_buckets(spark: SparkSession, path: str, schema: T.StructType, rows: DataFrame) -> DataFrame | None:
    """Of a table in buckets, the partitions that `rows` fall into; None if there is no such table.

    The numbers of the buckets, of which there are a fixed few, are read on the driver: the scan
    then lists and opens those folders only, whatever way the join takes that follows.
    """
    if not exists(spark, path):
        return None
    touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]
    table = spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path)
    return table.where(F.col(BUCKET).isin(touched))
