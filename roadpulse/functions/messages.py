"""Reading and writing message text, and tolerant number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_fields(names: list[str], value: str = "value") -> Column:
    """One text column per top-level JSON field, parsed together; NULL where absent or not JSON.

    This is a generator: one per select, and filters on the fields stay behind
    it, so a message is parsed once. Of a repeated field the last one counts.
    """
    return F.json_tuple(value, *names).alias(*names)


def once(*columns: Column | str) -> Column:
    """The given columns, computed once per row and before any filter on them."""
    return F.inline(F.array(F.struct(*columns)))


def to_id(text: Column) -> Column:
    """Integer id from text such as '12' or '12.0'; NULL if it is no whole number.

    The form is looked at first: a failing cast costs far more than a match.
    """
    text = F.trim(text)
    number = text.try_cast("double")
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint")).otherwise(
        F.when(number == F.floor(number), number.try_cast("bigint")))


def to_number(text: Column) -> Column:
    return text.try_cast("double")


def anomaly_message(edge_id: Column) -> Column:
    return F.to_json(F.struct(edge_id.cast("string").alias("edgeId")))


def speed_message(edge_id: Column, avg_speed: Column) -> Column:
    return F.to_json(F.struct(edge_id.alias("edge_id"), avg_speed.alias("avg_speed")))


def sign_text(board: Column, from_node: Column, to_node: Column) -> Column:
    """board.from.to; NULL if a part is missing (concat_ws alone would skip it)."""
    complete = board.isNotNull() & from_node.isNotNull() & to_node.isNotNull()
    return F.when(complete, F.concat_ws(".", board, from_node.cast("string"),
                                        to_node.cast("string")))


def routing_matches(routing_key: Column, pattern: str) -> Column:
    """Topic pattern over dotted words; `*` stands for exactly one word."""
    words = ["[^.]+" if word == "*" else rf"\Q{word}\E" for word in pattern.split(".")]
    return routing_key.rlike("^" + "[.]".join(words) + "$")
