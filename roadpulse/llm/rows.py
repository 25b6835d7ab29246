"""Documents as one struct and a key, so that joins cannot clash with any column of theirs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_key() -> Column:
    """A hash of doc_id and text; equal for repeated rows."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, _row): the whole row and its key."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
                       row_key().alias("_row"))


def without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows whose key is not among `rows` (_row)."""
    return keyed(docs).join(rows.select("_row"), "_row", "left_anti").select("doc.*")
