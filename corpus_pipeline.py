"""From raw documents to packed training sequences, one stage after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import decontaminate, language, lines, ngram_join, packing
from roadpulse.llm.queries import tokenizer_path
from roadpulse.llm.rows import row_key, without
from roadpulse.llm.ship import ship
from roadpulse.session import delete, fresh_path, scratch, settle, write

SEQUENCE, END_ID = 1024, 2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language known from the labels; texts unlike any of them go.

    NULL texts and texts without a letter are of no language and go; of repeated rows all stay or go;
    without any label all go; short texts are allowed more. Columns stay as they are.
    """
    ship(spark)
    model = language.fit(docs.select("text", "lang"))
    keyed = docs.select("doc_id", "text", "lang", row_key().alias("_row"))
    predicted = settle(language.predict(keyed, model, "lang", "_row"), "predicted")
    rejected = language.rejected(predicted, language.limits(predicted)).select("_row").distinct()
    return without(docs, rejected)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that nearly repeat an earlier one.

    NULL and empty texts stay; the earliest line is that of the smallest doc_id (NULL comes last), then
    place; repeated rows lose the same lines; documents left without any line go.
    """
    ship(spark)
    return lines.dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies.

    The one of the smallest doc_id stays (NULL comes last), then of the smallest hash of its text; of
    repeated rows one; texts without words all stay.
    """
    ship(spark)
    return ngram_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item.

    NULL and empty texts and items hold nothing and match nothing; equal rows go or stay together.
    """
    ship(spark)
    keyed = docs.select(row_key().alias("doc_id"), "text")
    found = decontaminate.matches(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, found.select(F.col("doc_id").alias("_row")).distinct())


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents and their places in sequences of 1024.

    A NULL or empty text is the end token alone; every row has its own pieces, repeated ones too; which
    of equally long pieces comes where is not defined.
    """
    ship(spark)
    return packing.pack_texts(docs, tokenizer_path("byte_bpe_50k.json"), END_ID, SEQUENCE)


#: The stages in order: name, function of (spark, docs, sf_dir).
STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_join", near_duplicates),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: No stage but the first filter can be said in SQL; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. What a stage settled on its way goes when its result is written, and that
    result when the next one is."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name)
        with scratch(spark):
            kept = stage(spark, docs, sf_dir)
            write(kept, path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if last:
            delete(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
