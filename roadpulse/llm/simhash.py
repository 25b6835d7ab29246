"""SimHash fingerprints of texts, and search within a Hamming radius by permuted block tables.

Terms are runs of `TERM` words, each as heavy as it is frequent in its text. The
128 bits of a term's hash vote for or against the bits of the fingerprint.

Search: a fingerprint is cut into `blocks` blocks. Two fingerprints that differ in
at most `radius` bits agree on `blocks - radius` whole blocks at least, so one
table per choice of so many blocks, keyed by their bits, holds every pair under an
equal key. Equal fingerprints are one entry. The search is exact.

Defined results: NULL text is empty; a text without words has the fingerprint 0;
NULL doc_ids come last in descending order, rows of equal doc_id are ordered by
text; repeated rows keep a row each; the only row of a table is next to itself; an
empty table gives no rows; other columns are not read. A text must fit into
memory together with the next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.batches import slices
from roadpulse.llm.keys import partitions
from roadpulse.llm.words import Words, mix

BITS, TERM = 128, 3
_LOWEST = -(1 << 63)


def fingerprints(column: pa.Array, term: int = TERM) -> np.ndarray:
    """(texts, 16) bytes."""
    hashes, _, counts = Words(column).windows(term, short=True)
    out = np.zeros((len(counts), BITS // 8), np.uint8)
    if not len(hashes):
        return out
    both = np.stack([hashes, mix(hashes + np.uint64(0x632BE59BD9B4E019))], axis=1)
    bits = np.unpackbits(both.view(np.uint8).reshape(len(hashes), -1), axis=1)
    # Eight-bit sums of at most 255 terms, then sums of those.
    parts = -(-counts // 255)
    text = np.repeat(np.arange(len(counts)), parts)
    part = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    votes = np.add.reduceat(bits, (np.cumsum(counts) - counts)[text] + part * 255, axis=0)
    some = np.flatnonzero(counts)
    votes = np.add.reduceat(votes, (np.cumsum(parts) - parts)[some], axis=0, dtype=np.int64)
    out[some] = np.packbits(2 * votes > counts[some, None], axis=1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 less the share of differing bits."""
    return 1 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def _hex(prints: np.ndarray) -> list[str]:
    text = prints.tobytes().hex()
    size = BITS // 4
    return [text[k:k + size] for k in range(0, len(text), size)]


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, "text", 1_000_000):
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(_hex(fingerprints(rows.column("text"))), pa.string())],
                names=["doc_id", "fingerprint"])


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (hexadecimal) of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _fingerprint, "doc_id long, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (bucket, ahead, key, doc_id, text) dealt and sorted so that each row with `ahead`
    false is followed, within its bucket, by the next in descending order of doc_id.

    Buckets are ranges of doc_id; a doc_id that fills several is cut by the hash of the
    text, which orders its rows. The first rows of each bucket are also sent to the one
    before, marked `ahead`: one per bucket, unless whole rows repeat. Texts are shuffled
    once.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("key"),
                        F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = partitions(spark)
    bounds = sorted(keyed.agg(F.percentile_approx("key", [k / n for k in range(1, n)] or [0.5], 10_000)).first()[0] or [])
    bucket = F.lit(0)
    if bounds:
        found = F.array(*map(F.lit, bounds))
        equal = F.size(F.filter(found, lambda b: b == F.col("key")))
        # 0 for the highest hashes, which come last among equal doc_ids, up to the number of equal bounds.
        part = F.floor((0.5 - F.col("_hash") / F.lit(2.0 ** 64)) * (equal + 1))
        bucket = F.size(F.filter(found, lambda b: b < F.col("key"))) + F.least(F.greatest(part, F.lit(0)), equal)
    keyed = keyed.withColumn("_hash", F.xxhash64("text")).withColumn("bucket", bucket.cast("int"))
    # One row per bucket, from the highest doc_id down; of that, the lowest hash.
    first = F.max(F.struct("key", F.bitwise_not("_hash").alias("rest")))
    heads = sorted(((r["bucket"], r["head"]["key"], ~r["head"]["rest"]) for r in
                    keyed.groupBy("bucket").agg(first.alias("head")).collect()), reverse=True)
    size = 1 + max((h[0] for h in heads), default=0)
    ahead = [[None] * size for _ in range(3)]
    for k, (own, key, text) in enumerate(heads):
        for column, value in zip(ahead, (key, text, heads[k - 1][0])):
            column[own] = value
    head = [F.element_at(F.array(*(F.lit(v).cast("long") for v in column)), F.col("bucket") + 1) for column in ahead]
    target = F.when((F.col("key") == head[0]) & (F.col("_hash") == head[1]), head[2]).cast("int")
    to = F.array(F.struct("bucket", F.lit(False).alias("ahead")),
                 F.struct(target.alias("bucket"), F.lit(True).alias("ahead")))
    both = keyed.select("key", "doc_id", "text", "_hash",
                        F.explode(F.filter(to, lambda x: x["bucket"].isNotNull())).alias("to"))
    return (both.select("to.*", "key", "doc_id", "text", "_hash").repartition(n, "bucket")
            .sortWithinPartitions("bucket", "ahead", F.desc("key"), "_hash", "text").drop("_hash"))


_EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double")


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _EDITED.split(", ")]
    held: pa.RecordBatch | None = None
    for batch in batches:
        for rows in slices(batch, "text", 1_000_000):
            if held is not None:
                rows = pa.Table.from_batches([held, rows]).combine_chunks().to_batches()[0]
            held = rows.slice(rows.num_rows - 1)
            texts = [t or "" for t in rows.column("text").to_pylist()]
            bucket = rows.column("bucket").to_numpy()
            own = ~rows.column("ahead").to_numpy(zero_copy_only=False)
            use = np.flatnonzero(own[:-1] & (bucket[1:] == bucket[:-1]))
            if not len(use):
                continue
            edited = []
            for k in use.tolist():
                third = len(texts[k]) // 3
                edited.append(texts[k][:len(texts[k]) - third] + texts[k + 1][:third])
            prints = fingerprints(rows.column("text"))
            changed = fingerprints(pa.array(edited, pa.string()))
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id").take(pa.array(use)),
                pa.array([len(texts[k]) for k in use], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                pa.array(_hex(prints[use])), pa.array(_hex(changed)),
                pa.array(likeness(prints[use], changed)), pa.array(likeness(prints[use], prints[use + 1]))],
                names=names)


def compare_edited(docs: DataFrame) -> DataFrame:
    """Each row's fingerprint against that of its text with the last third taken from the next row."""
    return with_next(docs).mapInArrow(_edit, _EDITED)


def within(queries: DataFrame, prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """Pairs (query, fingerprint, distance) of distinct fingerprints at most `radius` bits apart.

    Both frames need a hexadecimal column `fingerprint`. Keys of a table that
    many distinct fingerprints share are joined in parts by Spark.
    """
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("blocks must be more than the radius")
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    tables = list(combinations(range(blocks), blocks - radius))

    def keyed(frame: DataFrame, name: str) -> DataFrame:
        bits = F.concat(*(F.lpad(F.conv(F.substring("fingerprint", 1 + 8 * k, 8), 16, 2), 32, "0")
                          for k in range(BITS // 32)))
        distinct = frame.select("fingerprint").distinct().withColumn("_bits", bits)
        keys = [F.concat(F.lit(f"{t}:"), *(F.substring("_bits", edges[b] + 1, edges[b + 1] - edges[b])
                                           for b in chosen)) for t, chosen in enumerate(tables)]
        return distinct.select(F.col("fingerprint").alias(name), F.explode(F.array(*keys)).alias("_key"))

    halves = [F.bit_count(F.conv(F.substring("query", 1 + 8 * k, 8), 16, 10).cast("long").bitwiseXOR(
        F.conv(F.substring("fingerprint", 1 + 8 * k, 8), 16, 10).cast("long"))) for k in range(BITS // 32)]
    distance = sum(halves[1:], halves[0])
    pairs = keyed(queries, "query").join(keyed(prints, "fingerprint"), "_key").select(
        "query", "fingerprint", distance.cast("int").alias("distance"))
    return pairs.where(F.col("distance") <= radius).distinct()
