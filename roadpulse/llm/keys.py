"""Shuffling very many (64-bit key, owner) pairs as a few packed rows.

Each row holds the keys of one bucket from one slice of the input, sorted by
owner, so that a pair costs little more than the eight bytes of its key. Tasks that
receive rows hold their share of all pairs at once, which
`spark.sql.shuffle.partitions` sets; senders let a key through only a few times
per slice, however many owners it has there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.batches import binaries

PACKED = "bucket int, owners binary, sizes binary, keys binary, counts binary"
_NAMES = ["bucket", "owners", "sizes", "keys", "counts"]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_count(spark: SparkSession) -> int:
    """Buckets that keys are dealt into: several per task, so that tasks get even shares."""
    return 4 * partitions(spark)


def pack(keys: np.ndarray, owners: np.ndarray, buckets: int, counts: np.ndarray | None = None,
         places: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of `PACKED`; pairs of one owner must stand together. Counts, if any, go with the keys.

    `places`, equal for equal keys, deal out the keys; by default they do so themselves.
    """
    bucket = (((keys if places is None else places) >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    keys, owners, bucket = keys[order], owners[order], bucket[order]
    change = np.ones(len(keys), bool)
    change[1:] = (bucket[1:] != bucket[:-1]) | (owners[1:] != owners[:-1])
    runs = np.flatnonzero(change)
    sizes = np.diff(np.append(runs, len(keys))).astype("<u4")
    names, first = np.unique(bucket, return_index=True)
    ends = np.append(first, len(keys))
    run_ends = np.searchsorted(runs, ends)
    return pa.RecordBatch.from_arrays([
        pa.array(names), binaries(owners[runs].astype("<i8"), run_ends * 8),
        binaries(sizes, run_ends * 4), binaries(keys.astype("<u8"), ends * 8),
        pa.nulls(len(names), pa.binary()) if counts is None
        else binaries(counts[order].astype("<u4"), ends * 4)], names=_NAMES)


def flat(column: pa.Array, kind: str) -> np.ndarray:
    """All numbers of a binary column, one row after the other."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    if column.buffers()[2] is None:
        return np.zeros(0, kind)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(kind)


def unpack(batches: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and owners of packed rows."""
    if not batches:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys = np.concatenate([flat(b.column("keys"), "<u8") for b in batches])
    owners = np.concatenate([flat(b.column("owners"), "<i8") for b in batches])
    sizes = np.concatenate([flat(b.column("sizes"), "<u4") for b in batches])
    return keys, np.repeat(owners, sizes)


def marked(ids: DataFrame, column: str, bits: int = 23, hashed: bool = True) -> np.ndarray:
    """A fixed 2^bits bitmap holding the hashes of all ids: a filter that never misses one.

    Its size does not depend on the number of ids; too many ids only make it
    let more rows through. Ids that are hashes already need no other (`hashed`).
    """
    place = F.pmod(F.xxhash64(column) if hashed else F.col(column), F.lit(1 << bits))
    words = (ids.select(place.alias("p")).groupBy(F.shiftright("p", 5).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(p & 31 as int)))").alias("bits")).toArrow())
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return out


def is_marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether ids with these hashes may be in the bitmap."""
    place = np.mod(hashes, len(bitmap) * 32)
    return (bitmap[place >> 5] >> (place & 31).astype(np.uint32)) & np.uint32(1) != 0
