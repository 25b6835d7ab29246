"""Token ids as files of range asymmetric numeral system (rANS) blocks.

One static frequency table, counted over the whole corpus, codes every block.
A block holds the ids of consecutive whole documents, dealt in turn to `LANES`
interleaved coders that share one stream of 32-bit words. Checkpoints (word
position and coder states every `EVERY` steps) let a block be decoded from
several places at once; a crc32 covers each block. The coders are 64 bits wide
and run in NumPy, over all lanes and blocks of a group at a time.

Files, in a folder: ``table`` (one row: the frequency table), and ``blocks``
(``shard=k/``; rows shard, start, n_ids, frame), shards and, by `start`, blocks
in ascending doc_id order. A frame is self-contained but for the table:

    magic "RNS1", crc32 of the rest | n_docs, n_ids, lanes, every, n_words (u32)
    | doc ids (i64) | 1 for each NULL doc id (u8) | ids per document (u32)
    | word position (u32) and states (u64 x lanes) per checkpoint | words (u32)

Defined results: NULL text is empty text and yields the end id alone; documents
with a NULL doc_id come first, those with equal doc_ids are ordered by text and
keep their own entries; an empty table gives no blocks; other columns of the
input are not read. A document must fit into memory together with its ids.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.batches import binaries, ragged, slices
from roadpulse.llm.tokens import SLICE_CHARS, encoder
from roadpulse.session import fresh_path

LANES, EVERY, BLOCK_IDS = 128, 512, 262_144
#: Ids coded together by one call; bounds memory only.
GROUP_IDS = 4_000_000
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4sI5I")


class Table:
    """Frequencies scaled to 2^bits, at least 1 for every id that occurs."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        order = np.argsort(ids)
        self.ids, counts = ids[order].astype(np.uint32), counts[order].astype(np.float64)
        self.bits = max(16, int(np.ceil(np.log2(max(len(ids), 2)))) + 3)
        size = 1 << self.bits
        shares = np.maximum(1, np.floor(counts / counts.sum() * (size - len(ids)))).astype(np.int64)
        # What rounding left over goes to the most frequent id, or comes from the largest.
        by_size = np.argsort(-shares, kind="stable")
        rest = size - int(shares.sum())
        for k in by_size:
            step = rest if rest > 0 else max(rest, 1 - int(shares[k]))
            shares[k] += step
            rest -= step
            if not rest:
                break
        self.share = shares.astype(np.uint64)
        self.below = np.concatenate([[0], np.cumsum(shares)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(ids), dtype=np.uint32), shares)
        self.position = np.zeros(int(self.ids[-1]) + 1, np.int32)
        self.position[self.ids] = np.arange(len(ids))


def encode_blocks(table: Table, blocks: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of every block of ids: checkpoint word positions, checkpoint states, and words."""
    steps = np.array([-(-len(b) // LANES) for b in blocks])
    order = np.argsort(-steps, kind="stable")
    out: list = [None] * len(blocks)
    first = 0
    while first < len(order):
        longest = max(int(steps[order[first]]), 1)
        group = order[first:first + max(1, GROUP_IDS // (longest * LANES))]
        first += len(group)
        active = np.searchsorted(-steps[group], -np.arange(longest), "left")
        symbols = np.zeros((len(group), longest * LANES), np.int32)
        for k, b in enumerate(group):  # the unused lanes of the last step code symbol 0
            symbols[k, :len(blocks[b])] = table.position[blocks[b]]
        symbols = np.ascontiguousarray(symbols.reshape(len(group), longest, LANES).swapaxes(0, 1))
        states = np.full((len(group), LANES), _LOW, np.uint64)
        spilled = np.zeros(symbols.shape, bool)
        low = np.zeros(symbols.shape, np.uint32)
        checkpoints = np.zeros((-(-longest // EVERY), len(group), LANES), np.uint64)
        bits, limit = np.uint64(table.bits), np.uint64(63 - table.bits)
        for t in range(longest - 1, -1, -1):
            m = active[t]
            x, s = states[:m], symbols[t, :m]
            share = table.share[s]
            over = x >= (share << limit)
            spilled[t, :m], low[t, :m] = over, x
            x = x >> (over.astype(np.uint64) << np.uint64(5))
            whole = x // share
            states[:m] = (whole << bits) + (x - whole * share) + table.below[s]
            if t % EVERY == 0:
                checkpoints[t // EVERY, :m] = states[:m]
        for k, b in enumerate(group):
            mask = spilled[:steps[b], k]
            at = np.concatenate([[0], np.cumsum(mask.sum(axis=1))])
            marks = np.arange(0, steps[b], EVERY)
            out[b] = (at[marks].astype(np.uint32), checkpoints[:len(marks), k].copy(),
                      low[:steps[b], k][mask])
    return out


def decode_blocks(table: Table, coded: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """The ids of blocks given as (number of ids, checkpoint positions, states, words)."""
    pieces = []  # block, first step, steps, word position, states
    base, words = 0, []
    for b, (n, positions, states, stream) in enumerate(coded):
        steps = -(-n // LANES)
        for k, position in enumerate(positions):
            pieces.append((b, k * EVERY, min(EVERY, steps - k * EVERY), base + int(position), states[k]))
        words.append(stream)
        base += len(stream)
    out = [np.zeros(-(-n // LANES) * LANES, np.uint32) for n, *_ in coded]
    if pieces:
        pieces.sort(key=lambda p: -p[2])
        stream = np.concatenate(words).astype(np.uint64)
        lengths = np.array([p[2] for p in pieces])
        at = np.array([p[3] for p in pieces], np.int64)
        states = np.stack([p[4] for p in pieces])
        found = np.zeros((EVERY, len(pieces), LANES), np.uint32)
        bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
        for t in range(int(lengths[0])):
            m = int(np.searchsorted(-lengths, -t, "left"))
            x = states[:m]
            slot = x & mask
            s = table.symbol[slot.astype(np.int64)]
            found[t, :m] = s
            x = table.share[s] * (x >> bits) + slot - table.below[s]
            short = x < _LOW
            read = np.count_nonzero(short, axis=1)
            x[short] = (x[short] << np.uint64(32)) | stream[ragged(at[:m], read)]
            states[:m] = x
            at[:m] += read
        for k, (b, step, n, *_) in enumerate(pieces):
            out[b][step * LANES:(step + n) * LANES] = found[:n, k].reshape(-1)
    return [table.ids[ids[:n]] if n else ids[:0] for ids, (n, *_) in zip(out, coded)]


def pack_frame(doc_ids: list, counts: np.ndarray, n_ids: int,
               coded: tuple[np.ndarray, np.ndarray, np.ndarray]) -> bytes:
    positions, states, words = coded
    body = b"".join([
        struct.pack("<5I", len(doc_ids), n_ids, LANES, EVERY, len(words)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        bytes(d is None for d in doc_ids), counts.astype("<u4").tobytes(),
        positions.astype("<u4").tobytes(), states.astype("<u8").tobytes(), words.astype("<u4").tobytes()])
    return b"RNS1" + struct.pack("<I", zlib.crc32(body)) + body


def read_frame(frame: bytes) -> tuple[list, np.ndarray, tuple]:
    """Doc ids, ids per document, and what `decode_blocks` takes; raises on damage."""
    magic, crc, n_docs, n_ids, lanes, every, n_words = _HEAD.unpack_from(frame)
    if magic != b"RNS1" or (lanes, every) != (LANES, EVERY) or crc != zlib.crc32(memoryview(frame)[8:]):
        raise ValueError("damaged block")
    at = _HEAD.size

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(frame, kind, n, at)
        at += found.nbytes
        return found

    ids, null, counts = take("<i8", n_docs), take("u1", n_docs), take("<u4", n_docs)
    marks = -(-(-(-n_ids // LANES)) // EVERY)
    coded = (n_ids, take("<u4", marks), take("<u8", marks * LANES).reshape(marks, LANES),
             take("<u4", n_words))
    return [None if n else int(d) for d, n in zip(ids, null)], counts, coded


def _encode_texts(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        shard, start = TaskContext.get().partitionId(), 0
        seen = np.zeros(max(code.vocabulary, end_id + 1), np.int64)
        for batch in batches:
            for rows in slices(batch, "text", SLICE_CHARS):
                ids, counts = code.encode_ended([t or "" for t in rows.column("text").to_pylist()], end_id)
                seen += np.bincount(ids, minlength=len(seen))
                ends = np.concatenate([[0], np.cumsum(counts)])
                width = "<u2" if len(seen) <= 1 << 16 else "<u4"
                data = ids.astype(width)
                n = rows.num_rows
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, shard, np.int32)), rows.column("doc_id"),
                    pa.array(start + ends[:-1]), pa.array(counts.astype(np.int32)),
                    binaries(data, ends * data.itemsize), pa.nulls(n, pa.list_(pa.int32())),
                    pa.nulls(n, pa.list_(pa.int64()))], names=_TOKENS)
                start += int(ends[-1])
        used = np.flatnonzero(seen)
        if len(used):
            yield pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.nulls(1, pa.int64()), pa.array([start]),
                pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()),
                pa.array([used.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([seen[used]], pa.list_(pa.int64()))], names=_TOKENS)
    return run


_TOKENS = ["shard", "doc_id", "start", "n_ids", "ids", "used", "seen"]
_TOKENS_TYPE = ("shard int, doc_id long, start long, n_ids int, ids binary, "
                "used array<int>, seen array<long>")


def _encode_ids(table: Table, before: dict[int, int], wide: bool):
    kind = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard, first, end = [], None, 0, 0  # the block being filled
        closed, closed_ids = [], 0

        def close():
            nonlocal held, closed_ids
            if held:
                ids = np.concatenate([np.frombuffer(i, kind) for _, i in held])
                closed.append((shard, before[shard] + first, [d for d, _ in held],
                               np.array([len(i) // int(kind[-1]) for _, i in held]), ids))
                closed_ids += len(ids)
                held = []

        def write():
            nonlocal closed, closed_ids
            if closed:
                coded = encode_blocks(table, [c[4] for c in closed])
                frames = [pack_frame(c[2], c[3], len(c[4]), x) for c, x in zip(closed, coded)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([c[0] for c in closed], pa.int32()),
                    pa.array([c[1] for c in closed], pa.int64()),
                    pa.array([len(c[4]) for c in closed], pa.int64()),
                    pa.array(frames, pa.binary())], names=["shard", "start", "n_ids", "frame"])
            closed, closed_ids = [], 0

        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for k, (s, start) in enumerate(zip(columns[0].to_pylist(), columns[2].to_pylist())):
                if s != shard or start != end or end - first >= BLOCK_IDS:
                    close()
                    shard, first = s, start
                    if closed_ids >= GROUP_IDS:
                        yield from write()
                held.append((columns[1][k].as_py(), columns[4][k].as_py()))
                end = start + len(held[-1][1]) // int(kind[-1])
        close()
        yield from write()
    return run


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> None:
    """Encode every text, in ascending doc_id order, into a new folder."""
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tokens_path = fresh_path(spark, "tokens")
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .repartitionByRange(shards, F.col("doc_id"), F.xxhash64("text"))
     .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
     .mapInArrow(_encode_texts(tokenizer, end_id), _TOKENS_TYPE)
     .write.option("compression", "zstd").parquet(tokens_path))
    tokens = spark.read.schema(_TOKENS_TYPE).parquet(tokens_path)
    totals = tokens.where("seen IS NOT NULL")
    # At most one row per id of the vocabulary, and one per shard.
    counts = (totals.select(F.explode(F.arrays_zip("used", "seen")).alias("c"))
              .groupBy("c.used").agg(F.sum("c.seen").alias("seen")).toPandas())
    if not len(counts):
        counts = counts.reindex([0]).fillna(1).assign(used=end_id)
    sizes = totals.select("shard", "start").toPandas().sort_values("shard")
    before = dict(zip(sizes["shard"].tolist(), (sizes["start"].cumsum() - sizes["start"]).tolist()))
    ids, seen = counts["used"].to_numpy(np.int64), counts["seen"].to_numpy(np.int64)
    order = np.argsort(ids)
    spark.createDataFrame([(ids[order].tolist(), seen[order].tolist())],
                          "ids array<long>, counts array<long>").write.parquet(f"{folder}/table")
    wide = encoder(tokenizer).vocabulary > 1 << 16 or end_id >= 1 << 16
    (tokens.where("ids IS NOT NULL")
     .mapInArrow(_encode_ids(Table(ids, seen), before, wide),
                 "shard int, start long, n_ids long, frame binary")
     .write.partitionBy("shard").option("compression", "none").parquet(f"{folder}/blocks"))


def _decode(table: Table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, frames = batch.column("start").to_pylist(), batch.column("frame")
            for first in range(0, batch.num_rows, 16):
                read = [read_frame(f.as_py()) for f in frames[first:first + 16]]
                ids = decode_blocks(table, [r[2] for r in read])
                for start, (doc_ids, counts, _), block in zip(starts[first:], read, ids):
                    ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                    data = block.astype("<u4")
                    yield pa.RecordBatch.from_arrays([
                        pa.array(doc_ids, pa.int64()), pa.array(start + ends[:-1]),
                        pa.array(counts.astype(np.int64)), binaries(data, ends * 4)],
                        names=["doc_id", "start", "n_tokens", "ids"])
    return run


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a folder: doc_id, start (ids before it), n_tokens, ids (32-bit little-endian)."""
    row = spark.read.parquet(f"{folder}/table").first()
    table = Table(np.array(row["ids"]), np.array(row["counts"]))
    blocks = spark.read.schema("start long, n_ids long, frame binary, shard int").parquet(f"{folder}/blocks")
    return blocks.select("start", "frame").mapInArrow(
        _decode(table), "doc_id long, start long, n_tokens long, ids binary")


def digest(ids: DataFrame) -> DataFrame:
    return ids.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
