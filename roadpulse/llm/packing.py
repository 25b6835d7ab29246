"""Best-two-fit packing of token runs into sequences of a fixed length.

A sequence is filled greedily, largest piece first and always the largest that
still fits; then its smallest piece gives way to two unpacked pieces if they fill
the gap so expanded more tightly. Which pieces of one length go where does not
matter, so the plan is made from the number of pieces per length alone (at most
`capacity` numbers, however large the input): a pattern of lengths is repeated
for as long as each of its lengths lasts. Spark then deals the pieces out: piece
number r of its length belongs to the pattern whose range of numbers holds r.

Defined results: NULL text is empty text and packs its end id; NULL or repeated
doc_ids keep a piece per row; an empty table gives no rows; a document longer than
the capacity is cut into full pieces from its end, so that only its first piece
may be shorter; other columns are not read. A document must fit into memory
together with its ids.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.batches import binaries, released, slices
from roadpulse.llm.tokens import encoder
from roadpulse.session import settle

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, ids binary"
#: Characters of texts cut at once; bounds memory only.
_SLICE = 1_000_000


def _cut_texts(path: str, end_id: int, capacity: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in batches:
            for rows in slices(batch, "text", _SLICE):
                ids, counts = code.encode_ended([t or "" for t in rows.column("text").to_pylist()], end_id)
                parts = -(-counts // capacity)
                row = np.repeat(np.arange(len(counts)), parts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                # Where a piece ends, counted from the end of its document.
                behind = (parts[row] - 1 - piece) * capacity
                end = counts[row] - behind
                start = np.maximum(end - capacity, 0)
                first = np.concatenate([[0], np.cumsum(end - start)])
                data = ids.astype("<u4")
                view = memoryview(data).cast("B")
                crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                kept = binaries(data, first * 4) if keep_ids else pa.nulls(len(row), pa.binary())
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()),
                    pa.array(start), pa.array(end - start, pa.int32()), pa.array(crc, pa.int64()), kept],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
    return run


def cut_texts(docs: DataFrame, tokenizer: str, end_id: int, capacity: int,
              keep_ids: bool = True) -> DataFrame:
    """Token pieces of all texts, each text with its end id: the columns of `PIECES`."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        released(_cut_texts(tokenizer, end_id, capacity, keep_ids), keeps=True), PIECES)


class _Lengths:
    """How many pieces of each length are left, and the largest length up to a bound."""

    def __init__(self, counts: dict[int, int]):
        self.left = dict(counts)
        self.sorted = sorted(k for k, n in counts.items() if n)

    def largest(self, bound: int, used: dict[int, int]) -> int:
        """The largest length up to `bound` with more left than `used`; 0 if none."""
        k = bisect.bisect_right(self.sorted, bound) - 1
        while k >= 0 and self.left[self.sorted[k]] <= used.get(self.sorted[k], 0):
            k -= 1
        return self.sorted[k] if k >= 0 else 0

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n
        if not self.left[length]:
            self.sorted.remove(length)


def _fill(lengths: _Lengths, capacity: int) -> list[int]:
    chosen: list[int] = []
    used: dict[int, int] = {}
    gap = capacity
    while found := lengths.largest(gap, used):
        chosen.append(found)
        used[found] = used.get(found, 0) + 1
        gap -= found
    if gap and chosen:
        smallest = chosen[-1]
        used[smallest] -= 1
        wide, best = gap + smallest, (smallest, 0, 0)
        for a in reversed(lengths.sorted):  # the larger of the two
            if 2 * a <= best[0] or best[0] == wide:
                break
            if a >= wide or lengths.left[a] <= used.get(a, 0):
                continue
            b = lengths.largest(min(a, wide - a), {**used, a: used.get(a, 0) + 1})
            if b and a + b > best[0]:
                best = (a + b, a, b)
        if best[2]:
            chosen[-1:] = best[1:]
    return chosen


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(repetitions, lengths of one sequence) that use up the given numbers of pieces per length."""
    lengths, out = _Lengths(counts), []
    while lengths.sorted:
        chosen = _fill(lengths, capacity)
        per = {k: chosen.count(k) for k in chosen}
        times = min(lengths.left[k] // n for k, n in per.items())
        for k, n in per.items():
            lengths.take(k, n * times)
        out.append((times, chosen))
    return out


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the pieces of each length within the task."""
    task, seen = TaskContext.get().partitionId(), {}
    for batch in batches:
        length = batch.column("length").to_numpy()
        rank = np.empty(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        values, first, count = np.unique(length[order], return_index=True, return_counts=True)
        for v, f, n in zip(values.tolist(), first.tolist(), count.tolist()):
            rank[order[f:f + n]] = seen.get(v, 0) + np.arange(n)
            seen[v] = seen.get(v, 0) + n
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(length), task, np.int32)), pa.array(rank)],
            names=[*batch.schema.names, "_task", "_rank"])


def _slots(counts: dict[int, int], capacity: int) -> dict[int, tuple]:
    """Per length, the plan's ranges of piece numbers: first number, repetitions, first sequence, offsets."""
    out: dict[int, list] = {length: [] for length in counts}
    taken, sequence = dict.fromkeys(counts, 0), 0
    for times, chosen in plan(counts, capacity):
        at: dict[int, list[int]] = {}
        offset = 0
        for length in chosen:
            at.setdefault(length, []).append(offset)
            offset += length
        for length, offsets in at.items():
            for place in offsets:
                out[length].append((taken[length], sequence, place))
                taken[length] += times
        sequence += times
    return {length: tuple(np.array(column) for column in zip(*slots)) for length, slots in out.items()}


def _place(slots: dict[int, tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("_number").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for value in np.unique(length).tolist():
                rows = np.flatnonzero(length == value)
                first, first_sequence, place = slots[value]
                slot = np.searchsorted(first, number[rows], "right") - 1
                sequence[rows] = first_sequence[slot] + number[rows] - first[slot]
                offset[rows] = place[slot]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"])
    return run


_NUMBERED = "_task int, _rank long"


def _deal(numbered: DataFrame, capacity: int) -> DataFrame:
    """Numbered pieces with their sequence and offset."""
    own = numbered.drop("_task", "_rank")
    per_task = numbered.groupBy("_task", "length").agg(F.count("*").alias("_n"))
    # Numbers of a length run through the tasks one after the other.
    ahead = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    base = settle(per_task.withColumn("_base", F.coalesce(F.sum("_n").over(ahead), F.lit(0))), "lengths")
    counts = {r["length"]: r["n"] for r in  # at most `capacity` rows
              base.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    placed = numbered.join(base, ["_task", "length"]).select(
        *own.columns, (F.col("_rank") + F.col("_base")).alias("_number"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema)
    return placed.mapInArrow(_place(_slots(counts, capacity)), fields + ", sequence_id long, offset long")


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to pieces whose int column `length` is 1 to `capacity`."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return _deal(settle(pieces.mapInArrow(_rank, f"{fields}, {_NUMBERED}"), "pieces"), capacity)


def pack_texts(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """`pack` of the pieces of `cut_texts`, without their ids.

    Pieces are cut and numbered by one worker: with one each, both would come to hold an encoder.
    """
    cut, names = _cut_texts(tokenizer, end_id, capacity, keep_ids=False), [c.split()[0] for c in PIECES.split(", ")][:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _rank(pieces.select(names) for pieces in cut(batches))

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    numbered = own.mapInArrow(released(run, keeps=True), f"{PIECES.rsplit(', ', 1)[0]}, {_NUMBERED}")
    return _deal(settle(numbered, "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence as one binary, and its pieces in order; a sequence is at most `capacity` ids."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return packed.groupBy("sequence_id").agg(ordered.alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts, X'', (a, p) -> concat(a, p.ids))").alias("ids"),
        F.expr("transform(parts, p -> struct(p.doc_id, p.piece, p.offset, p.length))").alias("parts"))
