"""Exact Jaccard join of texts on word n-grams, with prefix trees.

Two texts link when 100 * |intersection| >= 75 * |union| of their sets of 5-word
shingles (lower-cased A-Z). Equal sets are one entry throughout.

1. In the order of their hashes, a set's first floor(n/4) + l shingles hold l
   shingles of any set it links with. Those prefixes are shuffled (packed, at most
   twice per slice) and every set without enough shared ones is out. Most texts go
   here.
2. Of the sets left, shingles are put into one global order, by the number of sets
   that hold them. Linked sets share one of their floor(n/4) + 1 rarest shingles,
   so each such shingle makes a group of sets to be compared.
   A pair is looked for in the group of the first shingle it has in common, behind which
   both must hold the shingles that they share.
3. Groups are resolved into components (`components.similar`). A set is compared
   with a batch of others through a prefix tree of them in the global order, most
   frequent first, so that sets with equal beginnings share the count of what they
   have in common; subtrees that cannot reach the bound with the length that
   remains are left out.

Defined results: NULL text and texts without words have an empty set and no link
(their component is their own doc_id); a text of fewer words than 5 is one
shingle; rows with a NULL doc_id take part, and a component of such rows alone is
NULL; repeated rows keep a row each; an empty table gives no rows; other columns
are not read. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.batches import binaries, released, slices
from roadpulse.llm.components import EDGE, lists, similar, sketches
from roadpulse.llm.keys import PACKED, bucket_count, flat, is_marked, marked, pack, partitions, unpack
from roadpulse.llm.rows import keyed
from roadpulse.llm.words import Words, _run_hashes
from roadpulse.session import settings, settle

SHINGLE = 5
#: Bytes of texts, and of sets of shingles, worked on at once; they bound memory only.
_SLICE, _SET_BYTES = 1_500_000, 4_000_000
#: Rows handed to Python at a time: of texts and of slices of sets, thousands are more than an executor should hold.
_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}
_EVEN = ~np.uint64(1)


def shared_needed(n: np.ndarray) -> np.ndarray:
    """The l of step 1: grows with n, and so with the size of the smaller set."""
    return np.maximum(1, n * 15 // 100)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, one text after the other; how many
    each has; and an even 64-bit key of each set."""
    hashes, _, counts = Words(column, lower=True).windows(size, short=True)
    text = np.repeat(np.arange(len(counts), dtype=np.uint16 if len(counts) < 1 << 16 else np.int64), counts)
    order = np.argsort(hashes)
    order = order[np.argsort(text[order], kind="stable")]
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes = hashes[new]
    sizes = np.bincount(text[new], minlength=len(counts))
    ends = np.cumsum(sizes)
    return hashes, sizes, _run_hashes(hashes, ends - sizes, ends) & _EVEN


_SENT = "bucket int, owners binary, sizes binary, keys binary, doc_id long, row long, n long, item long, kind int"
_FOUND = "doc_id long, row long, n long, item long, kind int"
_TEXT, _SHARED = 0, 1


def _rows(docs: pa.RecordBatch | None, n: np.ndarray, items: np.ndarray, kind: int) -> list[pa.Array]:
    of_docs = [pa.nulls(len(n), pa.int64())] * 2 if docs is None else [docs.column("doc_id"), docs.column("row")]
    return [*of_docs, pa.array(n.astype(np.int64)), pa.array(items.view(np.int64)),
            pa.array(np.full(len(n), kind, np.int32))]


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _count_owners(owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(owners, return_counts=True)


def _send(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", _SLICE):
                hashes, sizes, items = shingle_sets(rows.column("text"))
                n = rows.num_rows
                spread = pa.array((rows.column("row").to_numpy() % buckets).astype(np.int32))
                empty = pa.nulls(n, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [spread, empty, empty, empty, *_rows(rows, sizes, items, _TEXT)],
                    names=_names(_SENT))
                # One entry per distinct set, its prefix only.
                _, one = np.unique(items, return_index=True)
                one = one[sizes[one] > 0]
                starts = np.cumsum(sizes) - sizes
                length = sizes[one] // 4 + shared_needed(sizes[one])
                length = np.minimum(length, sizes[one])
                if not len(one):
                    continue
                keys = np.concatenate([hashes[s:s + k] for s, k in zip(starts[one], length)])
                owners = np.repeat(items[one], length)
                order = np.argsort(keys, kind="stable")
                keys, owners = keys[order], owners[order]
                opens = np.ones(len(keys), bool)
                opens[1:] = keys[1:] != keys[:-1]
                start = np.flatnonzero(opens)
                size = np.diff(np.append(start, len(keys)))
                several = size > 1
                # Shared within the slice: counted here, sent for two sets with the odd mark.
                inside = np.repeat(several, size)
                owner, times = _count_owners(owners[inside])
                if len(owner):
                    none = pa.nulls(len(owner), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((owner % np.uint64(buckets)).astype(np.int32)), none, none, none,
                         *_rows(None, times, owner, _SHARED)], names=_names(_SENT))
                sent_keys = np.concatenate([keys[start], keys[start[several]]])
                sent_owners = np.concatenate([
                    owners[start] | several.astype(np.uint64),
                    owners[start[several] + 1] | np.uint64(1)])
                order = np.argsort(sent_owners, kind="stable")
                packed = pack(sent_keys[order], sent_owners[order].view(np.int64), buckets)
                k = packed.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*packed.columns[:4], *[pa.nulls(k, pa.int64())] * 4, pa.nulls(k, pa.int32())],
                    names=_names(_SENT))
    return run


def _count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass texts and counts on, and count for every set its keys that other sets have."""
    held = []
    for batch in batches:
        ready = batch.filter(batch.column("kind").is_valid())
        if ready.num_rows:
            yield ready.select(_names(_FOUND))
        held.append(batch.filter(batch.column("kind").is_null()).select(["owners", "sizes", "keys"]))
    keys, owners = unpack(held)
    if not len(keys):
        return
    owners = owners.view(np.uint64)
    order = np.argsort(keys, kind="stable")
    keys, owners = keys[order], owners[order]
    opens = np.ones(len(keys), bool)
    opens[1:] = keys[1:] != keys[:-1]
    start = np.flatnonzero(opens)
    items = owners & _EVEN
    several = np.maximum.reduceat(items, start) != np.minimum.reduceat(items, start)
    size = np.diff(np.append(start, len(keys)))
    owner, times = _count_owners(owners[np.repeat(several, size) & (owners & np.uint64(1) == 0)])
    if len(owner):
        yield pa.RecordBatch.from_arrays(_rows(None, times, owner, _SHARED), names=_names(_FOUND))


def _sets(bitmap: np.ndarray):
    """The shingles of the sets that step 1 leaves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked = batch.filter(pa.array(is_marked(bitmap, batch.column("_hash").to_numpy())))
            for rows in slices(picked, "text", _SLICE):
                hashes, sizes, items = shingle_sets(rows.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(items.view(np.int64)), pa.array(sizes.astype(np.int64)),
                     binaries(hashes, np.append(0, np.cumsum(sizes)) * 8)], names=["item", "n", "shingles"])
    return run


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets put together to slices of bounded size, each a row."""
    task, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        for rows in slices(batch, "shingles", _SET_BYTES):
            yield pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | number], pa.int64()),
                 pa.array([rows.column("item").to_numpy().tobytes()], pa.binary()),
                 pa.array([rows.column("n").to_numpy().tobytes()], pa.binary()),
                 pa.array([flat(rows.column("shingles"), "<u8").tobytes()], pa.binary())],
                names=["slice", "items", "ns", "shingles"])
            number += 1


def _send_frequencies(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                keys, counts = np.unique(flat(batch.column("shingles").slice(k, 1), "<u8"), return_counts=True)
                owner = np.full(len(keys), batch.column("slice")[k].as_py(), np.int64)
                yield pack(keys, owner, buckets, counts)
    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Back to every slice: those of its shingles that several sets hold, and how many do."""
    held = [b for b in batches if b.num_rows]
    keys, owners = unpack(held)
    if not len(keys):
        return
    counts = np.concatenate([flat(b.column("counts"), "<u4") for b in held]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    opens = np.ones(len(keys), bool)
    opens[1:] = keys[order][1:] != keys[order][:-1]
    total = np.add.reduceat(counts[order], np.flatnonzero(opens))
    frequency = np.empty(len(keys), np.int64)
    frequency[order] = total[np.cumsum(opens) - 1]
    keep = np.flatnonzero(frequency > 1)
    keep = keep[np.argsort(owners[keep], kind="stable")]
    slices_, start = np.unique(owners[keep], return_index=True)
    ends = np.append(start, len(keep))
    yield pa.RecordBatch.from_arrays(
        [pa.array(slices_), binaries(keys[keep], ends * 8),
         binaries(frequency[keep].astype("<u4"), ends * 4)], names=["slice", "keys", "counts"])


_ORDERED = "item long, n long, alone long, ordered binary, groups array<long>, bits array<long>"
#: 64-bit words of a sketch: sets of up to some two thousand shingles are told apart.
_WORDS = 32
#: Of a set's rarest seventh, in which it meets all similar ones that are no smaller, so many of the most
#: frequent serve to find copies first.
_FIRST = 3


def _order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each set's shared shingles, most frequent first, how many it has alone, and the rarest shared ones, which make groups."""
    for batch in batches:
        for k in range(batch.num_rows):
            items = flat(batch.column("items").slice(k, 1), "<i8")
            ns = flat(batch.column("ns").slice(k, 1), "<i8")
            shingles = flat(batch.column("shingles").slice(k, 1), "<u8")
            known = flat(batch.column("keys").slice(k, 1).flatten(), "<u8")
            often = flat(batch.column("counts").slice(k, 1).flatten(), "<u4")
            order = np.argsort(known)
            known, often = known[order], often[order]
            place = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
            frequency = np.where(known[place] == shingles, often[place], 1)
            rows = []
            for item, n, start in zip(items.tolist(), ns.tolist(), (np.cumsum(ns) - ns).tolist()):
                own, f = shingles[start:start + n], frequency[start:start + n]
                shared = np.flatnonzero(f > 1)
                rare = n // 4 + 1 - (n - len(shared))
                if rare <= 0 or len(shared) < -(-3 * n // 4):
                    continue
                shared = shared[np.lexsort((own[shared], f[shared]))]
                rows.append((item, n, n - len(shared), own[shared[::-1]].tobytes(), own[shared[:rare]].view(np.int64),
                             sketches(own, np.array([n]), _WORDS)[0]))
            if rows:
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary()),
                     pa.array(columns[4], pa.list_(pa.int64())), lists(np.stack(columns[5]))], names=_names(_ORDERED))


def linked(probe: np.ndarray, n: int, others: list[np.ndarray], ns: list[int]) -> list[int]:
    """Which of the others (most frequent shared shingle first) link with the probe.

    The others in the order of their bytes are a prefix tree walked depth first:
    what two neighbours have in common at their beginning is one path, whose
    overlap with the probe is counted once.
    """
    probe = np.sort(probe)
    longest, least = max(map(len, others)), min(ns)
    lowest = -(-3 * (n + least) // 7)
    overlap = np.zeros(longest + 1, np.int64)  # of the path, up to each depth
    path, valid, dead, found = probe[:0], 0, None, []
    for k in sorted(range(len(others)), key=lambda i: others[i].tobytes()):
        other = others[k]
        m = min(len(path), len(other))
        differ = np.flatnonzero(path[:m] != other[:m])
        common = int(differ[0]) if len(differ) else m
        path, valid = other, min(valid, common)
        if dead is not None and common >= dead:
            continue  # still below the node that was left out
        dead, need = None, -(-3 * (n + ns[k]) // 7)
        while valid < len(other):
            if overlap[valid] + longest - valid < lowest:
                dead = valid
                break
            if overlap[valid] + len(other) - valid < need:
                break
            step = other[valid:valid + 128]
            place = np.minimum(np.searchsorted(probe, step), len(probe) - 1)
            overlap[valid + 1:valid + 1 + len(step)] = overlap[valid] + np.cumsum(probe[place] == step)
            valid += len(step)
        if valid == len(other) and 175 * int(overlap[valid]) >= 75 * (n + ns[k]):
            found.append(k)
    return found


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        order = np.argsort(a, kind="stable")
        edges = np.flatnonzero(np.append(True, a[order][1:] != a[order][:-1]))
        pairs = []
        for rows in np.split(order, edges[1:]):
            probe = np.frombuffer(batch.column("ordered_a")[rows[0]].as_py(), "<u8")
            others = [np.frombuffer(batch.column("ordered_b")[k].as_py(), "<u8") for k in rows.tolist()]
            for k in linked(probe, int(n_a[rows[0]]), others, n_b[rows].tolist()):
                pairs.append(rows[k])
        yield pa.RecordBatch.from_arrays([pa.array(a[pairs]), pa.array(b[pairs])], names=["a", "b"])


def _links_of(sets: DataFrame):
    def links(pairs: DataFrame) -> DataFrame:
        side = [sets.select(F.col("item").alias(c), F.col("n").alias(f"n_{c}"),
                            F.col("ordered").alias(f"ordered_{c}")) for c in "ab"]
        return pairs.join(side[1], "b").join(side[0], "a").mapInArrow(released(_compare), EDGE)
    return links


def text_sets(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All texts as (doc_id, n_shingles, item), item being the key of the set, and the
    components (item, component) of sets that link with another."""
    spark = docs.sparkSession
    with settings(spark, _BATCHES):
        own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        own = own.withColumn("row", F.xxhash64("doc_id", "text"))
        found = settle(own.mapInArrow(released(_send(bucket_count(spark))), _SENT)
                       .repartition(partitions(spark), "bucket").mapInArrow(released(_count_shared), _FOUND), "texts")
        texts = found.where(F.col("kind") == _TEXT).select("doc_id", F.col("n").alias("n_shingles"), "item", "row")
        sets = texts.where("n_shingles > 0").groupBy("item").agg(
            F.first("n_shingles").alias("n"), F.min("row").alias("row"))
        shared = found.where(F.col("kind") == _SHARED).groupBy("item").agg(F.sum("n").alias("shared"))
        needed = F.greatest(F.lit(1), F.floor((F.ceil(F.col("n") * 3 / 4) * 15) / 100))
        left = settle(sets.join(shared, "item").where(F.col("shared") >= needed).select("item", "row"), "left")
        picked = own.withColumn("_hash", F.xxhash64("row")).select("text", "_hash").mapInArrow(
            released(_sets(marked(left, "row"))), "item long, n long, shingles binary")
        picked = picked.join(left.select("item"), "item", "left_semi").dropDuplicates(["item"])
        parts = settle(picked.mapInArrow(released(_slices), "slice long, items binary, ns binary, shingles binary"), "sets")
        counted = (parts.select("slice", "shingles").mapInArrow(released(_send_frequencies(bucket_count(spark))), PACKED)
                   .repartition(partitions(spark), "bucket")
                   .mapInArrow(released(_frequencies), "slice long, keys binary, counts binary"))
        known = counted.groupBy("slice").agg(F.collect_list("keys").alias("keys"),
                                             F.collect_list("counts").alias("counts"))
        ordered = settle(parts.join(known, "slice").select("items", "ns", "shingles", "keys", "counts")
                         .mapInArrow(released(_order), _ORDERED), "ordered")
        # What a set has alone comes before its shared shingles.
        groups = ordered.select("item", "n", "alone", F.posexplode("groups").alias("at", "group")).select(
            "group", "item", "n", (F.col("alone") + F.col("at")).alias("before")).withColumn(
            "first", F.expr(f"7 * before <= n AND 7 * (before + {_FIRST}) > n"))
        return texts, similar(groups, _links_of(ordered.select("item", "n", "ordered")), 0.75,
                              ordered.select("item", "bits"), _WORDS)


def join_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) of every row."""
    texts, components = text_sets(docs)
    placed = texts.join(components, "item", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "item").alias("c"))
    placed = settle(placed, "placed")
    smallest = placed.where("n_shingles > 0").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    some = placed.where("n_shingles > 0").join(smallest, "c").select("doc_id", "n_shingles", "component_id")
    return some.union(placed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs without those of a component that has an earlier one.

    The first of a component is the one of the smallest doc_id (NULL comes last),
    then of the smallest hash of its text; of repeated rows one stays. Texts
    without words all stay. All columns are kept.
    """
    texts, components = text_sets(docs)
    placed = settle(texts.where("n_shingles > 0").join(components, "item", "left").select(
        "doc_id", "row", F.coalesce("component", "item").alias("c")), "placed")
    order = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("at"), "row")
    first = placed.groupBy("c").agg(F.min(order).alias("first"))
    rows = placed.join(first, "c").groupBy(F.col("row").alias("_row")).agg(
        F.max(F.col("first.row") == F.col("row")).alias("_first"), F.count("*").alias("_copies"))
    # Most rows are single and stay; only the others have to be looked up.
    marks = settle(rows.where("NOT _first OR _copies > 1"), "marks")
    found = keyed(docs)
    single = found.join(marks, "_row", "left_anti")
    repeated = found.join(marks.where("_first").select("_row"), "_row", "left_semi").dropDuplicates(["_row"])
    return single.union(repeated).select("doc.*")
