"""Removal of lines that nearly repeat another, by MinHash of character shingles.

A line's shingles are its runs of `SHINGLE` characters. One hash of each shingle
picks one of `BINS` bins and competes there for the lowest value (one-permutation
MinHash; empty bins borrow from the next). `ROWS` bins make a band; lines with an
equal band are candidates, which two lines with a Jaccard similarity of 0.75 miss
with a probability of 0.2 % and more similar ones still less. Candidates are
compared by their exact similarity (`components.similar`), links are joined by
distributed union-find, and the first line of each component, by doc_id and place,
stays. Equal lines are one entry throughout. Blank lines are neither compared nor
removed.

Defined results: NULL text has no lines and stays NULL; the empty text is one
blank line; lines of fewer characters than a shingle are one shingle; documents
with a NULL doc_id come after all others; rows with equal doc_ids are told apart by
their text, equal rows keep and lose the same lines; an empty table gives no rows;
`dedup` keeps all columns of its input, whatever their names. Lines are told apart,
and shingles compared, by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.batches import ragged, released, slices
from roadpulse.llm.components import EDGE, LOWEST, lists, similar, sketches
from roadpulse.llm.keys import bucket_count, flat, is_marked, marked, pack, partitions, unpack
from roadpulse.llm.rows import keyed, row_key
from roadpulse.llm.words import _run_hashes, _window_hashes, mix
from roadpulse.session import settle, settle_alone

SHINGLE, BINS, ROWS = 8, 64, 4
#: One band in so many is compared with its first member to begin with.
_FIRST = 4
_SLICE = 1_000_000
#: The same where slices share nothing, so that they stay in a core's cache.
_SMALL = 250_000
#: Shingles looked up at once when pairs are compared; bounds memory only.
_ASKED = 100_000
_EMPTY = np.uint64(0xFFFFFFFF)


class Lines:
    """The lines of a slice of texts: hash, place and whether blank, of each."""

    def __init__(self, column: pa.Array):
        texts = column.to_pylist()
        present = [t for t in texts if t is not None]
        self.points = np.frombuffer("\n".join(present).encode("utf-32-le", "surrogatepass"), "<u4")
        breaks = np.flatnonzero(self.points == 10)
        self.starts = np.append(0, breaks + 1)[:None if present else 0]
        self.ends = np.append(breaks, len(self.points))[:None if present else 0]
        counts = np.array([0 if t is None else t.count("\n") + 1 for t in texts], np.int64)
        self.text = np.repeat(np.arange(len(texts)), counts)
        self.number = np.arange(len(self.text)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.hashes = _run_hashes(self.points, self.starts, self.ends)
        solid = np.append(0, np.cumsum((self.points != 32) & ((self.points < 9) | (self.points > 13))))
        self.blank = solid[self.starts] == solid[self.ends]

    def shingles(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the shingles of some lines, and how many each has."""
        starts, ends = self.starts[rows], self.ends[rows]
        counts = np.maximum(ends - starts - SHINGLE + 1, 1)
        short = np.flatnonzero(ends - starts < SHINGLE)
        first = ragged(starts, counts)
        if len(self.points) < SHINGLE:
            return _run_hashes(self.points, starts, ends), counts
        found = _window_hashes(self.points, SHINGLE)
        # What a line shorter than a shingle takes here is replaced.
        at = (np.cumsum(counts) - counts)[short]
        first[at] = 0
        hashes = found[first]
        hashes[at] = _run_hashes(self.points, starts[short], ends[short]) if len(short) else 0
        return hashes, counts


def signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(lines, BINS) lowest values; each line has at least one shingle."""
    bits = BINS.bit_length() - 1
    cell = np.repeat(np.arange(len(counts)) << bits, counts) | (hashes >> np.uint64(64 - bits)).astype(np.int64)
    out = np.full(len(counts) * BINS, ~np.uint64(0))
    np.minimum.at(out, cell, hashes & np.uint64(0xFFFFFFFF))
    filled = out != ~np.uint64(0)
    out[~filled] = _EMPTY
    out, filled = out.reshape(-1, BINS), filled.reshape(-1, BINS)
    some = np.flatnonzero(~filled.all(axis=1))
    # An empty bin takes the next filled one, marked with the distance.
    there = np.where(np.tile(filled[some], 2), np.arange(2 * BINS), 4 * BINS)
    there = np.minimum.accumulate(there[:, ::-1], axis=1)[:, ::-1][:, :BINS]
    away = there - np.arange(BINS)
    out[some] = np.take_along_axis(out[some], there % BINS, axis=1) + (away.astype(np.uint64) << np.uint64(40))
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """(lines, bands) keys."""
    parts = signature.reshape(len(signature), -1, ROWS)
    key = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key


_SENT = "bucket int, owners binary, sizes binary, keys binary, group long, item long"
_GROUP = "group long, item long"


def _shared(keys: np.ndarray, owners: np.ndarray):
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    keys, owners = keys[new], owners[new]
    start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    size = np.diff(np.append(start, len(keys)))
    return keys, owners, start, np.repeat(size > 1, size)


def _send(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _SENT.split(", ")]
        for batch in batches:
            for rows in slices(batch, "text", _SMALL):
                lines = Lines(rows.column("text"))
                used = np.flatnonzero(~lines.blank)
                if not len(used):
                    continue
                items, one = np.unique(lines.hashes[used], return_index=True)
                keys = bands(signatures(*lines.shingles(used[one])))
                owners = np.repeat(items.view(np.int64), keys.shape[1])
                keys, owners, start, several = _shared(keys.reshape(-1), owners)
                # Groups within the slice go out whole; of each key, one member goes on.
                inside = np.flatnonzero(several)
                if len(inside):
                    none = pa.nulls(len(inside), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((keys[inside] % np.uint64(buckets)).astype(np.int32)), none, none, none,
                         pa.array(keys[inside].view(np.int64)), pa.array(owners[inside])], names=names)
                order = np.argsort(owners[start], kind="stable")
                packed = pack(keys[start][order], owners[start][order], buckets)
                none = pa.nulls(packed.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([*packed.columns[:4], none, none], names=names)
    return run


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = []
    for batch in batches:
        ready = batch.filter(batch.column("item").is_valid())
        if ready.num_rows:
            yield ready.select(["group", "item"])
        held.append(batch.filter(batch.column("item").is_null()).select(["owners", "sizes", "keys"]))
    keys, owners = unpack(held)
    if len(keys):
        keys, owners, _, several = _shared(keys, owners)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[several].view(np.int64)), pa.array(owners[several])], names=["group", "item"])


_LINE = "doc_id long, row long, line int, item long, blank boolean, text string"


def _list(bitmap: np.ndarray):
    """Every line; the text of those that are candidates, once per slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", _SLICE):
                lines = Lines(rows.column("text"))
                if not len(lines.hashes):
                    continue
                _, one = np.unique(lines.hashes, return_index=True)
                # The bitmap holds a hash of the item, so that both sides place it alike.
                one = one[~lines.blank[one] & is_marked(bitmap, _place(lines.hashes[one]))]
                texts = np.full(len(lines.hashes), None, object)
                for k in one.tolist():
                    texts[k] = lines.points[lines.starts[k]:lines.ends[k]].tobytes().decode(
                        "utf-32-le", "surrogatepass")
                docs = pa.array(lines.text)
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id").take(docs), rows.column("row").take(docs),
                    pa.array(lines.number.astype(np.int32)), pa.array(lines.hashes.view(np.int64)),
                    pa.array(lines.blank), pa.array(texts, pa.string())],
                    names=["doc_id", "row", "line", "item", "blank", "text"])
    return run


def _place(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(1)).astype(np.int64)


def _shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of lines, one line after the other, and how many each has."""
    lines = Lines(pa.array(texts, pa.string()))
    hashes, counts = lines.shingles(np.arange(len(texts)))
    line = np.repeat(np.arange(len(texts)), counts)
    # Few shingles come twice in their line: those and some others have marks that do.
    marks = hashes ^ mix(np.arange(1, len(texts) + 1, dtype=np.uint64))[line]
    twice = np.sort(marks)
    twice = twice[1:][twice[1:] == twice[:-1]]
    if len(twice):
        some = np.flatnonzero(_Known(twice).holds(marks))
        some = some[np.lexsort((hashes[some], line[some]))]
        again = some[1:][(hashes[some][1:] == hashes[some][:-1]) & (line[some][1:] == line[some][:-1])]
        hashes, line = np.delete(hashes, again), np.delete(line, again)
    return hashes, np.bincount(line, minlength=len(texts))


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, "text", _SMALL):
            hashes, counts = _shingle_sets(rows.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [rows.column("item"), pa.array(counts.astype(np.int64)), lists(sketches(hashes, counts))],
                names=["item", "n", "bits"])


class _Known:
    """A set of well mixed numbers, as a table by their highest bits and a sorted rest."""

    def __init__(self, numbers: np.ndarray):
        self.shift = np.uint64(64 - max(4, (2 * len(numbers)).bit_length()))
        # No slot is empty: of the two numbers that fill them none has its place there.
        self.table = np.full(1 << (64 - int(self.shift)), ~np.uint64(0))
        self.table[-1] = 0
        slots = self._slots(numbers)
        self.table[slots] = numbers
        out = self.table[slots] != numbers
        self.rest = np.sort(numbers[out])
        self.full = np.zeros(len(self.table), bool)
        self.full[slots[out]] = True

    def _slots(self, numbers: np.ndarray) -> np.ndarray:
        return (numbers >> self.shift).astype(np.int64)

    def holds(self, asked: np.ndarray) -> np.ndarray:
        slots = self._slots(asked)
        out = self.table[slots] == asked
        left = np.flatnonzero(self.full[slots] & ~out)
        if len(left):
            place = np.minimum(np.searchsorted(self.rest, asked[left]), len(self.rest) - 1)
            out[left] = self.rest[place] == asked[left]
        return out


def _cut_pairs(sizes: np.ndarray) -> Iterator[slice]:
    """Runs of pairs that ask for some `_ASKED` shingles each."""
    piece = (np.cumsum(sizes) - sizes) // _ASKED
    cuts = np.flatnonzero(np.diff(piece)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(sizes)]):
        yield slice(start, end)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sets are similar; a batch's lines are cut into shingles once each."""
    for batch in batches:
        for rows in slices(batch, "text_b", _SLICE):
            pair = np.stack([rows.column(c).to_numpy() for c in "ab"])
            items, first, which = np.unique(pair, return_index=True, return_inverse=True)
            columns = [rows.column(f"text_{c}") for c in "ab"]
            texts = [columns[k // rows.num_rows][k % rows.num_rows].as_py() for k in first.tolist()]
            hashes, counts = _shingle_sets(texts)
            ends = np.cumsum(counts)
            a, b = which.reshape(2, -1)
            # The shingles of every b, looked up among those of its a: both marked with the line's number.
            mark = mix(np.arange(len(items), dtype=np.uint64) + np.uint64(1))
            known = _Known(hashes ^ np.repeat(mark, counts))
            both = np.zeros(len(b), np.int64)
            for some in _cut_pairs(counts[b]):
                asked = hashes[ragged((ends - counts)[b[some]], counts[b[some]])] ^ np.repeat(mark[a[some]], counts[b[some]])
                found = np.append(0, np.cumsum(known.holds(asked)))
                upto = np.cumsum(counts[b[some]])
                both[some] = found[upto] - found[upto - counts[b[some]]]
            near = 100 * both >= 75 * (counts[a] + counts[b] - both)
            yield rows.select(["a", "b"]).filter(pa.array(near))


def _links_of(texts: DataFrame):
    def links(pairs: DataFrame) -> DataFrame:
        a, b = (texts.select(F.col("item").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
        return pairs.join(b, "b").join(a, "a").mapInArrow(released(_compare), EDGE)
    return links


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_key().alias("row"))


def classify(docs: DataFrame) -> DataFrame:
    """Every line of docs (doc_id, text): doc_id, row, line (from 0), class_doc_id and
    class_line (the first line of its component), and whether it is kept."""
    spark = docs.sparkSession
    own = _keyed(docs)
    groups = settle(own.select("text").mapInArrow(released(_send(bucket_count(spark))), _SENT)
                    .repartition(partitions(spark), "bucket").mapInArrow(released(_groups), _GROUP).distinct(), "groups")
    candidates = groups.select(F.shiftrightunsigned("item", 1).alias("place"))
    lines = settle(own.mapInArrow(released(_list(marked(candidates, "place", hashed=False))), _LINE), "lines")
    texts = lines.where("text IS NOT NULL").groupBy("item").agg(F.first("text").alias("text"))
    texts = settle(texts.join(groups.select("item").distinct(), "item", "left_semi"), "texts")
    sets = settle(texts.mapInArrow(released(_sketches), "item long, n long, bits array<long>"), "sets")
    # A quarter of the bands joins most copies; what they leave meets in the others.
    first = F.pmod("group", F.lit(_FIRST)) == 0
    members = groups.join(sets.select("item", "n"), "item").select("group", "item", "n", first.alias("first"))
    lowest = groups.groupBy("item").agg(F.slice(F.sort_array(F.collect_set("group")), 1, LOWEST).alias("lowest"))
    sketched = settle(sets.select("item", "bits").join(lowest, "item"), "sketched")
    components = similar(members, _links_of(texts), 0.75, sketched)
    solid = lines.where("NOT blank").drop("text", "blank").join(components, "item", "left").select(
        "doc_id", "row", "line", F.coalesce("component", "item").alias("c"))
    place = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("at"), "line", "row", "doc_id")
    first = solid.groupBy("c").agg(F.min(place).alias("first"))
    found = solid.join(first, "c").select(
        "doc_id", "row", "line", F.col("first.doc_id").alias("class_doc_id"),
        F.col("first.line").alias("class_line"),
        ((F.col("first.row") == F.col("row")) & (F.col("first.line") == F.col("line"))).alias("kept"))
    blank = lines.where("blank").select("doc_id", "row", "line", F.col("doc_id").alias("class_doc_id"),
                                        F.col("line").alias("class_line"), F.lit(True).alias("kept"))
    return found.union(blank)


def _marks(gone: Column) -> Column:
    """Of each line up to the last of the ascending numbers `gone`, whether it stays."""
    before = F.concat(F.array(F.lit(-1)), F.slice(gone, 1, F.size(gone) - 1))
    return F.flatten(F.zip_with(gone, before, lambda k, last: F.concat(
        F.array_repeat(F.lit(True), k - last - 1), F.array(F.lit(False)))))


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of docs with the lines to remove taken out of `text`; rows that lose all
    their lines but blank ones are dropped. `n_chars`, if there, counts the new text."""
    removed = settle_alone(docs.sparkSession, lambda: classify(docs).where("NOT kept").groupBy(
        F.col("row").alias("_row")).agg(_marks(F.array_sort(F.collect_set("line"))).alias("_stays")), "removed")
    # A text's lines beside their marks; a line without one stays, what is NULL is not joined.
    lines = F.zip_with(F.split("doc.text", "\n", -1), "_stays", lambda line, stays: F.when(F.coalesce(stays, F.lit(True)), line))
    out = keyed(docs).join(removed, "_row", "left").select(
        "doc", F.when(F.col("_stays").isNotNull(), F.array_join(lines, "\n")).alias("_left"))
    out = out.where(r"_left IS NULL OR _left RLIKE '[^ \\t-\\r]'")
    new = {"text": F.coalesce("_left", "doc.text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("_left").isNull(), F.col("doc.n_chars")).otherwise(
            F.length("_left")).cast(docs.schema["n_chars"].dataType)
    return out.select(*(new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))
