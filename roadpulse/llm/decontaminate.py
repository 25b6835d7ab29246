"""Copies of benchmark items in texts: n-gram seeds, rarest first, then Smith-Waterman alignment.

Words are lower-cased runs of letters and digits. Seeds are the items' runs of
`SEED` words; in how many documents each occurs is counted over all documents.
Wherever a document holds seeds of an item, however common, the stretch around them
is aligned with the whole item (match 2, mismatch and gap -1). The score, divided by
that of an exact copy, has to reach `SCORE`.

Rarity gives the order only: a document's stretch with the rarest seed of an item is
aligned first. Stretches that cannot reach `SCORE`, or the first one's score, by the
item's words they lack are spared the alignment; no result is lost by that.

The items are the query set: they are taken in blocks of at most `BLOCK_WORDS`
words, each of which all documents are read against.

Defined results: NULL text holds nothing, NULL items and items of fewer words than
a seed match nothing; rows with a NULL or repeated doc_id keep their own results;
equal items are all reported; of equal scores in a document the first stretch is
given; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.batches import slices
from roadpulse.llm.words import Words

SEED, SCORE = 3, 0.5
BLOCK_WORDS = 500_000
_SLICE = 1_000_000
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
MATCHES = "doc_id long, item_id long, score double, start_word long, end_word long"


class Items:
    """Words of a block of items and their seeds, sorted by hash."""

    def __init__(self, ids: list[int], texts: list[str]):
        words = Words(pa.array(texts, pa.string()), plain=True)
        self.ids, self.lengths = ids, words.counts
        self.words, self.first = words.hashes, np.cumsum(words.counts) - words.counts
        hashes, at, counts = words.windows(SEED)
        item = np.repeat(np.arange(len(counts)), counts)
        order = np.argsort(hashes, kind="stable")
        #: Per occurrence of a seed in an item, by hash.
        self.hash, self.item, self.place = hashes[order], item[order], (at - self.first[item])[order]
        self.seeds, self.start = np.unique(self.hash, return_index=True)
        self.size = np.diff(np.append(self.start, len(self.hash)))
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[(self.seeds >> np.uint64(42)).astype(np.int64)] = True
        #: Documents that hold each seed.
        self.frequency = np.zeros(len(self.seeds), np.int64)

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions that hold a seed, and the numbers of the seeds."""
        maybe = np.flatnonzero(self.sieve[(hashes >> np.uint64(42)).astype(np.int64)])
        seed = np.minimum(np.searchsorted(self.seeds, hashes[maybe]), len(self.seeds) - 1)
        found = self.seeds[seed] == hashes[maybe]
        return maybe[found], seed[found]


def align(regions: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each pair: score, and the first and past-last region word of it."""
    wide, long = max(map(len, regions)), max(map(len, items))
    n = len(regions)
    region = np.zeros((n, wide), np.uint64)
    item = np.ones((n, long), np.uint64)
    inside, within = np.zeros((n, wide), bool), np.zeros((n, long), bool)
    for k, (r, i) in enumerate(zip(regions, items)):
        region[k, :len(r)], inside[k, :len(r)] = r, True
        item[k, :len(i)], within[k, :len(i)] = i, True
    column = np.arange(wide)
    # Every cell carries where its alignment starts: scores are kept times `unit`, less the start.
    unit = 1 << 20
    score = np.zeros((n, wide + 1), np.int64)
    best, end = np.zeros(n, np.int64), np.zeros(n, np.int64)
    fresh = unit // 2 - np.arange(wide + 1)  # an alignment that begins after so many words
    score[:] = fresh
    for step in range(long):
        same = (region == item[:, step:step + 1]) & inside
        diagonal = score[:, :-1] + np.where(same, 2 * unit, -unit)
        row = np.maximum(np.maximum(diagonal, score[:, 1:] - unit), fresh[1:])
        # Gaps in the item: the best cell to the left less one per column.
        row = np.maximum.accumulate(row + column * unit, axis=1) - column * unit
        row = np.maximum(row, fresh[1:])
        row = np.where(inside, row, fresh[1:])
        active = within[:, step]
        score[active, 1:] = row[active]
        top = row.argmax(axis=1)
        value = row[np.arange(n), top]
        better = active & (value > best)
        best[better], end[better] = value[better], top[better] + 1
    points = (best + unit // 2 - 1) // unit
    start = points * unit + unit // 2 - best
    none = best < unit
    points[none], start[none], end[none] = 0, 0, 0
    return points, start, end


def limit(regions: list[np.ndarray], items: list[np.ndarray]) -> np.ndarray:
    """The most points that `align` can give each pair: an item's word adds 2 if the region
    has it anywhere and costs 1 otherwise."""
    n, lengths = len(items), np.array([len(i) for i in items])
    spread = np.arange(n, dtype=np.uint64) * _SPREAD
    # Words of different pairs that clash only raise a limit.
    there = np.isin(np.concatenate(items) + np.repeat(spread, lengths),
                    np.concatenate(regions) + np.repeat(spread, [len(r) for r in regions]))
    sums = np.full((n, lengths.max() + 1), -1, np.int64)
    sums[:, 0] = 0
    sums[:, 1:][np.arange(lengths.max()) < lengths[:, None]] = np.where(there, 2, -1)
    np.cumsum(sums, axis=1, out=sums)
    return (sums - np.minimum.accumulate(sums, axis=1)).max(axis=1)


def _stretches(items: Items, at: np.ndarray, seed: np.ndarray, text: np.ndarray,
               text_first: np.ndarray, text_words: np.ndarray):
    """(text, item, first word, past-last word, frequency of the rarest seed) of the stretches
    that hold an item's seeds."""
    repeat = items.size[seed]
    row = np.repeat(np.arange(len(at)), repeat)
    entry = np.arange(len(row)) - np.repeat(np.cumsum(repeat) - repeat, repeat) + items.start[seed[row]]
    item, doc = items.item[entry], text[row]
    begin = at[row] - text_first[doc] - items.place[entry]  # where the item would begin
    order = np.lexsort((begin, item, doc))
    item, doc, begin, frequency = item[order], doc[order], begin[order], items.frequency[seed[row]][order]
    slack = items.lengths[item] // 2 + 2
    opens = np.ones(len(item), bool)
    opens[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1]) | (begin[1:] - begin[:-1] > slack[1:])
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(item)) - 1 if len(first) else first
    item, doc = item[first], doc[first]
    low = np.maximum(begin[first] - slack[first], 0)
    high = np.minimum(begin[last] + items.lengths[item] + slack[first], text_words[doc])
    return doc, item, low, high, np.minimum.reduceat(frequency, first)


def _count(items: Items):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(items.seeds), np.int64)
        for batch in batches:
            for rows in slices(batch, "text", _SLICE):
                hashes, _, counts = Words(rows.column("text"), plain=True).windows(SEED)
                at, seed = items.hits(hashes)
                text = np.searchsorted(np.cumsum(counts), at, "right")
                pairs = np.unique(text * len(items.seeds) + seed)
                seen += np.bincount(pairs % len(items.seeds), minlength=len(seen))
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(seen[used])], names=["seed", "n"])
    return run


def _match(items: Items, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", _SLICE):
                words = Words(rows.column("text"), plain=True)
                hashes, first, counts = words.windows(SEED)
                at, seed = items.hits(hashes)
                if not len(at):
                    continue
                text_first = np.cumsum(words.counts) - words.counts
                text = np.searchsorted(np.cumsum(counts), at, "right")
                doc, item, low, high, frequency = _stretches(
                    items, first[at], seed, text, text_first, words.counts)
                length = items.lengths[item]

                def parts(which: np.ndarray) -> Iterator[tuple]:
                    """Of stretches, those of like size together: numbers, regions and items."""
                    order = which[np.argsort(length[which] * 10_000 + (high - low)[which], kind="stable")]
                    size = np.cumsum((length * (high - low))[order])
                    for part in np.split(order, np.flatnonzero(np.diff(size // 2_000_000)) + 1):
                        if len(part):
                            yield (part, [words.hashes[text_first[doc[k]] + low[k]:text_first[doc[k]] + high[k]]
                                          for k in part],
                                   [items.words[items.first[i]:items.first[i] + items.lengths[i]] for i in item[part]])

                most = np.zeros(len(doc), np.int64)
                for part, regions, own in parts(np.arange(len(doc))):
                    most[part] = limit(regions, own)
                hopeful = np.flatnonzero(most / (2 * length) >= least)
                # A document's stretch with the rarest seed of an item first, then those that can score as much.
                hopeful = hopeful[np.lexsort((low[hopeful], frequency[hopeful], item[hopeful], doc[hopeful]))]
                leads = np.ones(len(hopeful), bool)
                leads[1:] = (np.diff(doc[hopeful]) != 0) | (np.diff(item[hopeful]) != 0)
                best: dict[tuple[int, int], tuple] = {}
                reached = np.zeros(len(hopeful), np.int64)  # by the first stretch of each document and item
                place = np.empty(len(doc), np.int64)
                place[hopeful] = np.arange(len(hopeful))
                for turn in (0, 1):
                    if turn:
                        reached = reached[np.maximum.accumulate(np.where(leads, np.arange(len(leads)), 0))]
                    which = leads if not turn else ~leads & (most[hopeful] >= reached)
                    for part, regions, own in parts(hopeful[which]):
                        points, start, end = align(regions, own)
                        reached[place[part]] = points
                        score = points / (2 * length[part])
                        for k in np.flatnonzero(score >= least).tolist():
                            key = int(doc[part[k]]), int(item[part[k]])
                            new = (-float(score[k]), int(low[part[k]] + start[k]), int(low[part[k]] + end[k]))
                            best[key] = min(best.get(key, new), new)
                if best:
                    ids = rows.column("doc_id")
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array([d for d, _ in best])),
                        pa.array([items.ids[i] for _, i in best], pa.int64()),
                        *(pa.array(c) for c in zip(*((-s, a, b) for s, a, b in best.values())))],
                        names=["doc_id", "item_id", "score", "start_word", "end_word"])
    return run


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    ids, texts, size = [], [], 0
    for row in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        words = row["text"].count(" ") + 1
        if ids and size + words > BLOCK_WORDS:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(row["item_id"])
        texts.append(row["text"])
        size += words
    if ids:
        yield Items(ids, texts)


def matches(docs: DataFrame, benchmark: DataFrame, least: float = SCORE) -> DataFrame:
    """Rows (doc_id, item_id, score, start_word, end_word): documents that hold a copy of an item."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text IS NOT NULL")
    found = docs.sparkSession.createDataFrame([], MATCHES)
    for items in _blocks(benchmark):
        if not len(items.seeds):
            continue
        # One row per seed of the block.
        counted = own.mapInArrow(_count(items), "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
        counts = {r["seed"]: r["n"] for r in counted.collect()}
        items.frequency = np.array([counts.get(k, 0) for k in range(len(items.seeds))])
        found = found.union(own.mapInArrow(_match(items, least), MATCHES))
    return found
