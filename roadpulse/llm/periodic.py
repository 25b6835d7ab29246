"""Periodic runs of words, by recursive frequency splitting and a scan of lags.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal), at least `COPIES` periods and `SHORTEST` words long, that no neighbouring
word extends keeping period q.

1. Every word of a run occurs `COPIES` times in it at least. So a word that occurs
   more rarely within its segment, at first the whole text, lies in no run: it splits
   the segment, and the parts, in which words are rarer still, are looked at again
   until no segment changes. Segments too short for a run go.
2. The segments left are scanned at all lags. For lags from W = 2^k to below 2W a run
   covers a position that is a multiple of 2W, with W + lag words behind it; there
   W words are compared, as one hash, with those a lag away. Each hit is extended word
   by word to both sides. So a scan costs a segment's size times the logarithm of it,
   not their product. A lag that is a multiple of a run's own period gives no run.

All segments of a slice of texts are split and scanned at once in NumPy.

Defined results: NULL and empty texts have no words and no run; documents with any
doc_id, NULL included, and repeated rows keep a row each; an empty table gives no
rows; other columns are not read. Words are compared by 64-bit hashes. A text must fit
into memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.batches import ragged, slices, text_bytes
from roadpulse.llm.words import Words, _run_hashes, mix

COPIES, SHORTEST = 4, 6
#: Bytes of text searched at once; bounds memory only.
_SLICE = 1_000_000
RUNS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def split_by_frequency(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The segments of [start, end) in which every word occurs `COPIES` times, in order."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    while True:
        long = ends - starts >= SHORTEST
        starts, ends = starts[long], ends[long]
        if not len(starts):
            break
        sizes = ends - starts
        at, segment = ragged(starts, sizes), np.repeat(np.arange(len(starts)), sizes)
        own = mix(words[at] + (segment.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        _, which, times = np.unique(own, return_inverse=True, return_counts=True)
        rare = times[which] < COPIES
        splits = np.bincount(segment, rare, len(starts)) > 0
        done.append((starts[~splits], ends[~splits]))
        # Runs of words that are not rare, cut where a segment ends.
        stays = ~rare & splits[segment]
        opens, closes = stays.copy(), stays.copy()
        same = segment[1:] == segment[:-1]
        opens[1:] &= ~(stays[:-1] & same)
        closes[:-1] &= ~(stays[1:] & same)
        starts, ends = at[opens], at[closes] + 1
    if not done:
        return starts, ends
    starts, ends = (np.concatenate(side) for side in zip(*done))
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order]


def _hits(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int):
    """(position, lag, segment) with `width` equal words there and a lag away, for lags of width to 2 * width - 1."""
    last = ends - 2 * width  # the last position from which the least lag still fits
    some = np.flatnonzero(last >= starts)
    counts = (last[some] - starts[some]) // (2 * width) + 1
    segment = np.repeat(some, counts)
    at = starts[segment] + (np.arange(len(segment)) - np.repeat(np.cumsum(counts) - counts, counts)) * 2 * width
    lags = np.minimum(ends[segment] - at - 2 * width + 1, width)
    place = np.repeat(np.arange(len(at)), lags)
    lag = np.arange(len(place)) - np.repeat(np.cumsum(lags) - lags, lags) + width
    here = _run_hashes(words, at, at + width)
    there = at[place] + lag
    equal = np.flatnonzero(here[place] == _run_hashes(words, there, there + width))
    return at[place[equal]], lag[equal], segment[place[equal]]


def _equal_for(words: np.ndarray, a: int, b: int, most: int, step: int) -> int:
    """How many words from a on, one after the other in direction `step`, equal those from b on."""
    size, found = 32, 0
    while found < most:
        size = min(2 * size, most - found)
        x, y = a + step * found, b + step * found
        if step > 0:
            same = words[x:x + size] == words[y:y + size]
        else:
            same = (words[x - size + 1:x + 1] == words[y - size + 1:y + 1])[::-1]
        if not same.all():
            return found + int(np.argmin(same))
        found += size
    return found


def scan(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs in the given segments."""
    runs: list[tuple[int, int, int]] = []
    width, longest = 1, int((ends - starts).max(initial=0))
    while COPIES * width <= longest:
        at, lag, segment = _hits(words, starts, ends, width)
        new = np.ones(len(at), bool)
        for start, end, period in runs:  # `at` ascends
            low, high = np.searchsorted(at, [start, end])
            new[low:high] &= (lag[low:high] % period != 0) | (at[low:high] + lag[low:high] + width > end)
        seen: dict[int, int] = {}
        for c, q, s in zip(at[new].tolist(), lag[new].tolist(), segment[new].tolist()):
            if c + q + width <= seen.get(q, 0):
                continue
            first, last = int(starts[s]), int(ends[s])
            end = c + q + _equal_for(words, c, c + q, last - c - q, 1)
            start = c - _equal_for(words, c - 1, c + q - 1, c - first, -1)
            seen[q] = end
            if end - start >= max(SHORTEST, COPIES * q):
                runs.append((start, end, q))
        width *= 2
    return runs


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, "text", _SLICE):
            words = Words(rows.column("text"))
            ends = np.cumsum(words.counts)
            firsts = ends - words.counts
            found = sorted(scan(words.hashes, *split_by_frequency(words.hashes, firsts, ends)))
            owner = np.searchsorted(ends, [r[0] for r in found], "right")
            per_text: dict[int, list[dict]] = {}
            gone: dict[int, np.ndarray] = {}
            for text, (start, end, period) in zip(owner.tolist(), found):
                first = int(firsts[text])
                per_text.setdefault(text, []).append(
                    {"start": start - first, "length": end - start, "period": period})
                gone.setdefault(text, np.zeros(words.counts[text], bool))[start - first + period:end - first] = True
            data, offsets = text_bytes(rows.column("text"))
            data, offsets, kept = data.tobytes(), offsets.tolist(), []
            for text in range(rows.num_rows):
                own = data[offsets[text]:offsets[text + 1]].split()
                if text in gone:
                    own = [w for w, g in zip(own, gone[text].tolist()) if not g]
                kept.append(b" ".join(own))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([per_text.get(k, []) for k in range(rows.num_rows)], pa.list_(_RUN)),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])


def find_runs(docs: DataFrame) -> DataFrame:
    """Per row of docs (doc_id, text): its `runs` (start, length, period; in words, by start, then
    period) and `collapsed`, the words that are in no run after its first period, joined by blanks."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_find, RUNS)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text; a tenth of the texts, by crc32 of doc_id, repeat from some word on the words from there."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    g, n = F.floor(h / 10), F.size(words)
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + g % 8))

    def edited(i: Column) -> Column:
        return F.element_at(F.col("_words"), F.when(i < F.col("_a"), i).otherwise(
            F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int") + 1)

    chosen = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    plan = F.when(chosen, F.struct(words.alias("_words"), a.alias("_a"), p.alias("_p")))
    return (docs.select("doc_id", "text", plan.alias("_plan")).select("doc_id", "text", "_plan.*")
            .select("doc_id", F.when(F.col("_words").isNull(), F.col("text")).otherwise(F.array_join(
                F.transform(F.sequence(F.lit(0).cast("long"), F.size("_words").cast("long") - 1), edited), " ")).alias("text")))


def digest(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one, and hashes of all runs and of the words kept."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return (found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"),
        F.expr("1000 * _best.length div -_best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
