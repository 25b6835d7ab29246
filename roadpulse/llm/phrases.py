"""Collocations by dynamic itemset counting.

Texts are cut into pieces and those into words; a phrase is a run of words of one piece.
How often each phrase of up to `LONGEST` words occurs is counted in cyclic scans over
shards of the corpus. Lengths are interleaved: single words are counted from the first
shard on; a longer phrase becomes active at the first shard before which both its
subphrases (without its last, without its first word) have reached the threshold, is
counted in every shard from there on, around the cycle, and is complete after one full
cycle. Scanning ends when a full cycle has activated nothing new.

Which phrases have reached the threshold is told by a bitmap per stop, a filter that
never misses one. Bits are only ever added, so a phrase that passes at one stop passes at
all later ones: it is counted at a stop exactly if it passes there and did not yet pass
one cycle before. Hence a phrase that the filter lets through by chance is counted
in each shard once too, and all counts are exact. Phrases are counted by 64-bit hashes
of language and words; the number of counts is bounded by what is still incomplete:
complete phrases below the threshold are dropped, all others written out.

Scores and the rule that drops parts of longer phrases are joins and aggregates of
those counts.

Defined results: NULL text has no words; NULL language is `und`; repeated rows count as
often as they occur; doc_ids, NULL included, only deal texts into shards; an empty table
gives no rows; other columns are not read. A text must fit into memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.llm.batches import binaries, ragged, released, slices, text_bytes
from roadpulse.llm.keys import flat, marked
from roadpulse.llm.words import Words, _run_hashes, mix
from roadpulse.session import delete, fresh_path, settle

LEAST, LONGEST, SHARDS, TOP = 30, 4, 4, 2000
#: Bits of the filter: eight for each phrase that can reach the threshold, within these powers of two.
FEWEST_BITS, MOST_BITS = 18, 27
#: Bytes of text, words and counts handled at once; bound memory only.
_SLICE, _CHUNK, _HELD = 1_500_000, 400_000, 2_000_000
#: A part that many phrases share is looked up in so many places.
_SALTS = 8

_BREAKS = np.zeros(256, bool)
_BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_FOLDED = np.array([32 if _BREAKS[b] else b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

_TOKENS = "shard int, lang string, n_words long, words binary"


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.sha256(lang.encode()).digest()[:8], "little")


def _read(column: pa.Array) -> tuple[Words, np.ndarray]:
    """The words of texts, and whether a piece ends behind each."""
    data, offsets = text_bytes(column)
    folded = pa.Array.from_buffers(pa.large_string(), len(column), [
        None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(_FOLDED[data])])
    words = Words(folded)
    cuts = np.append(0, np.cumsum(_BREAKS[data]))
    ends = np.ones(len(words.hashes), bool)
    ends[:-1] = cuts[words.starts[1:]] != cuts[words.ends[:-1]]
    lasts = np.cumsum(words.counts)
    ends[lasts[words.counts > 0] - 1] = True
    return words, ends


def _hashes(words: Words, langs: list[str]) -> np.ndarray:
    """Hashes of words and the language of their text; odd, those of phrases are even."""
    seeds = {lang: _seed(lang) for lang in set(langs)}
    own = np.array([seeds[lang] for lang in langs], np.uint64)
    return mix(words.hashes ^ np.repeat(own, words.counts)) | np.uint64(1)


def _tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of all words of one shard and language in a slice, with a 0 behind each piece."""
    for batch in batches:
        for rows in slices(batch, "text", _SLICE):
            words, ends = _read(rows.column("text"))
            langs, shards = rows.column("lang").to_pylist(), rows.column("shard").to_pylist()
            before = np.append(0, np.cumsum(ends))
            out = np.zeros(len(ends) + int(before[-1]), np.uint64)
            out[np.arange(len(ends)) + before[:-1]] = _hashes(words, langs)
            upto = np.cumsum(words.counts)
            first, last = upto - words.counts, upto
            starts, sizes = first + before[first], last - first + before[last] - before[first]
            groups: dict[tuple, list[int]] = {}
            for k, key in enumerate(zip(shards, langs)):
                groups.setdefault(key, []).append(k)
            order = [k for own in groups.values() for k in own]
            whole = out[ragged(starts[order], sizes[order])]
            limits = np.append(0, np.cumsum([int(sizes[own].sum()) for own in groups.values()]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in groups], pa.int32()), pa.array([lang for _, lang in groups], pa.string()),
                 pa.array([int(words.counts[own].sum()) for own in groups.values()], pa.int64()),
                 binaries(whole, limits * 8)], names=["shard", "lang", "n_words", "words"])


def tokens(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All texts as word hashes, dealt into shards."""
    shard = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.col("text")), F.lit(shards)).cast("int")
    dealt = docs.where("text IS NOT NULL").select(
        shard.alias("shard"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    return dealt.mapInArrow(released(_tokenize), _TOKENS)


def _in(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(len(bitmap) * 32 - 1)
    return (bitmap[(place >> np.uint64(5)).astype(np.int64)] >> (place & np.uint64(31)).astype(np.uint32)) & 1 != 0


def _joined(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return _run_hashes(words, starts, ends) & ~np.uint64(1)


def _phrases(words: np.ndarray, known: np.ndarray, longest: int, before: np.ndarray | None = None):
    """Per length from 2 on: where phrases begin whose subphrases of all lengths are known, their
    hashes, and whether that was so by the earlier filter too."""
    at, hashes = np.flatnonzero(words), words[words != 0]
    early = np.full(len(at), before is not None)
    for size in range(2, longest + 1):
        inside = _in(known, hashes)
        at, hashes, early = at[inside], hashes[inside], early[inside]
        if before is not None:
            early = early & _in(before, hashes)
        # Both subphrases are known where the next one begins a word later.
        both = np.flatnonzero(at[1:] == at[:-1] + 1)
        at, early = at[both], early[both] & early[both + 1]
        hashes = _joined(words, at, at + size)
        yield at, hashes, early


def _count(now: np.ndarray, before: np.ndarray | None, single: bool, longest: int):
    """Counts (h, n) of the phrases active at this stop."""
    def of(words: np.ndarray) -> Iterator[np.ndarray]:
        if single:
            yield words[words != 0]
        for _, found, early in _phrases(words, now, longest, before):
            yield found[~early]

    def told(held: list[np.ndarray]) -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for rows in slices(batch, "words", 8 * _CHUNK):
                for found in of(flat(rows.column("words"), "<u8")):
                    held.append(found)
                    size += len(found)
                if size > _HELD:
                    yield told(held)
                    held, size = [], 0
        if size:
            yield told(held)
    return run


#: Rows of packed words are large: so few are read and handed to Python at a time.
_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "32", "spark.sql.parquet.columnarReaderBatchSize": "32"}


@contextmanager
def _few_rows(spark: SparkSession) -> Iterator[None]:
    """Jobs within read a few rows at a time; a scan otherwise holds thousands of them at once."""
    before = {k: spark.conf.get(k) for k in _ROWS}
    for k, v in _ROWS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _write(frame: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = fresh_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path), path


def counts(dealt: DataFrame, bits: int, least: int = LEAST, longest: int = LONGEST,
           shards: int = SHARDS) -> tuple[DataFrame, np.ndarray]:
    """(h, n) of every phrase that occurs `least` times, and the filter that knows them all."""
    spark = dealt.sparkSession
    filters = [np.zeros(1 << (bits - 5), np.uint32)]
    active, used, done, stop = None, None, [], 0
    h, n, since = F.col("h"), F.col("n"), F.col("since")
    while stop < shards or not np.array_equal(filters[stop], filters[stop - shards]):
        before = filters[stop - shards] if stop >= shards else None
        seen = (dealt.where(F.col("shard") == stop % shards).select("words")
                .mapInArrow(released(_count(filters[stop], before, stop < shards, longest)), "h long, n long")
                .withColumn("since", F.lit(stop)))
        rows = seen if active is None else active.union(seen)
        with _few_rows(spark):
            state, path = _write(rows.groupBy(h).agg(F.sum(n).alias("n"), F.min(since).alias("since")), "phrase-counts")
        if used:
            delete(spark, used)
        used, reached = path, state.where(n >= least)
        filters.append(filters[stop] | marked(reached, "h", bits, hashed=False))
        stop += 1
        # Activated at its first count or before, so complete a cycle later.
        done.append(_write(reached.where(since + shards <= stop).select(h, n), "phrases-complete"))
        active = state.where(since + shards > stop)
        if stop > shards:
            filters[stop - shards - 1] = None
    done.append(_write(active.where(n >= least).select(h, n), "phrases-complete"))
    union = done[0][0]
    for frame, _ in done[1:]:
        union = union.union(frame)
    known, _ = _write(union, "phrases")
    for path in [used, *(p for _, p in done)]:
        delete(spark, path)
    return known, filters[stop]


_DESCRIBED = "h long, lang string, phrase string, lefts array<long>, rights array<long>, inner array<long>"


def _spelled(words: Words, first: np.ndarray, size: int) -> pa.Array:
    """The runs of `size` words that begin with the given ones, joined by single blanks."""
    which = (first[:, None] + np.arange(size)).ravel()
    starts, lengths = words.starts[which], words.ends[which] - words.starts[which]
    ends = np.cumsum(lengths + 1)
    out, keep = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8), np.ones(int(ends[-1]) if len(ends) else 0, bool)
    out[ragged(ends - lengths - 1, lengths)] = words.data[ragged(starts, lengths)]
    last = ends[size - 1::size]
    keep[last - 1] = False
    return binaries(out[keep], np.append(0, last - np.arange(1, len(last) + 1))).cast(pa.string())


def _describe(known: np.ndarray, missing: np.ndarray, longest: int):
    """Text and parts of the phrases that are missing, once a task."""
    kinds = [pa.int64(), pa.string(), pa.string(), *[pa.list_(pa.int64())] * 3]
    names = ["h", "lang", "phrase", "lefts", "rights", "inner"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = np.zeros(0, np.uint64)
        for batch in batches:
            for rows in slices(batch, "text", _SLICE // 2):
                words, ends = _read(rows.column("text"))
                own = _hashes(words, rows.column("lang").to_pylist())
                text = np.repeat(np.arange(rows.num_rows), words.counts)
                # Words with a 0 behind each piece, and which word stands where.
                places = np.arange(len(own)) + np.append(0, np.cumsum(ends))[:-1]
                spaced = np.zeros(len(own) + int(ends.sum()), np.uint64)
                spaced[places] = own
                number = np.zeros(len(spaced), np.int64)
                number[places] = np.arange(len(own))
                for size, (at, found, _) in enumerate(_phrases(spaced, known, longest), 2):
                    inside = np.flatnonzero(_in(missing, found))
                    found, first = np.unique(found[inside], return_index=True)
                    new = ~np.isin(found, told)
                    if not new.any():
                        continue
                    told = np.concatenate([told, found[new]])
                    at = at[inside[first[new]]]

                    def runs(spans: list[tuple[int, int]]) -> pa.Array:
                        parts = [spaced[at + a] if b - a == 1 else _joined(spaced, at + a, at + b) for a, b in spans]
                        flat_ = np.stack(parts, 1).ravel() if parts else np.zeros(0, np.uint64)
                        return pa.ListArray.from_arrays(
                            pa.array(np.arange(len(at) + 1, dtype=np.int32) * len(spans)), pa.array(flat_.view(np.int64)))

                    cuts = range(1, size)
                    inner = [(a, b) for a in range(size) for b in range(a + 2, size + 1) if b - a < size]
                    columns = [pa.array(found[new].view(np.int64)), rows.column("lang").take(pa.array(text[number[at]])),
                               _spelled(words, number[at], size), runs([(0, c) for c in cuts]),
                               runs([(c, size) for c in cuts]), runs(inner)]
                    yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, kinds)], names=names)
    return run


#: Shares of the documents, in 64ths, that are searched one after the other for the texts of phrases.
_SEARCHED = (0, 1, 8, 64)


def described(docs: DataFrame, known: DataFrame, bitmap: np.ndarray, bits: int, longest: int = LONGEST) -> DataFrame:
    """(h, lang, phrase, a, lefts, rights, inner) of all known phrases of two words and more.

    Frequent ones are told from a small share of the documents; the others look only for what
    is missing then. Each document is searched once at most.
    """
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.col("text"), F.lit(1)), F.lit(_SEARCHED[-1]))
    texts = docs.where("text IS NOT NULL").select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text", part.alias("part"))
    left = known.where(F.col("h") % 2 == 0).withColumnRenamed("n", "a")
    found, missing = None, bitmap
    for low, high in zip(_SEARCHED, _SEARCHED[1:]):
        rows = (texts.where(F.col("part").between(low, high - 1)).select("lang", "text")
                .mapInArrow(released(_describe(bitmap, missing, longest)), _DESCRIBED))
        told = settle(rows.dropDuplicates(["h"]).join(left, "h"), "candidates")
        found = told if found is None else found.union(told)
        left = settle(left.join(told.select("h"), "h", "left_anti"), "missing")
        missing = marked(left, "h", bits, hashed=False)
        if not missing.any():
            break
    return found


def _looked_up(rows: DataFrame, part: str, name: str, known: DataFrame) -> DataFrame:
    """The rows with the count of one of their parts as `name`."""
    salt = F.pmod(F.col("h"), F.lit(_SALTS)).cast("int")
    answers = known.select(F.col("h").alias(part), F.col("n").alias(name),
                           F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt"))
    return rows.withColumn("_salt", salt).join(answers, [part, "_salt"]).drop("_salt", part)


def _wide(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def scored(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """candidates (h, lang, phrase, a, lefts, rights, inner) with l, r and score of their lowest-scoring cut."""
    cuts = candidates.select("h", "a", F.posexplode(F.arrays_zip("lefts", "rights")).alias("cut", "parts")).select(
        "h", "a", "cut", F.col("parts.lefts").alias("left"), F.col("parts.rights").alias("right"))
    cuts = _looked_up(_looked_up(cuts, "left", "l", known), "right", "r", known)
    # Products and sums may pass 64 bits.
    cuts = cuts.withColumn("both", _wide(F.col("l")) + _wide(F.col("r"))).withColumn(
        "score", F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div both"))
    lowest = cuts.groupBy("h").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    return candidates.join(lowest.select("h", "low.l", "low.r", "low.score"), "h")


def without_parts(candidates: DataFrame, percent: int = 80) -> DataFrame:
    """Candidates that no longer one holds which is nearly as frequent."""
    longer = (candidates.select(F.explode("inner").alias("h"), "a").groupBy("h")
              .agg(F.max("a").alias("_longer")))
    nearly = _wide(F.col("_longer")) * 100 >= _wide(F.col("a")) * percent
    return (candidates.join(longer, "h", "left").where(~F.coalesce(nearly, F.lit(False))).drop("_longer"))


def best(rows: DataFrame, top: int = TOP, salts: int = 64) -> DataFrame:
    """Each language's first rows by score, a and phrase, with their rank; first those of parts of it."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(salts))
    some = (rows.withColumn("_part", part)
            .withColumn("_nr", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
            .where(F.col("_nr") <= top).drop("_nr", "_part"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return some.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS,
                 top: int = TOP) -> DataFrame:
    """Per language of docs (doc_id, text, lang) its best phrases: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    path = fresh_path(spark, "words")
    tokens(docs, shards).write.partitionBy("shard").parquet(path)
    dealt = spark.read.schema(_TOKENS).parquet(path)
    totals = settle(dealt.groupBy("lang").agg(F.sum("n_words").alias("n")), "words-per-language")
    words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(MOST_BITS, max(FEWEST_BITS, int(8 * longest * words // least).bit_length()))
    known, bitmap = counts(dealt, bits, least, longest, shards)
    delete(spark, path)
    candidates = described(docs, known, bitmap, bits, longest)
    rows = best(scored(without_parts(candidates), known), top)
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
