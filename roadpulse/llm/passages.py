"""Removal of passages that an earlier document has too, with Aho-Corasick automata.

A window is `SIZE` consecutive words of one document. It goes from a document if
the same words also start in one with a smaller doc_id:

1. Every window's hash is shuffled (packed, at most twice per slice) to find the
   windows of several documents and the first document of each: consecutive
   windows of one first document make a passage.
2. Passages are dealt into shards by first document. Each shard's passages, cut
   into blocks of `BLOCK` words, are compiled into one automaton; any window of a
   passage holds a whole block.
3. The documents that share a window stream through the automata of the shards
   that hold their first documents. Each hit is extended to both sides by
   comparing words; runs of at least `SIZE` words are removed. A shard with many
   documents is split into parts that compile the same automaton.

Documents without a shared window cannot hold a passage and skip step 3.

Defined results: NULL text has no words; a NULL doc_id is neither smaller nor
larger than another, so such a document keeps all words and takes none; rows with
equal doc_ids are documents of equal rank that leave each other alone; repeated
rows keep a row each; windows are judged on the input; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.batches import binaries, slices
from roadpulse.llm.keys import bucket_count, flat, is_marked, marked, pack, partitions, unpack
from roadpulse.llm.words import Words, _run_hashes
from roadpulse.session import settle

SIZE, BLOCK = 50, 25
#: Words compiled into one automaton and bytes of text streamed through one copy of it, about.
SHARD_WORDS, PART_BYTES = 200_000, 8_000_000
_SLICE = 1_500_000

_SENT = "bucket int, owners binary, sizes binary, keys binary, links binary"
_FOUND = "doc_id long, first long, keys binary"
_KEPT = "n_words long, n_removed long, kept_sha256 string"


def _anchors(words: Words, first: np.ndarray, size: int) -> np.ndarray:
    """Of each window, the lowest hash of the runs of four words in it (of its words, if short).

    Windows that follow each other mostly share it, so they are dealt to one task.
    """
    run = 4 if size > 4 else 1
    hashes = np.append(_run_hashes(words.hashes, np.arange(max(len(words.hashes) - run + 1, 0)),
                                   np.arange(run, len(words.hashes) + 1)), np.zeros(run - 1, np.uint64))
    width, reach = size - run + 1, 1
    while 2 * reach <= width:
        hashes[:len(hashes) - reach] = np.minimum(hashes[:len(hashes) - reach], hashes[reach:])
        reach *= 2
    return np.minimum(hashes[first], hashes[first + width - reach])


def _shared_pairs(keys: np.ndarray, owners: np.ndarray):
    """Keys of several owners: (key, first owner) once each, and distinct (owner, first owner) links."""
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    opens = np.ones(len(keys), bool)
    opens[1:] = keys[1:] != keys[:-1]
    start = np.flatnonzero(opens)
    run = np.cumsum(opens) - 1
    first, last = owners[start], owners[np.append(start[1:], len(keys)) - 1]
    several = first != last
    later = several[run] & (owners != first[run])
    links = np.unique(np.stack([owners[later], first[run][later]], axis=1), axis=0)
    return keys[start], first, last, several, links, order[start]


def _send(size: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", _SLICE):
                words = Words(rows.column("text"))
                keys, at, counts = words.windows(size)
                if not len(keys):
                    continue
                anchors = _anchors(words, at, size)
                owners = np.repeat(rows.column("doc_id").to_numpy(zero_copy_only=False), counts)
                keys, first, last, several, links, one = _shared_pairs(keys, owners)
                # A key goes out with its first and last document here: no more, however frequent.
                keys = np.concatenate([keys, keys[several]])
                owners = np.concatenate([first, last[several]])
                places = np.concatenate([anchors[one], anchors[one[several]]])
                order = np.argsort(owners, kind="stable")
                sent = pack(keys[order], owners[order], buckets, places=places[order])
                names = [*sent.schema.names[:4], "links"]
                yield pa.RecordBatch.from_arrays(
                    [*sent.columns[:4], pa.nulls(sent.num_rows, pa.binary())], names=names)
                if len(links):
                    none = pa.array([b""], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(links[0, 0]) % buckets], pa.int32()), none, none, none,
                         pa.array([links.astype("<i8").tobytes()], pa.binary())], names=names)
    return run


def _link_batch(links: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(links[:, 0]), pa.array(links[:, 1]), pa.nulls(len(links), pa.binary())],
        names=["doc_id", "first", "keys"])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = []
    for batch in batches:
        links = flat(batch.column("links").drop_null(), "<i8").reshape(-1, 2)
        if len(links):
            yield _link_batch(links)
        held.append(batch.select(["owners", "sizes", "keys"]))
    keys, owners = unpack(held)
    if not len(keys):
        return
    keys, first, _, several, links, _ = _shared_pairs(keys, owners)
    if len(links):
        yield _link_batch(links)
    keys, first = keys[several], first[several]
    order = np.argsort(first, kind="stable")
    docs, start = np.unique(first[order], return_index=True)
    yield pa.RecordBatch.from_arrays(
        [pa.array(docs), pa.nulls(len(docs), pa.int64()),
         binaries(keys[order], np.append(start, len(order)) * 8)], names=["doc_id", "first", "keys"])


def shared_windows(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Rows (doc_id, first, keys): either windows whose first document is doc_id, or that
    doc_id shares a window with the earlier document `first`."""
    spark = docs.sparkSession
    sent = docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(
        _send(size, bucket_count(spark)), _SENT)
    return sent.repartition(partitions(spark), "bucket").mapInArrow(_find, _FOUND)


def _digest(words: list[str], removed: np.ndarray | None) -> tuple[int, int, str]:
    kept = words if removed is None else [w for w, gone in zip(words, removed) if not gone]
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _part(bitmap: np.ndarray):
    """Digests of documents that share nothing; the text of the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("_hash").to_numpy(zero_copy_only=False)
            known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            shares = is_marked(bitmap, hashes) & known
            texts = batch.column("text")
            own = [None if s else _digest(_words(t.as_py()), None) for s, t in zip(shares, texts)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([t.as_py() if s else None for s, t in zip(shares, texts)], pa.string()),
                pa.array(shares),
                *(pa.array([o and o[k] for o in own], kind)
                  for k, kind in enumerate((pa.int64(), pa.int64(), pa.string())))],
                names=["doc_id", "text", "shares", "n_words", "n_removed", "kept_sha256"])
    return run


def _passages(size: int):
    """Runs of consecutive shared windows of their first document, as word hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, "text", _SLICE):
                words = Words(rows.column("text"))
                keys, _, counts = words.windows(size)
                found = []
                for k, (doc, n, at, word) in enumerate(zip(
                        rows.column("doc_id").to_pylist(), counts.tolist(), (np.cumsum(counts) - counts).tolist(),
                        (np.cumsum(words.counts) - words.counts).tolist())):
                    own = flat(rows.column("keys").slice(k, 1).flatten(), "<u8")
                    found += [(doc, words.hashes[word + a:word + b + size - 1].astype("<u8").tobytes())
                              for a, b in _runs(np.isin(keys[at:at + n], own))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _ in found], pa.int64()), pa.array([r for _, r in found], pa.binary()),
                     pa.array([len(r) // 8 for _, r in found], pa.int64())],
                    names=["first", "words", "n_words"])
    return run


def _runs(marked_: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marked_, [False]]).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


class Automaton:
    """All passages of a shard; finds the runs of a document that occur in earlier ones."""

    def __init__(self, firsts: list[int], passages: list[np.ndarray], size: int):
        import ahocorasick
        self.size, self.block = size, size // 2
        self.firsts, self.passages = firsts, passages
        places: dict[tuple, list[tuple[int, int]]] = {}
        for number, words in enumerate(passages):
            short = (words & np.uint64(0xFFFFFFFF)).tolist()
            for at in range(0, len(short) - self.block + 1, self.block):
                places.setdefault(tuple(short[at:at + self.block]), []).append((number, at))
        self.places = list(places.values())
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for number, block in enumerate(places):
            self.automaton.add_word(block, number)
        if places:
            self.automaton.make_automaton()

    def covered(self, doc_id: int, words: np.ndarray) -> np.ndarray:
        """Which words lie in a run of at least `size` words that an earlier passage holds.

        A hit whose surroundings, a block to both sides, are covered is passed over:
        where its run goes on, the run holds a further block, which is hit too.
        """
        covered, done = np.zeros(len(words), bool), {}
        if not self.places:
            return covered
        for last, number in self.automaton.iter(tuple((words & np.uint64(0xFFFFFFFF)).tolist())):
            at = last - self.block + 1
            around = covered[max(0, at - self.block):last + 1 + self.block]
            if around.all():
                continue
            for passage, place in self.places[number]:
                if self.firsts[passage] >= doc_id or at < done.get((passage, at - place), 0):
                    continue
                other, shift = self.passages[passage], at - place
                low, high = max(0, shift), min(len(words), shift + len(other))
                same = words[low:high] == other[low - shift:high - shift]
                hit = at - low
                if not same[hit:hit + self.block].all():
                    continue
                left = np.flatnonzero(~same[:hit])
                right = np.flatnonzero(~same[hit:])
                start = low + (int(left[-1]) + 1 if len(left) else 0)
                end = low + hit + (int(right[0]) if len(right) else len(same) - hit)
                done[passage, shift] = end
                if end - start >= self.size:
                    covered[start:end] = True
                    if around.all():
                        break
        return covered


def _stream(size: int):
    def run(docs: pa.Table, passages: pa.Table) -> pa.Table:
        automaton = Automaton(passages["first"].to_pylist(),
                              [np.frombuffer(w, "<u8") for w in passages["words"].to_pylist()], size)
        out = []
        for batch in docs.to_batches():
            for rows in slices(batch, "text", _SLICE):
                words = Words(rows.column("text"))
                at = np.append(0, np.cumsum(words.counts)).tolist()
                for k, (doc, text) in enumerate(zip(rows.column("doc_id").to_pylist(), rows.column("_text").to_pylist())):
                    found = automaton.covered(doc, words.hashes[at[k]:at[k + 1]])
                    out += [(doc, text, start, end) for start, end in _runs(found)]
        columns = list(zip(*out)) or [[]] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "_text", "start", "end"])
    return run


def locate(docs: DataFrame, links: DataFrame, passages: DataFrame, size: int = SIZE) -> DataFrame:
    """Rows (doc_id, _text, start, end): runs of words in documents (doc_id, text, _text) that
    passages (first, words, n_words) of smaller doc_ids hold; links (doc_id, first) say where to look."""
    total = passages.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_WORDS))
    shard = F.pmod(F.xxhash64("first"), F.lit(shards)).alias("shard")
    routed = links.select("doc_id", shard).distinct().join(docs, "doc_id")
    routed = settle(routed.withColumn("bytes", F.octet_length("text")), "routed")
    parts = routed.groupBy("shard").agg(
        F.ceil((F.sum("bytes") + 1) / PART_BYTES).cast("long").alias("parts"))
    left = routed.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("doc_id"), "parts"))
    right = passages.withColumn("shard", shard).join(parts, "shard").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    return left.select("shard", "part", "doc_id", "_text", "text").groupBy("shard", "part").cogroup(
        right.select("shard", "part", "first", "words").groupBy("shard", "part")).applyInArrow(
        _stream(size), "doc_id long, _text long, start long, end long")


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            words = _words(text)
            removed = np.zeros(len(words), bool)
            for run in runs or ():
                removed[run["start"]:run["end"]] = True
            rows.append(_digest(words, removed if runs else None))
        columns = list(zip(*rows)) or [[]] * 3
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
             pa.array(columns[2], pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def repeated_runs(docs: DataFrame, size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """All documents (doc_id, text where they share a window, `shares`, digest where they
    don't), and the runs of words to remove: (doc_id, _text, start, end)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = settle(shared_windows(own, size), "windows")
    bitmap = marked(found, "doc_id")
    all_docs = settle(own.withColumn("_hash", F.xxhash64("doc_id")).mapInArrow(
        _part(bitmap), f"doc_id long, text string, shares boolean, {_KEPT}"), "documents")
    sharing = all_docs.where("shares").select("doc_id", "text", F.xxhash64("text").alias("_text"))
    own_keys = found.where("keys IS NOT NULL").groupBy("doc_id").agg(F.collect_list("keys").alias("keys"))
    passages = settle(sharing.select("doc_id", "text").join(own_keys, "doc_id").select("doc_id", "text", "keys")
                      .mapInArrow(_passages(size), "first long, words binary, n_words long"), "passages")
    links = found.where("first IS NOT NULL").select("doc_id", "first").distinct()
    # A link found within a slice may lead to a document that is not the first of all.
    further = links.join(links.select(F.col("doc_id").alias("first"), F.col("first").alias("second")), "first")
    links = links.union(further.select("doc_id", "second"))
    return all_docs, settle(locate(sharing, links, passages, size), "runs")


def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Per row of docs (doc_id, text): n_words, n_removed and the hash of the words kept."""
    all_docs, runs = repeated_runs(docs, size)
    per_text = runs.groupBy("doc_id", "_text").agg(F.collect_set(F.struct("start", "end")).alias("runs"))
    shared = (all_docs.where("shares").withColumn("_text", F.xxhash64("text"))
              .join(per_text, ["doc_id", "_text"], "left").select("doc_id", "text", "runs")
              .mapInArrow(_remove, f"doc_id long, {_KEPT}"))
    return all_docs.where("NOT shares").select(*shared.columns).union(shared)
