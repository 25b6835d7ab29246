"""Language identification with interpolated Kneser-Ney character models.

Texts are lower-cased; every run of other characters than letters is one blank
symbol. Per language, 4-grams of symbols are counted over all labelled texts;
lower orders use continuation counts (in how many larger types a gram occurs),
with one absolute discount per language and order. All of that is grouping and
joining in Spark. The model keeps, per order, the sorted codes of the grams with a
log probability per language; it grows with the distinct grams of the labelled texts, and is
the one thing sent to all tasks. Tasks look codes up through a table of their hashes, whose
size follows the number of grams; the code itself is compared, so a gram that was not
seen falls back to the order below. A text gets the language of the lowest cross-entropy
per symbol; equal ones go to the first in alphabetical order.

Rejection is calibrated: per language, by the mean and deviation of the
cross-entropies that its own labelled texts get; the few symbols of a short text
are allowed more.

Defined results: NULL text and texts without a letter are `und` with score 0 and
NULL cross-entropy, as is every text when nothing was labelled; rows with NULL
text or label are not learnt from; repeated rows count as often as they occur;
documents with any doc_id, NULL included, keep a row each; other columns of the
input are not read. A text must fit into memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.batches import released, slices
from roadpulse.session import settle

UNKNOWN = "und"
#: Bytes of text scored at once; bounds memory only.
_SLICE = 1_000_000
ORDER = 4
#: A text is rejected beyond so many deviations above its language's mean
#: cross-entropy, plus an allowance, over the root of its length, for chance.
DEVIATIONS, CHANCE = 16.0, 4.0
_SYMBOL = np.uint64((1 << 16) - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@cache
def _symbols() -> np.ndarray:
    """Code point to symbol: 0 for all but letters; letters beyond 16 bits share the last block."""
    points = np.arange(0x110000, dtype=np.uint32)
    letter = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)
    return np.where(letter, np.where(points < 0x10000, points, 0xE000 + points % 0x1900), 0).astype(np.uint16)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All grams of `ORDER` symbols, 16 bits each, one per symbol of a text, and how many each text has."""
    lower = [t.lower() for t in texts]
    points = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum(np.fromiter(map(len, lower), np.int64, len(lower)))
    symbol = _symbols()[points]
    first = np.zeros(len(symbol) + 1, bool)
    first[ends - np.fromiter(map(len, lower), np.int64, len(lower))] = True
    before = np.concatenate([[0], symbol[:-1]]).astype(np.uint16)
    before[first[:-1]] = 0
    keep = (symbol != 0) | (before != 0)
    upto = np.concatenate([[0], np.cumsum(keep)])
    counts = np.diff(np.concatenate([[0], upto[ends]]))
    kept = symbol[keep].astype(np.uint64)
    start = np.repeat(np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    place = np.arange(len(kept)) - start
    code = kept.copy()
    for back in range(1, ORDER):
        shifted = np.zeros(len(kept), np.uint64)
        shifted[back:] = kept[:-back] if len(kept) > back else kept[:0]
        shifted[place < back] = 0
        code |= shifted << np.uint64(16 * back)
    return code, counts


class _Index:
    """Row numbers of sorted codes. Tasks make a table by hash of one that every symbol asks."""

    def __init__(self, codes: np.ndarray, direct: bool = False):
        self.codes, self.direct, self.table = codes, direct, None
        self.bits = max(10, (4 * len(codes)).bit_length())

    def __getstate__(self):
        return {**self.__dict__, "table": None}

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * _SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _search(self, codes: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[place] == codes, place, -1).astype(np.int32)

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """Row of each code, -1 where it is not held."""
        if not len(self.codes):
            return np.full(len(codes), -1, np.int32)
        if not self.direct:
            return self._search(codes)
        if self.table is None:
            self.table = np.full(1 << self.bits, -1, np.int32)
            self.table[self._slot(self.codes)] = np.arange(len(self.codes), dtype=np.int32)
        out = self.table[self._slot(codes)]
        # A used slot may be that of another code.
        other = np.flatnonzero((out >= 0) & (self.codes[out] != codes))
        out[other] = self._search(codes[other])
        return out


@dataclass
class Model:
    languages: list[str]
    symbols: int = 1
    #: Per order from 1: index of grams and their log probabilities (rows x languages).
    index: list[_Index] = field(default_factory=list)
    log_p: list[np.ndarray] = field(default_factory=list)
    #: Per order from 1, of the contexts of order - 1 symbols: index and log of the weight of the lower order.
    context: list[_Index] = field(default_factory=list)
    log_rest: list[np.ndarray] = field(default_factory=list)

    def below(self, codes: np.ndarray, order: int) -> np.ndarray:
        """Log probabilities of grams that an order does not hold, from the order below."""
        rows = self.context[order - 1].rows(codes >> np.uint64(16))
        rest = np.where(rows[:, None] >= 0, self.log_rest[order - 1][rows], 0.0)
        if order == 1:
            return rest - np.log(self.symbols)
        mask = np.uint64((1 << (16 * (order - 1))) - 1)
        return rest + self.score(codes & mask, order - 1)

    def score(self, codes: np.ndarray, order: int = ORDER) -> np.ndarray:
        rows = self.index[order - 1].rows(codes)
        out = self.log_p[order - 1][rows]
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            out[missing] = self.below(codes[missing], order)
        return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}

    def merge(parts: list) -> tuple[np.ndarray, np.ndarray]:
        codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        return codes, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)

    for batch in batches:
        for rows in slices(batch, "text", _SLICE):
            languages = rows.column("lang")
            for language in pc.unique(languages).to_pylist():
                own = rows.column("text").filter(pc.equal(languages, language)).to_pylist()
                parts = held.setdefault(language, [])
                parts.append(np.unique(grams(own)[0], return_counts=True))
                if sum(len(c) for c, _ in parts) > 2_000_000:
                    held[language] = [merge(parts)]
    for language, parts in held.items():
        codes, n = merge(parts)
        for at in range(0, len(codes), 100_000):
            piece = codes[at:at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(piece)), pa.array(piece.view(np.int64)),
                 pa.array(n[at:at + 100_000])], names=["lang", "code", "n"])


def fit(labelled: DataFrame) -> Model:
    """A model of all rows (text, lang) whose text and lang are not NULL."""
    counted = settle(labelled.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
                     .mapInArrow(released(_count), "lang string, code long, n long")
                     .groupBy("lang", "code").agg(F.sum("n").alias("n")), "grams")
    model = Model([r["lang"] for r in counted.select("lang").distinct().orderBy("lang").collect()])
    types = {ORDER: counted}
    for order in range(ORDER - 1, 0, -1):
        mask = F.lit((1 << (16 * order)) - 1)
        types[order] = (types[order + 1].select("lang", F.col("code").bitwiseAND(mask).alias("code"))
                        .groupBy("lang", "code").agg(F.count("*").alias("n")))
    model.symbols = types[1].select("code").distinct().count() + 1
    lower = None
    place = {language: k for k, language in enumerate(model.languages)}
    for order in range(1, ORDER + 1):
        grams_ = types[order]
        # Discount by the number of types seen once and twice.
        discounts = grams_.groupBy("lang").agg(
            F.sum((F.col("n") == 1).cast("int")).alias("once"),
            F.sum((F.col("n") == 2).cast("int")).alias("twice")).select("lang", F.greatest(
                F.lit(0.1), F.coalesce(F.try_divide("once", F.col("once") + 2 * F.col("twice")), F.lit(0.1)))
            .alias("d"))
        head = F.shiftrightunsigned("code", 16) if order > 1 else F.lit(0).cast("long")
        contexts = (grams_.groupBy("lang", head.alias("head"))
                    .agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
                    .join(discounts, "lang")
                    .withColumn("rest", F.col("d") * F.col("kinds") / F.col("total")))
        known = grams_.withColumn("head", head).join(contexts, ["lang", "head"]).select(
            "lang", "code", "rest", (F.greatest(F.col("n") - F.col("d"), F.lit(0)) / F.col("total")).alias("own"))
        if order == 1:
            p = known.select("lang", "code", (F.col("own") + F.col("rest") / model.symbols).alias("p"))
        else:
            tail = F.col("code").bitwiseAND(F.lit((1 << (16 * (order - 1))) - 1))
            p = known.withColumn("tail", tail).join(
                lower.select("lang", F.col("code").alias("tail"), F.col("p").alias("tail_p")),
                ["lang", "tail"]).select("lang", "code", (F.col("own") + F.col("rest") * F.col("tail_p")).alias("p"))
        lower = settle(p, f"order{order}")
        _add(model, place, contexts.select("lang", F.col("head").alias("code"), F.col("rest").alias("value")).toArrow(),
             lower.select("lang", "code", F.col("p").alias("value")).toArrow())
    return model


def _matrix(model: Model, place: dict, rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes, and the logarithm of their values per language, with an empty last row."""
    codes, at = np.unique(rows["code"].to_numpy().view(np.uint64), return_inverse=True)
    languages = rows["lang"].combine_chunks().dictionary_encode()
    column = np.array([place[x] for x in languages.dictionary.to_pylist()], np.int64)
    values = np.full((len(codes) + 1, len(model.languages)), np.nan)
    values[at, column[languages.indices.to_numpy()]] = np.log(rows["value"].to_numpy())
    return codes, values


def _add(model: Model, place: dict, contexts: pa.Table, grams_: pa.Table) -> None:
    codes, rest = _matrix(model, place, contexts)
    model.context.append(_Index(codes))
    model.log_rest.append(np.nan_to_num(rest, nan=0.0))
    codes, values = _matrix(model, place, grams_)
    # A language without the gram falls back to its lower order.
    order = len(model.index) + 1
    fallback = model.below(codes, order) if len(codes) else values[:0]
    held = values[:-1]
    held[np.isnan(held)] = fallback[np.isnan(held)]
    model.index.append(_Index(codes, order == ORDER))
    model.log_p.append(np.nan_to_num(values, nan=0.0).astype(np.float32))


def _score(model: Model, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            for rows in slices(batch, "text", _SLICE):
                codes, counts = grams([t or "" for t in rows.column("text").to_pylist()])
                entropy = np.full((len(counts), max(len(model.languages), 1)), np.nan)
                used = np.flatnonzero(counts) if model.languages else np.zeros(0, int)
                if len(used):
                    starts = (np.cumsum(counts) - counts)[used]
                    entropy[used] = -np.add.reduceat(
                        model.score(codes), starts, axis=0, dtype=np.float64) / counts[used, None]
                best = np.full(len(counts), len(model.languages))
                score, lowest = np.zeros(len(counts)), np.full(len(counts), np.nan)
                best[used] = entropy[used].argmin(axis=1)
                lowest[used] = entropy[used].min(axis=1)
                # Evidence grows with the root of the length: symbols depend on each other.
                apart = (entropy[used] - lowest[used, None]) * np.sqrt(counts[used, None])
                score[used] = 1 / np.exp(-apart).sum(axis=1)
                yield pa.RecordBatch.from_arrays([
                    *(rows.column(c) for c in keep), pa.array(names[best], pa.string()), pa.array(score),
                    pa.array(lowest, from_pandas=True), pa.array(counts.astype(np.int64))],
                    names=[*keep, "lang_pred", "score", "entropy", "n_symbols"])
    return run


def predict(docs: DataFrame, model: Model, *more: str) -> DataFrame:
    """doc_id and the columns `more`, lang_pred, score (0 to 1), entropy (nats per symbol) and
    n_symbols of every row."""
    keep = ["doc_id", *more]
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *more, "text")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema if f.name in keep)
    return own.mapInArrow(
        released(_score(model, keep)), f"{types}, lang_pred string, score double, entropy double, n_symbols long")


def limits(predicted: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """Per language, the highest cross-entropy of long texts accepted: rows (lang_pred, highest).

    `predicted` holds predictions and, in `lang`, the labels of those learnt from.
    """
    own = predicted.where("lang = lang_pred AND entropy IS NOT NULL")
    return own.groupBy("lang_pred").agg(
        (F.avg("entropy") + deviations * F.coalesce(F.stddev_pop("entropy"), F.lit(0.0))).alias("highest"))


def rejected(predicted: DataFrame, highest: DataFrame) -> DataFrame:
    """Predictions that are `und` or above their language's limit."""
    return predicted.join(highest, "lang_pred", "left").where(
        (F.col("lang_pred") == UNKNOWN)
        | (F.col("entropy") > F.col("highest") + CHANCE / F.sqrt("n_symbols"))).drop("highest")
