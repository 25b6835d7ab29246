"""Token ids of whole texts, equal to the tokenizers library's own, at the price of a lookup per word."""

from __future__ import annotations

import gc
import os
import re
from functools import cache, lru_cache
from itertools import chain

import numpy as np

from roadpulse.llm.batches import CACHES, ragged

_PIECES = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+").findall
_OTHER_SPACE = re.compile(r"[^\S \t-\r]").search
#: Distinct pieces a task remembers from slice to slice, and the longest of
#: them; both bound memory only.
REMEMBERED, LONGEST = 800_000, 64
#: Runs of marks whose ids a task remembers; bounds memory only.
_MARKS = 1_000
#: Bytes of text encoded at once; bounds memory only.
SLICE_CHARS = 2_000_000
#: A blank or none, Latin letters, and ASCII marks or none: no rule joins letters and marks after them.
_PLAIN = re.compile(r"( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)").fullmatch
# Byte-level models name a byte by the character of its number if that is printable,
# and else by the next free one from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_BLANK = {"": "", " ": chr(_BYTES[32])}
#: The Latin letters of `_PLAIN` beyond ASCII, by the names of their bytes.
_LETTERS = {c: chr(c).encode().decode("latin-1").translate(_BYTES) for c in range(192, 256)}


class _Numbers(dict):
    """Numbers pieces as they come; `fresh` lists those that came first."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.fresh.append(piece)
        return number


class Encoder:
    """Encodes texts piece by piece, a piece being blanks and the word after them.

    No rule of the given vocabularies looks across the blanks between two words
    but for runs that mix ASCII blanks with others; texts with such are encoded
    whole, and so are texts that hold the name of an added token, in any case: the
    library gives such a name its own id.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        names = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # A name without blanks lies within one piece.
        self._added = re.compile("|".join(map(re.escape, names)) or r"(?!)", re.IGNORECASE).search
        self._whole = any(not _PIECES(n) or _PIECES(n)[0] != n or n != n.strip() for n in names)
        # Marks are few and come again; a model's own object costs a call each time it is asked for.
        self._tokenize = self.tokenizer.model.tokenize
        self._marks = lru_cache(_MARKS)(lambda marks: [t.id for t in self._tokenize(marks)])
        self._word = self._plain_words()
        self.numbers = _Numbers()
        self.odd: set[int] = set()
        # Ids of piece n: flat[starts[n]:starts[n + 1]].
        self.starts, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _plain_words(self):
        """How the model names a plain word, if in a way known here: with the blank or without, in lower case."""
        def named(letters: str) -> str:
            return letters if letters.isascii() else letters.translate(_LETTERS)

        for word in (lambda blank, letters: _BLANK[blank] + named(letters), lambda blank, letters: named(letters.lower())):
            try:
                if all(self._plain_ids(word, p) == self.tokenizer.encode(p, add_special_tokens=False).ids
                       for p in (" Ab", "xyzzy", " Thequickest.", "a,", " QQ?***", "I!", " Ñandúes;", "Zß:", "ÀÖ")):
                    return word
            except Exception:  # the model has no such symbol
                continue
        return None

    def _plain_ids(self, word, piece: str) -> list[int] | None:
        plain = _PLAIN(piece)
        if not plain:
            return None
        blank, letters, marks = plain.groups()
        ids = [t.id for t in self._tokenize(word(blank, letters))]
        if marks:
            ids += self._marks(marks)
        return ids

    def _learn(self) -> None:
        fresh, first = self.numbers.fresh, len(self.starts) - 1
        gc.disable()  # nothing here is cyclic; collecting would walk all pieces
        try:
            lists = [self._plain_ids(self._word, p) for p in fresh] if self._word else [None] * len(fresh)
            rest = [k for k, ids in enumerate(lists) if ids is None]
            found = self.tokenizer.encode_batch_fast([fresh[k] for k in rest], add_special_tokens=False)
            for k, e in zip(rest, found):
                lists[k] = e.ids
        finally:
            gc.enable()
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(lists), np.uint32)])
        # A name without blanks and other space stay within a piece, so a search of all pieces at once finds them.
        joined = "\n".join(fresh)
        if self._whole or self._added(joined) or not joined.isascii() and _OTHER_SPACE(joined):
            self.odd.update(n for n, piece in enumerate(fresh, first)
                            if self._whole or self._added(piece)
                            or not piece.isascii() and _OTHER_SPACE(piece))

    def _forget(self) -> None:
        """Drop what the last slice taught beyond the bound."""
        fresh = self.numbers.fresh
        first = len(self.numbers) - len(fresh)
        if len(self.numbers) > REMEMBERED or any(len(p) > LONGEST for p in fresh):
            for piece in fresh:
                del self.numbers[piece]
            self.odd -= set(range(first, first + len(fresh)))
            self.starts = self.starts[:first + 1]
            self.flat = self.flat[:self.starts[-1]]
        self.numbers.fresh = []

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other (unsigned 32 bits), and how many each text has."""
        pieces, sizes = [], []
        for text in texts:
            cut = _PIECES(text)
            pieces += cut
            sizes.append(len(cut))
        numbers = np.fromiter(map(self.numbers.__getitem__, pieces), np.int64, len(pieces))
        if self.numbers.fresh:
            self._learn()
        starts = self.starts[numbers]
        lengths = self.starts[numbers + 1] - starts
        ids = self.flat[ragged(starts, lengths)]
        ends = np.cumsum(sizes, dtype=np.int64)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        counts = upto[ends] - upto[ends - np.asarray(sizes, np.int64)]
        if self.odd and pieces:
            odd = np.isin(numbers, np.fromiter(self.odd, np.int64))
            rows = np.unique(np.searchsorted(ends, np.flatnonzero(odd), "right"))
            if len(rows):
                parts = np.split(ids, np.cumsum(counts)[:-1])
                for row in rows:
                    whole = self.tokenizer.encode(texts[row], add_special_tokens=False).ids
                    parts[row] = np.asarray(whole, np.uint32)
                ids, counts = np.concatenate(parts), np.fromiter(map(len, parts), np.int64)
        self._forget()
        return ids, counts

    def encode_ended(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As `encode`, with an id appended to every text."""
        ids, counts = self.encode(texts)
        out = np.full(len(ids) + len(texts), end_id, np.uint32)
        ends = np.cumsum(counts + 1) - 1
        keep = np.ones(len(out), bool)
        keep[ends] = False
        out[keep] = ids
        return out, counts + 1


@cache
def encoder(path: str) -> Encoder:
    """One encoder per Python worker, which its tasks share until one of another kind comes."""
    return Encoder(path)


CACHES.append(encoder.cache_clear)
