"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Sets:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def similar(sets, links):
    """Union of all pairs of sets with 100 * intersection >= 75 * union."""
    holders = defaultdict(list)
    for i, own in sets.items():
        common = Counter(j for g in own for j in holders[g])
        for j, n in common.items():
            if 100 * n >= 75 * (len(own) + len(sets[j]) - n):
                links.join(i, j)
        for g in own:
            holders[g].append(i)


def shingles(text, size=5):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + size]) for k in range(max(len(words) - size + 1, 1)))


def components(docs):
    """(doc_id, set size, component) of documents with distinct ids."""
    sets = {i: shingles(t) for i, t in docs}
    links = Sets(sets)
    similar(sets, links)
    return sorted((i, len(s), links.find(i)) for i, s in sets.items())


def without_repeats(docs, size=50):
    """(doc_id, words, removed words, hash of the rest); rows of equal doc_id do not see each other."""
    words = [(i, WORD.findall(t or "")) for i, t in docs]
    first = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - size + 1):
                key = tuple(w[k:k + size])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1 if i is not None else 0):
            if first[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def line_classes(docs, size=8):
    """(doc_id, line, class_doc_id, class_line, kept) of documents with distinct ids."""
    places = [(i, k, line) for i, t in docs if t is not None for k, line in enumerate(t.split("\n"))]
    solid = {line for _, _, line in places if line.strip(" \t\n\r\x0b\x0c")}
    sets = {line: frozenset(line[k:k + size] for k in range(max(len(line) - size + 1, 1))) for line in solid}
    links = Sets(sets)
    similar(sets, links)
    last = float("inf")
    first = {}
    for i, k, line in sorted(places, key=lambda p: (last if p[0] is None else p[0], p[1])):
        if line in solid:
            first.setdefault(links.find(line), (i, k))
    return sorted(((i, k, *(own := first[links.find(line)] if line in solid else (i, k)), own == (i, k))
                   for i, k, line in places), key=repr)


def packed(lengths, capacity):
    """Sequences that greedy first-fit decreasing needs."""
    gaps = []
    for n in sorted(lengths, reverse=True):
        for k, gap in enumerate(gaps):
            if gap >= n:
                gaps[k] -= n
                break
        else:
            gaps.append(capacity - n)
    return len(gaps)


def periodic_runs(words):
    """(start, length, period) of the maximal stretches of smallest period q, max(6, 4q) words and more."""
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ids, found = [number[w] for w in words], {}
    for q in range(1, len(ids) // 4 + 1):
        at = 0
        while at + q < len(ids):
            if ids[at] != ids[at + q]:
                at += 1
                continue
            start = at
            while at + q < len(ids) and ids[at] == ids[at + q]:
                at += 1
            if at + q - start >= max(6, 4 * q):
                # A multiple of a run's period finds the same stretch again.
                found.setdefault((start, at + q - start), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def planted(doc_id, words):
    """The words after the rule that makes a tenth of the documents periodic."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def periodic_digest(doc_id, text):
    words = planted(doc_id, WORD.findall(text or ""))
    runs = periodic_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    told = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def collocations(docs, least, top=2000, longest=4):
    """(lang, rank, phrase, a, l, r, n, score) of documents (doc_id, text, lang)."""
    count, totals = Counter(), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                count.update((lang, tuple(words[i:i + n])) for i in range(len(words) - n + 1))
    some = {k: a for k, a in count.items() if len(k[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, words), a in some.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if j - i < len(words):
                    longer[lang, words[i:j]] = max(longer[lang, words[i:j]], a)
    rows = defaultdict(list)
    for (lang, words), a in some.items():
        if 100 * longer[lang, words] < 80 * a:
            cuts = [(count[lang, words[:k]], count[lang, words[k:]]) for k in range(1, len(words))]
            score, _, l, r = min((2000000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts))
            rows[lang].append((-score, -a, " ".join(words).encode(), l, r))
    return sorted((lang, nr, phrase.decode(), -a, l, r, totals[lang], -score) for lang, own in rows.items()
                  for nr, (score, a, phrase, l, r) in enumerate(sorted(own)[:top], 1))


def without_repeated_bytes(docs, size=50):
    """(doc_id, bytes, removed bytes, spans, hash of the rest); rows of equal doc_id do not see each other."""
    data = [(i, (t or "").encode()) for i, t in docs]
    first = {}
    for i, b in data:
        if i is not None:
            for k in range(len(b) - size + 1):
                key = b[k:k + size]
                first[key] = min(first.get(key, i), i)
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1 if i is not None else 0):
            if first[b[k:k + size]] < i:
                gone[k:k + size] = b"\1" * size
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)
