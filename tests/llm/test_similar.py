"""Near-copies: components, n-gram join, lines, repeated passages, fingerprints."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import components, lines, ngram_join, passages, simhash
from roadpulse.llm.words import Words
from tests.llm import plain

BLANKS = [" ", "\n", "\t", "  ", "\x0b", "\r\n"]


def documents(seed, n, vocabulary=400, copies=0.5):
    """Random texts, many of them edited copies of, or quoting, earlier ones."""
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)] + ["é", "Ünd", "I", "a b"]
    out = []
    for i in range(n):
        size = rnd.choice([0, 1, 4, 5, 6, 30, 60, 130, 200])
        own = rnd.choices(words, k=size)
        if out and rnd.random() < copies:
            other = rnd.choice(out)[1].split()
            if rnd.random() < 0.5:
                own = [rnd.choice(words) if rnd.random() < 0.02 else w for w in other]
            else:
                at = rnd.randrange(len(own) + 1)
                own = own[:at] + other[rnd.randrange(len(other) + 1):][:rnd.choice([49, 50, 80])] + own[at:]
        out.append((i, "".join(w + rnd.choice(BLANKS) for w in own)))
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_words():
    texts = ["a b  c\td", "", None, " x", "a b", "b c d a b", "é ü", "\n\n", "   "]
    words = Words(pa.array(texts))
    split = [plain.WORD.findall(t or "") for t in texts]
    assert words.counts.tolist() == [len(s) for s in split]
    flat = [w for s in split for w in s]
    for i, a in enumerate(flat):
        for j, b in enumerate(flat):
            assert (words.hashes[i] == words.hashes[j]) == (a == b)
    assert Words(pa.array([], pa.string())).counts.tolist() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_connected(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(1000, 1200)]
    edges += [(5000, k) for k in range(5001, 5400)] + [(7, 7)] + edges[:9]
    sets = plain.Sets({x for e in edges for x in e})
    for a, b in edges:
        sets.join(a, b)
    expected = {x: sets.find(x) for e in edges if e[0] != e[1] for x in e}
    got = components.connected(spark.createDataFrame(edges, "a long, b long").repartition(5))
    assert dict(map(tuple, got.collect())) == expected
    assert components.connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_of_a_chain_take_few_stages(spark):
    """Stages, not rows, cost the time of small tables dealt out over many tasks."""
    nodes = list(range(1500))
    random.Random(3).shuffle(nodes)
    edges = spark.createDataFrame(list(zip(nodes, nodes[1:])), "a long, b long").repartition(40)
    sc, tracker, group = spark.sparkContext, spark.sparkContext.statusTracker(), "chain"
    sc.setJobGroup(group, "components of a chain")
    try:
        got = components.connected(edges).collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(map(tuple, got)) == [(k, 0) for k in range(1500)]
    stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
    assert 0 < len(stages) <= 40


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join(spark, texts, seed):
    docs = documents(seed, 150)
    got = rows_of(ngram_join.join_texts(texts(docs, "item").repartition(7)))
    assert got == sorted(plain.components(docs), key=repr)


def test_chains_of_copies_are_one_component(spark, texts):
    """Far ends of a chain do not link, and a hub is no neighbour of all: rounds after the first find them."""
    rnd = random.Random(9)
    words = [f"x{k}" for k in range(60)]
    docs = [(0, " ".join(words))]
    for i in range(1, 40):
        words = words[2:] + [f"y{i}a", f"y{i}b"]
        docs.append((i, " ".join(words)))
    rnd.shuffle(docs)
    got = rows_of(ngram_join.join_texts(texts(docs)))
    assert got == sorted(plain.components(docs), key=repr)
    assert {r[2] for r in got} == {0}


def test_tree_walk_equals_set_counts():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2 ** 60, 300).astype(np.uint64)
    sets = [base[np.sort(rng.choice(300, rng.integers(1, 290), replace=False))] for _ in range(200)]
    sets += [np.concatenate([base[:k], rng.integers(0, 2 ** 60, 30).astype(np.uint64)]) for k in range(1, 290, 9)]
    for probe in (base, base[:250], base[30:200]):
        expected = [k for k, s in enumerate(sets) if 100 * (n := len(np.intersect1d(s, probe)))
                    >= 75 * (len(s) + len(probe) - n)]
        assert sorted(ngram_join.linked(probe, len(probe), sets, [len(s) for s in sets])) == expected


def test_join_of_defined_cases(spark, texts):
    same = "one two three four five six"
    rows = [(None, same), (4, same.upper()), (4, same), (4, same), (2, None), (3, ""), (5, "one two"), (6, "ONE  two"),
            (7, " \n"), (None, "alone here"), (8, "big " * 30_000), (9, "big " * 29_000)]
    assert rows_of(ngram_join.join_texts(texts(rows))) == sorted([
        (None, 2, 4), (4, 2, 4), (4, 2, 4), (4, 2, 4), (2, 0, 2), (3, 0, 3), (5, 1, 5), (6, 1, 5), (7, 0, 7),
        (None, 1, None), (8, 1, 8), (9, 1, 8)], key=repr)
    kept = ngram_join.one_of_each(texts(rows, "_first"))
    assert kept.columns == ["doc_id", "text", "_first"]
    # Of equal rows one stays, of equal doc_ids the one with the lower hash of its text.
    assert [r.doc_id for r in kept.where(F.upper("text") == same.upper()).collect()] == [4]
    assert sorted(r.doc_id for r in kept.where("doc_id <> 4").collect()) == [2, 3, 5, 7, 8]
    assert ngram_join.join_texts(texts([])).collect() == []
    assert ngram_join.one_of_each(texts([])).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_passages(spark, texts, seed, monkeypatch):
    monkeypatch.setattr(passages, "SHARD_WORDS", 700)  # several automata
    monkeypatch.setattr(passages, "PART_BYTES", 3000)  # each in several parts
    docs = documents(seed, 120, copies=0.7)
    assert rows_of(passages.remove_repeats(texts(docs).repartition(7))) == plain.without_repeats(docs)


def test_repeats_of_defined_cases(spark, texts):
    run = " ".join(f"r{k}" for k in range(50))
    loop = "a b " * 200
    rows = [(5, run), (5, run), (3, run + " tail"), (None, run), (9, "x " + run + " y " + run), (1, None), (2, ""),
            (10, loop), (11, loop + "c"), (12, "b " + loop), (13, "w " * 40_000), (14, "w " * 60_000)]
    assert rows_of(passages.remove_repeats(texts(rows, "first"))) == plain.without_repeats(rows)
    assert passages.remove_repeats(texts([])).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_lines(spark, texts, seed):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choices("abcdefghij   ", k=rnd.choice([0, 3, 9, 60, 200]))) for _ in range(60)]

    def edited(line):
        at = rnd.randrange(len(line) + 1)
        return line[:at] + rnd.choice(["", "x", "yz ", "é"]) + line[at:]

    docs = [(i, "\n".join(edited(rnd.choice(pool)) if rnd.random() < .6 else rnd.choice(pool)
                          for _ in range(rnd.randrange(1, 6)))) for i in range(80)]
    got = rows_of(lines.classify(texts(docs, "item").repartition(5)).drop("row"))
    expected = plain.line_classes(docs)
    # Banding may miss a link of little similarity; here it finds nearly all.
    assert sum(a != b for a, b in zip(got, expected)) <= 0.01 * len(expected)
    assert len(got) == len(expected)


def test_lines_of_defined_cases(spark, texts):
    long = " ".join(f"k{k}" for k in range(20_000))
    rows = [(7, "same line here\n\n \nshort"), (3, "same line here\nother words stand here"), (None, "same line here"),
            (4, None), (5, ""), (8, "short\nshort"), (9, long), (10, long + "r"), (3, "same line here")]
    got = [tuple(r) for r in lines.classify(texts(rows, "text_a")).drop("row").collect()]
    assert sorted(r[:2] for r in got if r[0] == 8) == [(8, 0), (8, 1)]
    classes = {(r[0], r[1]): r[2:] for r in got if r[0] not in (3, None)}
    assert classes[7, 0] == (3, 0, False) and classes[7, 1] == (7, 1, True) and classes[7, 2] == (7, 2, True)
    assert classes[7, 3] == (7, 3, True) and classes[8, 0] == (7, 3, False) and classes[5, 0] == (5, 0, True)
    assert classes[10, 0] == (9, 0, False)
    assert sorted(r[4] for r in got if r[:2] == (3, 0)) == [False, True]
    left = lines.dedup(texts(rows, "_gone").withColumn("n_chars", F.lit(-1)))
    assert left.columns == ["doc_id", "text", "_gone", "n_chars"]
    kept = {(r.doc_id, r.text): r.n_chars for r in left.collect()}
    assert kept[7, "\n \nshort"] == 8 and kept[4, None] == -1 and kept[9, long] == -1
    assert not [k for k in kept if k[0] in (None, 8, 10)] and (5, "") in kept
    assert lines.classify(texts([])).collect() == [] == lines.dedup(texts([])).collect()


def test_removing_lines_leaves_one_table_and_no_shuffle_files(spark, texts):
    """Nor are texts written or shuffled a second time for their lines that stay."""
    import os

    from roadpulse import session
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, folder = spark.conf.get(setting), session.shared_folder(spark).removeprefix("file:")
    there = set(os.listdir(folder))
    rows = [(k, f"{hashlib.md5(b'%d' % k).hexdigest()}\nthe same in all texts\n\n{hashlib.sha1(b'%d' % k).hexdigest()}")
            for k in range(12)]
    left = lines.dedup(texts(rows))
    assert [x.split("-")[0] for x in set(os.listdir(folder)) - there] == ["removed"]
    assert spark.conf.get(setting) == before
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and plan.count("Join") == 1
    kept = {r.doc_id: r.text for r in left.collect()}
    assert kept[0].split("\n")[1] == "the same in all texts" and kept[7].count("\n") == 2


def test_marks_of_lines_that_stay(spark):
    gone = spark.createDataFrame([([0],), ([2, 3, 5],), ([0, 1, 2],)], "gone array<int>")
    got = [r[0] for r in gone.select(lines._marks(F.col("gone"))).collect()]
    assert got == [[False], [True, True, False, False, True, False], [False] * 3]


def test_shingles_are_runs_of_their_line():
    from roadpulse.llm.words import _run_hashes
    cut = lines.Lines(pa.array(["abcdefgh\n\nabc\nabcdefghi", None, "", "é𝄞" * 7 + "\nbcdefghi"], pa.string()))
    rows = np.array([0, 2, 3, 5, 6])
    hashes, counts = cut.shingles(rows)
    assert counts.tolist() == [1, 1, 2, 7, 1]
    firsts = np.concatenate([s + np.arange(c) for s, c in zip(cut.starts[rows], counts)])
    lasts = np.minimum(firsts + lines.SHINGLE, np.repeat(cut.ends[rows], counts))
    assert (hashes == _run_hashes(cut.points, firsts, lasts)).all()
    assert hashes[0] == hashes[2] and hashes[3] == hashes[-1]
    short = lines.Lines(pa.array(["ab\nc"], pa.string()))
    assert (short.shingles(np.arange(2))[0] == _run_hashes(short.points, short.starts, short.ends)).all()


def test_bands_find_similar_lines():
    """Of lines with a similarity of 0.75 to 0.85, banding meets at least 97 %."""
    rng = np.random.default_rng(2)
    met = total = 0
    for _ in range(400):
        a = rng.integers(0, 2 ** 63, 200).astype(np.uint64)
        b = np.concatenate([a[:178], rng.integers(0, 2 ** 63, 22).astype(np.uint64)])
        keys = lines.bands(lines.signatures(np.concatenate([a, b]), np.array([200, 200])))
        met += bool((keys[0] == keys[1]).any())
        total += 1
    assert met >= 0.97 * total


def test_fingerprints_in_order(spark, texts):
    docs = documents(3, 90, copies=0.3)
    rnd = random.Random(1)
    rnd.shuffle(docs)
    got = {r.doc_id: r for r in simhash.compare_edited(texts(docs, "key").repartition(6)).collect()}
    ordered = sorted(docs, reverse=True)
    for k, (i, text) in enumerate(ordered):
        other = ordered[(k + 1) % len(ordered)][1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + other[:cut]
        row = got[i]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        prints = simhash.fingerprints(pa.array([text, edited, other]))
        assert [row.fingerprint, row.edited_fingerprint] == [p.tobytes().hex() for p in prints[:2]]
        assert row.near_edited == simhash.likeness(prints[:1], prints[1:2])[0]
        assert row.near_next == simhash.likeness(prints[:1], prints[2:])[0]


def test_hot_doc_id_is_cut_into_buckets(spark, texts):
    rows = [(5, f"t{k}") for k in range(300)] + [(None, f"n{k}") for k in range(200)] + [(k, f"k{k}") for k in range(90)]
    frame = texts(rows).withColumn("h", F.xxhash64("text"))
    order = [r.text for r in frame.orderBy(F.col("doc_id").desc_nulls_last(), "h").collect()]
    dealt = simhash.with_next(texts(rows).repartition(5)).collect()
    assert max(sum(r.bucket == b and not r.ahead for r in dealt) for b in {r.bucket for r in dealt}) < 300
    follows = {a.text: b.text for a, b in zip(dealt, dealt[1:]) if a.bucket == b.bucket and not a.ahead}
    assert follows == {t: order[(k + 1) % len(order)] for k, t in enumerate(order)}
    plan = simhash.with_next(texts(rows))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_fingerprints_of_defined_cases(spark, texts):
    rows = [(None, "n"), (2, None), (2, "b b b"), (2, "b b b"), (1, ""), (9, "w " * 60_000)]
    got = simhash.compare_edited(texts(rows, "bucket")).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got)) == [
        (False, 1, 0), (False, 2, 0), (False, 2, 5), (False, 2, 5), (False, 9, 120_000), (True, 0, 1)]
    assert {r.fingerprint for r in got if r.n_chars == 0} == {"0" * 32}
    assert [r.near_next for r in simhash.compare_edited(texts([(4, "a b c")])).collect()] == [1.0]
    assert simhash.compare_edited(texts([])).collect() == []
    # A vote per term and bit, by hand.
    hashes, _, _ = Words(pa.array(["a b c d b c d"])).windows(3)
    high = [int((hashes >> np.uint64(8 * (b // 8) + 7 - b % 8) & np.uint64(1)).sum()) * 2 > len(hashes) for b in range(64)]
    bits = np.unpackbits(simhash.fingerprints(pa.array(["a b c d b c d"])))[:64].astype(bool)
    assert bits.tolist() == high


def test_search_within_a_radius(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, (40, 16), dtype=np.uint8)
    prints = [base]
    for flips in (1, 2, 3, 4, 5, 9):
        bits = np.unpackbits(base, axis=1)
        for row in bits:
            row[rng.choice(128, flips, replace=False)] ^= 1
        prints.append(np.packbits(bits, axis=1))
    every = np.concatenate(prints)
    names = [p.tobytes().hex() for p in every]
    df = spark.createDataFrame([(n,) for n in names + names[:3]], "fingerprint string")
    for radius, blocks in ((0, 1), (3, 5), (4, 6)):
        got = {tuple(r) for r in simhash.within(df.where("fingerprint < '8'"), df, radius, blocks).collect()}
        distance = np.bitwise_count(every[:, None] ^ every[None]).sum(axis=2)
        assert got == {(names[i], names[j], int(distance[i, j])) for i in range(len(names)) if names[i] < "8"
                       for j in range(len(names)) if distance[i, j] <= radius}


def test_known_numbers_are_told_exactly():
    rnd = np.random.default_rng(5)
    ends = np.array([0, 1, (1 << 64) - 1, (1 << 64) - 2], np.uint64)
    near = rnd.integers(0, 50, 3000).astype(np.uint64)  # many of one slot
    for numbers in (np.zeros(0, np.uint64), ends[:1], ends[2:3], ends, near, rnd.integers(0, 1 << 63, 3000).astype(np.uint64)):
        asked = np.concatenate([numbers, ends, near, rnd.integers(0, 1 << 63, 1000).astype(np.uint64)])
        assert lines._Known(numbers).holds(asked).tolist() == np.isin(asked, numbers).tolist()


def test_shingles_are_taken_once_in_each_line():
    texts = ["a" * 30, "", "abcabcabcabcabcabc", "a" * 30, "another line of words, another line of words", "short", "é" * 12]
    hashes, counts = lines._shingle_sets(texts)
    own = np.split(hashes, np.cumsum(counts)[:-1])
    for text, got in zip(texts, own):
        distinct = {text[k:k + 8] for k in range(max(1, len(text) - 7))}
        assert len(set(got.tolist())) == len(got) == len(distinct)
    assert own[0].tolist() == own[3].tolist()


def test_signatures_take_the_lowest_of_each_bin(monkeypatch):
    monkeypatch.setattr(np, "sort", None)  # shingles are not sorted for it
    hashes = np.random.default_rng(6).integers(0, 1 << 63, 400).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    got = lines.signatures(hashes, np.array([399, 1]))
    for k in range(lines.BINS):
        own = [h & 0xFFFFFFFF for h in hashes[:399].tolist() if h >> 58 == k]
        assert not own or got[0, k] == min(own)
    assert len({x & 0xFFFFFFFF for x in got[1].tolist()}) == 1


def test_first_pairs_pass_the_sketches(spark):
    """Items of one group whose sketches differ too much are not compared."""
    sets = {1: range(100), 2: range(5, 105), 3: range(500, 600), 4: range(90, 190)}
    rows = [(7, k, len(s), True) for k, s in sets.items()]
    hashes = np.concatenate([lines.mix(np.array(s, np.uint64)) for s in sets.values()])
    bits = components.sketches(hashes, np.array([len(s) for s in sets.values()])).tolist()
    sketched = spark.createDataFrame([(k, b, [7]) for k, b in zip(sets, bits)], "item long, bits array<long>, lowest array<long>")
    seen = []

    def links_of(pairs):
        seen.extend((r.a, r.b) for r in pairs.collect())
        return pairs.where("a = 1 AND b = 2")

    groups = spark.createDataFrame(rows, "group long, item long, n long, first boolean")
    found = components.similar(groups, links_of, 0.75, sketched)
    assert {(r.item, r.component) for r in found.collect()} == {(1, 1), (2, 1)}
    assert seen == [(1, 2)]


def copies_of_one(seed, n, most, size=100):
    """Texts with up to `most` words of one text replaced, and some cut at an end."""
    rnd = random.Random(seed)
    words, docs = [f"x{k}" for k in range(size)], []
    for i in range(n):
        own = list(words)
        for k, at in enumerate(rnd.sample(range(size), rnd.randrange(most + 1))):
            own[at] = f"y{i}.{k}"
        docs.append((i, " ".join(own[rnd.choice([0, 0, 0, 4, 12]):size - rnd.choice([0, 0, 0, 5, 10])])))
    return docs


@pytest.mark.parametrize(("seed", "most", "size"), [(1, 7, 100), (2, 4, 100), (3, 3, 30), (4, 2, 12)])
def test_copies_at_all_distances(spark, texts, seed, most, size):
    docs = copies_of_one(seed, 120, most, size)
    got = rows_of(ngram_join.join_texts(texts(docs, "item").repartition(5)))
    assert got == sorted(plain.components(docs), key=repr)
    assert len({r[2] for r in got}) < 100


def test_copies_too_far_apart_leave_their_groups(spark, texts, monkeypatch):
    """Copies of one text that have more than a seventh of their shingles alone link with none of their size."""
    docs, rows = [], {"mixed": 0, "pairs": 0}
    for i in range(40):
        words = [f"x{k}" for k in range(104)]
        for k in range(4):
            words[5 + 25 * k + i % 20] = f"y{i}.{k}"
        docs.append((i, " ".join(words)))
    settle = components.settle

    def counted(df, name, *more):
        out = settle(df, name, *more)
        if name in rows:
            rows[name] += out.count()
        return out

    monkeypatch.setattr(components, "settle", counted)
    got = rows_of(ngram_join.join_texts(texts(docs)))
    assert got == sorted(plain.components(docs), key=repr) == sorted(((i, 100, i) for i in range(40)), key=repr)
    assert rows == {"mixed": 0, "pairs": 0}


def test_last_pairs_are_those_of_their_first_common_member(spark):
    """Of a group of copies none of which link, no pair is left whose other members are too few."""
    n, far = 70, 60
    # Item k has 10 + k % 5 members before the group's, items of `far` less than a seventh.
    rows = [(1, k, n, 10 + k % 5 if k < far else 4, k >= far) for k in range(80)]
    groups = spark.createDataFrame(rows, "group long, item long, n long, before long, first boolean")
    seen = []

    def links_of(pairs):
        seen.append({(r.a, r.b) for r in pairs.collect()})
        return pairs.where("a < 0")

    assert components.similar(groups, links_of, 0.75).collect() == []
    near = {k for k in range(80) if 7 * rows[k][3] <= n}
    assert len(near) == 32
    met = set().union(*seen)
    assert {(a, b) for a in near for b in near if a < b} <= met
    assert all(a in near and b in near for a, b in met)
