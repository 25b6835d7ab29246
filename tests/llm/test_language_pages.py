"""Language identification, main text of pages, decontamination, pipeline."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from roadpulse.llm import decontaminate, language, queries, site_style
from tests.llm import plain

# --- languages ---------------------------------------------------------------

WORDS = {"aa": "the and with over under river stone bridge".split(),
         "bb": "der und mit über unter fluß stein brücke".split(),
         "cc": "река и мост под над камень с".split()}


def sentences(seed, n):
    rnd = random.Random(seed)
    return [(" ".join(rnd.choices(WORDS[lang], k=rnd.randrange(3, 30))), lang)
            for lang in WORDS for _ in range(n)]


class Plain:
    """Interpolated Kneser-Ney as the formulas say it, one language."""

    def __init__(self, texts, order, symbols):
        self.order, self.symbols = order, symbols
        self.counts = {order: Counter(g for t in texts for g in self.grams(t))}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.discount, self.context = {}, {}
        for k, counts in self.counts.items():
            once, twice = (sum(n == m for n in counts.values()) for m in (1, 2))
            self.discount[k] = max(0.1, once / (once + 2 * twice)) if once + 2 * twice else 0.1
            self.context[k] = defaultdict(lambda: [0, 0])
            for g, n in counts.items():
                self.context[k][g[:-1]][0] += n
                self.context[k][g[:-1]][1] += 1

    def grams(self, text):
        plain_text, out = "", []
        for c in text.lower():
            c = c if c.isalpha() else " "
            if c != " " or plain_text[-1:] not in ("", " "):
                plain_text += c
        padded = " " * (self.order - 1) + plain_text
        return [padded[k:k + self.order] for k in range(len(plain_text))]

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / self.symbols
        total, kinds = self.context[k].get(gram[:-1], (0, 0))
        if not total:
            return self.p(gram[1:])
        d = self.discount[k]
        return max(self.counts[k].get(gram, 0) - d, 0) / total + d * kinds / total * self.p(gram[1:])

    def entropy(self, text):
        grams = self.grams(text)
        return -sum(math.log(self.p(g)) for g in grams) / len(grams)


def test_entropy_equals_the_formulas(spark):
    rows = sentences(1, 12)
    model = language.fit(spark.createDataFrame([*rows, (None, "aa"), ("x", None)], "text string, lang string"))
    assert model.languages == sorted(WORDS)
    symbols = len({c for t, _ in rows for c in t.lower() if c.isalpha()}) + 2  # the blank, and any other
    own = [Plain([t for t, g in rows if g == lang], language.ORDER, symbols) for lang in model.languages]
    texts = ["The river, the stone!", "unter  der Brücke 12 мост", "qqq zzz", "a", "Мост и река;", "\n\n the"]
    codes, counts = language.grams(texts)
    found = model.score(codes)
    for text, start, n in zip(texts, np.cumsum(counts) - counts, counts):
        expected = [m.entropy(text) for m in own]
        assert -found[start:start + n].mean(axis=0) == pytest.approx(expected, rel=1e-4)


def test_held_out_languages(spark, texts):
    model = language.fit(spark.createDataFrame(sentences(1, 60), "text string, lang string"))
    rows = sentences(2, 40)
    docs = [(i, t) for i, (t, _) in enumerate(rows)]
    odd = [(None, "the bridge"), (900, None), (901, ""), (902, " 12 !? "), (903, "the " * 30_000), (903, "der Stein")]
    got = language.predict(texts(docs + odd, "lang_pred"), model).collect()
    by_id = {r.doc_id: r for r in got if r.doc_id != 903}
    assert sum(by_id[i].lang_pred == rows[i][1] for i in range(len(rows))) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in got)
    for i in (900, 901, 902):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].entropy) == ("und", 0.0, None)
    assert by_id[None].lang_pred == "aa"
    assert sorted(r.lang_pred for r in got if r.doc_id == 903) == ["aa", "bb"]
    assert language.predict(texts([]), model).collect() == []
    # Calibrated rejection: learnt texts and short ones stay, letters without a language go.
    learnt = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(sentences(1, 60))] + [
        (1000, "qzxj " * 80, None), (1001, "the", None), (1002, "1", None)], "doc_id long, text string, lang string")
    seen = language.predict(learnt, model, "lang")
    assert sorted(r.doc_id for r in language.rejected(seen, language.limits(seen)).collect()) == [1000, 1002]


def test_without_labels_all_is_unknown(spark, texts):
    model = language.fit(spark.createDataFrame([], "text string, lang string"))
    assert [(r.lang_pred, r.score) for r in language.predict(texts([(1, "abc")]), model).collect()] == [("und", 0.0)]


def test_given_documents(spark):
    got = queries.op10_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    rate = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert rate >= 0.98
    fold = got.select((F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("f"), "held_out")
    assert fold.where("f <> held_out").count() == 0


# --- pages -------------------------------------------------------------------

def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize("source, expected", [
    (page("<nav><ul><li>Home</li></ul></nav><article><h1>Head &amp; shoulders</h1><p>One\n two <b>three</b>four"
          "<br>five<p>Six &lt;7&gt; &eacute;&#233;&#x1F642;</article><footer>&copy;</footer>"),
     "Head & shoulders\n\nOne two threefour five\n\nSix <7> éé🙂"),
    (page("<article><p>a</p><script>var t='</p><p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>b</p>"
          "<form><input><p>no</p></form><aside>no</aside><section class='reader-comments'><p>no</p></section>"
          "<p>c <a href='x>y'>link</a> d</p></article>"), "a\n\nb\n\nc link d"),
    (page("<div class=\"cookie-notice\">no</div><header><h1>Site</h1></header><main><div><p>x</p><ul><li>l1<li>l2</ul>"
          "<table><tr><td>t1<td>t2</table></div></main><div id=sidebar>no</div>"), "x\n\nl1\n\nl2\n\nt1\n\nt2"),
    (page("<div class='ad'>no</div><p>plain page</p><p>more&nbsp;text &am"), "plain page\n\nmore text &am"),
    (page("<article><p>never closed <b>bold<p>next"), "never closed bold\n\nnext"),
    ("just text", "just text"), ("", ""), (None, ""), ("<p", ""), ("< p> a <1", "< p> a <1"),
    (page("<article class='comment'><p>no</p></article><article><p>yes</p></article>"), "yes"),
])
def test_main_text(spark, source, expected):
    df = spark.createDataFrame([(1, "http://h.example/x", source, "p")], "page_id long, url string, html string, paths string")
    assert [(r.text, r.n_chars) for r in site_style.extract(df).collect()] == [(expected, len(expected))]


STORY = "<p>a long enough story of the day</p>"


@pytest.mark.parametrize("body", [
    f"<div class='content with-sidebar'>{STORY}</div>", f"<div id='page' class='no-sidebar'>{STORY}</div>",
    f"<article class='post has-comments'>{STORY}</article>", f"<main class='hasToc'>{STORY}</main>",
    f"<div class='sidebar'><div class='comments'><article>{STORY}</article></div></div><p>x</p>",
    f"<div class='widget'>{STORY}</div><div class='ad'>no</div>",
    f"<main><div class='widget-area'>{STORY}</div><div class='comments'>{STORY * 9}</div></main>",
    f"<article>{STORY}</article><div class='comments'><article>{STORY * 2}</article></div>",
    f"<article>{STORY}<div class='comments'>{STORY * 9}</div></article>",
])
def test_words_of_a_wrapper_do_not_remove_the_article(body):
    got = site_style.Page(page(body))
    kept = [t for n, t in got.blocks if not got.noise[n] and (got.main[n] or not any(got.main))]
    assert [t for t in kept if t != "x"] == ["a long enough story of the day"]


@pytest.mark.parametrize("tag", ["button", "select", "object", "audio", "video", "canvas", "svg", "math", "iframe",
                                 "noscript"])
def test_unclosed_elements_do_not_cut_the_page(tag):
    got = site_style.Page(page(f"<{tag}>no</{tag}><p>a</p><{tag}><p>b</p><{tag} x='y'><p>c</p><script>no"))
    assert [t for _, t in got.blocks] == ["a", "b", "c"]


def test_repeated_branches_go_by_their_importance(spark):
    """No tag or class tells these blocks; only that a site repeats them does."""
    rnd = random.Random(3)
    pool = [f"boiler plate {k} text" for k in range(8)]

    def body(k):
        return page(f"<div class='x1'><div>{rnd.choice(pool)}</div><div>{rnd.choice(pool)}</div></div>"
                    f"<div class='x2'><h2>title {k}</h2><p>story {k} {rnd.random()}</p><p>{pool[0]}</p></div>")

    rows = [(k, "https://one.example/a", body(k)) for k in range(300)]
    rows += [(1000 + k, "https://small.example/b", body(1000 + k)) for k in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in site_style.extract(df.repartition(5)).collect():
        blocks = r.text.split("\n\n")
        # A repeated paragraph of a story stays: what counts is the branch.
        assert len(blocks) == 3 and blocks[0] == f"title {r.page_id}" and blocks[2] == pool[0]


def test_copies_of_a_page_count_once(spark):
    """Copies are no boilerplate, whatever the noise around them; marked articles are never left out."""
    rnd = random.Random(2)

    def body(k, tag="div"):
        return page(f"<div class='ad'>advert {rnd.random()}</div>"
                    f"<{tag}><h2>title {k}</h2><p>story {k}</p><p>more of {k}</p></{tag}>")

    rows = [("https://equal.example/a", body(1))] * 1000
    rows += [(f"https://ten.example/{k}", body(f"t{k % 30}")) for k in range(300)]
    rows += [("https://near.example/a", body("n", "article").replace("</article>", f"</article><p>{k}</p>"))
             for k in range(150)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in site_style.extract(df.repartition(3)).collect()}
    names = ["1"] * 1000 + [f"t{k % 30}" for k in range(300)] + ["n"] * 150
    assert got == {i: f"title {k}\n\nstory {k}\n\nmore of {k}" for i, k in enumerate(names)}


@pytest.mark.parametrize("size, others", [(2, 0), (3, 0), (20, 0), (99, 0), (3, 200)])
def test_small_hosts_have_their_own_tree(spark, size, others):
    """Untold menus and notices go from a few pages on, also where no other host has them."""
    def body(k, menu):
        return page(f"<div><ul><li>Start {menu}</li><li>About {menu}</li></ul></div><div class='x'>Notice of {menu}</div>"
                    f"<div class='y'><h2>title {k}</h2><p>story {k}</p><p>more of {k}</p></div>")

    rows = [(k, "https://one.example/a", body(k, "one")) for k in range(size)]
    rows += [(1000 + k, f"https://h{k % 50}.example/b", body(1000 + k, f"h{k % 50}")) for k in range(others)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in site_style.extract(df.repartition(3)).collect()}
    assert got == {k: f"title {k}\n\nstory {k}\n\nmore of {k}" for k, _, _ in rows}


def test_pages_of_defined_cases(spark):
    schema = "page_id long, url string, html string"
    long = page("<article>" + "<p>word</p>" * 20_000 + "</article>")
    rows = [(None, None, page("<p>a</p>")), (1, "u", None), (2, "http://h/x", long), (2, "http://h/x", long)]
    got = site_style.extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 1), (1, 0), (2, 119_998), (2, 119_998)]
    assert site_style.extract(spark.createDataFrame([], schema)).collect() == []


# --- benchmark ---------------------------------------------------------------

def brute(region, item):
    before, best = [0] * (len(region) + 1), 0
    for i in item:
        row = [0]
        for j, r in enumerate(region):
            row.append(max(0, before[j] + (2 if r == i else -1), before[j + 1] - 1, row[j] - 1))
        best, before = max(best, *row), row
    return best


def test_alignment_equals_brute_force():
    rnd = random.Random(3)
    items = [[rnd.randrange(5) for _ in range(rnd.randrange(1, 14))] for _ in range(300)]
    regions = [[rnd.randrange(5) for _ in range(rnd.randrange(1, 22))] for _ in range(300)]
    arrays = [[np.array(x, np.uint64) + 5 for x in y] for y in (regions, items)]
    points, start, end = decontaminate.align(*arrays)
    assert points.tolist() == [brute(r, i) for r, i in zip(regions, items)]
    for r, i, p, a, b in zip(regions, items, points, start, end):
        assert brute(r[a:b], i) == p


def test_copies_and_edited_copies_are_found(spark, texts):
    rnd = random.Random(1)
    words = [f"w{k}" for k in range(3000)]
    stop = ["the", "of", "and", "in"]

    def prose(n):
        return [rnd.choice(stop) if rnd.random() < .4 else rnd.choice(words) for _ in range(n)]

    items = [prose(rnd.choice([14, 25, 50])) for _ in range(12)]
    docs, expected = [], set()
    for i in range(200):
        text = prose(rnd.choice([5, 80, 400]))
        if i % 4 == 0:
            k = rnd.randrange(12)
            copy = [w if rnd.random() > (i % 3) * 0.07 else rnd.choice(words) for w in items[k]]
            copy = copy[:5] + (["extra", "words"] if i % 8 == 0 else []) + copy[5:]
            at = rnd.randrange(len(text))
            text[at:at] = [w.upper() if i % 16 == 0 else w for w in copy]
            expected.add((i, k))
        docs.append((i, ", ".join(text) if i % 5 == 0 else " ".join(text)))
    benchmark = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    found = decontaminate.matches(texts(docs, "score").repartition(5), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected
    assert all(0.5 <= r.score <= 1 and r.end_word > r.start_word for r in found)


@pytest.mark.parametrize("total, copies", [(200, 1), (200, 150), (1002, 2), (1002, 700)])
def test_equal_edited_copies_are_all_found(spark, texts, total, copies):
    """However often the same edited copy occurs, and in however few documents."""
    rnd = random.Random(5)
    item = [f"i{k}" for k in range(50)]
    edited = [f"x{k}" if k % 5 == 4 else w for k, w in enumerate(item)]
    docs = [(i, " ".join([f"w{rnd.randrange(500)}" for _ in range(30)] + (edited if i < copies else item[:6])))
            for i in range(total)]
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = decontaminate.matches(texts(docs).repartition(3), benchmark).collect()
    # The copy's last word is a changed one.
    assert sorted((r.doc_id, r.score, r.start_word, r.end_word) for r in found) == [
        (i, pytest.approx((40 * 2 - 9) / 100), 30, 79) for i in range(copies)]


def test_limit_is_never_below_the_alignment():
    rnd = random.Random(4)
    items = [[rnd.randrange(9) for _ in range(rnd.randrange(1, 14))] for _ in range(300)]
    regions = [[rnd.randrange(9) for _ in range(rnd.randrange(1, 22))] for _ in range(300)]
    most = decontaminate.limit(*([np.array(x, np.uint64) for x in y] for y in (regions, items)))
    assert all(m >= brute(r, i) for m, r, i in zip(most, regions, items))
    assert decontaminate.limit([np.array([1, 2, 9], np.uint64)], [np.array([1, 5, 2, 6, 6], np.uint64)]).tolist() == [3]


def test_items_in_blocks_and_hot_items(spark, texts, monkeypatch):
    """An item that most documents hold keeps seeds; blocks of items give what one block gives."""
    items = [(1, "one two three four five six seven"), (2, None), (3, "a b"), (4, ""), (5, "red green blue cyan"),
             (5, "red green blue cyan")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = [(k, "x one two three four five six seven y") for k in range(30)] + [
        (None, "red green blue cyan"), (40, None), (41, ""), (40, "a b"), (42, "q " * 50_000 + "red green blue cyan")]
    for words in (500_000, 3):
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", words)
        got = [(r.doc_id, r.item_id, r.start_word, r.end_word) for r in
               decontaminate.matches(texts(docs), benchmark).collect()]
        assert sorted(g for g in got if g[1] == 1) == [(k, 1, 1, 8) for k in range(30)]
        assert sorted((g for g in got if g[1] == 5), key=repr) == sorted(
            [(None, 5, 0, 4)] * 2 + [(42, 5, 50_000, 50_004)] * 2, key=repr)
    assert decontaminate.matches(texts([]), benchmark).collect() == []
    assert decontaminate.matches(texts(docs), benchmark.limit(0)).collect() == []


# --- pipeline ----------------------------------------------------------------

@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Rows of documents and of what each stage keeps of its predecessor's."""
    out = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        got = stage(spark, out[-1], sf_dir)
        out.append(spark.createDataFrame(got.collect(), got.schema))
    return [df.toPandas() for df in out], out


def test_stage_columns(stages):
    _, frames = stages
    for df in frames[1:-1]:
        assert df.schema == frames[0].schema
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "ngram_join", "decontamination", "best_fit_packing"]


def test_language_stage_keeps_clean_documents(stages):
    rows = stages[0]
    assert len(rows[1]) >= 0.99 * len(rows[0])


def test_language_stage_rejects_foreign_texts(spark, sf_dir):
    """Texts in other scripts and of no language go; the given ones stay."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    foreign = ["Ο γρήγορος ποταμός και η πέτρινη γέφυρα κοντά στην πόλη ", "Быстрая река и каменный мост у города ",
               "qzxj vkrt wqpf zzgh xkcd bqlm hjkw "]
    rows = [(10**9 + k, foreign[k % 3] * (1 + k), None, "planted", 1) for k in range(30)]
    got = corpus_pipeline.language_id(spark, docs.union(spark.createDataFrame(rows, docs.schema)), sf_dir)
    kept = {r.doc_id for r in got.select("doc_id").collect()}
    assert not kept & {r[0] for r in rows}
    assert len(kept) >= 0.99 * docs.count()


def test_line_stage(stages):
    before, after = stages[0][1], stages[0][2]
    classes = {(i, k): kept for i, k, _, _, kept in plain.line_classes(list(zip(before.doc_id, before.text)))}
    expected = {}
    for i, t in zip(before.doc_id, before.text):
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if classes[i, k])
        if left.strip() or left == t:
            expected[i] = left
    assert dict(zip(after.doc_id, after.text)) == expected
    assert (after.n_chars == after.text.str.len()).all()


def test_join_stage(stages):
    before, after = stages[0][2], stages[0][3]
    groups = plain.components(list(zip(before.doc_id, before.text)))
    assert sorted(after.doc_id) == [i for i, _, c in groups if i == c]


def test_decontamination_stage(stages, sf_dir, spark):
    before, after = stages[0][3], stages[0][4]
    items = [set(zip(w, w[1:], w[2:])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
             if (w := r.text.lower().split())]
    gone = set(before.doc_id) - set(after.doc_id)
    for i, t in zip(before.doc_id, before.text):
        w = t.lower().split()
        grams = set(zip(w, w[1:], w[2:]))
        share = max(len(grams & own) / len(own) for own in items)
        assert i in gone if share > 0.8 else i not in gone if share < 0.2 else True


def test_packing_stage(stages):
    before, packed = stages[0][4], stages[0][5]
    assert set(packed.doc_id) == set(before.doc_id)
    assert packed.groupby("sequence_id").length.sum().max() <= 1024
    assert packed.sequence_id.nunique() <= -(-packed.length.sum() // 1024) * 1.05 + 1


def test_run_equals_the_stages(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir).toPandas()
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got[keys].values.tolist())) == sorted(map(tuple, stages[0][5][keys].values.tolist()))


def test_stages_of_defined_cases(spark, tmp_path):
    """NULLs anywhere, repeated rows, empty tables and clashing columns go through all stages."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row string, doc string, row long"
    rows = [(1, "the river and the stone bridge", "aa", None, 1, "r", "d", 1), (None, None, None, None, None, None, None, None),
            (2, "", "aa", "s", 0, "", "", 0), (3, "the river and the stone bridge", "aa", "s", 3, "r", "d", 2),
            (4, "over the bridge with stone under it\nmore", None, "s", 3, "r", "d", 2),
            (4, "over the bridge with stone under it\nmore", None, "s", 3, "r", "d", 2)]
    spark.createDataFrame([(1, "nothing like it at all"), (None, None)], "item_id long, text string") \
        .write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            if name != "best_fit_packing":
                assert docs.columns == [f.split()[0] for f in schema.split(", ")]
            docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count() == 0
