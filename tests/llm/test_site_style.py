"""What the style trees decide, against a plain version of them."""

import math
import tracemalloc
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import site_style

SCHEMA = "page_id long, url string, html string, shape long"


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, 0) for i, r in enumerate(rows)], SCHEMA).repartition(4)


def html(body):
    return f"<html><body>{body}</body></html>"


def test_the_tree_judges_named_parts_of_articles(spark):
    def body(k, own):
        return html(f"<article><h1>title {k}</h1><p>story {k}</p><div class='related-work'><p>work {own}</p></div>"
                    f"<div class='share'><p>tell others</p></div><div class='promo'><p>offer {k % 3}</p></div>"
                    f"<div class='comments'><p>reader {k} says</p></div></article>")

    rows = [("https://many.example/a", body(k, k)) for k in range(40)]
    rows += [("https://few.example/a", body(100 + k, k)) for k in range(4)]
    got = {r.page_id: r.text for r in site_style.extract(frame(spark, rows)).collect()}
    # On a site of many pages the tree knows that the work is each page's own, and that the others repeat.
    assert got == {k: f"title {k}\n\nstory {k}\n\nwork {k}" if k < 40 else f"title {60 + k}\n\nstory {60 + k}"
                   for k in range(44)}


def test_pages_without_article_are_what_the_tree_makes_of_them(spark, monkeypatch):
    def body(k):
        return html(f"<div><ul><li>Start</li><li>About</li></ul></div><div class='x'><p>story {k}</p><p>more {k}</p></div>"
                    f"<div><p>All rights with us</p></div>")

    rows = [(f"https://h{k % 3}.example/{k}", body(k)) for k in range(60)]
    got = {r.page_id: r.text for r in site_style.extract(frame(spark, rows)).collect()}
    assert got == {k: f"story {k}\n\nmore {k}" for k in range(60)}
    # Without the trees every page would read otherwise.
    trees = site_style.style_trees
    monkeypatch.setattr(site_style, "style_trees", lambda parsed: trees(parsed).where("false"))
    without = {r.page_id: r.text for r in site_style.extract(frame(spark, rows)).collect()}
    assert all(without[k] != got[k] for k in range(60))


def plain_trees(pages):
    """{(host, path): (share, presentation, content, pages)} by the definitions, page by page."""
    seen, every = defaultdict(dict), {}
    for url, source in pages:
        page = site_style.Page(source)
        paths, children = page.paths(), page.children()
        counted = {(paths[n], "style", tuple(page.names[c] for c in children[n] if not page.noise[c]))
                   for n in range(len(paths)) if not page.noise[n]}
        counted |= {(paths[n], "text", t) for n, t in page.blocks if not page.noise[n]}
        seen[site_style._host(url)][frozenset(counted)] = every[frozenset(counted)] = counted

    def values(own):
        by_path = defaultdict(Counter)
        for counted in own.values():
            for path, kind, feature in counted:
                by_path[path][kind, feature] += 1
        out = {}
        for path, counts in by_path.items():
            styles = [k for (kind, _), k in counts.items() if kind == "style"]
            texts = [k for (kind, _), k in counts.items() if kind == "text"]
            m = sum(styles)
            same = repeated = None
            if m > 1:
                entropy = -sum(k / m * math.log(k / m) for k in styles) / math.log(m)
                same = (1 - 1 / m) * (1 - entropy)
                if texts:
                    # Each text's pages as a share of the largest entropy a text can have.
                    repeated = (1 - 1 / m) * min(1, sum(math.log(k) for k in texts) / len(texts) / math.log(m))
            out[path] = (0.9 ** len(styles), same, repeated, m)
        return out

    all_hosts, out = values(every), {}
    least = lambda a, b: None if a is None and b is None else 1 - max(x for x in (a, b) if x is not None)
    for host, own in seen.items():
        for path, (share, same, repeated, n) in values(own).items():
            share_all, same_all, repeated_all, pages_all = all_hosts[path]
            if pages_all > 1:
                drawn = 10 / (10 + n - 1)
                scaled = [None if v is None else drawn * v for v in (same_all, repeated_all)]
                out[host, path] = ((1 - 1 / n) * share + share_all / n, least(same, scaled[0]), least(repeated, scaled[1]), n)
    return out


def test_importances_equal_the_plain_version(spark, sf_dir):
    rows = [(r.url, r.html or "") for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    rows += [(f"https://two.example/{k}", html(f"<div><p>a {k % 2}</p><p>b</p></div><ul><li>{k}</li></ul>" + "<hr>" * (k % 3)))
             for k in range(9)]
    expected = plain_trees(rows)
    parsed = frame(spark, rows).mapInArrow(site_style._parse, site_style._PARSED)
    got = {(r.host, r.path): (r.share, r.presentation, r.content, r.pages)
           for r in site_style.style_trees(parsed).collect()}
    assert got.keys() == expected.keys() and len(got) > 30
    for key, values in got.items():
        told = [k for k, v in enumerate(expected[key]) if v is not None]  # no content where no page has a text
        assert [values[k] for k in told] == pytest.approx([expected[key][k] for k in told], abs=1e-9), key


def test_a_page_is_joined_with_its_own_nodes_only(spark):
    rows = [("https://one.example/a", html(f"<div class='c{k // 2}'><p>text {k}</p></div>")) for k in range(200)]
    joined = []
    original = site_style._extract

    def watched(batches):
        for batch in batches:
            assert max((len(t or ()) for t in batch.column("tree").to_pylist()), default=0) <= 5
            yield from original(iter([batch]))

    site_style._extract = watched
    try:
        joined = site_style.extract(frame(spark, rows)).collect()
    finally:
        site_style._extract = original
    assert len(joined) == 200 and sum(r.n_chars > 0 for r in joined) == 200


def test_deep_pages_and_clashing_columns(spark):
    deep = html("<div class='sidebar'>" * 50_000 + "<div>" * 50_000 + "end")
    tracemalloc.start()
    page = site_style.Page(deep)
    assert len(page.paths()) == 100_003
    assert tracemalloc.get_traced_memory()[1] < 300_000_000
    tracemalloc.stop()
    rows = frame(spark, [("https://d.example/", deep), ("https://e.example/", html("<p>a</p>"))]).withColumns(
        {c: F.lit("x") for c in ("path", "tree", "host", "text", "n_chars", "parents")})
    assert {r.url: r.text for r in site_style.extract(rows).collect()}["https://e.example/"] == "a"
