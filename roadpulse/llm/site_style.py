"""Main text of web pages by site style trees.

The block elements of all pages of a host are merged by their paths (names are tag
and classes). Every node of the merged tree gets two importances between 0 and 1:

- presentation: the entropy of the child sequences that pages have below it;
- content: 1 less the mean entropy, over its distinct texts, of the pages that
  hold the text. Menus, adverts and footers repeat themselves, articles do not.

A page's branch is worth `1 - DECAY^l` of its node's presentation and `DECAY^l` of
the mean of its children and own texts, l being the number of child sequences.
Branches of which no part reaches `THRESHOLD` go.

A host's own tree counts from two pages on, and passes smoothly into the tree of all
hosts the fewer they are: what repeats (1 less an importance) on n pages counts
1 - 1/n of it, and in the tree of all hosts also only `SHRINK / (SHRINK + n - 1)`, n
being the node's pages on the host; the larger of both holds. Elements that are
not part of an article by their meaning (scripts, forms, menus, footers, comments,
...) have no importance at all, and where a page marks its article, only that counts;
if no part of a marked article reaches `THRESHOLD` it stays whole. Words of class and
id alone never remove what holds the page's only article or two thirds of its text (that of
readers' replies aside), nor do negated ones and those of a part (`no-`, `has-`, `with-`). Inside
an article the tree decides about such words, but for those of replies: a branch worth `SURE` on
`EVIDENCE` pages of its host stays, any other goes.

Pages that are equal but for such elements count once on a host, and once among all
hosts, however many copies there are.

Counting is grouping by host, node and text, with partial sums: no host is gathered. A page is
joined with the values of its own nodes, which pages with the same set of nodes share.

Defined results: NULL or empty html, and pages without a main text, give the empty
text; a NULL url is the host ''; repeated rows and page_ids keep a row each; an
empty table gives no rows; other columns are not read. One page must fit into memory.
"""

from __future__ import annotations

import html
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.session import settle

THRESHOLD, DECAY, SHRINK = 0.6, 0.9, 10
#: What is named like noise inside an article stays if its branch is worth so much on so many pages of the host.
SURE, EVIDENCE = 0.8, 10

BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li
main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math "
                "select button object canvas audio video".split())
#: Without an end tag, these reach to the end of the page.
_TO_END = frozenset("script style textarea title".split())
#: Tags, roles, and words of class and id that are no part of an article.
NOISE_TAGS = frozenset("head nav footer aside form menu dialog search fieldset".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog "
                        "menu menubar toolbar note".split())
NOISE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner breadcrumb
breadcrumbs comment comments commentlist cookie cookies consent disclaimer discussion disqus dialog feedback
footer gdpr header login masthead menu menus modal nav navbar navigation newsletter notice notices
notification overlay pagination pager popup promo promoted promotion related recommended replies reply
respond search share sharing sidebar sidebars signup social sponsor sponsored subscribe subscription
toolbar toc topbar widget widgets""".split())
#: Words of what readers add, which may well be most of a page's text.
REPLY_WORDS = frozenset("comment comments commentlist discussion disqus replies reply respond".split())
#: The word after one of these tells what an element has or lacks, not what it is.
PART_WORDS = frozenset("no not non without hide has have with".split())
# What opening an element closes, up to the elements that bound the search.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
           "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
           "tfoot": ({"thead", "tbody"}, {"table"})}
_MAIN = frozenset(("article", "main"))

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
                  r"|<[!?/][^>]*>|<[a-zA-Z/!?][^>]*\Z", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _told(given: dict[str, str]) -> set[str]:
    """The words of class and id, but for those that tell what an element has or lacks."""
    out = set()
    for part in f"{given.get('class', '')} {given.get('id', '')}".split():
        before = ""
        for word in (w.lower() for w in _WORDS.findall(part)):
            if before not in PART_WORDS:
                out.add(word)
            before = word
    return out


class Page:
    """The block elements of a page in order, and its texts.

    Lists by node: `parents`, `names`, `noise`, `main`, `told` (named like noise, inside an
    article), and of the element alone `never` (noise by tag, role or style) and `marks` (noise
    words); `blocks`: (node, text).
    """

    def __init__(self, source: str):
        self.parents, self.names, self.inside, self.never, self.marks = [-1], ["#"], [False], [False], [frozenset()]
        self.blocks: list[tuple[int, str]] = []
        self._open: list[tuple[str, int]] = [("#", 0)]  # open block elements: tag and node
        self._text: list[str] = []
        at, size, match = 0, len(source), _TAG.search
        unclosed: set[str] = set()  # tags that are not closed from here on
        while at < size:
            found = match(source, at)
            if not found:
                self._text.append(source[at:])
                break
            if found.start() > at:
                self._text.append(source[at:found.start()])
            at = found.end()
            tag = found[2]
            if not tag:
                continue
            tag = tag.lower()
            if found[1]:
                self._end(tag)
            elif tag in RAW:
                if tag not in unclosed and (not found[3].endswith("/") or tag in _TO_END):
                    close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                    if close:
                        at = close.end()
                    elif tag in _TO_END:
                        at = size
                    else:  # the tag alone is passed over
                        unclosed.add(tag)
            elif tag in BLOCK:
                self._start(tag, found[3])
            elif tag == "br":
                self._text.append(" ")
        self._flush()
        self._judge()

    def _judge(self) -> None:
        size, parents = len(self.parents), self.parents
        never, reply, length, said = self.never[:], [False] * size, [0] * size, [0] * size
        for node in range(1, size):
            never[node] = never[node] or never[parents[node]]
            reply[node] = reply[parents[node]] or not REPLY_WORDS.isdisjoint(self.marks[node])
        for node, text in self.blocks:
            length[node] += 0 if never[node] else len(text)
            said[node] += 0 if never[node] or reply[node] else len(text)
        for node in range(size - 1, 0, -1):
            length[parents[node]] += length[node]
            said[parents[node]] += said[node]
        marked = {n for n in range(size) if self.marks[n] and not never[n]
                  and (3 * said[n] <= 2 * said[0] or reply[n])}
        if marked:
            # The page's article: the longest of those below marked elements, if none lies elsewhere.
            above = [0] * size  # the nearest marked element around each
            articles = []
            for node in range(1, size):
                above[node] = parents[node] if parents[node] in marked else above[parents[node]]
                if self.names[node].split(".")[0] in _MAIN and not never[node] and node not in marked:
                    articles.append(node)
            if articles and all(above[n] for n in articles):
                node = above[max(articles, key=lambda n: length[n])]
                while node:
                    marked.discard(node)
                    node = above[node]
        self.noise, self.main = [False] * size, [False] * size
        # Within an article, words of class and id are for the tree to judge.
        self.told = [n in marked and self.inside[n] and not reply[n] for n in range(size)]
        for node in range(1, size):
            self.noise[node] = self.noise[parents[node]] or never[node] or node in marked and not self.told[node]
            self.main[node] = self.main[parents[node]] or (
                self.names[node].split(".")[0] in _MAIN and not self.noise[node])

    def _flush(self) -> None:
        if self._text:
            text = " ".join(html.unescape("".join(self._text)).split())
            if text:
                self.blocks.append((self._open[-1][1], text))
            self._text = []

    def _close(self, depth: int) -> None:
        self._flush()
        del self._open[depth:]

    def _end(self, tag: str) -> None:
        if tag in BLOCK:
            for depth in range(len(self._open) - 1, 0, -1):
                if self._open[depth][0] == tag:
                    self._close(depth)
                    return
            self._flush()

    def _start(self, tag: str, attributes: str) -> None:
        self._flush()
        if self._open[-1][0] == "p":  # no block element lies in a paragraph
            self._close(len(self._open) - 1)
        if tag in _CLOSES:
            closed, bounds = _CLOSES[tag]
            for depth in range(len(self._open) - 1, 0, -1):
                if self._open[depth][0] in bounds:
                    break
                if self._open[depth][0] in closed:
                    self._close(depth)
        elif tag[0] == "h" and tag[1:].isdigit() and self._open[-1][0][0] == "h" and self._open[-1][0][1:].isdigit():
            self._close(len(self._open) - 1)
        given = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
        classes = sorted(given.get("class", "").lower().split())
        parent = self._open[-1][1]
        node = len(self.parents)
        inside = self.inside[parent]
        self.parents.append(parent)
        self.names.append(".".join([tag, *classes]))
        self.inside.append(inside or tag in _MAIN)
        self.never.append(
            tag in NOISE_TAGS or given.get("role", "").lower() in NOISE_ROLES
            or tag == "header" and not inside or given.get("aria-hidden") == "true"
            or re.search(r"(^|\s)hidden(\s|=|$)", attributes) is not None
            or "display:none" in given.get("style", "").replace(" ", ""))
        marks = frozenset() if tag in ("html", "body") else NOISE_WORDS.intersection(_told(given))
        self.marks.append(marks - {"header"} if inside or tag in _MAIN else marks)
        if tag not in VOID:
            self._open.append((tag, node))

    def paths(self) -> list[int]:
        """A hash of each node's path, made from its parent's."""
        out = [_hash("#")]
        for parent, name in zip(self.parents[1:], self.names[1:]):
            out.append(_hash(f"{out[parent]}/{name}"))
        return out

    def children(self) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in self.parents]
        for node, parent in enumerate(self.parents[1:], 1):
            out[parent].append(node)
        return out


_PARSED = ("page_id long, url string, host string, shape long, parents array<int>, paths array<long>, "
           "noise array<boolean>, main array<boolean>, told array<boolean>, block_nodes array<int>, block_texts array<string>, "
           "content long, feature_paths array<long>, features array<long>, feature_styles array<long>")
_TYPES = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), *[pa.list_(pa.bool_())] * 3,
          pa.list_(pa.int32()), pa.list_(pa.string()), pa.int64(), *[pa.list_(pa.int64())] * 3]


def _host(url: str | None) -> str:
    return re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", "", url or "").lstrip("/").split("/")[0].split("@")[-1] \
        .split("?")[0].split("#")[0].lower()


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _PARSED.split(", ")]
    for batch in batches:
        for first in range(0, batch.num_rows, 500):
            rows = batch.slice(first, 500)
            parsed = []
            hosts = [_host(u) for u in rows.column("url").to_pylist()]
            for source, host in zip(rows.column("html").to_pylist(), hosts):
                page = Page(source or "")
                styles = [_hash(" ".join(page.names[c] for c in below if not page.noise[c]))
                          for below in page.children()]
                paths = page.paths()
                # What is counted of a page, each once; equal for its copies.
                counted = dict.fromkeys((p, x, 1) for p, x, n in zip(paths, styles, page.noise) if not n)
                counted |= dict.fromkeys((paths[n], _hash(t), 0) for n, t in page.blocks if not page.noise[n])
                features = [array("q", c) for c in zip(*counted)] or [array("q")] * 3
                content = xxhash.xxh64_intdigest(b"".join(c.tobytes() for c in features)) - (1 << 63)
                # Texts are only needed again where they may be kept.
                texts = [None if page.noise[node] else text for node, text in page.blocks]
                shape = xxhash.xxh64_intdigest(array("q", sorted(set(paths))).tobytes() + host.encode("utf-8", "surrogatepass"))
                parsed.append((shape - (1 << 63), page.parents, paths, page.noise, page.main, page.told,
                               [n for n, _ in page.blocks], texts, content, *features))
            columns = list(zip(*parsed))
            yield pa.RecordBatch.from_arrays(
                [rows.column("page_id"), rows.column("url"),
                 pa.array(hosts, pa.string()), *(pa.array(c, t) for c, t in zip(columns, _TYPES))], names=names)


def style_trees(parsed: DataFrame) -> DataFrame:
    """Rows (host, path, share, presentation, content, pages) of every host's tree, drawn towards the tree
    of all hosts; `share` is what the parts below count. Nodes on one page of all have none."""
    needed = parsed.select("host", "content", F.arrays_zip(
        F.col("feature_paths").alias("path"), F.col("features").alias("feature"),
        F.col("feature_styles").alias("style")).alias("counted"))

    def counted(*tree: str) -> DataFrame:
        pages = needed.dropDuplicates([*tree, "content"])
        return (pages.select(*tree, F.explode("counted").alias("n"))
                .groupBy(*tree, "n.path", "n.feature", (F.col("n.style") == 1).alias("style"))
                .agg(F.count("*").alias("k")))

    def importance(*tree: str) -> DataFrame:
        k = F.col("k")
        sums = counted(*tree).groupBy(*tree, "path").agg(
            F.sum(F.when(F.col("style"), k)).alias("pages"),
            F.sum(F.when(F.col("style"), 1)).alias("styles"),
            F.sum(F.when(F.col("style"), k * F.log(k))).alias("style_log"),
            F.avg(F.when(~F.col("style"), F.log(k))).alias("text_log"))
        m, sure = F.log("pages"), 1 - 1 / F.col("pages")
        return sums.select(
            *tree, "path", "pages", F.pow(F.lit(DECAY), F.col("styles")).alias("share"),
            F.when(F.col("pages") > 1, sure * F.col("style_log") / F.col("pages") / m).alias("same"),
            F.when(F.col("pages") > 1, sure * F.least(F.lit(1.0), F.col("text_log") / m)).alias("repeated"))

    own = importance("host")
    every = importance()
    every = every.where("pages > 1").select("path", *(F.col(v).alias(f"every_{v}") for v in ("share", "same", "repeated")))
    n = F.col("pages")
    drawn = SHRINK / (SHRINK + n - 1)
    return own.join(every, "path").select(
        "host", "path", ((1 - 1 / n) * F.col("share") + F.col("every_share") / n).alias("share"),
        (1 - F.greatest("same", drawn * F.col("every_same"))).alias("presentation"),
        (1 - F.greatest("repeated", drawn * F.col("every_repeated"))).alias("content"), "pages")


_TREE = "array<struct<path:long,share:double,presentation:double,content:double,pages:long>>"


def _keep(parents, paths, noise, main, told, block_nodes, tree) -> list[bool]:
    """Of each block, whether it is main text."""
    known = {n["path"]: n for n in tree or ()}
    size = len(parents)
    below: list[list[float]] = [[] for _ in range(size)]
    has_text = set(block_nodes)
    kept, dropped = [False] * size, [False] * size
    for node in range(size - 1, -1, -1):
        values = known.get(paths[node])
        parts = below[node]
        if node in has_text:
            content = values and values["content"]
            parts = [*parts, 1.0 if content is None else content]
        if noise[node]:
            value = 0.0
        elif values is None or not parts:
            value = sum(parts) / len(parts) if parts else 0.0
        elif not below[node]:
            value = parts[0]
        else:
            share = values["share"]
            value = (1 - share) * values["presentation"] + share * sum(parts) / len(parts)
        if told[node] and (values is None or values["pages"] < EVIDENCE or value < SURE):
            dropped[node], value = True, 0.0
        kept[node] = kept[node] or value >= THRESHOLD
        if node:
            below[parents[node]].append(value)
            kept[parents[node]] = kept[parents[node]] or kept[node] and not dropped[node]
    marked = any(main)
    alive = [False] * size
    for node in range(size):
        dropped[node] = dropped[node] or noise[node] or node > 0 and dropped[parents[node]]
        alive[node] = kept[node] and not dropped[node] and (node == 0 or alive[parents[node]])
    kept = [alive[n] and (main[n] or not marked) for n in block_nodes]
    if marked and not any(kept):
        return [main[n] and not dropped[n] for n in block_nodes]
    return kept


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in
                   ("parents", "paths", "noise", "main", "told", "block_nodes", "tree", "block_texts")]
        texts = []
        for *page, blocks in zip(*columns):
            keep = _keep(*page)
            texts.append("\n\n".join(t for t, k in zip(blocks, keep) if k and t))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text (blocks joined by two newlines) and n_chars of every page."""
    parsed = settle(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
                    .mapInArrow(_parse, _PARSED), "parsed")
    # A page needs its own nodes only, and pages of a host mostly have the same: one row per such set.
    shapes = parsed.select("shape", "host", F.array_distinct("paths").alias("paths")).dropDuplicates(["shape"])
    nodes = F.collect_list(F.struct("path", "share", "presentation", "content", "pages"))
    trees = settle(shapes.select("shape", "host", F.explode("paths").alias("path"))
                   .join(style_trees(parsed), ["host", "path"]).groupBy("shape").agg(nodes.cast(_TREE).alias("tree")), "trees")
    return parsed.join(trees, "shape", "left").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")
