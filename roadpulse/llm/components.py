"""Connected components, and the components of a similarity graph, as Spark jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.session import settle

EDGE = "a long, b long"


class UnionFind:
    """Sets of integers, each known by its smallest member."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent[x]
        return root

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's edges as one star per set that they join: at most one edge per node."""
    sets = UnionFind()
    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            sets.join(a, b)
    nodes = [x for x in sets.parent if sets.find(x) != x]
    for at in range(0, len(nodes), 100_000):
        some = nodes[at:at + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int64()), pa.array([sets.find(x) for x in some], pa.int64())], names=["a", "b"])


def _are_stars(edges: DataFrame) -> bool:
    """Whether every left end has one right end only and no right end is a left one."""
    ends = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).union(
        edges.select("b", F.lit(None).cast("long")))
    nodes = ends.groupBy("x").agg(F.min("y").alias("low"), F.max("y").alias("high"),
                                  F.bool_or(F.col("y").isNull()).alias("right"))
    return nodes.where("low < high OR low IS NOT NULL AND right").agg(F.count("*")).first()[0] == 0


def _stars(edges: DataFrame) -> DataFrame:
    """Distinct (a, b) for every node of edges (a, b) but the smallest of its component, which is b.

    Each task joins its own edges by union-find. What it leaves is dealt out by the larger end, of
    which no task has more than one edge, and joined again. Then every node is hung under what its
    smaller neighbour hangs under, and edges are dealt out and joined again, until all hang directly
    under the smallest of their component. A node with many larger neighbours meets them in a join only.
    """
    edges = edges.select("a", "b").where("a <> b").mapInArrow(_forest, EDGE)
    while True:
        stars = settle(edges.repartition("a").mapInArrow(_forest, EDGE), "edges")
        if _are_stars(stars):
            return settle(stars.distinct(), "stars")
        above = stars.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("low"))
        edges = stars.join(above, "b", "left").select("a", F.coalesce("low", "b").alias("b"))


def _rooted(stars: DataFrame) -> DataFrame:
    """Every node of stars (a, b) with its component, the smallest nodes too."""
    roots = stars.select(F.col("b").alias("item"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("item"), F.col("b").alias("component")).union(roots)


def connected(edges: DataFrame) -> DataFrame:
    """(item, component) of every node of edges (a, b): component is the smallest node reachable."""
    return _rooted(_stars(edges))


#: Rounds in which leftover members of a group are compared with one of its main component.
ROUNDS = 2
#: 64-bit words of a sketch; larger sets need more of them to be told apart.
WORDS = 8
#: An item's lowest groups, by which a pair is known to meet in another group first.
LOWEST = 16


def sketches(hashes: np.ndarray, counts: np.ndarray, words: int = WORDS) -> np.ndarray:
    """(sets, words): of each of 64 * words bits, whether an odd number of a set's hashes falls on it.

    The sketches of two sets differ in at most as many bits as the sets in members.
    """
    size = 64 * words
    cell = np.repeat(np.arange(len(counts)) * size, counts) + ((hashes >> np.uint64(20)) % np.uint64(size)).astype(np.int64)
    odd = np.bincount(cell, minlength=len(counts) * size) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8").reshape(len(counts), words)


def lists(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix of numbers as a list column."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]),
                                    pa.array(rows.ravel()))


def _merge(found: DataFrame, links: DataFrame) -> DataFrame:
    """Stars (item, c) after further links (a, b) between their items or new ones."""
    of = {c: found.select(F.col("item").alias(c), F.col("c").alias(f"c_{c}")) for c in "ab"}
    between = links.join(of["a"], "a", "left").join(of["b"], "b", "left").select(
        F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    joined = _stars(between).select(F.col("a").alias("c"), F.col("b").alias("component"))
    inside = found.join(joined, "c", "left").select("item", F.coalesce("component", "c").alias("c"))
    # What was a component's smallest item, or had no link, is no item of `found`.
    return settle(inside.union(joined.select("c", "component")), "components")


def _differ(bits: str, other: str, words: int) -> Column:
    """In how many bits two sketches differ."""
    if words > WORDS:
        # A sum of so many terms is more than the JVM compiles.
        each = F.zip_with(bits, other, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        return F.aggregate(each, F.lit(0), lambda total, x: total + x)
    return reduce(Column.__add__, (F.bit_count(F.col(bits)[k].bitwiseXOR(F.col(other)[k])) for k in range(words)))


def _allowed(pairs: DataFrame, sketched: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b, both) whose sketches allow a similarity, `both` being the sum of their sizes."""
    of = {c: sketched.select(F.col("item").alias(c), F.col("bits").alias(f"{c}_bits")) for c in "ab"}
    return pairs.join(of["a"], "a").join(of["b"], "b").where(
        7 * _differ("a_bits", "b_bits", words) <= F.col("both")).select("a", "b")


def similar(groups: DataFrame, links_of: Callable[[DataFrame], DataFrame], ratio: float,
            sketched: DataFrame | None = None, words: int = WORDS) -> DataFrame:
    """Components (item, component) of items under a similarity that only items with a common
    group can have. Items without a link may be missing.

    `groups` holds (group, item, n, first): distinct members of every group with
    their sizes, of which similar ones differ by no more than `ratio`. `links_of`
    turns candidate pairs (a, b), a < b, into the similar ones. `sketched` (item,
    bits, lowest) are `sketches` of sets that are similar from a Jaccard similarity of
    0.75 on, and may differ in a seventh of their members, and the `LOWEST` lowest
    groups of each item in ascending order.

    Where groups are members of the sets, put into one order, `groups` also holds how many of
    the item's own come `before` the group; `lowest` is not needed then. Similar sets meet in
    the first member they have in common, and hold all others behind it: both have to be long
    enough from there on. Items that no other of their group is small enough for leave it, and
    of the pairs left in the end only those are looked at that the group may be the first of.

    Only pairs whose sketches allow it are compared, which never miss a similar one.
    Each group of the `first` kind is compared with its smallest member, which
    joins most copies without looking at all their pairs. A group that lies in
    one component is then done. In the others, `ROUNDS` times, members outside
    the group's main component are compared with one of that; then those left
    with all members of other components. So no link between components is missed. A pair
    that meets in several groups is taken in the lowest of them: of both lists of
    lowest groups, none lower than that one is in both.
    """
    ordered = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    both = (F.col("n") + F.col("other_n")).alias("both")
    sized = F.least("n", "other_n") >= ratio * F.greatest("n", "other_n")
    placed = "before" in groups.columns
    first = groups.where("first")
    # The item with the fewest members that few others have is the likeliest to be what the others are copies of.
    hub = F.min_by(F.struct("item", "n"), F.struct(F.col("before") / F.col("n"), "item")) if placed else F.min(F.struct("item", "n"))
    hubs = first.groupBy("group").agg(hub.alias("hub"), F.count("*").alias("members"))
    stars = first.join(hubs.where("members > 1"), "group").select(
        F.col("item").alias("a"), F.col("hub.item").alias("b"), "n", F.col("hub.n").alias("other_n"))
    pairs = stars.where(sized & (F.col("a") != F.col("b"))).select(*ordered, both).distinct()
    pairs = settle(pairs.select("a", "b") if sketched is None else _allowed(pairs, sketched, words), "pairs")
    # A component's smallest item, like one without a link, is not listed: it is its own component.
    found = _stars(links_of(pairs)).select(F.col("a").alias("item"), F.col("b").alias("c"))
    tested, mixed = pairs, groups.drop("first")
    for round_ in range(ROUNDS + 1):
        mixed = _mixed(mixed.drop("c", "main"), found)
        if sketched is not None and round_ == (ROUNDS if placed else 0):
            # Most groups are done by now.
            mixed = mixed.join(sketched, "item")
        mixed = settle(mixed, "mixed")
        if mixed.isEmpty():
            break
        left = mixed.where("c <> main").withColumnRenamed("item", "a")
        right = mixed
        if round_ < ROUNDS:
            order = F.xxhash64("item", "group", F.lit(round_))
            one = F.min_by(F.struct(*(x for x in mixed.columns if x != "group")), order)
            right = mixed.where("c = main").groupBy("group").agg(one.alias("one")).select("group", "one.*")
        others = {"item": "b", "n": "other_n", "c": "other_c", "before": "other_before", "bits": "other_bits", "lowest": "other_lowest"}
        right = right.select("group", *(F.col(x).alias(y) for x, y in others.items() if x in right.columns))
        # Of two members outside the main component, the pair is taken once.
        near = sized & (F.col("c") != F.col("other_c")) & (
            (F.col("other_c") == F.col("main")) | (F.col("a") < F.col("b")))
        if placed and round_ == ROUNDS:
            near = near & _long_enough("n", "before", "other_n") & _long_enough("other_n", "other_before", "n")
        if "bits" in mixed.columns:
            near = near & (7 * _differ("bits", "other_bits", words) <= F.col("n") + F.col("other_n"))
            if round_ == ROUNDS and not placed:
                lower = F.array_min(F.array_intersect("lowest", "other_lowest")) < F.col("group")
                near = near & ~F.coalesce(lower, F.lit(False))
        new = left.join(right, "group").where(near)
        if sketched is not None and "bits" not in mixed.columns:
            # A pair meets in many groups, its sketches once.
            new = _allowed(new.select(*ordered, both).distinct(), sketched, words)
        else:
            new = new.select(*ordered).distinct()
        if round_ == ROUNDS:
            # One of the main component is seldom met twice; now all pairs that are left come.
            new = new.join(tested, ["a", "b"], "left_anti")
        new = settle(new, "pairs")
        if new.isEmpty():
            continue
        found = _merge(found, links_of(new))
        tested = tested.union(new)
    return _rooted(found.select(F.col("item").alias("a"), F.col("c").alias("b")))


def _long_enough(n: str, before: str, other_n: str) -> Column:
    """Whether a set of n members holds as many from the one after its first `before` on as it would share with a similar set."""
    return 3 * (F.col(n) + F.col(other_n)) <= 7 * (F.col(n) - F.col(before))


def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members of groups of several components, with their component `c` and the one that
    most members of their group have, `main`. Where groups have a place in their items' order,
    members leave a group whose smallest items are too large for them."""
    placed = settle(members.join(found, "item", "left").withColumn("c", F.coalesce("c", "item")), "placed")
    # Of two similar sets the smaller one meets the other in the first seventh of its members.
    ordered = "before" in members.columns
    least = [F.min(F.when(_long_enough("n", "before", "n"), F.col("n"))).alias("least")] if ordered else []
    sizes = placed.groupBy("group", "c").agg(F.count("*").alias("size"), *least)
    main = sizes.groupBy("group").agg(F.max_by("c", F.struct("size", "c")).alias("main"), F.count("*").alias("parts"),
                                      *[F.min("least").alias("least")] * ordered)
    mixed = placed.join(main.where("parts > 1").drop("parts"), "group")
    return mixed.where(_long_enough("n", "before", "least")).drop("least") if ordered else mixed
