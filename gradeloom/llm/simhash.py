"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints are sorted by their rank in the Gray code, which puts fingerprints with long shared bit
patterns side by side. Neighbours form groups; a node holds the bits that its whole group shares, less
those that the nodes above it hold already. A search goes down from the top, adds up the differences
to the shared bits and leaves a group when they exceed the distance.

The upper nodes stand for groups of neighbours of bounded size, the lower ones are built in the tasks. As long as
groups are few, all tasks hold their nodes; beyond that they hold those of partitions of the order, and whoever is
let into a partition is passed on to its groups there. Two fingerprints within distance d differ in d // 2 bits at most in the upper or in the lower half, so the
index is built twice, over the fingerprints and over their halves swapped, and each search stops at
d // 2 differences in the upper half. That leaves few groups to look into.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.components import components
from gradeloom.llm.shared import in_order, keep

FANOUT = 8
GROUPS = 4096  # upper nodes at most that all tasks hold
GROUP_SIZE = 4096  # fingerprints of a group at most
VISITORS = 65_536  # searches that enter a group, or a partition of the order, in one task
FRONTIER = 1 << 17  # pairs of searches and nodes that go down a level at once
BLOCK = 65_536


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Majority of the bits of the shingles' XXH64, repeats counted; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z, and ASCII white space
    n = max(0, len(words) - shingle + 1) or min(1, len(words))
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, n, BLOCK):
        part = words[start : min(n, start + BLOCK) + shingle - 1]
        grams = zip(*(part[i:] for i in range(shingle))) if len(part) >= shingle else [part]
        hashes = [xxhash.xxh64_intdigest(b" ".join(gram), seed) for gram in grams]
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of each row; no shuffle."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in batch["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": fps.view(np.int64)})

    source = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return source.mapInPandas(run, f"doc_id {kind}, fp long")


def gray_rank(x: Column) -> Column:
    """Place of a 64-bit pattern in the Gray code, shifted so that signed order is the order of places."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, shift))
    return x.bitwiseXOR(F.lit(-(2**63)))


def swapped(x: Column) -> Column:
    return F.shiftleft(x, 32).bitwiseOR(F.shiftrightunsigned(x, 32))


class GrayTree:
    """Nodes over leaves in Gray order. A leaf is a pattern under a mask: one fingerprint, or a group."""

    def __init__(self, masks: np.ndarray, patterns: np.ndarray):
        levels = [(masks, patterns)]
        while len(levels[-1][0]) > FANOUT:
            mask, pattern = levels[-1]
            first = np.arange(0, len(mask), FANOUT)
            ones, any_ = np.bitwise_and.reduceat(pattern, first), np.bitwise_or.reduceat(pattern, first)
            shared = np.bitwise_and.reduceat(mask, first) & ~(ones ^ any_)
            levels.append((shared, ones & shared))
        self.levels = levels[::-1]
        #: Bits that a node adds to those of the node above it.
        self.own = [self.levels[0][0]]
        for (above, _), (mask, _) in zip(self.levels, self.levels[1:]):
            self.own.append(mask & ~np.repeat(above, FANOUT)[: len(mask)])

    def uniform(self, labels: np.ndarray) -> list[np.ndarray]:
        """Of each node the label that all leaves below it have, else -1."""
        low, high, out = labels, labels, [labels]
        for _ in self.levels[1:]:
            first = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
            out.append(np.where(low == high, low, -1))
        return out[::-1]

    def search(self, queries: np.ndarray, distance: int, upper: int, labels=None, uniform=None):
        """Pairs (query, leaf) within the distance, in blocks of two arrays. Given labels of the
        queries, nodes whose leaves all have the query's label are left out."""
        todo = [(0, np.repeat(np.arange(len(queries)), len(self.own[0])), np.tile(np.arange(len(self.own[0])), len(queries)), None, None)]
        while todo:
            level, q, node, total, high = todo.pop()
            if len(q) > FRONTIER:
                half = len(q) // 2
                todo.append((level, q[half:], node[half:], *(x if x is None else x[half:] for x in (total, high))))
                q, node, total, high = q[:half], node[:half], *(x if x is None else x[:half] for x in (total, high))
                todo.append((level, q, node, total, high))
                continue
            if uniform is not None:
                new = uniform[level][node] != labels[q]
                q, node, total, high = q[new], node[new], *(x if x is None else x[new] for x in (total, high))
            unlike = (queries[q] ^ self.levels[level][1][node]) & self.own[level][node]
            here, there = np.bitwise_count(unlike).astype(np.uint8), np.bitwise_count(unlike >> np.uint64(32)).astype(np.uint8)
            total, high = (here, there) if total is None else (total + here, high + there)
            near = (total <= distance) & (high <= upper)
            q, node, total, high = q[near], node[near], total[near], high[near]
            if level == len(self.levels) - 1:
                yield q, node
                continue
            size = len(self.own[level + 1])
            child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            there = child < size
            todo.append((level + 1, np.repeat(q, FANOUT)[there], child[there], np.repeat(total, FANOUT)[there], np.repeat(high, FANOUT)[there]))


def _joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the elements a and b were joined pairwise: the least label of each set."""
    pairs = np.stack([labels[a], labels[b]])
    pairs = np.unique(pairs[:, pairs[0] != pairs[1]], axis=1)
    if pairs.shape[1] == 0:
        return labels
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    for x, y in pairs.T.tolist():
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    new = np.arange(len(labels))
    for x in parent:
        new[x] = root(x)
    return new[labels]


def stars(members: np.ndarray, visitors: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join what the links of the members (in Gray order) among each other and with the
    visitors connect: from an element to the least element of its set."""
    tree = GrayTree(np.full(len(members), ~np.uint64(0)), members)
    everyone = np.concatenate([members, visitors])
    labels, start, step, block = np.arange(len(everyone)), 0, 0, 256
    uniform, again = tree.uniform(labels[: len(members)]), 1
    while start < len(everyone):
        some = np.arange(start, min(start + block, len(everyone)))
        for q, leaf in tree.search(everyone[some], distance, distance // 2, labels[some], uniform):
            labels = _joined(labels, some[q], leaf)
        start, step = start + block, step + 1
        if step == again:  # sets that have grown together are passed over from now on
            uniform, again, block = tree.uniform(labels[: len(members)]), again * 2, min(block * 2, 4096)
        else:
            # Labels only merge: an older label of a node stands for the set it has gone into.
            uniform = [np.where(u >= 0, labels[u], -1) for u in uniform]
    moved = np.flatnonzero(labels != np.arange(len(labels)))
    return everyone[moved], everyone[labels[moved]]


def grouped(seen: DataFrame, n: int) -> DataFrame:
    """v and g of the `n` patterns v: groups that follow the Gray order, GROUP_SIZE in each at most. A group's
    number is that of its partition of the order, GROUPS of them at most, and in the lower half its place there."""
    parts = min(GROUPS, max(1, -(-n // GROUP_SIZE)))
    placed = in_order(seen, [gray_rank(F.col("v"))], parts).withColumn("at", F.monotonically_increasing_id())
    within = F.floor(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) / GROUP_SIZE).cast("long")
    return keep(placed.select("v", F.shiftleft(F.shiftright("at", 33), 32).bitwiseOR(within).alias("g")))


def _tree(nodes) -> tuple[np.ndarray, GrayTree]:
    """The numbers of nodes, in order, and the tree over what the patterns of each have in common."""
    ids, ones, any_ = (np.array(x, dtype=np.int64) for x in zip(*sorted(nodes)))
    shared = ~(ones ^ any_).view(np.uint64)
    return ids, GrayTree(shared, ones.view(np.uint64) & shared)


def _shared_bits(of: DataFrame, by: str) -> DataFrame:
    return of.groupBy(by).agg(F.expr("bit_and(a)").alias("a"), F.expr("bit_or(o)").alias("o"))


def _in_rooms(inside: DataFrame, visitors: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    """Both with a column `room`: visitors of one `by` are dealt over rooms of about VISITORS, and what is inside is in each."""
    rooms = visitors.groupBy(by).agg(F.ceil(F.count("*") / VISITORS).cast("int").alias("rooms")).where("rooms > 1")
    rooms = keep(rooms)
    count = F.coalesce(F.col("rooms"), F.lit(1))
    here = inside.join(rooms, by, "left").withColumn("room", F.explode(F.sequence(F.lit(0), count - 1))).drop("rooms")
    there = visitors.join(rooms, by, "left").withColumn("room", F.pmod(F.xxhash64("v"), count).cast("int")).drop("rooms")
    return here, there


def visits(members: DataFrame, distance: int) -> DataFrame:
    """g and v: the groups before its own in which a pattern v may have near ones, told by what all of a group share."""
    nodes = keep(_shared_bits(members.select("g", F.col("v").alias("a"), F.col("v").alias("o")), "g"))
    few = nodes.count() <= GROUPS
    part = F.shiftright("g", 32)
    tops = nodes if few else _shared_bits(nodes.withColumn("p", part), "p")
    held = _tree([tuple(r) for r in tops.collect()])  # GROUPS rows at most

    def enter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, tree = held
        for batch in batches:
            v, own = batch["v"].to_numpy().astype(np.int64), batch["g"].to_numpy().astype(np.int64)
            for q, leaf in tree.search(v.view(np.uint64), distance, distance // 2):
                # A pair of groups meets once, in the first of them; one partition may hold both.
                other = ids[leaf] < own[q] if few else ids[leaf] <= own[q] >> 32
                yield pd.DataFrame({"to": ids[leaf][other], "v": v[q][other], "own": own[q][other]})

    entered = members.select("g", "v").mapInPandas(enter, "to long, v long, own long")
    if few:
        return entered.select(F.col("to").alias("g"), "v")
    here, there = _in_rooms(nodes.withColumn("to", part), keep(entered), "to")

    def pass_on(inside: pd.DataFrame, visitors: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"g": np.empty(0, np.int64), "v": np.empty(0, np.int64)})]
        if len(inside) and len(visitors):
            ids, tree = _tree(zip(inside["g"], inside["a"], inside["o"]))
            v, own = visitors["v"].to_numpy().astype(np.int64), visitors["own"].to_numpy()
            for q, leaf in tree.search(v.view(np.uint64), distance, distance // 2):
                other = ids[leaf] < own[q]
                out.append(pd.DataFrame({"g": ids[leaf][other], "v": v[q][other]}))
        return pd.concat(out)

    return here.groupBy("to", "room").cogroup(there.groupBy("to", "room")).applyInPandas(pass_on, "g long, v long")


def similar_edges(fps: DataFrame, distance: int = 3) -> DataFrame:
    """Edges (u, v) that connect the fingerprints (fp, all different) as the links of all pairs
    within `distance` do. At most one edge per fingerprint and task comes out, not all pairs."""
    n, out = fps.count(), None
    if n == 0:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v"))
    for view in (lambda x: x, swapped):
        members = grouped(fps.select(view(F.col("fp")).alias("v")), n)
        here, there = _in_rooms(members, keep(visits(members, distance)), "g")
        here, there = here.select("g", "room", "v", F.lit(True).alias("member")), there.select("g", "room", "v", F.lit(False).alias("member"))

        def link(group: pd.DataFrame) -> pd.DataFrame:
            v, member = group["v"].to_numpy().astype(np.int64).view(np.uint64), group["member"].to_numpy(dtype=bool)
            own = v[member]
            rank = own.copy()
            for shift in (1, 2, 4, 8, 16, 32):
                rank ^= rank >> np.uint64(shift)
            u, w = stars(own[np.argsort(rank, kind="stable")], v[~member], distance)
            return pd.DataFrame({"u": u.view(np.int64), "v": w.view(np.int64)})

        met = here.union(there).groupBy("g", "room").applyInPandas(link, "u long, v long")
        met = met.select(view(F.col("u")).alias("u"), view(F.col("v")).alias("v"))
        out = met if out is None else out.union(met)
    return out


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp (signed long) and component_id of each row: the least doc_id among the rows whose
    fingerprints are connected by links of `distance` or fewer different bits.

    Texts that are null or have no words have fingerprint 0, which links like any other. Texts of
    fewer words than a shingle are one shingle; texts of any length are taken whole, in blocks of shingles. Equal
    fingerprints are folded before they are compared. An empty table has no rows; other columns are not looked at.
    Repeated rows have one component; a null doc_id is nobody's component as long as there is another.
    """
    rows = keep(fingerprints(df, key, text, shingle, seed))
    folded = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(similar_edges(folded.select("fp"), distance))
    sets = folded.join(found, folded["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("set"))
    sets = keep(sets)
    least = keep(sets.groupBy("set").agg(F.min("least").alias("component_id")))
    named = keep(sets.join(least, "set").select("fp", "component_id"))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")
