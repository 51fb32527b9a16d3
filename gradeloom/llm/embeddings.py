"""Near-duplicate embeddings by NN-descent.

Every vector holds a short list of its nearest neighbours so far. Lists start from random projection
trees and are refined: vectors that have a neighbour in common are compared, and whoever is nearer
than the worst of a list goes into it. Lists and comparisons take vectors of length 1 in single precision; the links
are then checked in double precision. A list that is full of links may hide more of them: where that is so, the
list is enlarged to all of the vector's component and to the full lists of the label's other components. That goes by
blocks of vectors that lie together: two blocks whose balls are too far apart, or so near that all their vectors
link, are settled by their centres, and only the others are compared vector by vector. Components that turn out to
link become one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.components import components
from gradeloom.llm.shared import in_order, keep, numbered

PAIRS = "rid long, pairs array<struct<sim: float, nbr: long>>"
SPACE = ["label", "dim"]
BLOCK = 512  # vectors on a side of a block of full comparisons


@dataclass(frozen=True)
class Descent:
    neighbours: int = 10
    trees: int = 5
    leaf: int = 64  # vectors compared with each other at once
    rounds: int = 12  # at most; an audit tells what is missing then
    changed: float = 0.001  # share of list entries whose change still calls for a round
    slack: float = 1e-4  # of cosine, for what single precision loses
    seed: int = 42


def runs(batches: Iterator[pd.DataFrame], keys: list[str], size: int) -> Iterator[pd.DataFrame]:
    """Blocks of at most `size` rows that follow each other and agree in `keys`."""
    held = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        if len(rows) == 0:
            continue
        new = (rows[keys] != rows[keys].shift()).any(axis=1).to_numpy()
        starts = np.flatnonzero(new)
        edges = [e for a, b in zip(starts, [*starts[1:], len(rows)]) for e in range(a, b, size)]
        for a, b in zip(edges, edges[1:]):
            yield rows.iloc[a:b]
        held = rows.iloc[edges[-1] :]
    if held is not None:
        yield held


def _matrix(column: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=kind).reshape(len(column), -1)


def _cosines(block: pd.DataFrame) -> np.ndarray:
    """Cosines of the vectors with each other, -2 of a vector with itself."""
    unit = _matrix(block["unit"], np.float32)
    sims = unit @ unit.T
    rid = block["rid"].to_numpy()
    sims[rid[:, None] == rid[None, :]] = -2
    return sims


def _best(block: pd.DataFrame, k: int, worst: np.ndarray | None = None) -> pd.DataFrame:
    """For each vector of a block the k nearest others that beat its worst neighbour so far."""
    sims, rid = _cosines(block), block["rid"].to_numpy()
    k = min(k, len(rid) - 1)
    if k < 1:
        return pd.DataFrame(columns=["rid", "pairs"], dtype=object)
    at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    best = np.take_along_axis(sims, at, axis=1)
    good = best > (-1.5 if worst is None else worst[:, None])
    rows = [(r, [(float(s), int(rid[j])) for s, j, g in zip(best[i], at[i], good[i]) if g]) for i, r in enumerate(rid) if good[i].any()]
    return pd.DataFrame(rows, columns=["rid", "pairs"], dtype=object)


def prepared(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """vec_id, label, dim, raw (doubles) of each row; raw is null for vectors that link with nothing."""

    @F.pandas_udf("binary")
    def doubles(column: pd.Series) -> pd.Series:
        out = []
        for v in column:
            a = None if v is None else np.array([np.nan if x is None else x for x in v], dtype=np.float64)
            good = a is not None and a.size > 0 and np.isfinite(a).all() and 0 < np.dot(a, a) < np.inf
            out.append((a + 0.0).tobytes() if good else None)
        return pd.Series(out, dtype=object)

    rows = df.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), doubles(F.col(vector)).alias("raw"))
    rows = rows.withColumn("raw", F.when(F.col("label").isNotNull(), F.col("raw")))
    return rows.withColumn("dim", F.octet_length("raw") / 8)


def _units(nodes: DataFrame) -> DataFrame:
    @F.pandas_udf("binary")
    def unit(raw: pd.Series) -> pd.Series:
        vectors = (np.frombuffer(r) for r in raw)
        return pd.Series([(v / np.sqrt(np.dot(v, v))).astype(np.float32).tobytes() for v in vectors], dtype=object)

    return nodes.select("rid", *SPACE, unit(F.col("raw")).alias("unit"))


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """One list of the k nearest per vector. Lists come from many blocks, so they are cut down twice."""
    best = lambda: F.slice(F.reverse(F.array_sort(F.array_distinct(F.flatten(F.collect_list("pairs"))))), 1, k)
    some = lists.withColumn("salt", F.pmod(F.xxhash64("pairs"), F.lit(16))).groupBy("rid", "salt").agg(best().alias("pairs"))
    return some.groupBy("rid").agg(best().alias("pairs"))


def _sides(vectors: Iterator[np.ndarray], seed: int, tree: int) -> pd.Series:
    """The sides of 48 random planes that each vector is on, as bits."""
    planes, codes = {}, []
    for x in vectors:
        if len(x) not in planes:
            planes[len(x)] = np.random.default_rng([seed, tree, len(x)]).normal(size=(48, len(x)))
        codes.append(int("".join("1" if p > 0 else "0" for p in planes[len(x)] @ x), 2))
    return pd.Series(codes, dtype="int64")


def _side(seed: int, tree: int):
    @F.pandas_udf("long")
    def side(unit: pd.Series) -> pd.Series:
        return _sides((np.frombuffer(v, dtype=np.float32).astype(np.float64) for v in unit), seed, tree)

    return side


def _first_lists(small: DataFrame, s: Descent) -> DataFrame:
    """Lists from trees: vectors sorted by the sides of random planes they are on, in leaves of equal size."""

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in runs(batches, SPACE, s.leaf):
            yield _best(block, s.neighbours)

    out = None
    for tree in range(s.trees):
        coded = keep(small.withColumn("code", _side(s.seed, tree)("unit")))
        lists = in_order(coded, [*SPACE, "code", "rid"]).mapInPandas(leaves, PAIRS)
        out = lists if out is None else out.union(lists)
    return keep(_merged(out, s.neighbours))


def _refined(small: DataFrame, lists: DataFrame, s: Descent, turn: int) -> DataFrame:
    """Better neighbours for the lists: vectors that meet at a common neighbour, on either side of it. Where many
    do, they are dealt into blocks, and into others in each turn."""
    edges = lists.select("rid", F.explode("pairs.nbr").alias("nbr"))
    met = edges.select(F.col("nbr").alias("center"), "rid").union(edges.select(F.col("rid").alias("center"), F.col("nbr").alias("rid")))
    full = F.when(F.size("pairs") >= s.neighbours, F.element_at("pairs", -1)["sim"]).otherwise(F.lit(-1.5))
    info = keep(small.join(lists.select("rid", full.cast("float").alias("worst")), "rid", "left").select("rid", "unit", F.coalesce("worst", F.lit(-1.5).cast("float")).alias("worst")))
    members = keep(met.distinct()).join(info, "rid")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in runs(batches, ["center"], s.leaf):
            yield _best(block, s.neighbours, block["worst"].to_numpy())

    return keep(in_order(members, ["center", F.xxhash64("rid", F.lit(turn))]).mapInPandas(compare, PAIRS))


def neighbour_lists(nodes: DataFrame, s: Descent) -> DataFrame:
    """rid and pairs (similarity, neighbour; best first) of nodes rid, label, dim, raw."""
    small = keep(_units(nodes))
    lists, n = _first_lists(small, s), small.count()
    for turn in range(s.rounds):
        better = _refined(small, lists, s, turn)
        merged = keep(_merged(lists.union(better), s.neighbours))
        old = lists.select("rid", F.explode("pairs.nbr").alias("nbr"))
        new = merged.select("rid", F.explode("pairs.nbr").alias("nbr")).join(old, ["rid", "nbr"], "left_anti").count()
        lists = merged
        if new <= s.changed * n * s.neighbours:
            break
    return lists


def _linked(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) whose cosine in double precision is `threshold` or more."""

    @F.pandas_udf("double")
    def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x), np.frombuffer(y)
            out.append(np.dot(x, y) / (np.sqrt(np.dot(x, x)) * np.sqrt(np.dot(y, y))))
        return pd.Series(out, dtype="float64")

    left, right = (nodes.select(F.col("rid").alias(c), F.col("raw").alias(f"raw_{c}")) for c in "uv")
    found = pairs.join(left, "u").join(right, "v").withColumn("cos", cosine("raw_u", "raw_v"))
    return keep(found.where(F.col("cos") >= threshold).select("u", "v"))


def _blocks(sets: DataFrame, nodes: DataFrame, order: list[str], own: str) -> tuple[DataFrame, DataFrame]:
    """The nodes of sets (rid, set and the columns of `order`) in blocks b of a set, and these blocks: the centre
    and the radius of a ball that holds the block, the copies in it, and its least and largest `own`."""
    @F.pandas_udf("long")
    def code(raw: pd.Series) -> pd.Series:
        return _sides(map(np.frombuffer, raw), 0, 0)  # so that vectors that lie together come together

    near = nodes.select("rid", "raw", "copies").withColumn("code", code("raw"))
    placed, _ = numbered(sets.join(near.select("rid", "code"), "rid"), ["set", *order[:-1], "code", order[-1]], "place")
    placed = keep(placed)
    first = keep(placed.groupBy("set").agg(F.min("place").alias("first")))
    block = ((F.col("place") - F.col("first")) / BLOCK).cast("int")
    of = placed.join(first, "set").select("set", *order, block.alias("b"))
    members = keep(of.join(near.drop("code"), "rid").withColumn("own", F.col(own)))

    def ball(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        x = _unit_matrix(group["raw"])
        centre = x.mean(axis=0)
        centre = centre / length if (length := np.linalg.norm(centre)) > 1e-9 else x[0]
        radius = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
        return pd.DataFrame([(*key, centre.tobytes(), radius, group["copies"].sum(), group["own"].min(), group["own"].max())])

    made = "set long, b int, centre binary, radius double, weight long, low long, high long"
    return members, keep(members.groupBy("set", "b").applyInPandas(ball, made))


def _unit_matrix(column: pd.Series) -> np.ndarray:
    x = _matrix(column, np.float64)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


ALL, NONE, SOME = 1, 0, 2


def _meetings(blocks: DataFrame, threshold: float, across: bool) -> DataFrame:
    """Pairs (i, j) of blocks of a set, i <= j, and `kind`: all of their vectors link, or some may. Pairs that are
    too far apart are left out; with `across` so are those of one `own`, and pairs of mixed blocks
    are never settled as a whole."""
    widest = float(np.arccos(threshold))

    @F.pandas_udf("int")
    def kind(a: pd.Series, z: pd.Series, near: pd.Series) -> pd.Series:
        angles = np.array([np.arccos(np.clip(np.dot(np.frombuffer(x), np.frombuffer(y)), -1, 1)) for x, y in zip(a, z)])
        far = angles - near > widest + 1e-6
        inside = angles + near <= widest - 1e-6
        return pd.Series(np.where(far, NONE, np.where(inside, ALL, SOME)), dtype="int32")

    side = lambda n: blocks.select("set", F.col("b").alias(n), *[F.col(c).alias(f"{c}_{n}") for c in ("centre", "radius", "weight", "low", "high")])
    both = side("i").join(side("j"), "set").where("i <= j")  # one row for BLOCK * BLOCK pairs of vectors
    one = (F.col("low_i") == F.col("high_i")) & (F.col("low_j") == F.col("high_j"))
    if across:
        both = both.where(~(one & (F.col("low_i") == F.col("low_j"))))
    met = both.withColumn("kind", kind("centre_i", "centre_j", F.col("radius_i") + F.col("radius_j"))).where(F.col("kind") != NONE)
    if across:
        met = met.withColumn("kind", F.when(one, F.col("kind")).otherwise(SOME))
    return keep(met.select("set", "i", "j", "kind", "weight_i", "weight_j", "low_i", "low_j"))


def _to_compare(members: DataFrame, met: DataFrame) -> DataFrame:
    """The members of both blocks of the pairs that have to be compared."""
    some = met.where(F.col("kind") == SOME).select("set", "i", "j")
    left = members.join(some.withColumn("b", F.col("i")), ["set", "b"])
    right = members.join(some.where("i < j").withColumn("b", F.col("j")), ["set", "b"])
    return left.unionByName(right).groupBy("set", "i", "j")


def _settled(members: DataFrame, met: DataFrame) -> DataFrame:
    """rid and how many vectors it links with in blocks that are settled as a whole, itself not counted."""
    whole = met.where(F.col("kind") == ALL)
    sides = whole.select("set", F.col("i").alias("b"), F.col("weight_j").alias("w"), (F.col("i") == F.col("j")).alias("itself"))
    sides = sides.union(whole.where("i < j").select("set", "j", "weight_i", F.lit(False)))
    sums = sides.groupBy("set", "b").agg(F.sum("w").alias("w"), F.max("itself").alias("itself"))
    return members.join(sums, ["set", "b"]).select("rid", (F.col("w") - F.when(F.col("itself"), F.col("copies")).otherwise(0)).alias("n"))


def _near(group: pd.DataFrame, threshold: float) -> np.ndarray:
    """Which vectors of two blocks link; inside a block only if it came alone, so that a pair counts once."""
    x = _matrix(group["raw"], np.float64)
    norm, b = np.sqrt(np.einsum("ij,ij->i", x, x)), group["b"].to_numpy()
    near = (x @ x.T) / np.outer(norm, norm) >= threshold
    np.fill_diagonal(near, False)
    if group["i"].iloc[0] != group["j"].iloc[0]:
        near &= b[:, None] != b[None, :]
    return near


def _enlarged(sets: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """rid and n_linked within its set, for nodes (rid, set) of sets with full lists, block by block."""
    members, blocks = _blocks(sets, nodes, ["rid"], "set")
    met = _meetings(blocks, threshold, False)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"rid": group["rid"], "n": _near(group, threshold) @ group["copies"].to_numpy()})

    compared = _to_compare(members, met).applyInPandas(compare, "rid long, n long")
    return compared.union(_settled(members, met)).groupBy("rid").agg(F.sum("n").alias("n_linked"))


def _across(full: DataFrame, nodes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links between different sets, for nodes (rid, set) with full lists: rid and n_across (links to
    other sets), and the pairs (u, v) of sets that link.

    A pair that is in neither list has both lists full, so blocks of full lists of a label are
    held against each other. Labels whose full lists are of one set have no such pair."""
    spaced = keep(full.join(nodes.select("rid", *SPACE), "rid"))
    spaces = spaced.groupBy(*SPACE).agg(F.min("rid").alias("space"), F.min("set").alias("a"), F.max("set").alias("z"))
    sets = spaced.join(spaces.where("a < z"), SPACE).select(F.col("space").alias("set"), F.col("set").alias("own_set"), "rid")
    members, blocks = _blocks(sets, nodes, ["own_set", "rid"], "own_set")
    met = _meetings(blocks, threshold, True)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        own, code = np.unique(group["own"].to_numpy(), return_inverse=True)
        near = _near(group, threshold) & (code[:, None] != code[None, :])
        linked, at = near @ group["copies"].to_numpy(), np.argwhere(np.triu(near))
        pairs = np.unique(np.sort(code[at], axis=1), axis=0)
        some = linked > 0
        counts = pd.DataFrame({"u": group["rid"].to_numpy()[some], "v": linked[some], "of_sets": False})
        return pd.concat([counts, pd.DataFrame({"u": own[pairs[:, 0]], "v": own[pairs[:, 1]], "of_sets": True})])

    compared = keep(_to_compare(members, met).applyInPandas(compare, "u long, v long, of_sets boolean"))
    counts = compared.where("not of_sets").select(F.col("u").alias("rid"), F.col("v").alias("n")).union(_settled(members, met))
    ends = F.col("low_i"), F.col("low_j")
    bridges = met.where(F.col("kind") == ALL).select(F.least(*ends).alias("u"), F.greatest(*ends).alias("v"))
    bridges = compared.where("of_sets").select("u", "v").union(bridges).distinct()
    return counts.groupBy("rid").agg(F.sum("n").alias("n_across")), bridges


def near_links(
    df: DataFrame,
    threshold: float = 0.93,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    how: Descent = Descent(),
) -> DataFrame:
    """vec_id, n_links (other rows linked directly) and component_id (least vec_id reachable) per row.

    Rows link if their labels are equal and not null, their dimensions are equal, and their cosine is
    `threshold` or more. A vector that is null, empty, zero or holds null or non-finite components
    links with nothing. Equal vectors of a label are folded first and count as linked, so repeated rows link with
    each other; rows that share a vec_id are rows of their own, and a null vec_id is nobody's component as long as
    there is another. Neighbours that are equally near are told apart by a number of the vector's own; ties decide
    about lists, not about links. No pair below the threshold is linked; how many above it are found is
    measured by `audit`. An empty table has no rows. Columns other than the three are not looked at.
    """
    rows = keep(prepared(df, key, vector, label))
    valid = rows.where(F.col("raw").isNotNull())
    folded = valid.groupBy(*SPACE, "raw").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    nodes = keep(folded.withColumn("rid", F.monotonically_increasing_id()))
    lists = neighbour_lists(nodes, how)

    near = lists.select("rid", F.explode("pairs").alias("p")).where(F.col("p.sim") >= threshold - how.slack)
    ends = (F.col("rid"), F.col("p.nbr"))
    links = _linked(keep(near.select(F.least(*ends).alias("u"), F.greatest(*ends).alias("v")).distinct()), nodes, threshold)
    found = keep(components(links))
    named = nodes.join(found, nodes["rid"] == found["node"], "left").select("rid", "least", "copies", F.coalesce("component", "rid").alias("set"))
    named = keep(named)

    # A list in which every place is taken by a link may have had no room for further ones.
    full = lists.where((F.size("pairs") >= how.neighbours) & (F.element_at("pairs", -1)["sim"] >= threshold - how.slack)).select("rid")
    full = keep(named.join(full, "rid", "left_semi").select("rid", "set"))
    crowded = keep(full.select("set").distinct())
    enlarged = _enlarged(named.join(crowded, "set", "left_semi").select("set", "rid"), nodes, threshold)
    both = links.union(links.select("v", "u")).toDF("rid", "other").join(named.select(F.col("rid").alias("other"), "copies"), "other")
    listed = both.groupBy("rid").agg(F.sum("copies").alias("n_listed"))

    across, bridges = _across(full, nodes, threshold)
    merged = keep(components(bridges)).withColumnRenamed("node", "set")
    named = named.join(merged, "set", "left").withColumn("set", F.coalesce("component", "set")).drop("component")
    named = keep(named)

    least = keep(named.groupBy("set").agg(F.min("least").alias("component_id")))
    counted = named.join(keep(listed), "rid", "left").join(keep(enlarged), "rid", "left").join(keep(across), "rid", "left").join(least, "set")
    linked = F.coalesce("n_linked", "n_listed", F.lit(0)) + F.coalesce("n_across", F.lit(0)) + F.col("copies") - 1
    result = keep(counted.select("rid", linked.cast("long").alias("n_links"), "component_id"))
    of_vector = keep(nodes.join(result, "rid").select(*SPACE, "raw", "n_links", "component_id"))
    alone = rows.where(F.col("raw").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return valid.join(of_vector, [*SPACE, "raw"]).select("vec_id", "n_links", "component_id").union(alone)


def audit(df: DataFrame, found: DataFrame, every: int = 50, threshold: float = 0.93, key="vec_id", vector="embedding", label="label", block: int = 2048) -> DataFrame:
    """vec_id, n_links and n_true of the vectors whose id is divisible by `every`: brute force against
    all rows, the queries in blocks of bounded size. Recall is the sum of n_links over that of n_true."""
    rows = keep(prepared(df, key, vector, label))
    asked, n = numbered(rows.where((F.col("vec_id") % every == 0) & F.col("raw").isNotNull()), ["vec_id", "raw"], "place")
    asked, out = keep(asked), None
    for start in range(0, max(n, 1), block):
        part = asked.where(F.col("place").between(start, start + block - 1))
        held = df.sparkSession.sparkContext.broadcast([tuple(r) for r in part.select("vec_id", "label", "dim", "raw").collect()])

        def compare(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            spaces: dict[tuple, list] = {}
            for vec_id, lab, dim, raw in held.value:
                spaces.setdefault((lab, dim), []).append((vec_id, np.frombuffer(raw)))
            for batch in batches:
                for space, group in batch.groupby(SPACE):
                    if space in spaces:
                        x, y = _matrix(group["raw"], np.float64), np.stack([v for _, v in spaces[space]])
                        x, y = (m / np.sqrt(np.einsum("ij,ij->i", m, m))[:, None] for m in (x, y))
                        counts = (y @ x.T >= threshold).sum(axis=1)
                        yield pd.DataFrame({"vec_id": [v for v, _ in spaces[space]], "n": counts})

        kind = f"vec_id {df.schema[key].dataType.simpleString()}, n long"
        met = rows.where(F.col("raw").isNotNull()).select(*SPACE, "raw").mapInPandas(compare, kind)
        out = met if out is None else out.union(met)
    true = out.groupBy("vec_id").agg((F.sum("n") - 1).alias("n_true"))
    return true.join(found.select("vec_id", "n_links"), "vec_id")
