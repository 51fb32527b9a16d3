"""Audit of filters that interact: what each of them removes, in every order they can be applied in.

A document is known by its mask, the set of filters it fails. In an order of the filters it goes at the
first step whose filter is in its mask. Numbered by their Lehmer codes, the orders that begin alike lie
side by side, so the orders in which a mask goes at a given step are a few intervals of ranks. Counts are
added at the starts of these intervals and taken off at their ends, and a running sum over the ranks gives
what every order removes at every step. Only counts by mask depend on the number of documents.
"""

from __future__ import annotations

from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.shared import keep

MOST_FILTERS = 7  # 5040 orders
SPACES = r"[\x20\x09-\x0D]+"
COUNTS = ("n", "good", "toxic")


def orders(names: str) -> list[str]:
    """All orders of the filters, by rank: the one of rank r has r as its Lehmer code."""
    if len(names) <= 1:
        return [names]
    return [f + rest for i, f in enumerate(names) for rest in orders(names[:i] + names[i + 1 :])]


def intervals(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, start, end): in the orders of these ranks a document that fails the filters of
    `mask` (bit i for filter i) goes at `step`, from 1. Neighbouring intervals are one."""
    if not 1 <= n <= MOST_FILTERS:
        raise ValueError(f"between 1 and {MOST_FILTERS} filters can be audited")
    out = []
    for mask in range(1, 1 << n):
        found: list[list[int]] = []

        def walk(left: tuple[int, ...], start: int, mask: int = mask, found: list = found) -> None:
            width = factorial(len(left) - 1)
            for digit, f in enumerate(left):  # the next digit of the Lehmer code
                at = start + digit * width
                if mask >> f & 1:
                    found.append([n - len(left) + 1, at, at + width])
                else:
                    walk(left[:digit] + left[digit + 1 :], at)

        walk(tuple(range(n)), 0)
        merged: list[list[int]] = []
        for step, start, end in sorted(found):
            if merged and merged[-1][0] == step and merged[-1][2] == start:
                merged[-1][2] = end
            else:
                merged.append([step, start, end])
        out += [(mask, *x) for x in merged]
    return out


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text alone; null texts are empty ones.

    A: under 100 words. B: under 80 different words in 100. C: over 10 capitals A-Z in 100 characters.
    D: any of `#$%&*|`. Words are runs of anything but ASCII white space, compared as they are.
    """
    t = F.coalesce(text, F.lit(""))
    bare = F.regexp_replace(t, rf"^{SPACES}|{SPACES}$", "")
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACES))
    capitals = F.length(F.regexp_replace(t, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": capitals * 100 > F.length(t) * 10,
        "D": t.rlike(r"[#$%&*|]"),
    }


def mask_of(failures: list[Column]) -> Column:
    """Bit i is set if the i-th filter fails; what is null does not fail."""
    out = F.lit(0)
    for i, failed in enumerate(failures):
        out = out + F.when(failed, F.lit(1 << i)).otherwise(F.lit(0))
    return out


def document_masks(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """part, mask (of the filters ABCDE), n, good and toxic: the documents of a part by their masks, how
    many they are, and of how many a label says quality 1 or toxic 1.

    E fails a text that a smaller key has too, anywhere in the table. Texts are compared by their SHA-256.
    Only the first holders of texts are found by grouping; a row then looks for itself among them, so
    no group of copies comes together in one task. A row without a key has no smaller key, so it never
    fails E; it has no labels. Rows that share a key are documents of their own, and of several labels of a
    key one that says 1 is enough. A null part is the empty string.
    """
    failures = text_failures(F.col(text))
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    rows = keep(
        docs.select(
            F.col(key).alias("key"), F.coalesce(F.col(part), F.lit("")).alias("part"), digest.alias("digest"),
            mask_of(list(failures.values())).alias("own"),
        )
    )
    first = rows.groupBy("digest").agg(F.min("key").alias("key")).where(F.col("key").isNotNull()).withColumn("first", F.lit(True))
    says = lambda c: F.max((F.col(c) == 1).cast("int"))
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(says("quality").alias("q"), says("toxic").alias("t"))
    copied = F.col("key").isNotNull() & F.col("first").isNull()
    seen = rows.join(first, ["digest", "key"], "left").join(known, "key", "left")
    mask = F.col("own") + F.when(copied, F.lit(1 << len(failures))).otherwise(F.lit(0))
    return seen.groupBy("part", mask.alias("mask")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("q") == 1).alias("good"), F.count_if(F.col("t") == 1).alias("toxic")
    )


def audit(masks: DataFrame, names: str = "ABCDE") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: a
    row for each part, order of the filters and step, also where nothing is removed.

    `masks` has part, mask, n, good, toxic, any number of rows for a mask. After `step` filters `kept`
    documents are left; the filter of this step removed `removed` of them, of which `good_lost` and
    `toxic_lost` are labelled so; `redundant` fail it but had gone before; `unique_fails` fail it
    alone; `shapley` is what the filter removes in all orders together. Without documents there are no rows.
    All tables here have at most n! * n rows a part.
    """
    spark, n = masks.sparkSession, len(names)
    if len(set(names)) != n:
        raise ValueError("filters need different letters")
    table = keep(masks.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in COUNTS]))  # 2**n rows a part at most
    ranges = spark.createDataFrame(intervals(n), "mask int, step int, start int, `end` int")
    covered = table.join(F.broadcast(ranges), "mask")
    ends = F.array(F.struct(F.col("start").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("end").alias("rank"), F.lit(-1).alias("sign")))
    points = covered.select("part", "step", F.explode(ends).alias("p"), *COUNTS)
    added = points.groupBy("part", "step", F.col("p.rank").alias("rank")).agg(*[F.sum(F.col(c) * F.col("p.sign")).alias(c) for c in COUNTS])

    named = [(r, step + 1, order, order[step]) for r, order in enumerate(orders(names)) for step in range(n)]
    grid = spark.createDataFrame(named, "rank int, step int, filter_order string, filter string")
    parts = table.groupBy("part").agg(F.sum("n").alias("total"))
    ranked = parts.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(factorial(n) - 1))))
    cells = ranked.join(F.broadcast(grid), "rank").join(added, ["part", "step", "rank"], "left")  # n! * n rows a part
    along = Window.partitionBy("part", "step").orderBy("rank")  # n! rows
    sums = {c: F.sum(F.coalesce(F.col(c), F.lit(0))).over(along) for c in COUNTS}
    cells = cells.withColumns(sums)

    fails = table.select("part", "mask", "n", F.explode(F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(1 << i).alias("bit")) for i, f in enumerate(names)])).alias("f"))
    failing = F.col("mask").bitwiseAND(F.col("f.bit")) != 0
    fails = fails.groupBy("part", F.col("f.filter").alias("filter")).agg(
        F.sum(F.when(failing, F.col("n")).otherwise(0)).alias("fails"), F.sum(F.when(F.col("mask") == F.col("f.bit"), F.col("n")).otherwise(0)).alias("unique_fails")
    )
    gone = F.sum("n").over(Window.partitionBy("part", "rank").orderBy("step"))  # n rows
    whole = F.sum("n").over(Window.partitionBy("part", "filter"))  # n! rows
    out = cells.withColumns({"gone": gone, "shapley": whole}).join(fails, ["part", "filter"])
    return out.select(
        "part", "filter_order", "step", (F.col("total") - F.col("gone")).alias("kept"), F.col("n").alias("removed"),
        (F.col("fails") - F.col("n")).alias("redundant"), "unique_fails", F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"), "shapley",
    )
