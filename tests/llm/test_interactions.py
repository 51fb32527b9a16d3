"""The audit of filters against applying them one after the other, in every order."""

from itertools import permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

from gradeloom.llm import interactions as I

LABELS = "doc_id long, quality int, toxic int"
DOCS = "doc_id long, text string, lang string"


def test_orders_are_lexicographic():
    assert I.orders("ABCDE") == ["".join(p) for p in permutations("ABCDE")]


@pytest.mark.parametrize("n", [1, 3, 5])
def test_intervals_say_where_each_mask_goes(n):
    names, got = "ABCDE"[:n], {}
    for mask, step, start, end in I.intervals(n):
        for rank in range(start, end):
            assert (mask, rank) not in got
            got[mask, rank] = step
    for mask in range(1, 1 << n):
        for rank, order in enumerate(I.orders(names)):
            assert got[mask, rank] == next(i for i, f in enumerate(order, 1) if mask >> names.index(f) & 1)
    assert len(got) == ((1 << n) - 1) * factorial(n)
    with pytest.raises(ValueError):
        I.intervals(8)


def applied(documents, labels, names):
    """documents: (id, part, set of failed filters). All rows of the audit, by applying the filters."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    out, whole = [], {}
    for part in sorted({p for _, p, _ in documents}):
        docs = [(i, fails) for i, p, fails in documents if p == part]
        for order in ("".join(p) for p in permutations(names)):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                late = sum(f in fails for _, fails in docs) - len(gone)
                left = [d for d in left if f not in d[1]]
                whole[part, f] = whole.get((part, f), 0) + len(gone)
                out.append([part, order, step, len(left), len(gone), late, sum(fails == {f} for _, fails in docs), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), f])
    return sorted((*row[:-1], whole[row[0], row[-1]]) for row in out)


def plain_fails(text, words):
    return {
        *("A" if len(words) < 100 else ""),
        *("B" if 100 * len(set(words)) < 80 * len(words) else ""),
        *("C" if 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text) else ""),
        *("D" if any(c in "#$%&*|" for c in text) else ""),
    }


def test_against_applying_them(spark):
    unlike = " ".join(f"w{i}" for i in range(120))
    texts = [None, "", " \t\n", unlike, unlike, "a " * 150, "ABC def", "x | y", unlike + " #", unlike.upper(), "\x0bone\x0ctwo\x1cthree", unlike, "é É", "long " * 30_000]
    rows = [(i, t, ("en", "de", None, "")[i % 4]) for i, t in enumerate(texts)] + [(3, unlike, "en"), (None, unlike, "en"), (None, None, None), (7, "z" * 5, "fr"), (20, "ABC def", "fr")]
    labels = [(3, 1, 0), (3, 0, 1), (4, 1, 1), (None, 1, 1), (6, 0, None), (99, 1, 1), (20, 1, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"key": F.lit(1), "mask": F.lit(2), "first": F.lit(True), "quality": F.lit(1), "part": F.lit("x")})
    split = str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})
    seen = []
    for i, t, lang in rows:
        text = t or ""
        words = [w for w in text.translate(split).split(" ") if w]
        copied = i is not None and any((u or "") == text and j is not None and j < i for j, u, _ in rows)
        seen.append((i, lang or "", plain_fails(text, words) | ({"E"} if copied else set())))
    labels_df = spark.createDataFrame(labels, LABELS)
    got = I.audit(I.document_masks(docs, labels_df))
    assert got.columns == "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    want = applied([(i, p, f) for i, p, f in seen], [x for x in labels if x[0] is not None], "ABCDE")
    assert sorted(map(tuple, got.collect())) == want
    assert len(want) == 600 * len({p for _, p, _ in seen})


def test_empty_and_own_filters(spark):
    none = spark.createDataFrame([], DOCS)
    assert I.audit(I.document_masks(none, spark.createDataFrame([], LABELS))).count() == 0
    masks = spark.createDataFrame([("p", 0, 4, 1, 0), ("p", 3, 2, 2, 1), ("p", 3, 1, 0, 0), ("p", 2, 5, 0, 5)], "part string, mask int, n long, good long, toxic long")
    got = {(r["filter_order"], r["step"]): r for r in I.audit(masks, "XY").collect()}
    assert [got["XY", 1]["removed"], got["XY", 2]["removed"], got["YX", 1]["removed"], got["YX", 2]["removed"]] == [3, 5, 8, 0]
    assert got["YX", 2]["redundant"] == 3 and got["XY", 2]["kept"] == 4 and got["YX", 1]["shapley"] == 13
    with pytest.raises(ValueError):
        I.audit(masks, "XX")
