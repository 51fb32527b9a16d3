"""Vector codes: every part of a vector becomes the index of the nearest entry of a small codebook.

The nearest entry is found by equal-average search. A part and an entry whose components sum up to
different values are at least (difference of the sums)^2 / dimension apart, so entries are sorted by
their sums, the search starts where the part's own sum belongs and goes outwards to both sides, and it ends once
that bound exceeds the best distance. All arithmetic is on whole numbers, so results are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.shared import keep

SALTS = 32  # tasks that the rows of one label are spread over at least
LIMIT = 1 << 28  # of a component times the width of a part: no sum of squared distances is beyond 64 bits then
NONE = 3_037_000_499  # gap of a side without entries: its square is the largest that 64 bits hold


@dataclass(frozen=True)
class Coding:
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096  # components become floor(scale * x)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of and squared distance to the nearest of the entries `book` (k, d) for each row of `x`
    (n, d), both whole numbers; of entries equally near the one of least index. And how many distances
    were worked out."""
    n, (k, d) = len(x), book.shape
    sums = book.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    by_sum, of = sums[order], x.sum(axis=1)
    right = np.searchsorted(by_sum, of)  # the next entries on either side
    left = right - 1
    best, index = np.full(n, np.iinfo(np.int64).max // d), np.full(n, k)
    todo, compared = np.arange(n), 0
    while len(todo):
        low, high, s = left[todo], right[todo], of[todo]
        down = np.where(low >= 0, s - by_sum[low], NONE)
        up = np.where(high < k, by_sum[np.minimum(high, k - 1)] - s, NONE)
        gap = np.minimum(down, up)
        near = gap * gap <= d * best[todo]  # an equal bound may still hide an entry of less index
        todo, lower = todo[near], (down <= up)[near]
        at = order[np.where(lower, left[todo], np.minimum(right[todo], k - 1))]
        distance = ((x[todo] - book[at]) ** 2).sum(axis=1)
        compared += len(todo)
        nearer = (distance < best[todo]) | (distance == best[todo]) & (at < index[todo])
        best[todo[nearer]], index[todo[nearer]] = distance[nearer], at[nearer]
        left[todo[lower]] -= 1
        right[todo[~lower]] += 1
    return index, best, compared


def whole_vectors(df: DataFrame, how: Coding, key: str, vector: str, label: str) -> DataFrame:
    """vec_id, label and v (whole numbers) of the rows whose vector has components, all known and finite.

    Raises where the job runs if vectors differ in length, if it is not a multiple of `parts`, or if a
    component is too large to be squared and summed in 64 bits.
    """
    v, x = F.col(vector), lambda c: c.cast("double")
    good = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(x(c)) & (F.abs(x(c)) < float("inf")))
    large = F.exists(v, lambda c: F.abs(x(c)) * how.scale * F.size(v) >= float(LIMIT * how.parts))
    wrong = F.raise_error(F.lit(f"a vector's length is no multiple of {how.parts}, or it has a component that is too large")).cast("array<long>")
    ints = F.transform(v, lambda c: F.floor(x(c) * how.scale).cast("long"))
    ints = F.when(large | (F.size(v) % how.parts != 0), wrong).otherwise(ints)
    return df.where(good).select(F.col(key).alias("vec_id"), F.col(label).alias("label"), ints.alias("v"))


def _parts(column: pa.Array, how: Coding, width: int) -> np.ndarray:
    """The vectors of a column as (rows, parts, width)."""
    lengths = column.value_lengths().to_numpy()
    if (lengths != how.parts * width).any():
        raise ValueError("vectors differ in length")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), how.parts, width)


def _moved(vectors: DataFrame, books: np.ndarray, how: Coding) -> np.ndarray:
    """The codebooks after a round: each entry is the mean, rounded down, of the parts nearest to it."""
    width = books.shape[2]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((how.parts, books.shape[1], width + 1), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _parts(batch.column("v"), how, width)
                for p in range(how.parts):
                    index, _, _ = nearest(x[:, p], books[p])
                    order = np.argsort(index, kind="stable")
                    used, first = np.unique(index[order], return_index=True)
                    total[p, used, :width] += np.add.reduceat(x[order, p], first, axis=0)
                    total[p, used, width] += np.diff([*first, len(order)])
        cells = np.flatnonzero(total.reshape(-1, width + 1)[:, width])
        yield pa.RecordBatch.from_pydict({"cell": cells, "sums": list(total.reshape(-1, width + 1)[cells])}, pa.schema([("cell", pa.int64()), ("sums", pa.list_(pa.int64()))]))

    met = vectors.select("v").mapInArrow(sums, "cell long, sums array<long>")
    # At most parts * entries * (width + 1) sums reach the driver, whatever the number of vectors.
    cells = met.select("cell", F.posexplode("sums").alias("place", "s")).groupBy("cell", "place").agg(F.sum(F.col("s").cast("decimal(20,0)")).alias("s"))
    found = {(r["cell"], r["place"]): int(r["s"]) for r in cells.collect()}
    moved = books.copy()
    for cell in {c for c, _ in found}:
        n = found[cell, width]
        moved[cell // books.shape[1], cell % books.shape[1]] = [found[cell, i] // n for i in range(width)]
    return moved


def fit(vectors: DataFrame, how: Coding = Coding()) -> np.ndarray:
    """Codebooks (parts, entries, width) of the rows of `whole_vectors`.

    They start as the parts of the vectors with the least vec_ids (of equal ones those of least
    components; unknown ids come last); fewer vectors than `entries` give fewer entries. A round is one
    pass over the vectors, and rounds end early once nothing moves any more, as the rest would not
    change anything.
    """
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(how.entries).select("v").collect()
    if len({len(r["v"]) for r in first}) > 1:
        raise ValueError("vectors differ in length")
    width = len(first[0]["v"]) // how.parts if first else 0
    start = np.array([r["v"] for r in first], dtype=np.int64).reshape(len(first), how.parts, width)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    for _ in range(how.rounds if first else 0):
        moved = _moved(vectors, books, how)
        if (moved == books).all():
            break
        books = moved
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and place, in decimal with commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(vectors: DataFrame, books: np.ndarray, how: Coding = Coding()) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error (squared distances summed up); no shuffle."""
    width = books.shape[2]
    kinds = [vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            x = _parts(batch.column("v"), how, width)
            found = [nearest(x[:, p], books[p])[:2] for p in range(how.parts)]
            codes = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            error = sum(d for _, d in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes]), pa.array(error, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    return vectors.mapInArrow(run, f"vec_id {kinds[0]}, label {kinds[1]}, code string, error long")


def compress(
    df: DataFrame, how: Coding = Coding(), key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 for every row with a usable vector.

    Rows whose vector is null, empty, or has unknown or infinite components are left out. `label_error`
    is the error of all rows of a label, unknown labels being one. Repeated rows and ids count as often as
    they come. Without a usable vector there are no rows. The codebooks, parts * entries * width
    numbers, go to all tasks; vectors are not shuffled, but for one narrow row each that meets the sum of its
    label, spread over SALTS places so that a label with a third of all rows is not in one task.
    """
    if not 1 <= how.entries <= 256:
        raise ValueError("a part has between 1 and 256 entries")
    vectors = keep(whole_vectors(df, how, key, vector, label))
    books = fit(vectors, how)
    coded = keep(encode(vectors, books, how))
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).select(F.col("label").alias("of"), "label_error")
    spread = by_label.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    met = salted.join(spread, salted["label"].eqNullSafe(spread["of"]) & (salted["salt"] == spread["place"]))
    return met.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
