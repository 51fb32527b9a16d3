"""Benchmark decontamination by size-partitioned MinHash containment search.

The sets are word shingles. A test item is short, a document may be long, so their Jaccard
similarity says little; containment, the share of the item's shingles that the document holds, does.
Documents are partitioned by the size of their shingle set, and every size class has a MinHash of its
own length: one permutation of the hashes is cut into bins, four times as many as the class has
shingles at most, and each bin keeps its least hash. An item in the document then shares the least
hash of a bin with probability of about 0.86 for each shared shingle, so a handful of shared shingles
makes a candidate almost surely; for the shortest items more permutations are taken until the chance
to miss one is below `MISS`. Candidates are verified by their shingles themselves. An item of fewer words
than a shingle is looked up among the shingles of its own length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.words import Hashes, mixed, plain_words, sequences

MISS = 1e-6
ALONE = 0.14  # chance that a shared shingle is not its bin's least hash, at most
BLOCK_SHINGLES = 200_000  # of test items held by a task at once, about 40 MB
COLUMNS = "n_shingles long, n_shared long, containment double"


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """All shingles of a text; a text of fewer words is one shingle, one without words none."""
    if not words:
        return []
    if len(words) < size:
        return [b" ".join(words)]
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each shingle; texts of fewer words have none of this size."""
    return sequences(hashes, list(range(size))) if len(hashes) >= size else hashes[:0]


def repeats(shared: int) -> int:
    """Permutations after which an item with that many shared shingles is missed with MISS at most."""
    return max(1, math.ceil(math.log(MISS) / (shared * math.log(ALONE))))


def bin_minima(hashes: np.ndarray, size_class: int, repeat: int) -> np.ndarray:
    """The least permuted hash of each bin; sets of up to 2**size_class have 4 * 2**size_class bins."""
    x = np.sort(mixed(hashes + np.uint64(0x9E3779B97F4A7C15 * (repeat + 1) % 2**64)))
    which = x >> np.uint64(64 - size_class - 2)
    first = np.ones(len(x), dtype=bool)
    first[1:] = which[1:] != which[:-1]
    return x[first]


class Items:
    """A block of test items, and for each size class the bin minima that lead to them."""

    def __init__(self, rows: list[tuple], size: int, threshold: float):
        hashes = Hashes()
        self.ids = [r[0] for r in rows]
        self.sets, self.hashes, self.need = [], [], []
        short: dict[int, list[tuple[int, int]]] = {}
        for i, (_, text) in enumerate(rows):
            words = plain_words(text)
            self.sets.append(set(shingles(words, size)))
            self.hashes.append(np.unique(shingle_hashes(hashes.of(words), size)))
            self.need.append(max(1, math.ceil(threshold * len(self.sets[-1]) - 1e-9)))
            if 0 < len(words) < size:
                short.setdefault(len(words), []).append((int(shingle_hashes(hashes.of(words), len(words))[0]), i))
        #: By number of words, the items shorter than a shingle: their hashes in order, and whose they are.
        self.short = {n: tuple(np.array(x, dtype=t) for x, t in zip(zip(*sorted(found)), (np.uint64, np.int64))) for n, found in short.items()}
        self.repeats = max((repeats(n) for n, s in zip(self.need, self.sets) if s), default=0)
        self.tables: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def table(self, size_class: int, repeat: int) -> tuple[np.ndarray, np.ndarray]:
        if (size_class, repeat) not in self.tables:
            keys, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for i, h in enumerate(self.hashes):
                if len(h) and repeat < repeats(self.need[i]):
                    least = bin_minima(h, size_class, repeat)
                    keys.append(least)
                    owners.append(np.full(len(least), i))
            key, owner = np.concatenate(keys), np.concatenate(owners)
            order = np.argsort(key, kind="stable")
            self.tables[size_class, repeat] = key[order], owner[order]
        return self.tables[size_class, repeat]

    def candidates(self, hashes: np.ndarray) -> set[int]:
        size_class, found = max(0, len(hashes) - 1).bit_length(), set()
        for repeat in range(self.repeats if len(hashes) else 0):
            keys, owners = self.table(size_class, repeat)
            least = bin_minima(hashes, size_class, repeat)
            left, right = np.searchsorted(keys, least, "left"), np.searchsorted(keys, least, "right")
            for a, b in zip(left[right > left], right[right > left]):
                found.update(owners[a:b].tolist())
        return found


class Finder:
    """Looks for the items of a block in texts."""

    def __init__(self, block: Items, shingle: int):
        self.block, self.shingle, self.hashes = block, shingle, Hashes()

    def items(self, text: str | None) -> list[tuple[int, int]]:
        """Place in the block and number of shared shingles of each item that the text holds."""
        block, words = self.block, plain_words(text)
        hashes, out = self.hashes.of(words), []
        at = shingle_hashes(hashes, self.shingle)
        for i in sorted(block.candidates(np.unique(at))):
            places = np.flatnonzero(np.isin(at, block.hashes[i]))
            shared = {b" ".join(words[p : p + self.shingle]) for p in places} & block.sets[i]
            if len(shared) >= block.need[i]:
                out.append((i, len(shared)))
        for n, (keys, owners) in block.short.items():
            here = shingle_hashes(hashes, n)
            found = np.searchsorted(keys, here, "left"), np.searchsorted(keys, here, "right")
            held = set()
            for p in np.flatnonzero(found[1] > found[0]):
                own = b" ".join(words[p : p + n])
                held.update(i for i in owners[found[0][p] : found[1][p]].tolist() if own in block.sets[i])
            out += [(i, 1) for i in sorted(held)]
        return out


def _blocks(items: DataFrame) -> Iterator[list[tuple]]:
    """The items in blocks of bounded size, one after the other."""
    block, held = [], 0
    for key, text in items.toLocalIterator():
        n = len(plain_words(text))
        if block and held + n > BLOCK_SHINGLES:
            yield block
            block, held = [], 0
        block.append((key, text))
        held += n
    yield block


def contained_items(
    documents: DataFrame,
    items: DataFrame,
    shingle: int = 5,
    threshold: float = 0.8,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """One row for each document and item with containment of `threshold` or more:
    doc_id, item_id, n_shingles (of the item), n_shared, containment.

    Words are runs of ASCII letters and digits (in lower case) and other characters beyond ASCII.
    An item of fewer words than a shingle is one shingle of its own length and is contained where its words
    follow each other in a document; texts that are null or have no words match nothing, and a document shorter
    than an item does not hold it. Sets are taken, so repeated shingles count once; repeated rows are compared as
    often as they come; without items or documents there are no rows. What a document costs grows with its length. The test items are the query set: they are compared in blocks of bounded size, each
    against all documents, in one pass over the documents per block and without a shuffle.
    """
    kinds = documents.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, {COLUMNS}"
    source = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    context, out = documents.sparkSession.sparkContext, None
    for block in _blocks(items.select(item_id, text)):
        held = context.broadcast(block)

        def search(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            block = Items(held.value, shingle, threshold)
            found = Finder(block, shingle)
            for batch in batches:
                rows = []
                for key, value in zip(batch["doc_id"], batch["text"]):
                    for i, shared in found.items(value):
                        n = len(block.sets[i])
                        rows.append((key, block.ids[i], n, shared, shared / n))
                frame = pd.DataFrame(rows, columns=["doc_id", "item_id", "n_shingles", "n_shared", "containment"])
                yield frame.astype({"doc_id": object, "item_id": object})

        part = source.mapInPandas(search, schema)
        out = part if out is None else out.unionByName(part)
    return out


def clean_documents(
    documents: DataFrame, items: DataFrame, shingle: int = 5, threshold: float = 0.8, item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """The rows of `documents` that hold no item, columns as they are.

    Every row is judged by its own text where it lies, so nothing is shuffled or joined and a doc_id may be
    null or repeated. Rows without text or words hold nothing and stay; without items all rows stay. Texts of any
    length are searched whole.
    """
    context, kept = documents.sparkSession.sparkContext, documents
    for block in _blocks(items.select(item_id, text)):
        held = context.broadcast(block)

        @F.pandas_udf("boolean")
        def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            found = Finder(Items(held.value, shingle, threshold), shingle)
            for texts in batches:
                yield pd.Series([not found.items(t) for t in texts], dtype=bool)

        kept = kept.where(clean(F.col(text)))
    return kept
