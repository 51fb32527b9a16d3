"""Best-fit packing by vectors: documents into token sequences under several capacities.

A sequence has capacities for tokens, for documents and for attention cost (the sum of squared
piece lengths, as attention stays within a piece). A piece takes a share of each; it goes to the
open sequence that has room in every dimension and the best score, or opens a new one.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.shared import keep

PIECES = "doc_id {kind}, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds, and how much each capacity weighs when a sequence is chosen.

    With the defaults a piece has up to 2048 tokens and tokens alone decide: 2048 pieces are 2048 tokens at
    least, and pieces of 2048 tokens in all cost 2048 * 2048 at most. That keeps sequences fewest. Fewer documents, or
    less attention, bind; pieces then have `piece` tokens at most."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)

    @property
    def piece(self) -> int:
        """Tokens of the longest piece that a sequence can hold."""
        return max(1, min(self.tokens, math.isqrt(self.attention)))


@lru_cache(maxsize=4)
def _encoders(json_path: str, ranks_path: str | None, pattern: str | None):
    """The tokenizer, and a faster encoder of the same vocabulary for texts without special tokens."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(json_path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def slow(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    if ranks_path is None:
        return slow
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        return slow(text) if any(s in text for s in special) else fast.encode_ordinary(text)

    return encode


def token_pieces(
    df: DataFrame,
    json_path: str,
    ranks_path: str | None = None,
    pattern: str | None = None,
    size: int = 2048,
    end_id: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Every document as pieces of at most `size` token ids: doc_id, piece, start, length, ids_crc32
    and, if asked for, ids.

    A document's ids are those of the tokenizer file without added special tokens, then `end_id`.
    `ranks_path` and `pattern` may name the same vocabulary as ranks, which is read about four
    times as fast; texts that hold a special token's string go to the tokenizer itself. Only longer
    documents are cut, into pieces of `size`, the first of which takes the remainder. A null or
    empty text is the end id alone. Repeated rows are packed as often as they come; an empty table has no pieces.
    No shuffle. Whatever is packed under a Capacity takes its `piece` as `size`.
    """
    kind = df.schema[doc_id].dataType.simpleString()
    schema = PIECES.format(kind=kind) + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoders(json_path, ranks_path, pattern)
        for batch in batches:
            rows = []
            for key, value in zip(batch["doc_id"], batch["text"]):
                ids = np.array([*(encode(value) if value else ()), end_id], dtype="<u4")
                first = len(ids) % size or size
                edges = [0, *range(first, len(ids) + 1, size)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                    part = ids[a:b]
                    rows.append((key, piece, a, b - a, zlib.crc32(part.tobytes()), *([part.astype("i4")] if with_ids else ())))
            names = [field.split()[0] for field in schema.split(", ")]
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype(object)
            yield out

    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return source.mapInPandas(cut, schema)


class Bins:
    """Open sequences of one block of pieces, as arrays of residual capacities."""

    def __init__(self, capacity: Capacity, score: str, least: int):
        self.full = np.array([capacity.tokens, capacity.documents, capacity.attention], dtype=np.float64)
        self.score, self.least, self.weights = score, least, np.array(capacity.weights, dtype=np.float64)
        self.rest, self.ids, self.open, self.made = np.empty((64, 3)), np.empty(64, np.int64), 0, 0

    def _new(self) -> int:
        if self.open == len(self.ids):
            self.rest, self.ids = np.vstack([self.rest, self.rest]), np.concatenate([self.ids, self.ids])
        self.rest[self.open], self.ids[self.open] = self.full, self.made
        self.made, self.open = self.made + 1, self.open + 1
        return self.open - 1

    def put(self, need: np.ndarray) -> tuple[int, int]:
        """The sequence that takes `need`, and the tokens in it so far."""
        if (need > self.full).any():
            raise ValueError("a piece is larger than a sequence")
        rest = self.rest[: self.open]
        fits = np.flatnonzero((rest >= need).all(axis=1))
        if len(fits) == 0:
            at = self._new()
        else:
            share, left = need / self.full, (rest[fits] - need) / self.full
            # Least norm of what is left, or least weighted product of need and what is left: both
            # take the tightest sequence, in the dimensions that this piece presses on.
            points = (left * left if self.score == "norm" else left * share) @ self.weights
            at = int(fits[np.argmin(points)])
        found, offset = int(self.ids[at]), int(self.full[0] - self.rest[at, 0])
        self.rest[at] -= need
        if (self.rest[at] < (self.least, 1, self.least * self.least)).any():  # closed: no piece fits any more
            self.open -= 1
            self.rest[at], self.ids[at] = self.rest[self.open], self.ids[self.open]
        return found, offset


def best_fit(lengths: np.ndarray, capacity: Capacity, score: str) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece, longest pieces first."""
    bins = Bins(capacity, score, int(lengths.min()) if len(lengths) else 1)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        n = float(lengths[i])
        sequence[i], offset[i] = bins.put(np.array([n, 1.0, n * n]))
    return sequence, offset


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), score: str = "dot", block: int = 16_384) -> DataFrame:
    """`pieces` (as of `token_pieces`) with sequence_id and offset.

    Pieces are dealt evenly over blocks of about `block` pieces, whatever their documents, and
    every block is packed by itself, so a task's memory is bounded and a block leaves a sequence or
    so that could be fuller. `score` is `dot` (weighted dot product) or `norm` (residual norm).
    An empty table gives no sequence; ties are settled by the order of the rows in the block. A piece longer than
    `capacity.piece` is refused. Columns named like the new ones are replaced.
    """
    if score not in ("dot", "norm"):
        raise ValueError(f"unknown score: {score!r}")
    rows = keep(pieces)
    blocks = max(1, -(-rows.count() // block))
    names = rows.columns

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if parts:
            held = pd.concat(parts, ignore_index=True)
            sequence, held["offset"] = best_fit(held["length"].to_numpy(), capacity, score)
            held["sequence_id"] = sequence + (TaskContext.get().partitionId() << 32)
            yield held[[*names, "sequence_id", "offset"]]

    schema = rows.drop("sequence_id", "offset").schema.add("sequence_id", "long").add("offset", "long")
    names = [n for n in names if n not in ("sequence_id", "offset")]
    # Without a key, Spark deals rows out evenly and in a fixed order, also when a task runs again.
    return rows.select(*names).repartition(blocks).mapInPandas(fill, schema)


def packed_sequences(packed: DataFrame) -> DataFrame:
    """The token ids of every sequence (pieces with ids): sequence_id, ids, n_pieces. A group is at
    most one sequence long."""
    order = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(order, lambda p: p["ids"])).alias("ids"), F.count("*").alias("n_pieces")
    )
