"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Every row has a global number, its place in the order of a key. A Feistel network permutes the
numbers; the permuted number p gives shard p mod n and slot p div n. Nothing is stored: the place
of a row can be worked out from its number and the row at a place from the place.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.shared import numbered

ROUNDS = 8


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Feistel:
    """A permutation of 0 .. n-1 that depends on `seed` alone.

    The network works on pairs (l, r) with l < a and r < b, where a*b is the least such product
    of near equal sides that is n or more. A result of n or more is put in again (cycle walking)
    until it is below n; as a*b exceeds n by less than 2*sqrt(n)+1, this is rare.
    """

    def __init__(self, n: int, seed: int):
        if n < 0:
            raise ValueError("the number of rows is negative")
        self.n, self.seed = n, seed
        self.a = max(1, math.isqrt(max(0, n - 1)) + 1)
        self.b = max(1, -(-n // self.a))

    def _f(self, k: int, half: np.ndarray) -> np.ndarray:
        key = _mix(np.array([(self.seed * 0x2545F4914F6CDD1D + k) % 2**64], dtype=np.uint64))
        return _mix(half ^ key)

    def _forward(self, x: np.ndarray) -> np.ndarray:
        left, right = x // np.uint64(self.b), x % np.uint64(self.b)
        for k in range(ROUNDS):
            if k % 2:
                left = (left + self._f(k, right) % np.uint64(self.a)) % np.uint64(self.a)
            else:
                right = (right + self._f(k, left) % np.uint64(self.b)) % np.uint64(self.b)
        return left * np.uint64(self.b) + right

    def _backward(self, x: np.ndarray) -> np.ndarray:
        left, right = x // np.uint64(self.b), x % np.uint64(self.b)
        for k in reversed(range(ROUNDS)):
            if k % 2:
                a = np.uint64(self.a)
                left = (left + a - self._f(k, right) % a) % a
            else:
                b = np.uint64(self.b)
                right = (right + b - self._f(k, left) % b) % b
        return left * np.uint64(self.b) + right

    def _walk(self, numbers, step) -> np.ndarray:
        x = np.asarray(numbers, dtype=np.uint64)
        if x.size and int(x.max()) >= self.n:
            raise ValueError("a number lies outside the permutation")
        x = step(x)
        while (out := x >= np.uint64(self.n)).any():
            x[out] = step(x[out])
        return x.astype(np.int64)

    def place(self, numbers) -> np.ndarray:
        return self._walk(numbers, self._forward)

    def number(self, places) -> np.ndarray:
        """The inverse of `place`."""
        return self._walk(places, self._backward)


def locate(numbers, n_rows: int, n_shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of rows by their global numbers, without any table."""
    p = Feistel(n_rows, seed).place(numbers)
    return p % n_shards, p // n_shards


def row_at(shard: int, slot: int, n_rows: int, n_shards: int, seed: int) -> int:
    """The global number of the row at a place, without any table."""
    return int(Feistel(n_rows, seed).number([slot * n_shards + shard])[0])


def shard_rows(df: DataFrame, order: list[Column | str], n_shards: int, seed: int = 42) -> DataFrame:
    """`df` with `row_number`, `shard` and `slot`.

    Law `rows`: shard counts differ by one at most and slots are gapless from 0. Row numbers follow
    `order`; with an order that tells all different rows apart the result hangs on content, row
    count, shard count and seed alone, never on files or partitions. Nulls come first in the order;
    rows equal in all of `order` take places next to each other in the numbering, in any order; an
    empty table gives an empty result. Columns of these three names are replaced.
    """
    if n_shards < 1:
        raise ValueError("there must be a shard")
    rows, n = numbered(df.drop("row_number", "shard", "slot"), order, "row_number")

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(Feistel(n, seed).place(number.to_numpy()))

    return (
        rows.withColumn("__place", place("row_number"))
        .withColumn("shard", (F.col("__place") % n_shards).cast("int"))
        .withColumn("slot", F.expr(f"__place div {n_shards}"))
        .drop("__place")
    )


def write_shards(df: DataFrame, path: str) -> None:
    """The rows of `shard_rows` as one folder per shard; every file is in the order of its slots."""
    df.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
