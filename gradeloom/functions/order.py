"""Seeded, partition-independent hashes for sampling, ordering and splitting."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_hash(seed: int, keys: list[str], epoch: int | None = None) -> Column:
    """A hex digest of seed, epoch and key: the same for a row on every engine and layout."""
    head = f"{seed}:" if epoch is None else f"{seed}:{epoch}:"
    parts = F.concat_ws(":", *[F.col(k).cast("string") for k in keys])
    return F.md5(F.concat(F.lit(head), parts).cast("binary"))


def in_validation(seed: int, keys: list[str], fraction: float) -> Column:
    """True for a fixed `fraction` of keys, the same keys on every run."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be between 0 and 1")
    if fraction == 1.0:
        return F.lit(True)
    # Hex digests of equal length sort like the numbers they stand for.
    return F.substring(order_hash(seed, keys), 1, 8) < F.lit(f"{int(fraction * 16**8):08x}")
