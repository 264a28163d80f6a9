"""Sets of 64-bit hashes as bit arrays of one fixed size, to be broadcast whatever the size of the set.

A bit array never says no to a member; it may say yes to others, the more of them the fuller it is. So it only spares
work: what passes it has to be counted exactly afterwards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits that one row of the distributed array holds.
_BLOCK = 1 << 16


def bit_set(members: DataFrame, column: str, log_bits: int = 26) -> np.ndarray:
    """The set of the hashes in ``column`` (long) as an array of bytes with 2**log_bits bits. The bits are put together in
    Spark, block by block; what comes to the driver are the 2**log_bits bits (8 MB by default), however many hashes there are."""
    n = 1 << log_bits
    at = members.select(F.col(column).bitwiseAND(F.lit(n - 1)).alias("at")).distinct()
    at = at.select(F.shiftright("at", 16).alias("block"), F.col("at").bitwiseAND(F.lit(_BLOCK - 1)).cast("int").alias("bit"))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:  # at most 65,536 rows a block
        bits = np.zeros(_BLOCK, dtype=bool)
        bits[pdf["bit"].to_numpy()] = True
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    out = np.zeros(n >> 3, dtype=np.uint8)
    for r in at.groupBy("block").applyInPandas(fill, "block long, bits binary").toLocalIterator():
        out[r.block * (_BLOCK >> 3):(r.block + 1) * (_BLOCK >> 3)] = np.frombuffer(r.bits, dtype=np.uint8)
    return out


def members(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) may be in the set."""
    at = hashes & np.uint64(8 * len(bits) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def one_member(bits: np.ndarray, value: int) -> bool:
    """The same for one hash."""
    at = value & (8 * len(bits) - 1)
    return bool(bits[at >> 3] >> (at & 7) & 1)


def chunks(counts: dict, width: int) -> Iterator[list[tuple]]:
    """The items of a dictionary with ``width`` keys in each tuple, 50,000 at a time."""
    items = list(counts.items())
    for i in range(0, len(items), 50_000):
        yield [(*k, n) if width > 1 else (k, n) for k, n in items[i:i + 50_000]]
