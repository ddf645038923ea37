"""A bitmap of fixed size over 64-bit hashes, to keep most rows that a join would drop from leaving their task.

Its size does not depend on the data; the fuller it is the less it holds back. The join decides.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.session import shuffles_removed

BITS = 1 << 26


def bitmap(hashes: DataFrame, column: str, bits: int = BITS) -> Broadcast:
    """The bytes of a bitmap with the low bits of every hash set; at most ``bits / 64`` rows come to the driver."""
    slot = F.col(column).bitwiseAND(F.lit(bits - 1))
    packed = (
        hashes.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("set"))
    )
    with shuffles_removed(hashes.sparkSession):
        packed = packed.toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[packed.column("word").to_numpy()] = packed.column("set").to_numpy()
    return hashes.sparkSession.sparkContext.broadcast(words.tobytes())


def held(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the bitmap."""
    flat = np.frombuffer(bits, np.uint8)
    slot = hashes.astype(np.int64) & (8 * len(flat) - 1)
    return (flat[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
