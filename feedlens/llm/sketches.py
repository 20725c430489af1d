"""Parity sketches: bounds on how many elements two sets differ in.

Bit i of a set's sketch is the parity of its elements that hash to i, so the sketches of two sets
differ in at most as many bits as the sets differ in elements.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: 64-bit words of a sketch
SKETCH_WORDS = 16


def parity_sketches(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row of ``SKETCH_WORDS`` words per set; the sets are the runs of the hashes ``h`` from ``starts``."""
    bit = np.uint64(1) << ((h >> np.uint64(20)) & np.uint64(63))
    word = (h >> np.uint64(26)) & np.uint64(SKETCH_WORDS - 1)
    return np.stack([np.bitwise_xor.reduceat(np.where(word == w, bit, np.uint64(0)), starts) for w in range(SKETCH_WORDS)], axis=1)


def apart(a: str, b: str) -> Column:
    """Bits in which two sketch columns (arrays of bigint) differ."""
    return reduce(Column.__add__, [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(SKETCH_WORDS)])
