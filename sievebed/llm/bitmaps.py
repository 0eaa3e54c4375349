"""A bitmap of hashed keys: lets a scan leave out most rows that a later exact join would drop anyway.

Its size is fixed, whatever the number of keys: with very many it lets more rows pass, never fewer.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

#: log2 of the bits: 2**25 bits are 4 MB.
BITS = 25
_MASK = (1 << BITS) - 1


def bitmap(keys: DataFrame) -> Broadcast:
    """A broadcast array of 2**BITS bits with those of the longs ``keys`` set."""
    (key,) = keys.columns
    place = F.col(key).bitwiseAND(_MASK)
    words = keys.select(
        F.shiftright(place, 6).alias("word"),
        F.expr(f"shiftleft(1L, CAST(`{key}` & 63L AS INT))").alias("bits"),
    ).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    rows = words.toArrow()
    array = np.zeros(1 << (BITS - 6), np.uint64)
    array[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(array)


def may_hold(array: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each of the 64-bit ``keys`` may be among those the bitmap was made of."""
    place = keys.view(np.uint64) & np.uint64(_MASK)
    return (array[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
