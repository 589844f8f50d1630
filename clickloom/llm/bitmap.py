"""A bitmap of fixed size over 64-bit marks, to drop rows in the tasks that read them.

It is small enough to go to every task whatever it is made of. The fuller it is, the more rows pass, and
the join behind it decides in any case.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmap (512 KiB), in rows of 4 KiB as Spark builds them.
BITMAP_BITS = 1 << 22
_ROW_BITS = 1 << 15


def bitmap_of(marks: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bit for each value of the column ``mark``; rows of 4 KiB come to the driver, ``bits`` in all at most."""
    # Signed and unsigned remainders agree, as the number of bits is a power of two.
    bit = F.pmod(F.col("mark"), F.lit(bits))
    rows = marks.select(F.floor(bit / _ROW_BITS).cast("int").alias("row"), F.pmod(bit, F.lit(_ROW_BITS)).alias("bit"))
    out = np.zeros(bits // 8, np.uint8)
    for r in rows.groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        out[r["row"] * _ROW_BITS // 8 : (r["row"] + 1) * _ROW_BITS // 8] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def passes(bitmap: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Whether the bit of each mark is set."""
    bit = (marks.view(np.uint64) % np.uint64(len(bitmap) * 8)).astype(np.int64)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
