"""String hashes as expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _units(text: Column) -> Column:
    """The UTF-16 code units of a string; a character beyond the first plane has two."""

    def units(ch: Column) -> Column:
        code = F.ascii(ch).cast("long")
        rest = code - 65536
        pair = F.array(F.shiftright(rest, 10) + 55296, rest.bitwiseAND(F.lit(1023)) + 56320)
        return F.when(code < 65536, F.array(code)).otherwise(pair)

    chars = F.filter(F.split(text, ""), lambda ch: ch != "")
    return F.flatten(F.transform(chars, units))


def poly_hash(text: Column, seed: int, bits: int) -> Column:
    """``h = h * seed + unit`` over the code units, kept to the lowest ``bits`` bits at each step."""
    mask = F.lit((1 << bits) - 1).cast("long")
    return F.aggregate(
        _units(text), F.lit(0).cast("long"), lambda h, u: (h * F.lit(seed).cast("long") + u).bitwiseAND(mask)
    )


def hash_code(text: Column, factor: float = 1.0) -> Column:
    """The 32-bit signed string hash with factor 31, times ``factor``."""
    signed = (poly_hash(text, 31, 32) + (1 << 31)).bitwiseAND(F.lit((1 << 32) - 1)) - (1 << 31)
    return signed * F.lit(float(factor))
