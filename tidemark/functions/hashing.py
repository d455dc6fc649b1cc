"""A5's user hash, as a JVM-side higher-order expression (no Python UDF).

The reference folds the characters of the id with base 61 in 32-bit ints and
keeps the low 29 bits.  Masking at every step gives the same low 29 bits
(2^29 divides 2^32), so no overflow emulation is needed.  Contract: ids are
ASCII / BMP text (above U+FFFF the reference hashes UTF-16 units).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference): seed 61, bitmap of 2^29 bits.
HASH_SEED = 61
BITMAP_BITS = 1 << 29


def hash61(c: Column | str, seed: int = HASH_SEED, bits: int = BITMAP_BITS) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    mask = bits - 1
    chars = F.transform(F.split(c.cast("string"), ""), lambda ch: F.ascii(ch).cast("long"))
    return F.aggregate(chars, F.lit(0).cast("long"),
                       lambda acc, x: (acc * seed + x).bitwiseAND(F.lit(mask)))

