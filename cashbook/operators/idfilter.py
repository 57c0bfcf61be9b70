"""A bounded filter of ids in front of a shuffle join (J2 + F2).

Most rows of a large side may have no partner: payments of accounts that are
not on the main balance, here.  A bitmap of the partners' hashed ids, of a
fixed greatest size, is broadcast and tested before the exchange, so that such
rows are not moved.  A test may let a row pass that has no partner (the join
drops it), never the reverse, so results do not depend on the filter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The bitmap has 2^LEAST_BITS to 2^MOST_BITS bits; 64 of them are a row of the broadcast (two longs): a million rows.
LEAST_BITS, MOST_BITS = 16, 26
#: Bits for each id, by which at most one in ``SPREAD`` rows without a partner passes.
SPREAD = 8


def bitmap_bits(ids: int) -> int | None:
    """Size (as a power of two) for ``ids`` ids; None where the largest bitmap would let half of all rows pass."""
    bits = max(LEAST_BITS, math.ceil(math.log2(max(1, ids) * SPREAD)))
    if bits <= MOST_BITS:
        return bits
    return MOST_BITS if ids <= 1 << (MOST_BITS - 1) else None


def _place(id_: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(id_.cast("long")), F.lit(1 << bits))


def id_bitmap(ids: DataFrame, column: str, bits: int) -> DataFrame:
    """(word_, bits_): the set bits of the hashed ids, 64 to a row; combined before the exchange."""
    bit = F.expr("shiftleft(1L, CAST(at_ & 63 AS int))")
    return (ids.select(_place(F.col(column), bits).alias("at_"))
            .groupBy(F.shiftright("at_", 6).alias("word_")).agg(F.bit_or(bit).alias("bits_")))


def maybe_in(df: DataFrame, column: str, bitmap: DataFrame, bits: int) -> DataFrame:
    """Rows of ``df`` whose id may be in the bitmap; null ids are in none."""
    at = _place(F.col(column), bits)
    hit = F.expr("shiftright(bits_, CAST(at_ & 63 AS int)) & 1") == 1
    return (df.filter(F.col(column).isNotNull()).withColumn("at_", at)
            .join(F.broadcast(bitmap), (F.shiftright("at_", 6) == F.col("word_")) & hit, "left_semi").drop("at_"))
