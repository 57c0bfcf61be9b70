"""Rows and checksum of a table, taken while it is read or written.

A :class:`Tally` rides on the job that moves the rows (``DataFrame.observe``):
no extra pass over the data.  The checksum is the sum of two 64-bit hashes of
every row over all its columns, nulls included, so it depends neither on the
order of rows nor on partitions, and a row that is lost, doubled or changed
shows.  Sums are kept in pieces of 22 bits, which holds for 2^41 rows.

Observed sums are exact where the rows are moved by the stage that ends the
job, as all copies here are.  A shuffle stage that is run again after a lost
executor could count rows twice; a copy that does not agree is copied anew.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: First bit and number of bits of the pieces of a 64-bit hash.
PIECES = ((0, 22), (22, 21), (43, 21))


@dataclass(frozen=True)
class Total:
    rows: int
    checksum: str                              # 128 bits, hexadecimal


def _hashed(column: Column, kind: T.DataType) -> Column:
    """A value that Spark can hash: maps as their sorted entries."""
    if isinstance(kind, T.MapType):
        return F.array_sort(F.map_entries(column))
    return column


def metrics(df: DataFrame) -> list[Column]:
    values = []
    for f in df.schema.fields:
        c = _hashed(F.col("`" + f.name.replace("`", "``") + "`"), f.dataType)
        values += [c.isNull(), c]
    out = [F.count(F.lit(1)).alias("rows")]
    for i, h in enumerate((F.xxhash64(F.lit(1), *values), F.xxhash64(F.lit(2), *values))):
        out += [F.sum(F.shiftrightunsigned(h, first).bitwiseAND(F.lit((1 << bits) - 1))).alias(f"h{i}_{first}")
                for first, bits in PIECES]
    return out


def total(found: dict) -> Total:
    """A total from the metrics' values; none are reported where no rows were."""
    sums = [sum((found.get(f"h{i}_{first}") or 0) << first for first, _ in PIECES) % (1 << 64) for i in range(2)]
    return Total(found.get("rows") or 0, "".join(f"{s:016x}" for s in sums))


class Tally:
    """Counts what passes through :meth:`of` when that frame is written."""

    def __init__(self):
        self._seen = Observation()

    def of(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, *metrics(df))

    def result(self) -> Total:
        """To be asked after the write has ended."""
        return total(self._seen.get)


def tally_of(df: DataFrame) -> Total:
    """The same figures by a pass over ``df``."""
    return total(df.agg(*metrics(df)).first().asDict())
