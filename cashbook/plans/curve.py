"""A file layout that prunes on two columns at once.

Rows are placed along a Hilbert curve over (rank of the club, rank of the
local time), so every file holds a small rectangle of both and its min/max
statistics let a lookup on either column, or on both, skip most files.

Ranks are quantiles of a bounded sample of the rows: equal steps of rank hold
about equal numbers of rows, whatever the distribution.  The curve's cells are
dealt to partitions in curve order, by their sampled rows; a cell that holds
more than a partition's share, such as one of a hot club, is dealt to several
by a hash of the row.  The sample decides the balance of the files only:
every row has a cell, sampled or not, and none is dropped.

The rows themselves are read once.  Each gets its partition number from three
small lookup tables (clubs of the sample, time steps, cells), joined as
broadcasts inside the scan's stage, and moves in one exchange by that number
(no boundary sampling, which would run the plan above it twice).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows sampled, on average; with it the lookup table of the clubs is bounded.
SAMPLE_ROWS = 200_000
#: Steps of equal length in which time is ranked.
TIME_STEPS = 4096
#: Ranks per column at most, as a power of two: cells are their square.
MOST_BITS = 9


def hilbert_positions(bits: int) -> np.ndarray:
    """Position along the Hilbert curve of each cell (x, y) of a 2^bits square, as a matrix."""
    # the curve of twice the side is four copies: transposed, plain, plain, and transposed the other way
    d = np.zeros((1, 1), dtype=np.int64)
    for _ in range(bits):
        q = d.size
        d = np.block([[d.T, q + d], [3 * q + d.T[::-1, ::-1], 2 * q + d]])
    return d


def _ranks(weight: np.ndarray, bits: int) -> np.ndarray:
    """Quantile rank in [0, 2^bits) of each of the ordered values, by the middle of its weight."""
    total = weight.sum()
    if not total:
        return np.zeros(len(weight), dtype=np.int64)
    middle = np.cumsum(weight) - weight / 2
    return np.minimum((middle * (1 << bits) / total).astype(np.int64), (1 << bits) - 1)


def _seconds(time: Column) -> Column:
    """Seconds of a wall-clock time, as if it were UTC."""
    return F.unix_timestamp(time.cast("timestamp"))


class Curve:
    """Where rows go: built from a sample of (club, time, rows) and a number of partitions."""

    def __init__(self, sample: pd.DataFrame, partitions: int):
        """``sample``: columns club, second, n; a null club or time is a value like any other, before all others."""
        self.partitions = max(1, partitions)
        # four cells a partition, so that neighbours can be dealt evenly
        self.bits = min(MOST_BITS, max(1, int(np.ceil(np.log2(4 * self.partitions) / 2))))
        known = sample["second"].dropna()
        self.first = int(known.min()) if len(known) else 0
        self.step = max(1, -(-(int(known.max()) - self.first + 1) // TIME_STEPS)) if len(known) else 1
        step = ((sample["second"].fillna(self.first) - self.first) // self.step).astype(np.int64)
        steps = np.bincount(step, weights=sample["n"], minlength=TIME_STEPS)[:TIME_STEPS]
        self.time_rank = _ranks(steps, self.bits)
        clubs = sample.groupby("club", dropna=False)["n"].sum().sort_index(na_position="first")
        self.clubs = clubs.index.to_numpy()
        self.club_rank = _ranks(clubs.to_numpy(dtype=np.float64), self.bits)

        side = 1 << self.bits
        position = hilbert_positions(self.bits)
        rank_of = {None if pd.isna(c) else c: r for c, r in zip(self.clubs, self.club_rank)}
        x = np.array([rank_of[None if pd.isna(c) else c] for c in sample["club"]], dtype=np.int64)
        # a little weight everywhere: cells without sampled rows get a place too
        weight = np.full(side * side, 0.01 * max(1, sample["n"].sum()) / (side * side))
        np.add.at(weight, position[x, self.time_rank[step]], sample["n"].to_numpy(dtype=np.float64))
        share = weight.sum() / self.partitions
        end = np.cumsum(weight)
        begin = end - weight
        first = np.minimum((begin / share).astype(np.int64), self.partitions - 1)
        last = np.minimum((np.nextafter(end, 0) / share).astype(np.int64), self.partitions - 1)
        # a cell on the border of two partitions goes to the one that has more of it; heavy cells keep their span
        heavy = weight > share
        middle = np.minimum(((begin + end) / 2 / share).astype(np.int64), self.partitions - 1)
        self.first_part = np.where(heavy, first, middle)
        self.parts = np.where(heavy, last - first + 1, 1)
        self.position = position

    def place(self, df: DataFrame, club: str, time: str) -> DataFrame:
        """``df`` in ``partitions`` partitions along the curve."""
        spark = df.sparkSession
        clubs = spark.createDataFrame([(None if pd.isna(c) else int(c), int(r)) for c, r in zip(self.clubs, self.club_rank)],
                                      "club_ long, x_ int")
        steps = spark.createDataFrame(pd.DataFrame({"step_": np.arange(TIME_STEPS, dtype=np.int64),
                                                    "y_": self.time_rank.astype(np.int32)}))
        side = np.arange(1 << self.bits, dtype=np.int32)
        xs, ys = (m.reshape(-1) for m in np.meshgrid(side, side, indexing="ij"))
        at = self.position[xs, ys]
        cells = spark.createDataFrame(pd.DataFrame({"cx_": xs, "cy_": ys, "first_": self.first_part[at].astype(np.int32),
                                                    "parts_": self.parts[at].astype(np.int32)}))
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
        second = F.coalesce(_seconds(F.col(time)), F.lit(self.first))
        step = F.greatest(F.lit(0), F.least(F.lit(TIME_STEPS - 1), F.floor((second - self.first) / self.step)))
        keyed = df.select(row, F.col(club).cast("long").alias("c_"), step.cast("long").alias("s_"))
        hashed = F.xxhash64("row")
        # a club that the sample missed holds few rows: any rank will do, the same for all its rows
        x = F.coalesce("x_", F.pmod(F.xxhash64("c_"), F.lit(1 << self.bits)).cast("int"))
        placed = (keyed.join(F.broadcast(clubs), F.col("c_").eqNullSafe(F.col("club_")), "left")
                  .join(F.broadcast(steps), F.col("s_") == F.col("step_"), "left")
                  .withColumn("x_", x)
                  .join(F.broadcast(cells), (F.col("x_") == F.col("cx_")) & (F.col("y_") == F.col("cy_")), "left"))
        part = (F.col("first_") + F.pmod(hashed, F.col("parts_"))).cast("int")
        moved = placed.select("row", part.alias("part_")).repartitionById(self.partitions, "part_")
        return moved.select("row.*").sortWithinPartitions(club, time)


def curve_of(rows: DataFrame, club: str, time: str, partitions: int) -> Curve:
    """The curve for a sample ``rows`` of about ``SAMPLE_ROWS`` rows."""
    counted = rows.groupBy(F.col(club).cast("long").alias("club"), _seconds(F.col(time)).alias("second")).agg(
        F.count(F.lit(1)).alias("n"))
    return Curve(counted.toPandas(), partitions)
