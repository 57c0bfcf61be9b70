"""Size-checked broadcast.

A side is broadcast only after a count proves it holds at most ``max_rows``
rows.  The count is one aggregate on the executors; the driver receives one
row, whatever the table.  A side over the bound gets a ``merge`` hint and the
join shuffles (AQE may still turn it into a broadcast from measured shuffle
sizes, and splits skewed partitions).  Callers project to the join key and a
few numeric columns first, so a row takes some tens of bytes.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Defaults; small dimension tables (payment types, balances, clubs) are
# hundreds to thousands of rows, accounts can be tens of millions.
DIMENSION_MAX_ROWS = 1_000_000
ACCOUNT_MAX_ROWS = 2_000_000


def one_row_each(probes: list[DataFrame]) -> list:
    """The single row of several aggregates, run concurrently."""
    with ThreadPoolExecutor(max_workers=max(1, len(probes))) as pool:
        return list(pool.map(lambda p: p.first(), probes))


def counted(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def bounded_broadcast(df: DataFrame, max_rows: int = DIMENSION_MAX_ROWS) -> DataFrame:
    return hint(df, counted(df).first()["n"] <= max_rows)


def hint(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast a side proven small; pin any other side to a shuffle join.

    The ``merge`` hint keeps the planner from broadcasting an unproven side
    on file-size estimates alone; AQE may still switch to a broadcast at run
    time, but only from measured shuffle sizes.
    """
    return F.broadcast(df) if small else df.hint("merge")
