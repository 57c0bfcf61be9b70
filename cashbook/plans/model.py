"""The stored model: refresh (S15) and read layout for club/time lookups.

The model table is rebuilt in full on each refresh (write-then-swap, see
:class:`cashbook.sources.warehouse.Warehouse`).  Its rows are clustered by club
and sorted by ``(id_club, payment_time_local)``, so every file holds few clubs
and every row group a narrow club / time band; a lookup by club and local-time
window then skips row groups (and files) by Parquet min/max statistics, with
the filters under ``PushedFilters``.

Default layout ``rebalance``: ``REBALANCE(id_club)`` then a sort within
partitions.  One pass over the payments; AQE sizes the output partitions to
the advisory size and splits the partition of a hot club -- one club, or the
NULL club of payments whose club row is missing, may hold a third of all rows
-- into several tasks.  Layout ``range`` (``repartitionByRange`` with a row
hash as last key) gives tighter per-file club ranges but its boundary
sampling re-runs the whole upstream plan once more; it is used on request and
when AQE is disabled (a rebalance without AQE would be a plain hash shuffle
with no skew split).

Layout ``curve`` (:mod:`cashbook.plans.curve`; that of a warehouse run) places
rows along a space-filling curve over club and local time, so that lookups on
either column alone skip most files too, at any row-group size.  It reads the
upstream plan once, and a sample of the payments before.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashbook.operators.rules import MODEL_TABLES
from cashbook.plans.curve import SAMPLE_ROWS, curve_of
from cashbook.plans.pnl import pnl_feed, pnl_long
from cashbook.sources.fixtures import BillingTables, catalog_tables
from cashbook.sources.warehouse import Warehouse

MODEL_SCHEMA = "models"
LOOKUP_KEYS = ("id_club", "payment_time_local")


# one output range per this many bytes of payment input
TARGET_INPUT_BYTES_PER_RANGE = 256 * 1024 * 1024


def input_bytes(df: DataFrame) -> int:
    """Total size of the files ``df`` reads (driver-side file metadata only).

    One content summary per folder holding input files -- one call per
    table version folder, not one per file.
    """
    files = df.inputFiles()
    if not files:
        return 0
    sc = df.sparkSession.sparkContext
    jvm = sc._jvm
    conf = sc._jsc.hadoopConfiguration()
    total = 0
    for folder in sorted({f.rsplit("/", 1)[0] for f in files}):
        p = jvm.org.apache.hadoop.fs.Path(folder)
        total += int(p.getFileSystem(conf).getContentSummary(p).getLength())
    return total


def range_count(spark: SparkSession, payments: DataFrame) -> int:
    """Number of output ranges: one per ``TARGET_INPUT_BYTES_PER_RANGE`` of
    payment input, never fewer than ``spark.sql.shuffle.partitions``."""
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(floor, -(-input_bytes(payments) // TARGET_INPUT_BYTES_PER_RANGE))


def clustered(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range-partition and sort for club / local-time lookups (layout ``range``).

    The row hash as last range key lets boundaries cut through a hot group.
    Without ``partitions`` the count follows ``spark.sql.shuffle.partitions``.
    """
    tb = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("_tb")
    keys = [F.col(k) for k in LOOKUP_KEYS] + [F.col("_tb")]
    x = df.select("*", tb)
    x = x.repartitionByRange(partitions, *keys) if partitions else x.repartitionByRange(*keys)
    return x.sortWithinPartitions(*LOOKUP_KEYS).drop("_tb")


def rebalanced(df: DataFrame) -> DataFrame:
    """Cluster by club with AQE-sized, skew-split partitions (layout ``rebalance``)."""
    return df.hint("rebalance", "id_club").sortWithinPartitions(*LOOKUP_KEYS)


def along_curve(t: BillingTables, lang: str, partitions: int) -> DataFrame:
    """The model's rows along a curve over club and local time (layout ``curve``)."""
    payments = t.payment.count()
    some = t if payments <= SAMPLE_ROWS else t._replace(payment=t.payment.sample(SAMPLE_ROWS / payments, seed=1))
    return curve_of(pnl_feed(some), *LOOKUP_KEYS, partitions).place(pnl_long(t, lang), *LOOKUP_KEYS)


def aqe_enabled(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"


def refresh_model(spark: SparkSession, warehouse: Warehouse, lang: str = "en",
                  tables: BillingTables | None = None, partitions: int | None = None,
                  max_records_per_file: int | None = 5_000_000, layout: str = "rebalance") -> str:
    """S15 + S16: rebuild ``models.<model>`` from the billing tables.

    ``layout="range"`` (or AQE off) and ``layout="curve"``: ``partitions``
    club / local-time ranges, by default one per 256 MB of payment input and at
    least ``spark.sql.shuffle.partitions``, so ranges stay bounded at any size.
    """
    if layout not in ("rebalance", "range", "curve"):
        raise ValueError(f"unknown layout {layout!r}")
    t = tables if tables is not None else catalog_tables(warehouse)
    if layout == "curve":
        df = along_curve(t, lang, partitions if partitions is not None else range_count(spark, t.payment))
    elif layout == "rebalance" and partitions is None and aqe_enabled(spark):
        df = rebalanced(pnl_long(t, lang))
    else:
        n = partitions if partitions is not None else range_count(spark, t.payment)
        df = clustered(pnl_long(t, lang), n)
    return warehouse.replace(MODEL_SCHEMA, MODEL_TABLES[lang], df, max_records_per_file)


def model_table(warehouse: Warehouse, lang: str = "en") -> DataFrame:
    return warehouse.table(MODEL_SCHEMA, MODEL_TABLES[lang])


def _ntz(v: dt.datetime | str):
    text = v.isoformat(sep=" ") if isinstance(v, dt.datetime) else str(v)
    return F.lit(text).cast("timestamp_ntz")


def lookup(model: DataFrame, clubs: list[int], start: dt.datetime | str,
           end: dt.datetime | str) -> DataFrame:
    """Rows of ``clubs`` with ``start <= payment_time_local < end`` (local wall-clock time)."""
    return model.filter(F.col("id_club").isin(list(clubs))
                        & (F.col("payment_time_local") >= _ntz(start))
                        & (F.col("payment_time_local") < _ntz(end)))

