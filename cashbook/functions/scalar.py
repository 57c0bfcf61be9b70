"""Scalar helpers of the model (all built-in, codegen-friendly expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def to_double(c: Column | str) -> Column:
    """``x::double precision``.

    Money may arrive as text (a modified ``numeric`` lands as text in the
    warehouse).  With ANSI mode on, a malformed string fails the job the way
    the database cast does instead of turning into NULL.
    """
    return F.col(c).cast("double") if isinstance(c, str) else c.cast("double")


def zero_if_null(c: Column) -> Column:
    """``COALESCE(x, 0)`` on a double."""
    return F.coalesce(c, F.lit(0.0))


def local_time(ts: Column | str, offset_seconds: Column | str) -> Column:
    """``ts + offset * INTERVAL '1 second'``.

    Offsets are seconds (fractions kept, to the microsecond); a NULL offset --
    e.g. an account whose club row is missing -- gives a NULL local time.
    On TIMESTAMP_NTZ this is plain arithmetic, free of the session time zone.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    off = F.col(offset_seconds) if isinstance(offset_seconds, str) else offset_seconds
    return ts + off * F.expr("INTERVAL '1' SECOND")


def numeric_offset(c: Column, dtype) -> Column:
    """An offset column usable in :func:`local_time`.

    A numeric column is used as is; an offset stored as text (a modified
    numeric type lands as text in the warehouse) is read as a decimal with
    microsecond precision -- malformed text fails under ANSI mode.
    """
    from pyspark.sql import types as T
    return c.cast(T.DecimalType(38, 6)) if isinstance(dtype, T.StringType) else c
