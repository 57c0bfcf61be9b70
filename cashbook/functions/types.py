"""Warehouse type rule: source column type string -> Spark type.

Column types arrive as the source catalogue prints them (``format_type``
output, modifiers included).  Only an allow-list of exact spellings keeps its
type; everything else -- including any *modified* type such as
``numeric(12,2)``, ``character varying(40)`` or ``timestamp(3) ...`` -- is
stored as text, rendered the way the source prints the value.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The type spellings that keep their type, and the Spark type of
# each.  Every other spelling becomes text.
# ---------------------------------------------------------------------------
_SPARK_OF = {
    "integer": T.IntegerType(), "serial": T.IntegerType(),
    "bigint": T.LongType(), "bigserial": T.LongType(),
    "smallint": T.ShortType(),
    "numeric": T.DecimalType(38, 18),
    "real": T.FloatType(), "double precision": T.DoubleType(),
    "text": T.StringType(), "varchar": T.StringType(), "character varying": T.StringType(),
    "uuid": T.StringType(), "json": T.StringType(), "jsonb": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(), "timestamp without time zone": T.TimestampNTZType(),
    "timestamp with time zone": T.TimestampType(),
    "boolean": T.BooleanType(),
}
# ---------------------------------------------------------------------------

_NUMERIC_MOD = re.compile(r"^numeric\((\d+)(?:,\s*(\d+))?\)$")
_CHAR_MOD = re.compile(r"^character\((\d+)\)$")


def spark_type(pg_type: str, strict: bool = False) -> T.DataType:
    """Spark type the warehouse stores for ``pg_type``.

    ``strict=True`` keeps ``numeric(p,s)`` as ``DecimalType(p,s)`` instead of
    text (the one deliberate deviation offered, off by default).
    """
    if strict:
        m = _NUMERIC_MOD.match(pg_type)
        if m and int(m.group(1)) <= 38:
            return T.DecimalType(int(m.group(1)), int(m.group(2) or 0))
    return _SPARK_OF.get(pg_type, T.StringType())


def pg_type_of(dt: T.DataType) -> str:
    """Source-style spelling for a Spark type (for sources without a catalogue)."""
    if isinstance(dt, T.DecimalType):
        return f"numeric({dt.precision},{dt.scale})"
    if isinstance(dt, T.ArrayType):
        return pg_type_of(dt.elementType) + "[]"
    simple = {
        T.LongType: "bigint", T.IntegerType: "integer", T.ShortType: "smallint",
        T.ByteType: "smallint", T.DoubleType: "double precision", T.FloatType: "real",
        T.StringType: "text", T.BooleanType: "boolean", T.DateType: "date",
        T.TimestampNTZType: "timestamp without time zone",
        T.TimestampType: "timestamp with time zone", T.BinaryType: "bytea",
    }
    for cls, name in simple.items():
        if isinstance(dt, cls):
            return name
    return "text"


def _as_text(c: Column, src: T.DataType, pg_type: str) -> Column:
    """Render a value as the text the source would print for ``pg_type``.

    A number declared wider than a Spark decimal (38 digits) keeps the digits
    it has.
    """
    m = _NUMERIC_MOD.match(pg_type)
    if m and isinstance(src, T.NumericType) and int(m.group(1)) <= 38:
        # a fixed-scale number printed with its declared scale: 12.5 -> '12.50'
        target = T.DecimalType(int(m.group(1)), int(m.group(2) or 0))
        return (c if src == target else c.cast(target)).cast("string")
    m = _CHAR_MOD.match(pg_type)
    if m and isinstance(src, T.StringType):
        n = int(m.group(1))
        return F.when(F.length(c) < n, F.rpad(c, n, " ")).otherwise(c)
    if isinstance(src, T.ArrayType):
        element = pg_type[:-2] if pg_type.endswith("[]") else pg_type
        inner = isinstance(src.elementType, T.ArrayType)
        return F.concat(F.lit("{"), F.array_join(F.transform(
            c, lambda e: _array_item(_as_text(e, src.elementType, element), inner)), ",", "NULL"), F.lit("}"))
    if isinstance(src, T.TimestampType):
        # the offset as printed: +00, or +05:30 where it has minutes
        return F.concat(c.cast("string"), F.regexp_replace(F.date_format(c, "xxx"), ":00$", ""))
    if isinstance(src, T.BinaryType):
        return F.concat(F.lit("\\x"), F.lower(F.hex(c)))
    if isinstance(src, T.BooleanType):
        return F.when(c, F.lit("t")).when(~c, F.lit("f"))
    return c.cast("string")


def _array_item(text: Column, inner: bool) -> Column:
    """An element of an array literal: quoted where it would be misread, inner arrays as they are."""
    if inner:
        return text
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    plain = F.regexp_like(text, F.lit(r'^[^{}",\\\s]+$')) & (F.upper(text) != "NULL")
    return F.when(plain, text).when(text.isNotNull(), F.concat(F.lit('"'), escaped, F.lit('"')))


def coerce(df: DataFrame, columns: list[tuple[str, str]], strict: bool = False,
           targets: dict[str, T.DataType] | None = None) -> DataFrame:
    """Apply the warehouse type rule to ``df``; ``targets`` are columns whose type is settled already.

    ``columns`` is the ordered ``(name, pg_type)`` list of the source table;
    the result has exactly these columns, in this order, with the warehouse
    types.  One projection, evaluated inside the scan's codegen stage.
    """
    src_types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name, pg in columns:
        target = (targets or {}).get(name) or spark_type(pg, strict)
        c = F.col("`" + name.replace("`", "``") + "`")
        if isinstance(target, T.StringType) and not isinstance(src_types[name], T.StringType):
            c = _as_text(c, src_types[name], pg)
        elif isinstance(target, T.StringType):
            c = _as_text(c, src_types[name], pg) if _CHAR_MOD.match(pg) else c
        elif src_types[name] != target:
            c = c.cast(target)
        out.append(c.alias(name))
    return df.select(*out)
