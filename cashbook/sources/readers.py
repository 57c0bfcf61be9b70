"""Source readers and the CSV snapshot sink.

CSV layout is the one the source database's ``COPY ... CSV`` produces and
consumes: no header, ``,`` separator, ``"`` quote doubled inside values, a
NULL is an *unquoted* empty field and an empty string is ``""``.  Spark's
writer produces exactly that with minimal quoting; the reader maps unquoted
empty fields to NULL by itself, and its ``nullValue`` is set to a NUL
character -- a character the source's text type cannot hold -- so no real
string (not even ``\\N``) is ever read back as NULL.  Edge spaces are kept,
records may span lines, timestamps keep microseconds.

``multiLine`` reading cannot split a file, so a staged table is written as
many files (one per task, capped by ``maxRecordsPerFile``) and read back with
one task per file.  Files of other writers, such as a dump of one file a
table, are cut into blocks at any byte by :mod:`cashbook.sources.csv_split`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashbook.sources.csv_split import csv_records

CSV_WRITE_OPTIONS = {
    "header": "false", "sep": ",", "quote": '"', "escape": '"', "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX", "dateFormat": "yyyy-MM-dd",
}
CSV_READ_OPTIONS = {
    "header": "false", "sep": ",", "quote": '"', "escape": '"', "encoding": "UTF-8",
    "multiLine": "true", "nullValue": "\u0000", "mode": "FAILFAST", "lineSep": "\n",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
# one record of a one-column file after its line break: a quoted value (line breaks allowed) or a plain line
ONE_COLUMN_RECORD = r'\n("[^"]*+(?:""[^"]*+)*+"|[^"\n]*+)'


def write_csv_snapshot(df: DataFrame, path: str, max_records_per_file: int | None = 1_000_000) -> None:
    """Write ``df`` as headerless, database-compatible CSV files.

    A table of one column is written as lines: its NULL is an empty line,
    which the CSV writer would make ``""``.
    """
    if len(df.columns) == 1:
        value = F.col("`" + df.columns[0].replace("`", "``") + "`").cast("string")
        quoted = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
        plain = F.regexp_like(value, F.lit(r'^[^",\r\n]+$'))
        w = df.select(F.when(value.isNull(), "").when(plain, value).otherwise(quoted).alias("value")).write
    else:
        w = df.write.options(**CSV_WRITE_OPTIONS)
    w = w.mode("errorifexists")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.text(path) if len(df.columns) == 1 else w.csv(path)


def from_text(c: Column, target: T.DataType) -> Column:
    """A value as the database prints it, as ``target``: ``t`` / ``f``, offsets like ``+00``, ``\\x`` bytes.

    Text targets are kept as they are.  A value that the type cannot hold
    (``NaN`` in a decimal, ``infinity`` in a timestamp) fails the job.
    """
    if isinstance(target, T.StringType):
        return c
    if isinstance(target, T.TimestampType):
        c = F.regexp_replace(c, r"(:\d{2}(?:\.\d+)?[+-]\d{2})$", "$1:00")
    elif isinstance(target, T.BinaryType):
        return F.unhex(F.regexp_replace(c, r"^\\\\x", ""))
    return c.cast(target)


def _one_column(records: DataFrame) -> DataFrame:
    """Values of the records of a one-column file, blank ones too (NULL)."""
    value = F.col("record")
    inner = F.replace(F.expr("substring(record, 2, length(record) - 2)"), F.lit('""'), F.lit('"'))
    return records.select(F.when(value.startswith('"'), inner).when(value != "", value).alias("value"))


def _whole_files(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """Records of a one-column file; files with quotes are taken apart whole, one task a file."""
    records = spark.read.text(path)
    if multi_line and not records.filter(F.contains("value", F.lit('"'))).isEmpty():
        body = F.concat(F.lit("\n"), F.regexp_replace("value", r"\r?\n\z", ""))
        records = (spark.read.text(path, wholetext=True).filter("value <> ''")
                   .select(F.explode(F.regexp_extract_all(body, F.lit(ONE_COLUMN_RECORD), F.lit(1))).alias("value")))
    return records.withColumnRenamed("value", "record")


def _fields(records: DataFrame, n: int) -> DataFrame:
    """The ``n`` fields of each record as text; blank records hold none and go."""
    schema = ", ".join(f"c{i} string" for i in range(n))
    # a record is one line to the parser, whatever it holds
    options = {k: v for k, v in CSV_READ_OPTIONS.items() if k != "multiLine"} | {"lineSep": "\u0000"}
    row = F.from_csv("record", F.lit(schema), options)
    return records.filter("record <> ''").select(row.alias("row")).select("row.*")


def read_csv_snapshot(spark: SparkSession, path: str, schema: T.StructType,
                      multi_line: bool = True, split_bytes: int | None = None) -> DataFrame:
    """Read a CSV snapshot into a typed table (columns in file order).

    Every column is read as text and converted by expressions, so values in
    the database's own spelling are understood and text stays as it is.
    ``multi_line=True`` (default) accepts quoted values containing line
    breaks: by default each file is read by one task, with ``split_bytes`` in
    blocks of that size whose quotes are counted first.  For dumps known to
    hold no line breaks inside values, ``multi_line=False`` lets Spark split
    files without that count.
    """
    n = len(schema.fields)
    split = multi_line and split_bytes is not None
    if n == 1:
        raw = _one_column(csv_records(spark, path, split_bytes) if split else _whole_files(spark, path, multi_line))
    elif split:
        raw = _fields(csv_records(spark, path, split_bytes), n)
    else:
        text = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(n)])
        opts = dict(CSV_READ_OPTIONS, multiLine="true" if multi_line else "false")
        raw = spark.read.schema(text).options(**opts).csv(path)
    return raw.select(*[from_text(F.col(c), f.dataType).alias(f.name) for c, f in zip(raw.columns, schema.fields)])


# ---------------------------------------------------------------- JDBC

#: Bytes of table storage that one task reads, and pages sampled for each split to find its bounds.
JDBC_SPLIT_BYTES, SAMPLED_PAGES = 128 << 20, 16
#: Splits of one table at most: each is a statement to the source.
MOST_JDBC_SPLITS = 10_000

def jdbc_options(url: str, table: str | None = None, query: str | None = None,
                 properties: dict | None = None, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None,
                 num_partitions: int | None = None, fetchsize: int = 10_000) -> dict:
    """Options of one JDBC read.

    With a numeric ``partition_column`` and its bounds the read is split into
    ``num_partitions`` range queries, one connection per task; the bounds only
    shape the split, every row is read.
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table / query")
    opts = {"url": url, "fetchsize": str(fetchsize), **(properties or {})}
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    if partition_column is not None:
        if table is None:
            raise ValueError("a partitioned read needs a table, not a query")
        if lower is None or upper is None or not num_partitions:
            raise ValueError("partitioned read needs lower, upper and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower),
                    upperBound=str(upper), numPartitions=str(max(1, int(num_partitions))))
    return opts


def split_count(lo: int, hi: int, rows_per_split: int) -> int:
    """Range splits for keys in [lo, hi]: one per ``rows_per_split`` keys."""
    return max(1, -(-(hi - lo + 1) // max(1, rows_per_split)))


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, num_partitions: int | None = None,
              fetchsize: int = 10_000, rows_per_split: int = 2_000_000) -> DataFrame:
    """Full-table JDBC read, range-split on ``partition_column`` when given.

    The bounds come from one ``min/max`` query pushed to the source; without
    an explicit ``num_partitions`` there is one split per ``rows_per_split``
    key values, so a task reads at most that many rows of a unique key,
    whatever the table size; sparse keys give more and smaller splits.  Each
    running task holds one source connection,
    so concurrent connections are bounded by the splits and the task slots.
    """
    if partition_column is None:
        return spark.read.format("jdbc").options(
            **jdbc_options(url, table=table, properties=properties, fetchsize=fetchsize)).load()
    qcol = '"' + partition_column.replace('"', '""') + '"'
    b = spark.read.format("jdbc").options(**jdbc_options(
        url, query=f"SELECT min({qcol}) AS lo, max({qcol}) AS hi FROM {table}",
        properties=properties)).load().first()
    if b is None or b["lo"] is None:
        return read_jdbc(spark, url, table, properties, None, fetchsize=fetchsize)
    lo, hi = int(b["lo"]), int(b["hi"])
    n = num_partitions or split_count(lo, hi, rows_per_split)
    return spark.read.format("jdbc").options(**jdbc_options(
        url, table=table, properties=properties, partition_column=partition_column,
        lower=lo, upper=hi + 1, num_partitions=n, fetchsize=fetchsize)).load()


def quoted_name(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def depth_predicates(column: str, bounds: list[int]) -> list[str]:
    """One condition a split: the keys between neighbouring ``bounds``; nulls are in the first.

    Whatever the bounds, every row meets exactly one condition; equal bounds
    count once.  Bounds that are quantiles of the key give splits of about
    equal numbers of rows, however sparse or skewed the keys are.
    """
    q, cuts = quoted_name(column), sorted(set(bounds))
    if not cuts:
        return [f"({q} IS NULL OR {q} IS NOT NULL)"]
    first = f"({q} < {cuts[0]} OR {q} IS NULL)"
    return [first, *[f"({q} >= {a} AND {q} < {b})" for a, b in zip(cuts, cuts[1:])], f"({q} >= {cuts[-1]})"]


def page_predicates(column: str, pages: int, splits: int) -> list[str]:
    """One condition a split: ranges of about equal numbers of pages of the table's storage.

    ``column`` holds the row's place (page, slot).  The last range is open,
    so rows on pages added since are read too.
    """
    q = quoted_name(column)
    cuts = sorted({pages * i // splits for i in range(1, splits)} - {0})

    def at(page: int) -> str:
        return f"'({page},0)'::tid"
    if not cuts:
        return [f"({q} IS NOT NULL)"]
    return [f"({q} < {at(cuts[0])})", *[f"({q} >= {at(a)} AND {q} < {at(b)})" for a, b in zip(cuts, cuts[1:])],
            f"({q} >= {at(cuts[-1])})"]


def quantile_query(table: str, column: str, splits: int, pages: int) -> str:
    """Asks for the inner bounds of ``splits`` ranges of about equal numbers of rows, from a sample of whole pages."""
    percent = min(100.0, 100.0 * SAMPLED_PAGES * splits / max(1, pages))
    steps = ", ".join(f"{i / splits:.6f}" for i in range(1, splits))
    return (f"SELECT CAST(unnest(percentile_disc(ARRAY[{steps}]) WITHIN GROUP (ORDER BY {quoted_name(column)})) "
            f"AS bigint) AS bound FROM {table} TABLESAMPLE SYSTEM ({percent:.6f}) REPEATABLE (1)")


def read_jdbc_splits(spark: SparkSession, url: str, table: str, predicates: list[str], properties: dict | None = None,
                     fetchsize: int = 10_000) -> DataFrame:
    """Full-table JDBC read, one task and connection for each of ``predicates``."""
    options = {"fetchsize": str(fetchsize), **(properties or {})}
    return spark.read.options(**options).jdbc(url, table, predicates=predicates, properties={})
