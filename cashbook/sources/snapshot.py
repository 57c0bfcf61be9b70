"""The snapshot job: copy every selected object of one or more sources.

    listing -> selection (kinds, exclusions) -> precedence across sources
      -> per table: read -> coerce types -> [stage as CSV] -> write-then-swap
      -> afterwards: replay the views

Each table copy is one distributed Spark job (read -> project -> write); the
driver only walks the list of objects, which is catalogue metadata.  Copies
run concurrently from a small thread pool so that many small tables keep a
large cluster busy, and each copy is retried as a whole (after Spark's own
task retries are exhausted, e.g. when a source connection drops).
"""

from __future__ import annotations

import logging
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable, Protocol

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cashbook.functions.numeric import fit_numeric, split_unfit
from cashbook.functions.types import coerce, pg_type_of, spark_type
from cashbook.sources import catalog as C
from cashbook.sources.csv_split import SPLIT_BYTES
from cashbook.sources.journal import RunJournal
from cashbook.sources.readers import (JDBC_SPLIT_BYTES, MOST_JDBC_SPLITS, depth_predicates, page_predicates,
                                      quantile_query, quoted_name, read_csv_snapshot, read_jdbc, read_jdbc_splits,
                                      write_csv_snapshot)
from cashbook.sources.tally import Tally, Total
from cashbook.sources.views import ViewReport, replay_views
from cashbook.sources.warehouse import Warehouse, delete_path, hadoop_path

log = logging.getLogger(__name__)

#: Name under which a row's place in storage is read where a table is split by pages.
PLACE = "cashbook_place"


class Source(Protocol):
    name: str

    def objects(self) -> DataFrame: ...                      # (schema, name, kind)
    def read(self, schema: str, name: str) -> DataFrame: ...
    def columns(self, schema: str, name: str) -> list[tuple[str, str]]: ...
    def view_sql(self, schema: str, name: str) -> str | None: ...
    def sizes(self) -> dict[tuple[str, str], int]: ...       # bytes of the objects, where known


@dataclass
class SourceObject:
    kind: str                                   # 'r', 'm', 'v', 'p', ...
    frame: Callable[[], DataFrame] | None = None  # data of a table / matview
    declared: dict[str, str] = field(default_factory=dict)  # column -> source type spelling
    sql: str | None = None                      # Spark SQL text of a view
    size: int = 0                               # bytes of its data, where known


class FrameSource:
    """A source whose objects are DataFrames (files, other catalogues, derived data).

    Column types default to the spelling the source database would print for
    the Spark type; ``declared`` overrides them per column (e.g. a money
    column that is ``numeric(12,2)`` at the source).
    """

    def __init__(self, spark: SparkSession, name: str, objects: dict[tuple[str, str], SourceObject]):
        self.spark, self.name, self._objects = spark, name, objects

    def objects(self) -> DataFrame:
        rows = [(s, n, o.kind) for (s, n), o in self._objects.items()]
        return self.spark.createDataFrame(rows, C.OBJECT_SCHEMA)

    def read(self, schema: str, name: str) -> DataFrame:
        return self._objects[(schema, name)].frame()

    def columns(self, schema: str, name: str) -> list[tuple[str, str]]:
        obj = self._objects[(schema, name)]
        return [(f.name, obj.declared.get(f.name, pg_type_of(f.dataType)))
                for f in self.read(schema, name).schema.fields]

    def view_sql(self, schema: str, name: str) -> str | None:
        return self._objects[(schema, name)].sql

    def sizes(self) -> dict[tuple[str, str], int]:
        return {key: o.size for key, o in self._objects.items()}


class JdbcSource:
    """A PostgreSQL source read over JDBC (driver jar supplied by the deployment).

    Listing, column types and view texts come from the source's standard
    metadata, one query each; a materialized view, which has none there, has
    the columns Spark reads from it.  A table is read through a select list that casts every column
    the warehouse stores as text to text at the source, so that it is printed
    there; timestamps without zone are read as such.  A large table is read in
    splits of about equal size: by quantiles of
    ``partition_columns[(schema, name)]``, by default its first integer column,
    and where it has none by ranges of its pages.  ``numeric_as_text`` gives
    unbounded numbers as text, for ``most_unfit`` of the copy.  View texts are returned as stored; they must be valid
    Spark SQL to replay.
    """

    def __init__(self, spark: SparkSession, name: str, url: str, properties: dict | None = None,
                 partition_columns: dict[tuple[str, str], str] | None = None,
                 num_partitions: int | None = None, query_timeout_s: int = 1800, numeric_as_text: bool = False):
        self.spark, self.name, self.url, self.numeric_as_text = spark, name, url, numeric_as_text
        # every statement sent to the source (one per split) is capped, 30 min by default
        self.properties = {"queryTimeout": str(query_timeout_s), "preferTimestampNTZ": "true",
                           **dict(properties or {})}
        self.partition_columns = dict(partition_columns or {})
        self.num_partitions = num_partitions
        self._asked: dict[str, dict[tuple[str, str], list[Row]]] = {}

    def _query(self, sql: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(
            url=self.url, query=sql, **self.properties).load()

    def _metadata(self, sql: str) -> dict[tuple[str, str], list[Row]]:
        """Rows of a metadata query by object; asked once."""
        if sql not in self._asked:
            rows: dict[tuple[str, str], list[Row]] = {}
            for r in self._query(sql).collect():
                rows.setdefault((r["schema"], r["name"]), []).append(r)
            self._asked[sql] = rows
        return self._asked[sql]

    def objects(self) -> DataFrame:
        rows = [(s, n, C.KIND_OF[r["type"]]) for (s, n), found in self._metadata(C.RELATIONS_QUERY).items()
                for r in found if r["type"] in C.KIND_OF]
        return self.spark.createDataFrame(rows, C.OBJECT_SCHEMA)

    def sizes(self) -> dict[tuple[str, str], int]:
        return {key: int(rows[0]["bytes"] or 0) for key, rows in self._metadata(C.SIZES_QUERY).items()}

    def select_list(self, schema: str, name: str) -> str:
        """Columns in order, cast to text at the source where the warehouse stores text."""
        def one(column: str, pg_type: str) -> str:
            q = quoted_name(column)
            kept = pg_type in ("text", "varchar", "character varying")
            text = isinstance(spark_type(pg_type), T.StringType) or (self.numeric_as_text and pg_type == "numeric")
            return f"CAST({q} AS text) AS {q}" if text and not kept else q
        return ", ".join(one(c, t) for c, t in self.columns(schema, name))

    def split_column(self, schema: str, name: str) -> str | None:
        given = self.partition_columns.get((schema, name))
        return given or next((c for c, t in self.columns(schema, name)
                              if t in ("integer", "bigint", "smallint")), None)

    def _table(self, schema: str, name: str) -> str:
        return quoted_name(schema) + "." + quoted_name(name)

    def storage(self, schema: str, name: str) -> tuple[int, int]:
        """Pages of the table's storage and bytes a page; views and foreign tables have none."""
        name = self._table(schema, name).replace("'", "''")
        row = self._query(f"SELECT pg_relation_size(to_regclass('{name}')) AS bytes, "
                          "CAST(current_setting('block_size') AS bigint) AS page").first()
        return int(row["bytes"] or 0) // int(row["page"]), int(row["page"])

    def splits(self, schema: str, name: str) -> list[str]:
        """Conditions of the table's splits; none where one task reads it whole."""
        pages, page = self.storage(schema, name)
        n = self.num_partitions or min(MOST_JDBC_SPLITS, -(-pages * page // JDBC_SPLIT_BYTES))
        if n < 2 or not pages:
            return []
        column = self.split_column(schema, name)
        if column is None:
            return page_predicates(PLACE, pages, n)
        bounds = self._query(quantile_query(self._table(schema, name), column, n, pages)).collect()
        return depth_predicates(column, [int(r["bound"]) for r in bounds if r["bound"] is not None])

    def read(self, schema: str, name: str) -> DataFrame:
        columns, table = self.select_list(schema, name), self._table(schema, name)
        splits = self.splits(schema, name)
        if not splits:
            return read_jdbc(self.spark, self.url, f"(SELECT {columns} FROM {table}) AS src", self.properties)
        if not splits[0].startswith(f"({quoted_name(PLACE)}"):
            return read_jdbc_splits(self.spark, self.url, f"(SELECT {columns} FROM {table}) AS src", splits,
                                    self.properties)
        placed = f"(SELECT {columns}, ctid AS {quoted_name(PLACE)} FROM {table}) AS src"
        return read_jdbc_splits(self.spark, self.url, placed, splits, self.properties).drop(PLACE)

    def columns(self, schema: str, name: str) -> list[tuple[str, str]]:
        listed = self._metadata(C.COLUMNS_QUERY).get((schema, name))
        if listed is None:
            return [(f.name, pg_type_of(f.dataType)) for f in self._query(
                f"SELECT * FROM {self._table(schema, name)}").schema.fields]
        return [(r["column"], C.type_spelling(r["data_type"], r["domain_name"], r["length"], r["digits"], r["scale"],
                                              r["fraction"])) for r in sorted(listed, key=lambda r: r["position"])]

    def view_sql(self, schema: str, name: str) -> str | None:
        rows = self._metadata(C.VIEW_TEXTS_QUERY).get((schema, name))
        text = rows[0]["definition"] if rows else None
        return text.rstrip().rstrip(";") if text else None


class FileSource:
    """A source given as files: ``<root>/<schema>/<table>/`` folders.

    ``fmt="csv"``: headerless, database-style CSV snapshots (the layout of
    :mod:`cashbook.sources.readers`); their columns must be declared in order
    as ``(name, source type)``, the way the source catalogue lists them, and
    are read with the warehouse types; a column that is stored as text is
    kept byte for byte.  A file is read in blocks of ``split_bytes``, also
    where values hold line breaks; ``multi_line=False`` saves the count of
    its quotes where none does.  ``numeric_as_text`` gives unbounded numbers
    as text, for ``most_unfit`` of the copy.  ``fmt="parquet"``: the schema
    comes from the files; declared types are optional overrides.  Listing the
    folders is a metadata call on the driver; the data is read by the
    executors.
    """

    def __init__(self, spark: SparkSession, name: str, root: str, fmt: str = "parquet",
                 columns: dict[tuple[str, str], list[tuple[str, str]]] | None = None,
                 views: dict[tuple[str, str], str] | None = None, multi_line: bool = True,
                 split_bytes: int = SPLIT_BYTES, numeric_as_text: bool = False):
        if fmt not in ("parquet", "csv"):
            raise ValueError(f"unknown format {fmt!r}")
        self.spark, self.name, self.root, self.fmt = spark, name, root.rstrip("/"), fmt
        self.multi_line, self.split_bytes, self.numeric_as_text = multi_line, split_bytes, numeric_as_text
        self._columns = dict(columns or {})
        self._views = dict(views or {})

    def _dirs(self) -> list[tuple[str, str]]:
        fs, p = hadoop_path(self.spark, self.root)
        out = []
        for sd in fs.listStatus(p):
            if not sd.isDirectory() or sd.getPath().getName().startswith(("_", ".")):
                continue
            for td in fs.listStatus(sd.getPath()):
                if td.isDirectory() and not td.getPath().getName().startswith(("_", ".")):
                    out.append((sd.getPath().getName(), td.getPath().getName()))
        return sorted(out)

    def objects(self) -> DataFrame:
        rows = [(s, n, "r") for s, n in self._dirs()] + [(s, n, "v") for s, n in self._views]
        return self.spark.createDataFrame(rows, C.OBJECT_SCHEMA)

    def read(self, schema: str, name: str) -> DataFrame:
        path = f"{self.root}/{schema}/{name}"
        if self.fmt == "parquet":
            return self.spark.read.parquet(path)
        cols = self._columns.get((schema, name))
        if not cols:
            raise KeyError(f"CSV table {schema}.{name} needs its declared columns")
        read_schema = T.StructType([T.StructField(
            c, T.StringType() if self.numeric_as_text and t == "numeric" else spark_type(t), True) for c, t in cols])
        return read_csv_snapshot(self.spark, path, read_schema, self.multi_line, self.split_bytes)

    def columns(self, schema: str, name: str) -> list[tuple[str, str]]:
        declared = self._columns.get((schema, name)) or []
        if self.fmt == "csv":
            return list(declared)
        over = dict(declared)
        return [(f.name, over.get(f.name, pg_type_of(f.dataType)))
                for f in self.read(schema, name).schema.fields]

    def view_sql(self, schema: str, name: str) -> str | None:
        return self._views.get((schema, name))

    def sizes(self) -> dict[tuple[str, str], int]:
        out = {}
        for schema, name in self._dirs():
            fs, p = hadoop_path(self.spark, f"{self.root}/{schema}/{name}")
            out[(schema, name)] = int(fs.getContentSummary(p).getLength())
        return out


class ViewsFailed(RuntimeError):
    """Some views could not be replayed; ``report`` names them."""

    def __init__(self, report: ViewReport):
        lines = [f"{s}.{n}: {why}" for (s, n), why in report.failed.items()]
        lines += [f"{s}.{n}: no definition" for s, n in report.missing_sql]
        super().__init__("views not replayed:\n" + "\n".join(lines))
        self.report = report


@dataclass
class SnapshotReport:
    copied: list[tuple[str, str, str, int]] = field(default_factory=list)  # schema, name, kind, source
    locations: dict[tuple[str, str], str] = field(default_factory=dict)
    totals: dict[tuple[str, str], Total] = field(default_factory=dict)
    views: ViewReport | None = None


class CopyMismatch(RuntimeError):
    """A copy does not hold the rows that were read."""


def copy_verified(source: Source, schema: str, name: str, warehouse: Warehouse, *,
                  staging: str = "direct", stage_root: str | None = None, strict_types: bool = False,
                  max_records_per_file: int | None = None,
                  most_unfit: float | None = None) -> tuple[str, Total]:
    """Copy one table: read -> coerce -> [CSV stage] -> write, compare, swap; its location and total.

    The rows are counted and summed up while they are read from the source,
    and with a stage once more while they are loaded from it; the row counts
    in the footers of the written files are the third figure.  Where they
    differ the new version goes and :class:`CopyMismatch` is raised.  A CSV
    stage is removed once the warehouse copy is committed.

    With ``most_unfit``, columns of unbounded ``numeric`` that the source gives
    as text get the decimal that holds them, or stay text
    (:mod:`cashbook.functions.numeric`); rows set aside for that go to the
    table ``<name>_unfit``.
    """
    df, columns = source.read(schema, name), source.columns(schema, name)
    if most_unfit is not None:
        texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
        fits = fit_numeric(df, [c for c, t in columns if t == "numeric" and c in texts], most_unfit)
        df, unfit = split_unfit(df, fits)
        if any(fit.unfit for fit in fits) or warehouse.exists(schema, f"{name}_unfit"):
            warehouse.replace(schema, f"{name}_unfit", unfit, max_records_per_file)
        df = coerce(df, columns, strict_types, {fit.column: fit.target for fit in fits})
    else:
        df = coerce(df, columns, strict_types)
    read = Tally()

    def check(location: str, loaded: Tally | None = None) -> None:
        want = read.result()
        got = loaded.result() if loaded is not None else want
        stored = df.sparkSession.read.parquet(location).count()          # from the footers
        if got != want or stored != want.rows:
            raise CopyMismatch(f"{schema}.{name}: read {want}, loaded {got}, stored {stored} rows")

    if staging == "direct":
        return warehouse.replace(schema, name, read.of(df), max_records_per_file, check), read.result()
    if staging != "csv":
        raise ValueError(f"unknown staging {staging!r}")
    if not stage_root:
        raise ValueError("CSV staging needs stage_root")
    stage = f"{stage_root.rstrip('/')}/{schema}/{name}/{uuid.uuid4().hex}"
    write_csv_snapshot(read.of(df), stage)
    loaded = Tally()
    loc = warehouse.replace(schema, name, loaded.of(read_csv_snapshot(df.sparkSession, stage, df.schema)),
                            max_records_per_file, lambda location: check(location, loaded))
    delete_path(df.sparkSession, stage)
    return loc, read.result()


def copy_table(source: Source, schema: str, name: str, warehouse: Warehouse, **options) -> str:
    """:func:`copy_verified`; the location alone."""
    return copy_verified(source, schema, name, warehouse, **options)[0]


def _with_retries(fn, attempts: int, what: str):
    for i in range(1, attempts + 1):
        try:
            return fn()
        except Exception:  # noqa: BLE001 - whole-copy retry, re-raised at the end
            log.warning("copy of %s failed (attempt %d/%d)", what, i, attempts, exc_info=True)
            if i == attempts:
                raise


def largest_first(items: list, size: Callable) -> list:
    """Longest first: with a few workers that each take the next item, none is left with a large one at the end."""
    return sorted(items, key=lambda item: -size(item))


def snapshot_sources(spark: SparkSession, sources: list[Source], warehouse: Warehouse, *,
                     staging: str = "direct", stage_root: str | None = None,
                     strict_types: bool = False, parallelism: int = 4, retries: int = 3,
                     exclude_schemas: tuple[str, ...] = C.EXCLUDE_SCHEMAS,
                     exclude_tables: tuple[tuple[str, str], ...] = C.EXCLUDE_TABLES,
                     replay: bool = True, max_records_per_file: int | None = None,
                     allow_failed_views: bool = False, data_kinds: tuple[str, ...] = C.DATA_KINDS,
                     run: str | None = None, most_unfit: float | None = None) -> SnapshotReport:
    """S2 + S13: copy all selected objects of ``sources`` into ``warehouse``.

    Tables and materialized views first (S17: a matview is copied as data),
    then the views.  Where several sources hold the same (schema, name), the
    last listed source wins.  The largest objects are copied first, so that
    none of them starts when the others are done.  A copy is tried once and
    ``retries`` times more.  With a name for the ``run``, a run that failed and
    is started again under that name copies only what is not committed yet.
    A view that cannot be created, or has no text, is an error
    (:class:`ViewsFailed`, after all others are in place) unless
    ``allow_failed_views``.
    """
    listings = [C.select_objects(s.objects(), tuple(data_kinds) + C.VIEW_KINDS,
                                 exclude_schemas, exclude_tables) for s in sources]
    chosen = C.with_precedence(listings).orderBy("schema", "name").collect()
    tables = [(r["schema"], r["name"], r["kind"], r["source"]) for r in chosen
              if r["kind"] in data_kinds]
    views = [(r["schema"], r["name"], r["source"]) for r in chosen if r["kind"] in C.VIEW_KINDS]

    for schema in sorted({t[0] for t in tables} | {v[0] for v in views}):
        warehouse.ensure_schema(schema)

    report = SnapshotReport()
    journal = RunJournal(warehouse, run) if run else None
    done = journal.done() if journal else {}
    sizes = [s.sizes() for s in sources]
    todo = []
    for schema, name, kind, src in tables:
        source, location, total = done.get((schema, name), (None, None, None))
        if source == sources[src].name:
            report.copied.append((schema, name, kind, src))
            report.locations[(schema, name)], report.totals[(schema, name)] = location, total
        else:
            todo.append((schema, name, kind, src))
    todo = largest_first(todo, lambda item: sizes[item[3]].get(item[:2], 0))

    failed = threading.Event()

    def one(item):
        if failed.is_set():                    # nothing is started after a copy that failed for good
            return None
        try:
            return copy(item)
        except Exception:
            failed.set()
            raise

    def copy(item):
        schema, name, kind, src = item
        sc = spark.sparkContext
        # per-thread job properties: a readable description, and a pool that a
        # cluster running the FAIR scheduler shares evenly among the copies
        sc.setLocalProperty("spark.scheduler.pool", "cashbook-copy")
        sc.setJobDescription(f"copy {schema}.{name} from {sources[src].name}")
        done = _with_retries(lambda: copy_verified(
            sources[src], schema, name, warehouse, staging=staging, stage_root=stage_root,
            strict_types=strict_types, max_records_per_file=max_records_per_file, most_unfit=most_unfit),
            1 + retries, f"{schema}.{name}")
        if journal:
            journal.record(schema, name, sources[src].name, *done)
        return item, *done

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for future in [pool.submit(one, item) for item in todo]:
            if (copied := future.result()) is not None:
                (schema, name, kind, src), loc, total = copied
                report.copied.append((schema, name, kind, src))
                report.locations[(schema, name)], report.totals[(schema, name)] = loc, total
    report.copied.sort()

    if replay and views:
        report.views = replay_views(
            spark, [(s, n, sources[src].view_sql(s, n)) for s, n, src in views], warehouse=warehouse)
        if (report.views.failed or report.views.missing_sql) and not allow_failed_views:
            raise ViewsFailed(report.views)
    if journal:
        journal.close()
    return report


def manifest(spark: SparkSession, report: SnapshotReport, warehouse: Warehouse) -> DataFrame:
    """One row per copied object and replayed view: schema_name, table_name, kind, n_rows, checksum.

    Both are read back from the warehouse, one aggregate per object.  The
    checksum adds up the leading 32 bits of each row's md5 over its integer
    and text columns (joined by ``|``, NULL as ``~``), so it does not depend
    on row order.
    """
    def described(df: DataFrame, schema: str, name: str, kind: str) -> DataFrame:
        plain = [F.coalesce(F.col("`" + f.name.replace("`", "``") + "`").cast("string"), F.lit("~"))
                 for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.IntegralType))]
        digest = F.conv(F.substring(F.md5(F.concat_ws("|", *plain)), 1, 8), 16, 10).cast("bigint")
        return df.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.coalesce(F.sum(digest), F.lit(0)).alias("checksum")).select(
            F.lit(schema).alias("schema_name"), F.lit(name).alias("table_name"), F.lit(kind).alias("kind"),
            "n_rows", "checksum")

    parts = [described(spark.read.parquet(report.locations[(s, n)]), s, n, kind) for s, n, kind, _ in report.copied]
    parts += [described(warehouse.table(s, n), s, n, "v") for s, n in (report.views.created if report.views else [])]
    if not parts:
        return spark.createDataFrame(
            [], "schema_name string, table_name string, kind string, n_rows bigint, checksum bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
