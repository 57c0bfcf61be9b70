"""The warehouse sink: full refresh of a table by write-then-swap.

Each refresh writes the complete new contents to a fresh folder
``<root>/<schema>/<name>/v<time>-<id>`` through Spark's commit protocol
(all-or-nothing, task retries after a lost executor are safe), and only then
points the catalogue table at it.  Readers therefore see either the old or
the new snapshot, never an empty or half-loaded table, and repeated refreshes
never accumulate rows.  Only where the columns changed must the catalogue
entry be dropped and made anew, and a reader may miss it for that moment.
Superseded folders are removed, keeping the previous committed one for
readers that are still scanning it; folders of failed attempts do not count,
and go once they are old.

Catalogue names are global to a metastore, so two warehouses (one per
language, say) need a ``namespace`` each: it prefixes their schemas.  A table
name that already belongs to another root is an error, never overwritten.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def quote_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def qualified(schema: str, name: str) -> str:
    return f"{quote_ident(schema)}.{quote_ident(name)}"


#: Age at which the folder of an uncommitted refresh is taken for abandoned.
ABANDONED_S = 24 * 3600


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, keep_versions: int = 2, namespace: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep_versions = max(1, keep_versions)
        self.namespace = namespace

    def schema_name(self, schema: str) -> str:
        """Catalogue schema of a warehouse schema."""
        return f"{self.namespace}_{schema}" if self.namespace else schema

    def qualified(self, schema: str, name: str) -> str:
        return qualified(self.schema_name(schema), name)

    # -- layout ---------------------------------------------------------
    def table_dir(self, schema: str, name: str) -> str:
        return f"{self.root}/{schema}/{name}"

    def new_location(self, schema: str, name: str) -> str:
        return f"{self.table_dir(schema, name)}/v{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:8]}"

    # -- catalogue ------------------------------------------------------
    def ensure_schema(self, schema: str) -> None:
        """``CREATE SCHEMA IF NOT EXISTS``."""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quote_ident(self.schema_name(schema))}")

    def exists(self, schema: str, name: str) -> bool:
        return self.spark.catalog.tableExists(self.qualified(schema, name))

    def is_view(self, schema: str, name: str) -> bool:
        return self.spark.catalog.getTable(self.qualified(schema, name)).tableType in ("VIEW", "TEMPORARY")

    def _point(self, schema: str, name: str, location: str) -> None:
        qn = self.qualified(schema, name)
        loc = location.replace("'", "\\'")
        if self.exists(schema, name) and self.is_view(schema, name):
            # the object was a view in an earlier run and is a table now
            self.spark.sql(f"DROP VIEW {qn}")
        if self.exists(schema, name):
            self._check_own(schema, name)
            old = self.spark.table(qn).schema
            new = self.spark.read.parquet(location).schema
            if [(f.name, f.dataType) for f in old] == [(f.name, f.dataType) for f in new]:
                self.spark.sql(f"ALTER TABLE {qn} SET LOCATION '{loc}'")
                self.spark.sql(f"REFRESH TABLE {qn}")
                return
            # the column set changed: the catalogue entry itself must be replaced
            self.spark.sql(f"DROP TABLE {qn}")
        self.spark.sql(f"CREATE TABLE {qn} USING parquet LOCATION '{loc}'")

    def _check_own(self, schema: str, name: str) -> None:
        """The catalogue table must be one of this root's versions."""
        row = (self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.qualified(schema, name)}")
               .filter("col_name = 'Location'").first())
        fs, own = self._fs(self.table_dir(schema, name))
        if row and not row["data_type"].startswith(fs.makeQualified(own).toString().rstrip("/") + "/"):
            raise RuntimeError(f"{self.qualified(schema, name)} belongs to {row['data_type']}; "
                               f"give this warehouse a namespace of its own")

    # -- refresh --------------------------------------------------------
    def replace(self, schema: str, name: str, df: DataFrame, max_records_per_file: int | None = None,
                check: Callable[[str], None] | None = None) -> str:
        """Replace the table's contents with ``df``; returns the new location.

        ``check`` sees the new version before readers do; if it raises, the
        version goes and the table stays as it was.
        """
        self.ensure_schema(schema)
        location = self.new_location(schema, name)
        w = df.write.mode("errorifexists").format("parquet")
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", str(max_records_per_file))
        w.save(location)
        if check is not None:
            try:
                check(location)
            except Exception:
                delete_path(self.spark, location)
                raise
        self._point(schema, name, location)
        self._prune(schema, name)
        return location

    def table(self, schema: str, name: str) -> DataFrame:
        return self.spark.table(self.qualified(schema, name))

    # -- housekeeping ---------------------------------------------------
    def _fs(self, path: str):
        return hadoop_path(self.spark, path)

    def versions(self, schema: str, name: str) -> list[str]:
        fs, p = self._fs(self.table_dir(schema, name))
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
        return sorted(n for n in names if n.startswith("v"))

    def attach(self) -> list[tuple[str, str]]:
        """Register every table of this warehouse at its newest committed version.

        For a new session on a catalogue that does not persist (Spark's
        in-memory catalogue); with a persistent metastore the registrations
        are already there.  Only versions with a ``_SUCCESS`` marker count.
        """
        fs, root = self._fs(self.root)
        if not fs.exists(root):
            return []
        attached = []
        for sd in fs.listStatus(root):
            schema = sd.getPath().getName()
            if not sd.isDirectory() or schema.startswith("_"):
                continue
            for td in fs.listStatus(sd.getPath()):
                name = td.getPath().getName()
                done = self.committed(schema, name)
                if done:
                    self.ensure_schema(schema)
                    self._point(schema, name, f"{self.table_dir(schema, name)}/{done[-1]}")
                    attached.append((schema, name))
        return sorted(attached)

    def committed(self, schema: str, name: str) -> list[str]:
        """Versions whose write was committed, oldest first."""
        base = self.table_dir(schema, name)
        return [v for v in self.versions(schema, name)
                if self._fs(f"{base}/{v}/_SUCCESS")[0].exists(self._fs(f"{base}/{v}/_SUCCESS")[1])]

    def _prune(self, schema: str, name: str) -> None:
        """Remove committed versions beyond those kept, and abandoned attempts."""
        done = self.committed(schema, name)
        old = set(done[:-self.keep_versions])
        limit = (time.time() - ABANDONED_S) * 1000
        for v in self.versions(schema, name):
            if v in old or (v not in done and int(v[1:14]) < limit):
                delete_path(self.spark, f"{self.table_dir(schema, name)}/{v}")


def hadoop_path(spark: SparkSession, path: str):
    """(FileSystem, Path) for ``path`` on whatever storage the cluster uses."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder this package wrote (superseded versions, finished stages)."""
    fs, p = hadoop_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)
