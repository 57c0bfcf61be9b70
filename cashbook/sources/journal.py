"""The journal of a snapshot run: what a repeated run need not copy again.

Each committed copy leaves one small file under
``<warehouse>/_journal/<run>/``, named after the object and written whole
before it gets its name, so an entry is there or not, never in part.  A run
that is started again under the same name takes over the copies of its
journal whose versions are still the table's newest, and copies the rest.  The journal goes
when the run has ended.
"""

from __future__ import annotations

import json
from urllib.parse import quote, unquote

from cashbook.sources.tally import Total
from cashbook.sources.warehouse import Warehouse, delete_path, hadoop_path


class RunJournal:
    def __init__(self, warehouse: Warehouse, run: str):
        self.warehouse = warehouse
        self.folder = f"{warehouse.root}/_journal/{quote(run, safe='')}"

    def _entry(self, schema: str, name: str) -> str:
        return f"{self.folder}/{quote(schema, safe='')}@{quote(name, safe='')}"

    def record(self, schema: str, name: str, source: str, location: str, total: Total) -> None:
        spark = self.warehouse.spark
        fs, path = hadoop_path(spark, self._entry(schema, name))
        part = hadoop_path(spark, f"{self._entry(schema, name)}.part")[1]
        out = fs.create(part, True)
        try:
            out.write(bytearray(json.dumps({"source": source, "location": location, "rows": total.rows,
                                            "checksum": total.checksum}).encode()))
        finally:
            out.close()
        fs.delete(path, False)
        if not fs.rename(part, path):
            raise RuntimeError(f"cannot write {path.toString()}")

    def done(self) -> dict[tuple[str, str], tuple[str, str, Total]]:
        """(source, location, total) of the copies that still are their tables' newest versions."""
        spark = self.warehouse.spark
        fs, folder = hadoop_path(spark, self.folder)
        if not fs.exists(folder):
            return {}
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        found = {}
        for text in [n for n in names if not n.endswith(".part")]:
            schema, name = (unquote(x) for x in text.split("@"))
            entry = json.loads(self._text(f"{self.folder}/{text}"))
            newest = self.warehouse.committed(schema, name)[-1:]
            if newest == [entry["location"].rsplit("/", 1)[1]] and self.warehouse.exists(schema, name):
                found[(schema, name)] = (entry["source"], entry["location"], Total(entry["rows"], entry["checksum"]))
        return found

    def _text(self, path: str) -> str:
        fs, p = hadoop_path(self.warehouse.spark, path)
        stream = fs.open(p)
        try:
            jvm = self.warehouse.spark.sparkContext._jvm
            return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def close(self) -> None:
        delete_path(self.warehouse.spark, self.folder)
