"""Command line entry: ``python -m cashbook run config.json``.

Config (JSON)::

    {
      "warehouse": "hdfs:///warehouse/en",       # table root (shared storage)
      "namespace": "en",                         # optional; one per warehouse on a shared metastore
      "lang": "en",                              # model labels: en | ru
      "staging": "direct",                       # or "csv" (staged in spark.checkpoint.dir)
      "model_partitions": 2000,                  # optional; default: shuffle partitions + AQE
      "sources": [                               # later-listed source wins on equal names
        {"name": "dump", "files": "hdfs:///dumps/main", "format": "csv",
         "columns": {"billing.payment": [["id", "bigint"], ["amount", "numeric(12,2)"]]}},
        {"name": "main", "jdbc_url": "jdbc:postgresql://host:5432/main",
         "properties": {"user": "etl", "driver": "org.postgresql.Driver"},
         "password_env": "MAIN_DB_PASSWORD",     # optional: name of an environment variable
         "partition_columns": {"billing.payment": "id"},
         "num_partitions": null}                 # default: one split per 2M values of the key, or of
                                                 # the table's first integer column
      ]
    }

The JDBC driver jar is supplied by the deployment (``--jars`` / ``spark.jars``).
"""

from __future__ import annotations

import argparse
import json
import os
import sys


def build_sources(spark, cfg: dict):
    from cashbook.sources.snapshot import FileSource, JdbcSource
    out = []
    for s in cfg["sources"]:
        if "files" in s:
            cols = {tuple(k.split(".", 1)): [tuple(c) for c in v]
                    for k, v in s.get("columns", {}).items()}
            views = {tuple(k.split(".", 1)): v for k, v in s.get("views", {}).items()}
            out.append(FileSource(spark, s["name"], s["files"], s.get("format", "parquet"),
                                  cols, views, bool(s.get("multi_line", True))))
            continue
        props = dict(s.get("properties", {}))
        if s.get("password_env"):
            props["password"] = os.environ[s["password_env"]]
        parts = {tuple(k.split(".", 1)): v for k, v in s.get("partition_columns", {}).items()}
        n = s.get("num_partitions")
        out.append(JdbcSource(spark, s["name"], s["jdbc_url"], props, parts,
                              int(n) if n else None))
    return out


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cashbook")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="snapshot all sources, replay views, rebuild the model")
    run.add_argument("config")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from cashbook.plans.pipeline import refresh_warehouse
    from cashbook.session import apply_engine_conf
    from cashbook.sources.warehouse import Warehouse

    with open(args.config, encoding="utf-8") as f:
        cfg = json.load(f)
    spark = SparkSession.builder.appName("cashbook").getOrCreate()
    apply_engine_conf(spark)
    rep = refresh_warehouse(spark, build_sources(spark, cfg),
                            Warehouse(spark, cfg["warehouse"], namespace=cfg.get("namespace", "")),
                            cfg.get("lang", "en"), staging=cfg.get("staging", "direct"),
                            model_partitions=cfg.get("model_partitions"))
    print(json.dumps({"copied": [".".join(c[:2]) for c in rep.snapshot.copied],
                      "views": [".".join(v) for v in (rep.snapshot.views.created
                                                      if rep.snapshot.views else [])],
                      "model": rep.model_location}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
