"""Session construction and the shared scratch location.

Scratch output (staged CSV, warehouse copies made by checks) always goes under
the folder the cluster names in ``spark.checkpoint.dir``; a private temporary
folder is made only by a ``local`` master without that setting, i.e. in tests.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package relies on.  AQE re-plans joins from real
# shuffle sizes and splits skewed join partitions; ANSI mode makes a bad money
# string fail the job instead of silently becoming NULL.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def get_session(master: str = "local[8]", app: str = "cashbook",
                shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = {**ENGINE_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g"}
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for cut lineage and scratch tables.

    Read from the session; only a ``local`` master without one gets a private
    folder, registered as the checkpoint directory.  On a cluster a folder of
    one machine would hide its files from the others, so that is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current.rstrip("/")
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="cashbook-ckpt-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/cashbook/{tag}-{uuid.uuid4().hex[:12]}"
