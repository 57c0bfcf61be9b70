"""Readers for the driver-provided parquet tables (``<sf_dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_READS: dict = {}


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """The parquet table; one DataFrame per (session, file, spread).

    The files are read-only inputs, so the lazily evaluated DataFrame (schema
    and file listing) is resolved once per session and reused.

    ``spread=True``: each testdata table is one file with a single row group,
    and a row group is the unit of scan parallelism, so the scan -- and all
    work fused after it -- runs as one task.  A small input is therefore
    hash-repartitioned over the cores on its leading id column: deterministic
    on retry without the sort a round-robin repartition needs, and the other
    columns can still be pruned below the shuffle.  An input of as many files
    as cores keeps its scan parallelism; shuffling it would only add work.
    """
    if name not in TABLES:
        raise KeyError(name)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path, spread)
    df = _READS.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        cores = spark.sparkContext.defaultParallelism
        if spread and len(df.inputFiles()) < cores:
            df = df.repartition(cores, df.columns[0])
        _READS[key] = df
    return df
