"""One full warehouse run, as a scheduler calls it.

    snapshot every source into the warehouse (later-listed source wins)
      -> replay the source views
      -> rebuild the P&L model with its club / local-time layout

A view that cannot be replayed stops the run before the model is built.

The run is idempotent: every table and the model are replaced by
write-then-swap, so a retried or repeated run leaves the same state and
readers never see a half-written table.  A run with a name that failed takes up
where it stopped when it is started again under that name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from cashbook.plans.model import refresh_model
from cashbook.session import scratch_dir
from cashbook.sources.snapshot import SnapshotReport, Source, snapshot_sources
from cashbook.sources.warehouse import Warehouse


@dataclass
class RunReport:
    snapshot: SnapshotReport
    model_location: str


def refresh_warehouse(spark: SparkSession, sources: list[Source], warehouse: Warehouse,
                      lang: str = "en", *, staging: str = "direct", stage_root: str | None = None,
                      model_partitions: int | None = None, parallelism: int = 4,
                      retries: int = 3, strict_types: bool = False, layout: str = "curve", run: str | None = None) -> RunReport:
    if staging == "csv" and stage_root is None:
        stage_root = scratch_dir(spark, "stage")
    rep = snapshot_sources(spark, sources, warehouse, staging=staging, stage_root=stage_root,
                           strict_types=strict_types, parallelism=parallelism, retries=retries, run=run)
    loc = refresh_model(spark, warehouse, lang, partitions=model_partitions, layout=layout)
    return RunReport(rep, loc)
