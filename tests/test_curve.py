"""The layout along a space-filling curve over club and local time."""
import datetime as dt
import glob

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest

from cashbook.plans import curve, model as M, pnl
from cashbook.session import scratch_dir
from cashbook.sources.fixtures import fixture_tables
from helpers import bag

SF = "/root/testdata/sf0.01"


def test_curve_visits_neighbours():
    for bits in range(1, 6):
        d = curve.hilbert_positions(bits)
        where = np.empty((d.size, 2), dtype=int)
        where[d.reshape(-1)] = np.argwhere(d >= 0)
        assert sorted(d.reshape(-1).tolist()) == list(range(4 ** bits))
        assert (np.abs(np.diff(where, axis=0)).sum(axis=1) == 1).all()


def test_partitions_are_even_and_hot_cells_are_split():
    r = np.random.default_rng(3)
    club = np.where(r.random(20_000) < 1 / 3, 7, r.integers(1, 60, 20_000)).astype(float)
    club[:500] = np.nan
    second = (r.beta(2, 5, 20_000) * 3e8).astype(np.int64)
    second[5000:11_000] = 123_456_789                                 # one moment holds a third of the rows
    c = curve.Curve(pd.DataFrame({"club": club, "second": second, "n": 1}), 40)
    assert c.first_part.min() == 0 and (c.first_part + c.parts).max() == 40
    assert (np.diff(c.first_part) >= 0).all()
    assert c.parts.max() > 1                                          # a cell of more than a partition's share
    rank = dict(zip((None if np.isnan(x) else x for x in c.clubs), c.club_rank))
    x = np.array([rank[None if np.isnan(v) else v] for v in club])
    step = np.minimum((second - c.first) // c.step, curve.TIME_STEPS - 1)
    cell = c.position[x, c.time_rank[step]]
    load = np.bincount(c.first_part[cell] + r.integers(0, 1 << 30, len(cell)) % c.parts[cell], minlength=40)
    assert load.max() <= 3 * 20_000 / 40


def _footers(path):
    out = []
    for f in glob.glob(path.replace("file:", "") + "/*.parquet"):
        md = pq.ParquetFile(f).metadata
        names = [md.schema.column(i).name for i in range(md.num_columns)]
        stats = [[md.row_group(g).column(names.index(k)).statistics for g in range(md.num_row_groups)]
                 for k in M.LOOKUP_KEYS]
        known = [[s for s in col if s.has_min_max] for col in stats]              # none where all are null
        out.append([(min(s.min for s in col), max(s.max for s in col)) if col else None for col in known])
    return out


def test_files_are_skipped_on_either_key_alone(spark):
    """At default row-group size, from the statistics that Spark's filters use."""
    t = fixture_tables(spark, SF)
    lo, hi = dt.datetime(1995, 1, 1), dt.datetime(1995, 7, 1)
    kept = {}
    for layout in ("curve", "rebalance"):
        path = scratch_dir(spark, "t-curve")
        df = M.along_curve(t, "en", 32) if layout == "curve" else M.rebalanced(pnl.pnl_long(t, "en"))
        df.write.parquet(path)
        files = _footers(path)
        kept[layout] = (len(files), sum(c is not None and c[0] <= 5 <= c[1] for c, _ in files),
                        sum(x is not None and x[0] < hi and x[1] >= lo for _, x in files))
    files, club, time = kept["curve"]
    assert files >= 24 and club <= files // 2 and time <= files // 2
    files, _, time = kept["rebalance"]
    assert time == files                                              # the default layout keeps all files here


def test_layout_keeps_every_row(spark, sf_small, monkeypatch):
    """Also with a sample that misses most clubs and much of the time range."""
    monkeypatch.setattr(M, "SAMPLE_ROWS", 40)
    t = fixture_tables(spark, sf_small)
    assert bag(M.along_curve(t, "ru", 6)) == bag(pnl.pnl_long(t, "ru"))


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, None), (None, dt.datetime(2020, 1, 1))],
                                  [(3, dt.datetime(2020, 1, 1))] * 5])
def test_odd_inputs(spark, rows):
    df = spark.createDataFrame(rows, "id_club int, payment_time_local timestamp_ntz")
    placed = curve.curve_of(df, *M.LOOKUP_KEYS, 3).place(df, *M.LOOKUP_KEYS)
    assert bag(placed) == bag(df) and (not rows or placed.rdd.getNumPartitions() == 3)


def test_one_exchange_and_one_scan_of_the_payments(spark, tmp_path):
    path = str(tmp_path / "pay")
    spark.range(1000).selectExpr("CAST(id % 7 AS int) AS id_club",
                                 "CAST(timestamp_seconds(id * 86400) AS timestamp_ntz) AS payment_time_local"
                                 ).write.parquet(path)
    df = spark.read.parquet(path)
    placed = curve.curve_of(df, *M.LOOKUP_KEYS, 5).place(df, *M.LOOKUP_KEYS)
    plan = placed._jdf.queryExecution().sparkPlan().toString() + placed._jdf.queryExecution().optimizedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert placed.filter("id_club = 3").count() == df.filter("id_club = 3").count()
