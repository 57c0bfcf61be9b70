"""Copies are counted and summed up while they are written, and compared before readers see them."""
import datetime as dt
import decimal

import pytest

from cashbook.session import scratch_dir
from cashbook.sources import snapshot as S
from cashbook.sources.snapshot import CopyMismatch, FrameSource, SourceObject, copy_verified
from cashbook.sources.tally import Tally, tally_of
from cashbook.sources.warehouse import Warehouse
from helpers import bag

ROWS = [(1, "a", 1.5, decimal.Decimal("2.50"), dt.datetime(2020, 1, 2, 3, 4, 5, 6), None, [1, None]),
        (2, None, float("nan"), None, None, "x\ny", None), (2, None, float("nan"), None, None, "x\ny", None),
        (None, "", -0.0, decimal.Decimal("-1.00"), dt.datetime(1969, 1, 1), '"q"', [])]
KINDS = "i long, s string, d double, m decimal(10,2), t timestamp_ntz, u string, l array<int>"


def test_total_depends_on_rows_only(spark):
    df = spark.createDataFrame(ROWS, KINDS)
    whole = tally_of(df)
    assert whole.rows == 4 and len(whole.checksum) == 32
    assert tally_of(df.repartition(3).orderBy("u")) == whole
    assert tally_of(df.limit(3)) != whole and tally_of(df.union(df.limit(1))) != whole
    twice = spark.createDataFrame(ROWS + ROWS[1:2] * 2, KINDS)       # pairs of equal rows do not cancel
    assert tally_of(twice).checksum != whole.checksum
    a = spark.createDataFrame([(None, "a")], "x string, y string")
    b = spark.createDataFrame([("a", None)], "x string, y string")
    assert tally_of(a) != tally_of(b)


def test_maps_and_empty_frames(spark):
    m = spark.sql("SELECT map('a', 1, 'b', 2) AS m")
    assert tally_of(m) == tally_of(spark.sql("SELECT map('b', 2, 'a', 1) AS m"))
    seen = Tally()
    seen.of(spark.createDataFrame([], KINDS)).write.parquet(scratch_dir(spark, "t-none"))
    assert seen.result() == tally_of(spark.createDataFrame([], KINDS)) and seen.result().rows == 0


def test_observed_total_equals_a_pass(spark, sf_small):
    from cashbook.sources.testdata import read_table
    for name in ("lineitem", "documents", "events"):
        df = read_table(spark, sf_small, name, spread=True)
        seen = Tally()
        path = scratch_dir(spark, "t-seen")
        seen.of(df).write.parquet(path)
        assert seen.result() == tally_of(spark.read.parquet(path))


@pytest.mark.parametrize("staging", ["direct", "csv"])
def test_copy_reports_what_it_stored(spark, staging):
    wh = Warehouse(spark, scratch_dir(spark, "t-ver"), namespace=f"t_ver_{staging}")
    df = spark.createDataFrame(ROWS, KINDS).drop("d")
    src = FrameSource(spark, "a", {("s", "t"): SourceObject("r", lambda: df)})
    _, total = copy_verified(src, "s", "t", wh, staging=staging, stage_root=scratch_dir(spark, "t-ver-stage"))
    assert total == tally_of(wh.table("s", "t")) and total.rows == 4


@pytest.mark.parametrize("damage", [lambda df: df.limit(3), lambda df: df.union(df.limit(1)),
                                    lambda df: df.selectExpr("i", "upper(s) AS s")])
def test_lost_doubled_or_changed_rows_fail_the_copy(spark, monkeypatch, damage):
    wh = Warehouse(spark, scratch_dir(spark, "t-lost"), namespace=f"t_lost_{abs(hash(damage)) % 10**9}")
    df = spark.createDataFrame([(i, f"v{i}") for i in range(4)], "i long, s string")
    src = FrameSource(spark, "a", {("s", "t"): SourceObject("r", lambda: df)})
    stage = dict(staging="csv", stage_root=scratch_dir(spark, "t-lost-stage"))
    copy_verified(src, "s", "t", wh, **stage)
    before = bag(wh.table("s", "t"))
    read = S.read_csv_snapshot
    monkeypatch.setattr(S, "read_csv_snapshot", lambda *a: damage(read(*a)))
    with pytest.raises(CopyMismatch, match="s.t: read"):
        copy_verified(src, "s", "t", wh, **stage)
    assert bag(wh.table("s", "t")) == before and len(wh.committed("s", "t")) == 1


def test_rows_missing_in_the_files_fail_the_copy(spark, monkeypatch):
    wh = Warehouse(spark, scratch_dir(spark, "t-lost2"), namespace="t_lost2")
    df = spark.range(9)
    src = FrameSource(spark, "a", {("s", "t"): SourceObject("r", lambda: df)})
    monkeypatch.setattr(S.Tally, "of", lambda self, frame, of=S.Tally.of: of(self, frame).limit(5))
    with pytest.raises(CopyMismatch):
        S.snapshot_sources(spark, [src], wh, retries=1)
    assert not wh.exists("s", "t")
