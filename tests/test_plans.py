"""Plan-shape checks: one payment scan, broadcasts only where bounded, skew
splitting on the shuffle path, filters pushed into Parquet for lookups."""

import re
from collections import Counter

import pytest

from cashbook.plans import model as M
from cashbook.plans import pnl
from cashbook.session import scratch_dir
from cashbook.sources.fixtures import fixture_tables
from cashbook.sources.warehouse import Warehouse
from helpers import bag, tables


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_payment_scan_and_no_shuffle(spark, sf_small):
    df = pnl.pnl_long(fixture_tables(spark, sf_small), "en")
    text = plan_text(df)
    assert len(re.findall(r"lineitem\.parquet", text)) == 1          # payments read once
    # dims all broadcast: no join-induced shuffle (the only exchange spreads the
    # single-row-group test input over the cores)
    assert "ENSURE_REQUIREMENTS" not in text
    assert text.count("BroadcastHashJoin") >= 4


def test_34_branch_form_scans_many_times(spark, sf_small):
    # the literal form over an unstaged source re-reads the payments per branch
    df = pnl.pnl_union(fixture_tables(spark, sf_small), "en", stage=False)
    assert len(re.findall(r"lineitem\.parquet", plan_text(df))) == 34


@pytest.fixture
def skew_conf(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_account_is_split_on_shuffle_path(spark, skew_conf):
    types = [(5, 1, 1, 1, 0, None), (103, 0, None, 1, 0, None)]
    accounts = [(i, i % 7, 1) for i in range(1, 200)]
    # account 1 holds a third of all payments
    pays = [(i, 5 if i % 2 else 103, 1 if i % 3 == 0 else (i % 198) + 1, f"{i}.25")
            for i in range(1, 30001)]
    t = tables(spark, pays, types, accounts)
    shuffled = pnl.pnl_long(t, "en", account_max_rows=10)     # accounts over the bound
    rows = shuffled.collect()
    cols = sorted(shuffled.columns)
    got = Counter(tuple(r[c] for c in cols) for r in rows)
    text = plan_text(shuffled)
    assert "isFinalPlan=true" in text
    assert "SortMergeJoin(skew=true)" in text
    assert got == bag(pnl.pnl_long(t, "en"))                   # broadcast path, same rows
    assert sum(got.values()) == 90000


def test_lookup_filters_pushed_to_parquet(spark, sf_small):
    from cashbook.sources.fixture_sources import billing_source
    from cashbook.sources.snapshot import snapshot_sources
    wh = Warehouse(spark, scratch_dir(spark, "t-plan"), namespace="t_plan")
    snapshot_sources(spark, [billing_source(spark, sf_small)], wh)
    M.refresh_model(spark, wh, "en")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    q = M.lookup(M.model_table(wh, "en"), [5, 7], "1995-01-01", "1997-01-01")
    q.collect()
    text = q._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    assert "In(id_club" in pushed
    assert "GreaterThanOrEqual(payment_time_local" in pushed
    assert "LessThan(payment_time_local" in pushed


def test_model_files_sorted_by_club_and_time(spark, sf_small):
    from pyspark.sql import functions as F
    from cashbook.sources.fixture_sources import billing_source
    from cashbook.sources.snapshot import snapshot_sources
    wh = Warehouse(spark, scratch_dir(spark, "t-layout"), namespace="t_layout")
    snapshot_sources(spark, [billing_source(spark, sf_small)], wh)
    loc = M.refresh_model(spark, wh, "en", partitions=4, layout="range")
    df = spark.read.parquet(loc).withColumn("f", F.input_file_name())
    ranges = (df.groupBy("f").agg(F.min("id_club").alias("lo"), F.max("id_club").alias("hi"))
                .orderBy("lo").collect())
    assert len(ranges) >= 2
    # range partitioning: club ranges of files overlap at most at their edges
    for a, b in zip(ranges, ranges[1:]):
        assert a["hi"] is None or b["lo"] is None or a["hi"] <= b["lo"]


def test_rebalanced_layout_clusters_clubs(spark, sf_small):
    from pyspark.sql import functions as F
    from cashbook.sources.fixture_sources import billing_source
    from cashbook.sources.snapshot import snapshot_sources
    wh = Warehouse(spark, scratch_dir(spark, "t-layout2"), namespace="t_layout2")
    snapshot_sources(spark, [billing_source(spark, sf_small)], wh)
    loc = M.refresh_model(spark, wh, "en")
    df = spark.read.parquet(loc).withColumn("f", F.input_file_name())
    clubs = df.select("id_club").distinct().count()
    files_per_club = df.groupBy("id_club").agg(F.countDistinct("f").alias("n")).agg(F.max("n")).first()[0]
    assert files_per_club == 1 < clubs           # a small club lives in one file
    for f in [r["f"] for r in df.select("f").distinct().collect()]:
        rows = spark.read.parquet(f).select("id_club", "payment_time_local").collect()
        keys = [(r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0) for r in rows]
        assert keys == sorted(keys)               # sorted within each file (nulls first)


def test_rebalance_splits_hot_club(spark, skew_conf):
    from pyspark.sql import functions as F
    types = [(5, 1, 1, 1, 0, None)]
    accounts = [(1, 7, 1)] + [(i, i, 1) for i in range(2, 40)]
    # club 7 (account 1) holds a third of all payments
    pays = [(i, 5, 1 if i % 3 == 0 else (i % 38) + 2, f"{i}.5") for i in range(1, 30001)]
    t = tables(spark, pays, types, accounts)
    wh = Warehouse(spark, scratch_dir(spark, "t-hot"), namespace="t_hot")
    loc = M.refresh_model(spark, wh, "en", tables=t)
    df = spark.read.parquet(loc).withColumn("f", F.input_file_name())
    assert df.count() == 3 * 30000
    hot_files = df.filter("id_club = 7").select("f").distinct().count()
    assert hot_files > 1                          # the hot club was split over several tasks


def test_explicit_salting_splits_hot_account(spark):
    from pyspark.sql import functions as F
    from cashbook.operators.skew import salted_join
    types = [(5, 1, 1, 1, 0, None), (103, 0, None, 1, 0, None)]
    accounts = [(i, i % 7, 1) for i in range(1, 200)]
    pays = [(i, 5 if i % 2 else 103, 1 if i % 3 == 0 else (i % 198) + 1, f"{i}.25")
            for i in range(1, 30001)]
    t = tables(spark, pays, types, accounts)
    salted = pnl.pnl_long(t, "en", account_max_rows=10, skew="salt")
    assert bag(salted) == bag(pnl.pnl_long(t, "en"))
    # placement: account 1 (10,000 payments) over a 1,000-row budget lands in several
    # shuffle partitions of the join
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        p = t.payment.select("id", "id_balance_user")
        a = t.balance_user.select(F.col("id").alias("acc_id"), "id_club")
        j = salted_join(p, a, "id_balance_user", "acc_id", rows_per_task=1000)
        assert j.count() == 30000
        parts = (j.filter("id_balance_user = 1").select(F.spark_partition_id().alias("pid"))
                  .distinct().count())
        assert parts >= 4
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_salting_left_join_keeps_unmatched(spark):
    from pyspark.sql import functions as F
    from cashbook.operators.skew import salted_join
    big = spark.range(0, 5000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k2 long, s string")
    out = salted_join(big, small, "k", "k2", "left", rows_per_task=100)
    assert out.count() == 5000
    assert out.filter("k = 2 AND s IS NULL").count() == big.filter("k = 2").count()
    assert out.filter("k = 0 AND s = 'a'").count() == big.filter("k = 0").count()


def test_both_layouts_store_the_model_rows(spark, sf_small):
    from cashbook.sources.fixture_sources import billing_source
    from cashbook.sources.fixtures import fixture_tables
    from cashbook.sources.snapshot import snapshot_sources
    wh = Warehouse(spark, scratch_dir(spark, "t-layouts"), namespace="t_layouts")
    snapshot_sources(spark, [billing_source(spark, sf_small)], wh)
    expected = bag(pnl.pnl_long(fixture_tables(spark, sf_small), "ru"))
    for layout in ("rebalance", "range"):
        loc = M.refresh_model(spark, wh, "ru", layout=layout)
        assert bag(spark.read.parquet(loc)) == expected, layout


def test_clustered_layout_lets_lookups_skip_row_groups(spark):
    """Counted from the Parquet footers: the min/max statistics Spark's row-group filter uses."""
    import datetime as dt
    import glob

    import pyarrow.parquet as pq

    def kept_row_groups(path, clubs, lo, hi):
        total = kept = 0
        for f in glob.glob(path.replace("file:", "") + "/*.parquet"):
            md = pq.ParquetFile(f).metadata
            names = [md.schema.column(i).name for i in range(md.num_columns)]
            ci, ti = names.index("id_club"), names.index("payment_time_local")
            for g in range(md.num_row_groups):
                c = md.row_group(g).column(ci).statistics
                t = md.row_group(g).column(ti).statistics
                total += 1
                kept += ((c is None or not c.has_min_max or any(c.min <= k <= c.max for k in clubs))
                         and (t is None or not t.has_min_max or (t.max >= lo and t.min < hi)))
        return total, kept

    from cashbook.sources.fixtures import fixture_tables
    df = pnl.pnl_long(fixture_tables(spark, "/root/testdata/sf0.01"), "en")
    lo, hi = dt.datetime(1995, 1, 1), dt.datetime(1997, 1, 1)
    result = {}
    for label, frame in (("clustered", M.rebalanced(df)), ("unclustered", df)):
        path = scratch_dir(spark, "t-rowgroups")
        frame.write.option("parquet.block.size", 16384).parquet(path)
        result[label] = kept_row_groups(path, [5, 7, 13], lo, hi)
    total, kept = result["clustered"]
    assert total > 50 and kept <= total // 4          # most row groups skipped
    assert result["unclustered"][1] == result["unclustered"][0]   # nothing skippable


def test_generated_branches_fit_the_jit(spark, sf_small):
    """HotSpot leaves methods of over 8,000 bytes uncompiled, which makes the 34 branches several times slower."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = pnl.pnl_rows(fixture_tables(spark, sf_small), "en")._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) <= 8000
    assert "keep" not in plan.toString()               # no struct with a flag for each branch


def test_generated_branches_equal_the_union(spark):
    """Rows with several leaves, none, zeros, NaN and totals that cancel out: the same bag as the literal union."""
    from cashbook.operators.rules import LEAVES
    from cashbook.operators.union import KEY_COLUMNS, branches, pnl_generated, union_all
    labels = [leaf.label("en") for leaf in LEAVES]
    amounts = [{}, {0: "12.50"}, {0: "0.00"}, {0: "1", 1: "2", 8: "0.1", 29: "-3"}, {3: "NaN"}, {0: "5", 10: "5"},
               dict.fromkeys(range(len(labels)), "0.1"), {0: "12.50"}, {7: "-1e300", 12: "1e300"}]
    rows = [(i % 3, None, None, i, None, *[a.get(k) for k in range(len(labels))]) for i, a in enumerate(amounts)]
    kinds = ["int", "timestamp_ntz", "timestamp_ntz", "int", "int"]
    schema = ", ".join([f"`{c}` {t}" for c, t in zip(KEY_COLUMNS, kinds)] + [f"`{x}` string" for x in labels])
    wide = spark.createDataFrame(rows, schema)
    got, want = pnl_generated(wide), union_all(branches(wide))
    assert got.columns == want.columns and got.dtypes == want.dtypes

    def printed(df):
        return Counter(tuple(map(str, r)) for r in df.collect())
    assert printed(got) == printed(want) and got.count() > 40
