import datetime as dt
import json
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cashbook.session import scratch_dir
from cashbook.sources import catalog as C
from cashbook.sources.readers import jdbc_options, read_csv_snapshot, write_csv_snapshot
from cashbook.sources.snapshot import FrameSource, SourceObject, copy_table, manifest, snapshot_sources
from cashbook.sources.testdata import read_table
from cashbook.sources.views import replay_views
from cashbook.sources.warehouse import Warehouse
from helpers import bag

NASTY = [(1, None), (2, ""), (3, 'a"b'), (4, "x,y\nz\r\nw"), (5, "\\N"), (6, "  sp  "),
         (7, "Привет, мир"), (8, "back\\slash"), (9, '"'), (10, ","), (11, "\t tab")]


def test_csv_round_trip_edge_strings(spark):
    df = spark.createDataFrame(NASTY, "id int, s string").withColumn(
        "ts", F.lit("2020-01-02 03:04:05.123456").cast("timestamp_ntz"))
    path = scratch_dir(spark, "t-csv")
    write_csv_snapshot(df, path)
    back = read_csv_snapshot(spark, path, df.schema)
    assert bag(back) == bag(df)


@pytest.mark.parametrize("table", ["events", "lineitem", "documents"])
def test_csv_round_trip_testdata(spark, sf_small, table):
    df = read_table(spark, sf_small, table)
    path = scratch_dir(spark, f"t-csv-{table}")
    write_csv_snapshot(df, path)
    assert bag(read_csv_snapshot(spark, path, df.schema)) == bag(df)


def test_csv_reads_database_style_timestamps(spark):
    path = scratch_dir(spark, "t-csv-db")
    spark.createDataFrame([("1,2020-01-02 03:04:05,\n2,2020-01-02 03:04:05.5,\"\"\n",)], "v string") \
        .coalesce(1).write.text(path)
    back = read_csv_snapshot(spark, path, spark.createDataFrame(
        [], "id int, ts timestamp_ntz, s string").schema).orderBy("id").collect()
    assert back[0]["ts"] == dt.datetime(2020, 1, 2, 3, 4, 5) and back[0]["s"] is None
    assert back[1]["ts"] == dt.datetime(2020, 1, 2, 3, 4, 5, 500000) and back[1]["s"] == ""


def test_full_refresh_no_accumulation_and_old_rows_gone(spark, sf_small):
    wh = Warehouse(spark, scratch_dir(spark, "t-wh"), namespace="t_wh")
    orders = read_table(spark, sf_small, "orders")
    src_full = FrameSource(spark, "a", {("s1", "orders"): SourceObject("r", lambda: orders)})
    copy_table(src_full, "s1", "orders", wh)
    copy_table(src_full, "s1", "orders", wh)
    assert wh.table("s1", "orders").count() == orders.count()
    small = FrameSource(spark, "a", {("s1", "orders"): SourceObject(
        "r", lambda: orders.filter(F.col("o_orderstatus") == "O"))})
    held = wh.table("s1", "orders")               # a reader bound to the old snapshot
    copy_table(small, "s1", "orders", wh)
    assert wh.table("s1", "orders").count() == orders.filter("o_orderstatus = 'O'").count()
    assert held.count() == orders.count()         # kept version still readable
    assert len(wh.versions("s1", "orders")) == 2  # older ones pruned


def test_schema_change_replaces_catalogue_entry(spark, sf_small):
    wh = Warehouse(spark, scratch_dir(spark, "t-wh2"), namespace="t_wh2")
    region = read_table(spark, sf_small, "region")
    wh.replace("s2", "r", region)
    wh.replace("s2", "r", region.withColumn("extra", F.lit(1)))
    assert "extra" in wh.table("s2", "r").columns


def test_object_selection(spark):
    objs = spark.createDataFrame([
        ("public", "a", "r"), ("public", "b", "v"), ("public", "c", "m"), ("public", "d", "p"),
        ("tiger", "e", "r"), ("topology", "f", "r"), ("pg_catalog", "g", "r"),
        ("billing", "payment", "r"), ("cntrl", "club", "r"),
    ] + [(s, n, "r") for s, n in C.EXCLUDE_TABLES], C.OBJECT_SCHEMA)
    data = {(r["schema"], r["name"]) for r in C.select_objects(objs, C.DATA_KINDS).collect()}
    assert data == {("public", "a"), ("public", "c"), ("billing", "payment"), ("cntrl", "club")}
    views = {(r["schema"], r["name"]) for r in C.select_objects(objs, C.VIEW_KINDS).collect()}
    assert views == {("public", "b")}


def test_two_sources_later_wins(spark, sf_small):
    nation = read_table(spark, sf_small, "nation")
    a = FrameSource(spark, "a", {("s3", "t"): SourceObject("r", lambda: nation.limit(3)),
                                 ("s3", "only_a"): SourceObject("r", lambda: nation)})
    b = FrameSource(spark, "b", {("s3", "t"): SourceObject("r", lambda: nation)})
    wh = Warehouse(spark, scratch_dir(spark, "t-wh3"), namespace="t_wh3")
    rep = snapshot_sources(spark, [a, b], wh)
    assert wh.table("s3", "t").count() == 25
    assert sorted((s, n, src) for s, n, _, src in rep.copied) == [("s3", "only_a", 0), ("s3", "t", 1)]
    m = {(r["table_name"]): r["n_rows"] for r in manifest(spark, rep, wh).collect()}
    assert m == {"t": 25, "only_a": 25}


def test_view_fixpoint_and_placeholder(spark, sf_small):
    wh = Warehouse(spark, scratch_dir(spark, "t-wh4"), namespace="t_wh4")
    wh.replace("s4", "nation", read_table(spark, sf_small, "nation"))
    rep = replay_views(spark, [
        ("s4", "v_top", "SELECT n_name, _(n_name) AS label FROM s4.v_mid"),
        ("s4", "v_none", None),
        ("s4", "v_mid", "SELECT * FROM s4.v_base WHERE n_regionkey > 0"),
        ("s4", "v_base", "SELECT n_name, n_regionkey FROM s4.nation"),
        ("s4", "v_broken", "SELECT * FROM s4.does_not_exist"),
    ], warehouse=wh)
    assert sorted(rep.created) == [("s4", "v_base"), ("s4", "v_mid"), ("s4", "v_top")]
    assert rep.missing_sql == [("s4", "v_none")]
    assert ("s4", "v_broken") in rep.failed
    rows = wh.table("s4", "v_top").collect()
    assert rows and all(r["n_name"] == r["label"] for r in rows)


def test_jdbc_options():
    o = jdbc_options("jdbc:postgresql://h/db", table='"billing"."payment"', partition_column="id",
                     lower=1, upper=1000, num_partitions=16, properties={"user": "u"})
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "16" and o["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", table="t", query="select 1")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", query="select 1", partition_column="id", lower=1, upper=2,
                     num_partitions=2)


def test_full_run_two_sources_then_model(spark, sf_small):
    from cashbook.plans.model import model_table
    from cashbook.plans.pipeline import refresh_warehouse
    from cashbook.sources.fixture_sources import billing_source, main_source
    wh = Warehouse(spark, scratch_dir(spark, "t-run"), namespace="t_run")
    rep = refresh_warehouse(spark, [main_source(spark, sf_small), billing_source(spark, sf_small)],
                            wh, "ru", staging="csv")
    assert model_table(wh, "ru").count() == 4007
    # the billing tables exist in both sources; the later one (index 1) wins
    assert {(s, n): src for s, n, _, src in rep.snapshot.copied}[("billing", "payment")] == 1
    assert rep.snapshot.views.created == [("billing", "v_active_payment")]


def test_jdbc_split_count_scales_with_key_range():
    from cashbook.sources.readers import split_count
    assert split_count(1, 10, 2_000_000) == 1
    assert split_count(1, 10_000_000, 2_000_000) == 5
    assert split_count(1, 10**12, 2_000_000) == 500_000


def test_model_range_count(spark, sf_small):
    from cashbook.plans.model import range_count
    from cashbook.sources.testdata import read_table
    li = read_table(spark, sf_small, "lineitem")
    assert range_count(spark, li) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_csv_stage_removed_after_copy(spark, sf_small):
    from cashbook.sources.warehouse import hadoop_path
    stage = scratch_dir(spark, "t-stage")
    wh = Warehouse(spark, scratch_dir(spark, "t-wh5"), namespace="t_wh5")
    nation = read_table(spark, sf_small, "nation")
    src = FrameSource(spark, "a", {("s5", "n"): SourceObject("r", lambda: nation)})
    copy_table(src, "s5", "n", wh, staging="csv", stage_root=stage)
    assert bag(wh.table("s5", "n")) == bag(nation)
    fs, p = hadoop_path(spark, f"{stage}/s5/n")
    assert not fs.exists(p) or len(fs.listStatus(p)) == 0


def test_partitioned_parent_copied_only_on_request(spark, sf_small):
    from cashbook.sources.fixture_sources import matview_source
    wh = Warehouse(spark, scratch_dir(spark, "t-kinds"), namespace="t_kinds")
    rep = snapshot_sources(spark, [matview_source(spark, sf_small)], wh)
    assert [(s, n, k) for s, n, k, _ in rep.copied] == [("reports", "orders_mv", "m")]
    wh2 = Warehouse(spark, scratch_dir(spark, "t-kinds2"), namespace="t_kinds2")
    rep2 = snapshot_sources(spark, [matview_source(spark, sf_small)], wh2, data_kinds=("r", "m", "p"))
    assert sorted(k for _, _, k, _ in rep2.copied) == ["m", "p"]


def test_file_source_csv_dumps_and_parquet(spark, sf_small):
    from cashbook.functions.types import coerce
    from cashbook.sources.fixture_sources import LINEITEM_TYPES
    from cashbook.sources.snapshot import FileSource
    root = scratch_dir(spark, "t-files")
    li = read_table(spark, sf_small, "lineitem")
    declared = [(c, LINEITEM_TYPES[c]) for c in li.columns]
    write_csv_snapshot(coerce(li, declared), f"{root}/public/lineitem")
    read_table(spark, sf_small, "orders").write.parquet(f"{root}/public/orders")
    src = FileSource(spark, "dump", root, "csv", {("public", "lineitem"): declared})
    assert sorted(r["name"] for r in src.objects().collect()) == ["lineitem", "orders"]
    wh = Warehouse(spark, scratch_dir(spark, "t-files-wh"), namespace="t_files_wh")
    copy_table(src, "public", "lineitem", wh)
    got = wh.table("public", "lineitem")
    assert got.schema["l_extendedprice"].dataType.simpleString() == "string"
    assert bag(got) == bag(coerce(li, declared))
    psrc = FileSource(spark, "p", root, "parquet")
    copy_table(psrc, "public", "orders", wh)
    assert bag(wh.table("public", "orders")) == bag(read_table(spark, sf_small, "orders"))


def test_command_line_run_over_file_source(spark, sf_small, tmp_path):
    import json
    import subprocess
    import sys
    from pathlib import Path
    from cashbook.sources.fixtures import fixture_table, QUALIFIED
    root = scratch_dir(spark, "t-cli-src")
    for name, (schema, table) in QUALIFIED.items():
        fixture_table(spark, sf_small, name).write.parquet(f"{root}/{schema}/{table}")
    cfg = {"warehouse": scratch_dir(spark, "t-cli-wh"), "lang": "en",
           "sources": [{"name": "files", "files": root, "format": "parquet",
                        "columns": {"billing.payment": [["amount", "numeric(12,2)"]]}}]}
    cfg_path = tmp_path / "run.json"
    cfg_path.write_text(json.dumps(cfg))
    out = subprocess.run([sys.executable, "-m", "cashbook", "run", str(cfg_path)],
                         cwd=Path(__file__).resolve().parents[1], capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    rep = json.loads(out.stdout.strip().splitlines()[-1])
    assert sorted(rep["copied"]) == ["billing.balance", "billing.balance_user", "billing.payment",
                                     "billing.payment_type", "cntrl.club"]
    assert spark.read.parquet(rep["model"]).count() == 4007


def test_object_changing_kind_between_runs(spark, sf_small):
    nation = read_table(spark, sf_small, "nation")
    wh = Warehouse(spark, scratch_dir(spark, "t-kind-change"), namespace="t_kind_change")
    wh.replace("s6", "base", nation)
    wh.replace("s6", "x", nation)
    rep = replay_views(spark, [("s6", "x", "SELECT n_name FROM s6.base")], warehouse=wh)   # table -> view
    assert rep.created == [("s6", "x")] and wh.table("s6", "x").columns == ["n_name"]
    wh.replace("s6", "x", nation)                                              # view -> table
    assert wh.table("s6", "x").count() == 25 and not wh.is_view("s6", "x")


def test_jdbc_source_orchestration_without_a_database(spark, sf_small):
    """JdbcSource logic over canned catalogue answers (no database is started)."""
    from cashbook.sources.snapshot import JdbcSource

    orders = read_table(spark, sf_small, "orders")

    class CannedJdbc(JdbcSource):
        asked = 0

        def _query(self, sql):
            self.asked += 1
            if "FROM information_schema.tables" in sql:
                return spark.createDataFrame(
                    [("sales", "orders", "BASE TABLE"), ("tiger", "x", "BASE TABLE"), ("sales", "v_open", "VIEW"),
                     ("sales", "parent", "PARTITIONED TABLE"), ("sales", "tmp", "LOCAL TEMPORARY")],
                    "schema string, name string, type string")
            if "FROM information_schema.columns" in sql:
                types = [("bigint", None, None, 64, 0, None), ("bigint", None, None, 64, 0, None),
                         ("character", None, 1, None, None, None), ("numeric", None, None, 12, 2, None),
                         ("timestamp without time zone", None, None, None, None, 6),
                         ("character varying", None, 15, None, None, None)]
                rows = [("sales", "orders", f.name, i, *t) for i, (f, t) in enumerate(zip(orders.schema.fields, types))]
                return spark.createDataFrame(
                    rows[::-1], "schema string, name string, column string, position int, data_type string, "
                                "domain_name string, length int, digits int, scale int, fraction int")
            if "pg_relation_size" in sql:
                return spark.createDataFrame([("sales", "orders", 8192)], "schema string, name string, bytes long")
            assert "FROM pg_views" in sql
            return spark.createDataFrame(
                [("sales", "v_open", " SELECT o_orderkey FROM sales.orders WHERE o_orderstatus = 'O';")],
                "schema string, name string, definition string")

        def read(self, schema, name):
            assert (schema, name) == ("sales", "orders")
            return orders

    src = CannedJdbc(spark, "pg", "jdbc:postgresql://unused/db")
    assert [c for c, _ in src.columns("sales", "orders")] == orders.columns
    assert src.select_list("sales", "orders") == (
        '"o_orderkey", "o_custkey", CAST("o_orderstatus" AS text) AS "o_orderstatus", '
        'CAST("o_totalprice" AS text) AS "o_totalprice", "o_orderdate", '
        'CAST("o_orderpriority" AS text) AS "o_orderpriority"')
    assert src.split_column("sales", "orders") == "o_orderkey"
    assert src.properties["preferTimestampNTZ"] == "true"
    wh = Warehouse(spark, scratch_dir(spark, "t-jdbc"), namespace="t_jdbc")
    rep = snapshot_sources(spark, [src], wh)
    assert [(s, n) for s, n, _, _ in rep.copied] == [("sales", "orders")]
    got = wh.table("sales", "orders")
    assert got.schema["o_totalprice"].dataType.simpleString() == "string"   # numeric(12,2) -> text
    assert got.schema["o_orderdate"].dataType.simpleString() == "timestamp_ntz"
    assert rep.views.created == [("sales", "v_open")]
    assert src.asked == 4                           # relations, columns, sizes and view texts, once each
    assert wh.table("sales", "v_open").count() == orders.filter("o_orderstatus = 'O'").count()


def test_metadata_queries_and_type_spellings():
    from cashbook.functions.types import spark_type
    from cashbook.sources import catalog as C
    for sql in (C.RELATIONS_QUERY, C.COLUMNS_QUERY, C.VIEW_TEXTS_QUERY):
        assert "NOT IN ('pg_catalog', 'information_schema')" in sql
    assert set(C.DATA_KINDS + C.VIEW_KINDS) <= set(C.KIND_OF.values())
    spell = C.type_spelling
    assert spell("numeric", digits=12, scale=2) == "numeric(12,2)"
    assert spell("numeric") == "numeric" and spell("integer", digits=32, scale=0) == "integer"
    assert spell("character varying", length=40) == "character varying(40)"
    assert spell("timestamp without time zone", fraction=6) == "timestamp without time zone"
    assert spell("timestamp with time zone", fraction=3) == "timestamp(3) with time zone"
    assert spell("time without time zone", fraction=0) == "time(0) without time zone"
    assert spell("integer", domain="positive") == "positive"
    assert spark_type(spell("timestamp without time zone", fraction=3)).simpleString() == "string"


def test_view_chain_attempts_are_linear_and_cycles_fail(spark, sf_small):
    wh = Warehouse(spark, scratch_dir(spark, "t-chain"), namespace="t_chain")
    wh.replace("s7", "base", read_table(spark, sf_small, "nation"))
    n = 30
    chain = [("s7", f"v{i}", f"SELECT * FROM s7.v{i - 1}" if i else "SELECT * FROM s7.base")
             for i in range(n)]
    rep = replay_views(spark, list(reversed(chain)) + [
        ("s7", "c1", "SELECT * FROM s7.c2"), ("s7", "c2", "SELECT * FROM s7.c1"),
        ("s7", "gone", "SELECT * FROM s7.never_copied")], warehouse=wh)
    assert len(rep.created) == n
    assert wh.table("s7", f"v{n - 1}").count() == 25
    assert rep.attempts <= 2 * n + 3 + 2          # each chain view at most twice
    assert {("s7", "c1"), ("s7", "c2"), ("s7", "gone")} <= set(rep.failed)


def test_single_line_csv_is_split(spark, sf_small):
    li = read_table(spark, sf_small, "lineitem")
    path = scratch_dir(spark, "t-split")
    write_csv_snapshot(li.coalesce(1), path)                       # one file, no embedded newlines
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        whole = read_csv_snapshot(spark, path, li.schema, multi_line=True)
        split = read_csv_snapshot(spark, path, li.schema, multi_line=False)
        assert whole.rdd.getNumPartitions() == 1 < split.rdd.getNumPartitions()
        assert bag(split) == bag(whole)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_attach_registers_newest_versions(spark, sf_small):
    root = scratch_dir(spark, "t-attach")
    wh = Warehouse(spark, root, namespace="t_attach")
    nation = read_table(spark, sf_small, "nation")
    wh.replace("s8", "n", nation.limit(3))
    wh.replace("s8", "n", nation)
    spark.sql(f"DROP TABLE {wh.qualified('s8', 'n')}")                     # as if a new session had no registration
    assert not wh.exists("s8", "n")
    assert Warehouse(spark, root, namespace="t_attach").attach() == [("s8", "n")]
    assert wh.table("s8", "n").count() == 25


def dump(spark, tag, text):
    """A hand-made file as the database writes it."""
    path = scratch_dir(spark, tag)
    folder = Path(path.removeprefix("file:"))
    folder.mkdir(parents=True)
    (folder / "dump.csv").write_text(text, newline="")
    return path


@pytest.mark.parametrize("text,want", [
    ("a\n\nb\n", ["a", None, "b"]),
    ("\n\n", [None, None]),
    ('\n\n"q"\nb\n\n', [None, None, "q", "b", None]),
    ('"x ""y"""\n\n"two\nlines"\n""\n', ['x "y"', None, "two\nlines", ""]),
])
def test_one_column_dump_keeps_blank_records(spark, text, want):
    path = dump(spark, "t-one", text)
    got = read_csv_snapshot(spark, path, spark.createDataFrame([], "s string").schema)
    assert sorted(map(str, (r["s"] for r in got.collect()))) == sorted(map(str, want))


def test_one_column_round_trip(spark):
    df = spark.createDataFrame([(s,) for _, s in NASTY] + [(None,)], "s string")
    path = scratch_dir(spark, "t-one-rt")
    write_csv_snapshot(df, path)
    assert bag(read_csv_snapshot(spark, path, df.schema)) == bag(df)


def test_database_spellings(spark):
    path = dump(spark, "t-spell", "t,2020-01-02 03:04:05+00,NaN,  12.50 ,1\n"
                                  "f,2020-01-02 03:04:05.25+05:30,,NaN,\n")
    schema = spark.createDataFrame([], "b boolean, ts timestamp, x double, s string, n decimal(38,18)").schema
    a, b = sorted(read_csv_snapshot(spark, path, schema).collect(), key=lambda r: not r["b"])
    assert a["b"] is True and b["b"] is False
    utc = read_csv_snapshot(spark, path, schema).select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SS").alias("t"))
    assert sorted(r["t"] for r in utc.collect()) == ["2020-01-01 21:34:05.25", "2020-01-02 03:04:05.00"]
    assert a["x"] != a["x"] and b["x"] is None
    assert a["s"] == "  12.50 " and b["s"] == "NaN"            # text targets are kept byte for byte
    assert a["n"] == Decimal(1) and b["n"] is None


def test_nan_in_a_decimal_is_loud(spark):
    path = dump(spark, "t-nan", "1,NaN\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_csv_snapshot(spark, path, spark.createDataFrame([], "id int, n decimal(38,18)").schema).collect()


def test_two_warehouses_keep_their_own_tables(spark):
    en, ru = (Warehouse(spark, scratch_dir(spark, f"t-two-{k}"), namespace=f"t_two_{k}") for k in ("en", "ru"))
    en.replace("billing", "payment", spark.range(3))
    ru.replace("billing", "payment", spark.range(7))
    assert en.table("billing", "payment").count() == 3 and ru.table("billing", "payment").count() == 7
    thief = Warehouse(spark, scratch_dir(spark, "t-two-thief"), namespace="t_two_en")
    with pytest.raises(RuntimeError, match="namespace"):
        thief.replace("billing", "payment", spark.range(9))
    assert en.table("billing", "payment").count() == 3


def test_quoted_identifiers_in_views(spark):
    wh = Warehouse(spark, scratch_dir(spark, "t-quoted"), namespace="t_quoted")
    wh.replace("s9", "t", spark.createDataFrame([(1, 2, "x.s9.y")], '`order` int, `Сумма` int, nm string'))
    rep = replay_views(spark, [("s9", "v", 'SELECT "order", "Сумма" AS "Итог", nm, \'s9.t\' AS lit FROM "s9"."t" s9'),
                               ("s9", "w", "SELECT s9.v.nm FROM s9.v")], warehouse=wh)
    assert not rep.failed
    assert tuple(wh.table("s9", "v").first()) == (1, 2, "x.s9.y", "s9.t")
    assert wh.table("s9", "v").columns == ["order", "Итог", "nm", "lit"]
    assert wh.table("s9", "w").first()[0] == "x.s9.y"


def test_broken_view_stops_the_run(spark, sf_small):
    from cashbook.plans.pipeline import refresh_warehouse
    from cashbook.sources.fixture_sources import billing_objects
    from cashbook.sources.snapshot import ViewsFailed
    objects = billing_objects(spark, sf_small)
    objects[("reports", "v_bad")] = SourceObject("v", sql="SELECT no_such_column FROM billing.payment")
    objects[("reports", "v_none")] = SourceObject("v")
    wh = Warehouse(spark, scratch_dir(spark, "t-broken"), namespace="t_broken")
    with pytest.raises(ViewsFailed, match="v_bad.*\n.*v_none"):
        refresh_warehouse(spark, [FrameSource(spark, "m", objects)], wh)
    assert not wh.exists("models", "cash_flow") and wh.versions("models", "cash_flow") == []
    rep = snapshot_sources(spark, [FrameSource(spark, "m", objects)], wh, allow_failed_views=True)
    assert rep.views.missing_sql == [("reports", "v_none")]


def test_failed_attempts_do_not_evict(spark):
    wh = Warehouse(spark, scratch_dir(spark, "t-evict"), namespace="t_evict")
    wh.replace("s", "t", spark.range(4))
    held = wh.table("s", "t")
    spark.range(1).write.parquet(wh.new_location("s", "t") + "/part")        # an attempt that was not committed
    wh.replace("s", "t", spark.range(5))
    assert held.count() == 4 and wh.table("s", "t").count() == 5
    assert len(wh.committed("s", "t")) == 2 and len(wh.versions("s", "t")) == 3
    old = f"{wh.table_dir('s', 't')}/v{1:013d}-abandoned"
    spark.range(1).write.parquet(old + "/part")
    wh.replace("s", "t", spark.range(6))
    assert not any("abandoned" in v for v in wh.versions("s", "t"))


def test_copies_are_tried_once_and_retried(spark):
    from cashbook.sources.snapshot import snapshot_sources as run
    tries = []

    def frame():
        tries.append(1)
        raise OSError("gone")
    src = FrameSource(spark, "a", {("s", "t"): SourceObject("r", frame)})
    with pytest.raises(OSError):
        run(spark, [src], Warehouse(spark, scratch_dir(spark, "t-retry"), namespace="t_retry"), retries=3)
    assert len(tries) == 4


def test_checkpoint_folder_is_required_on_a_cluster(monkeypatch):
    from cashbook import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(type("S", (), {"sparkContext": Context()})())
