"""

Every query reads the given parquet tables (or what Spark derives from them)
in full.  The billing tables of the model are derived from the testdata by
the fixture texts in :mod:`cashbook.sources.fixtures`; the oracle texts put
the same fixture texts in a leading ``WITH``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashbook import oracle as O
from cashbook.functions.scalar import local_time, to_double, zero_if_null
from cashbook.functions.types import pg_type_of
from cashbook.operators import feed as FD
from cashbook.operators.broadcast import bounded_broadcast
from cashbook.operators.rules import (BAR_CODES, EXPENSE_KEYS, GAMING_CODES, LEAVES,
                                      OTHER_REVENUE_KEYS, ROLLUPS, SALES_KEYS, TOP_UP_CODES)
from cashbook.plans import model as M
from cashbook.plans import pnl
from cashbook.session import scratch_dir
from cashbook.sources import fixture_sources as FS
from cashbook.sources.fixtures import fixture_table, fixture_tables
from cashbook.sources.readers import write_csv_snapshot
from cashbook.sources.snapshot import (FileSource, FrameSource, SourceObject, copy_table, manifest,
                                       snapshot_sources)
from cashbook.sources.tally import tally_of
from cashbook.sources.testdata import read_table
from cashbook.sources.warehouse import Warehouse

FLAGSHIP_SF = "/root/testdata/sf0.001"
LEAF_KEYS = tuple(m.key for m in LEAVES)
ROLLUP_KEYS = tuple(r.key for r in ROLLUPS)
WIDE_KEYS = ["id", "payment_time", "id_club", "id_payment_type", "id_grp_payment_type",
             "profit", "amount"]


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the English cash-flow / P&L model on sf0.001."""
    return pnl.pnl_long(fixture_tables(spark, FLAGSHIP_SF), "en")


# ---------------------------------------------------------------- P&L model

def _model(lang: str, metrics=None):
    return lambda spark, sf: pnl.pnl_long(fixture_tables(spark, sf), lang, metrics)


def _wide(keys, lang="en"):
    def run(spark, sf):
        w = pnl.pnl_wide(fixture_tables(spark, sf), lang, keys)
        return w.select(*WIDE_KEYS, *[F.col(f"`{c}`") for c in w.columns[len(FD.FEED_COLUMNS):]])
    return run


def q_scan_payment(spark, sf):
    return fixture_table(spark, sf, "payment")


def q_pnl_source(spark, sf):
    return pnl.pnl_feed(fixture_tables(spark, sf))


def q_pnl_wide(spark, sf):
    return pnl.pnl_wide(fixture_tables(spark, sf), "en")


def q_filter_active_types(spark, sf):
    return FD.active_types(fixture_table(spark, sf, "payment_type"))


def q_filter_main_balance(spark, sf):
    t = fixture_tables(spark, sf)
    bu = FD.main_balance_accounts(t.balance_user).select(F.col("id").alias("bu_id"), "id_club")
    return t.payment.join(bu, t.payment["id_balance_user"] == bu["bu_id"], "inner").select(
        "id", "date", "id_balance_user", "id_club")


def q_pred_in_list(spark, sf):
    t = fixture_tables(spark, sf)
    pt = bounded_broadcast(t.payment_type.select(F.col("id").alias("pt_id"), "profit", "method"))
    x = t.payment.join(pt, t.payment["id_payment_type"] == pt["pt_id"], "inner")
    code = F.col("id_payment_type")
    pred = ((code.isin(list(GAMING_CODES)) | code.isin(list(BAR_CODES)) | code.isin(list(TOP_UP_CODES)))
            & (F.col("profit") == 1))
    return x.filter(pred).select("id", "date", "id_payment_type", "profit", "method")


def q_join_payment_type(spark, sf):
    return FD.payment_type_join(fixture_tables(spark, sf))


def q_join_account(spark, sf):
    return FD.account_left_join(fixture_tables(spark, sf))


def q_join_balance(spark, sf):
    return FD.balance_left_join(fixture_tables(spark, sf))


def q_join_club(spark, sf):
    return FD.club_left_join(fixture_tables(spark, sf))


def q_union_all_bag(spark, sf):
    return pnl.pnl_rows(fixture_tables(spark, sf), "en")


def q_scalar_cast_double(spark, sf):
    p = fixture_table(spark, sf, "payment")
    return p.select("id", "amount", to_double("amount").alias("amount_double"))


def q_scalar_coalesce(spark, sf):
    p = fixture_table(spark, sf, "payment")
    return p.select("id", "amount", zero_if_null(to_double("amount")).alias("amount_or_zero"))


def q_local_time(spark, sf):
    j = FD.club_left_join(fixture_tables(spark, sf))
    return j.select("id", F.col("date").alias("payment_time"), "time_zone",
                    local_time("date", "time_zone").alias("payment_time_local"))


# ------------------------------------------------- snapshot job and stored model
# Each writes into a fresh warehouse under the session's checkpoint folder,
# then returns what it reads back from there.

def _warehouse(spark) -> Warehouse:
    root = scratch_dir(spark, "warehouse")
    return Warehouse(spark, root, namespace="q" + root.rsplit("-", 1)[1])


def q_snapshot_all(spark, sf):
    wh = _warehouse(spark)
    rep = snapshot_sources(spark, [FS.main_source(spark, sf)], wh)
    return manifest(spark, rep, wh)


def q_snapshot_coerced(spark, sf):
    wh = _warehouse(spark)
    snapshot_sources(spark, [FS.lineitem_source(spark, sf)], wh)
    return wh.table("public", "lineitem")


def _staged(name):
    """One of three tables staged as CSV."""
    def run(spark, sf):
        wh = _warehouse(spark)
        snapshot_sources(spark, [FS.text_source(spark, sf)], wh, staging="csv",
                         stage_root=scratch_dir(spark, "stage"))
        return wh.table("public", name)
    return run


def q_snapshot_csv_split(spark, sf):
    """A table dumped as quoted CSV files with line breaks in its values, as a foreign system leaves it.

    The files are of any size, one a scan task; they are read in blocks, cut at any byte.
    """
    root = scratch_dir(spark, "dump")
    docs = read_table(spark, sf, "documents")
    write_csv_snapshot(docs, f"{root}/public/documents", max_records_per_file=None)
    columns = [(f.name, pg_type_of(f.dataType)) for f in docs.schema.fields]
    src = FileSource(spark, "dump", root, "csv", {("public", "documents"): columns}, split_bytes=1 << 20)
    wh = _warehouse(spark)
    copy_table(src, "public", "documents", wh)
    return wh.table("public", "documents")


def q_snapshot_verified(spark, sf):
    """Copies through a CSV stage: the totals taken on the way must agree with the stored tables."""
    wh = _warehouse(spark)
    rep = snapshot_sources(spark, [FS.text_source(spark, sf)], wh, staging="csv",
                           stage_root=scratch_dir(spark, "stage"))
    rows = [(s, n, t.rows, tally_of(wh.table(s, n)) == t) for (s, n), t in rep.totals.items()]
    return spark.createDataFrame(rows, "schema_name string, table_name string, n_rows bigint, verified boolean")


def q_snapshot_numeric_fit(spark, sf):
    """Unbounded numbers: a decimal, text for the column of over 38 digits, and the few rows with NaN set aside."""
    wh = _warehouse(spark)
    snapshot_sources(spark, [FS.number_source(spark, sf)], wh, most_unfit=0.01)
    keys = ["l_orderkey", "l_linenumber"]
    kept, aside = wh.table("public", "numbers"), wh.table("public", "numbers_unfit")
    return kept.select(*keys, F.col("price").cast("double"), "wide", F.col("odd").cast("double"),
                       F.lit(None).cast("string").alias("unfit")).unionByName(
        aside.select(*keys, F.col("price").cast("double"), "wide", F.lit(None).cast("double").alias("odd"),
                     F.array_join("unfit_columns", ",").alias("unfit")))


def q_two_warehouses(spark, sf):
    """Both language models, each in a warehouse of its own and from its own accounts.

    On the Russian side every account belongs to the next club.
    """
    models = []
    for lang in ("en", "ru"):
        wh, objects = _warehouse(spark), FS.billing_objects(spark, sf)
        if lang == "ru":
            objects[("billing", "balance_user")] = SourceObject("r", lambda: fixture_table(
                spark, sf, "balance_user").withColumn("id_club", F.col("id_club") + 1))
        models.append((lang, wh))
        snapshot_sources(spark, [FrameSource(spark, lang, objects)], wh)
    for lang, wh in models:                           # both are filled before either model is built
        M.refresh_model(spark, wh, lang)
    parts = [M.model_table(wh, lang).select(F.lit(lang).alias("lang"), "*") for lang, wh in models]
    return parts[0].unionByName(parts[1])


def q_snapshot_refresh(spark, sf):
    """Load an outdated version, then the current one: only the current rows remain."""
    wh = _warehouse(spark)
    old = FrameSource(spark, "main", {("public", "orders"): SourceObject(
        "r", lambda: read_table(spark, sf, "orders").withColumn(
            "o_totalprice", F.col("o_totalprice") * 2))})
    copy_table(old, "public", "orders", wh)
    copy_table(FS.main_source(spark, sf), "public", "orders", wh)
    copy_table(FS.main_source(spark, sf), "public", "orders", wh)
    return wh.table("public", "orders")


def q_snapshot_two_sources(spark, sf):
    wh = _warehouse(spark)
    rep = snapshot_sources(spark, FS.two_sources(spark, sf), wh)
    return manifest(spark, rep, wh)


def q_snapshot_matview(spark, sf):
    wh = _warehouse(spark)
    snapshot_sources(spark, [FS.matview_source(spark, sf)], wh)
    return wh.table("reports", "orders_mv")


def q_view_replay(spark, sf):
    wh = _warehouse(spark)
    rep = snapshot_sources(spark, [FS.view_source(spark, sf)], wh)
    if rep.views is None or len(rep.views.created) != 3:
        raise RuntimeError(f"view replay incomplete: {rep.views}")
    return wh.table("reports", "v_club_payments")


def _refreshed_model(spark, sf, lang="en", layout="rebalance"):
    wh = _warehouse(spark)
    snapshot_sources(spark, [FS.billing_source(spark, sf)], wh)
    M.refresh_model(spark, wh, lang, layout=layout)
    return M.model_table(wh, lang)


LOOKUP_CLUBS = [5, 7, 13]
LOOKUP_FROM, LOOKUP_TO = "1995-01-01 00:00:00", "1997-01-01 00:00:00"


def q_model_refresh(spark, sf):
    return _refreshed_model(spark, sf, "en")


def q_model_layout_lookup(spark, sf):
    return M.lookup(_refreshed_model(spark, sf, "en", "curve"), LOOKUP_CLUBS, LOOKUP_FROM, LOOKUP_TO)


def _llm():
    """The training-data queries and their SQL; nothing where that subpackage is not installed."""
    try:
        import corpus_pipeline
        from cashbook.llm import queries as llm
    except ModuleNotFoundError as e:
        if e.name in ("corpus_pipeline", "cashbook.llm"):
            return {}, {}
        raise
    sql = dict(llm.ORACLE_SQL)
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_llm()[0], **_billing_queries()}


def _billing_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pnl_en": _model("en"),
        "pnl_ru": _model("ru"),
        "scan_payment": q_scan_payment,
        "pnl_source": q_pnl_source,
        "pnl_sales_by_method": _wide(SALES_KEYS),
        "pnl_other_revenue_cols": _wide(OTHER_REVENUE_KEYS),
        "pnl_expense_cols": _wide(EXPENSE_KEYS),
        "pnl_wide": q_pnl_wide,
        "filter_active_types": q_filter_active_types,
        "filter_main_balance": q_filter_main_balance,
        "pred_in_list": q_pred_in_list,
        "pnl_leaf": _model("en", LEAF_KEYS),
        "pnl_rollups": _model("en", ROLLUP_KEYS),
        "join_payment_type": q_join_payment_type,
        "join_account": q_join_account,
        "join_balance": q_join_balance,
        "join_club": q_join_club,
        "union_all_bag": q_union_all_bag,
        "pnl_other_revenue": _model("en", ["other_revenue"]),
        "pnl_total_revenue": _model("en", ["total_revenue"]),
        "pnl_total_expenses": _model("en", ["total_expenses"]),
        "pnl_profit": _model("en", ["profit"]),
        "scalar_cast_double": q_scalar_cast_double,
        "scalar_coalesce": q_scalar_coalesce,
        "local_time": q_local_time,
        "snapshot_all": q_snapshot_all,
        "snapshot_coerced": q_snapshot_coerced,
        "snapshot_csv": _staged("documents"),
        "snapshot_csv_events": _staged("events"),
        "snapshot_csv_lineitem": _staged("lineitem"),
        "snapshot_csv_split": q_snapshot_csv_split,
        "snapshot_verified": q_snapshot_verified,
        "snapshot_numeric_fit": q_snapshot_numeric_fit,
        "two_warehouses": q_two_warehouses,
        "snapshot_refresh": q_snapshot_refresh,
        "snapshot_two_sources": q_snapshot_two_sources,
        "snapshot_matview": q_snapshot_matview,
        "view_replay": q_view_replay,
        "model_refresh": q_model_refresh,
        "model_layout_lookup": q_model_layout_lookup,
    }


# ---------------------------------------------------------------- oracles

def _two_models_sql():
    moved = O.model_sql("ru").replace("c_nationkey + 2 END", "c_nationkey + 3 END")
    return f"SELECT 'en' AS lang, * FROM ({O.model_sql('en')}) UNION ALL SELECT 'ru' AS lang, * FROM ({moved})"


def _wide_sql(keys):
    cols = ["id", "payment_time", "id_club", "id_payment_type", "id_grp_payment_type", "profit",
            "amount"]
    return O.source_sql("en", cols, keys)


_PT_JOIN = "FROM payment p JOIN payment_type pt ON p.id_payment_type = pt.id"
_BU_JOIN = "FROM payment p LEFT JOIN balance_user bu ON p.id_balance_user = bu.id"


_PLAIN = {
    "balance": "id", "balance_user": "id, id_club, id_balance", "club": "id, time_zone",
    "payment": "id, id_payment_type, id_balance_user, amount, id_reservation_terminal, id_subscription_user, "
               "id_reservation_shop, id_parent",
    "payment_type": "id, profit, method, state, direct, id_parent",
    "customer": "c_custkey, c_name, c_nationkey, c_mktsegment",
    "orders": "o_orderkey, o_custkey, o_orderstatus, o_orderpriority",
    "lineitem": "l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(12,2)), "
                "CAST(l_discount AS DECIMAL(12,2)), CAST(l_tax AS DECIMAL(12,2)), l_returnflag, l_linestatus",
    "part": "p_partkey, p_name, p_brand, p_type, p_size",
}


def _counts(rows: list[tuple[str, str, str, str, str]]) -> str:
    """Rows and checksum per object; the last item names the integer and text columns in order."""
    def one(s, n, k, src, columns):
        parts, depth, at = [], 0, 0
        for i, ch in enumerate(columns + ","):
            depth += (ch == "(") - (ch == ")")
            if ch == "," and not depth:
                parts.append(columns[at:i].strip())
                at = i + 1
        row = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in parts)
        digest = f"CAST('0x' || substr(md5(concat_ws('|', {row})), 1, 8) AS BIGINT)"
        return (f"SELECT '{s}' AS schema_name, '{n}' AS table_name, '{k}' AS kind, count(*) AS n_rows, "
                f"CAST(coalesce(sum({digest}), 0) AS BIGINT) AS checksum FROM {src}")
    return "\nUNION ALL\n".join(one(*r) for r in rows)


_LINEITEM_TEXT = ("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
                  "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS l_extendedprice, "
                  "CAST(CAST(l_discount AS DECIMAL(12,2)) AS VARCHAR) AS l_discount, "
                  "CAST(CAST(l_tax AS DECIMAL(12,2)) AS VARCHAR) AS l_tax, "
                  "l_returnflag, l_linestatus, l_shipdate FROM lineitem")


def oracle_sql() -> dict[str, str]:
    return {**_llm()[1], **_billing_sql()}


def _billing_sql() -> dict[str, str]:
    W = O.fixtures_with()
    gaming, bar, top = (", ".join(map(str, c)) for c in (GAMING_CODES, BAR_CODES, TOP_UP_CODES))
    return {
        "pnl_en": O.model_sql("en"),
        "pnl_ru": O.model_sql("ru"),
        "scan_payment": f"{W}\nSELECT * FROM payment",
        "pnl_source": O.source_sql("en"),
        "pnl_sales_by_method": _wide_sql(SALES_KEYS),
        "pnl_other_revenue_cols": _wide_sql(OTHER_REVENUE_KEYS),
        "pnl_expense_cols": _wide_sql(EXPENSE_KEYS),
        "pnl_wide": O.source_sql("en", None, LEAF_KEYS),
        "filter_active_types": f"{W}\nSELECT * FROM payment_type pt WHERE pt.state = 1",
        "filter_main_balance": f"{W}\nSELECT p.id, p.date, p.id_balance_user, bu.id_club "
                               f"{_BU_JOIN} WHERE bu.id_balance = 1",
        "pred_in_list": f"{W}\nSELECT p.id, p.date, p.id_payment_type, pt.profit, pt.method "
                        f"{_PT_JOIN} WHERE (p.id_payment_type IN ({gaming}) OR p.id_payment_type "
                        f"IN ({bar}) OR p.id_payment_type IN ({top})) AND pt.profit = 1",
        "pnl_leaf": O.model_sql("en", LEAF_KEYS),
        "pnl_rollups": O.model_sql("en", ROLLUP_KEYS),
        "join_payment_type": f"{W}\nSELECT p.id, p.date, p.id_payment_type, p.amount, pt.profit, "
                             f"pt.method, pt.state {_PT_JOIN}",
        "join_account": f"{W}\nSELECT p.id, p.date, p.id_balance_user, bu.id_club, bu.id_balance "
                        f"{_BU_JOIN}",
        "join_balance": f"{W}\nSELECT p.id, p.date, p.id_balance_user, bu.id_balance, b.id AS b_id "
                        f"{_BU_JOIN} LEFT JOIN balance b ON bu.id_balance = b.id",
        "join_club": f"{W}\nSELECT p.id, p.date, p.id_balance_user, bu.id_club, c.time_zone "
                     f"{_BU_JOIN} LEFT JOIN club c ON c.id = bu.id_club",
        "union_all_bag": O.model_sql("en"),
        "pnl_other_revenue": O.model_sql("en", ["other_revenue"]),
        "pnl_total_revenue": O.model_sql("en", ["total_revenue"]),
        "pnl_total_expenses": O.model_sql("en", ["total_expenses"]),
        "pnl_profit": O.model_sql("en", ["profit"]),
        "scalar_cast_double": f"{W}\nSELECT id, amount, CAST(amount AS DOUBLE) AS amount_double "
                              f"FROM payment",
        "scalar_coalesce": f"{W}\nSELECT id, amount, COALESCE(CAST(amount AS DOUBLE), 0) AS "
                           f"amount_or_zero FROM payment",
        "local_time": f"{W}\nSELECT p.id, p.date AS payment_time, c.time_zone, "
                      f"p.date + (c.time_zone * INTERVAL '1 second') AS payment_time_local "
                      f"{_BU_JOIN} LEFT JOIN club c ON c.id = bu.id_club",
        "snapshot_all": W + "\n" + _counts([
            ("billing", "balance", "r", "balance", _PLAIN["balance"]),
            ("billing", "balance_user", "r", "balance_user", _PLAIN["balance_user"]),
            ("billing", "payment", "r", "payment", _PLAIN["payment"]),
            ("billing", "payment_type", "r", "payment_type", _PLAIN["payment_type"]),
            ("cntrl", "club", "r", "club", _PLAIN["club"]),
            ("public", "customer", "r", "customer", _PLAIN["customer"]),
            ("public", "lineitem", "r", "lineitem", _PLAIN["lineitem"]),
            ("public", "orders", "r", "orders", _PLAIN["orders"]),
            ("reports", "orders_mv", "m", "orders", _PLAIN["orders"]),
            ("billing", "v_active_payment", "v",
             "payment p JOIN payment_type pt ON p.id_payment_type = pt.id WHERE pt.state = 1",
             "p.id, p.amount, pt.method"),
        ]),
        "snapshot_coerced": _LINEITEM_TEXT,
        "snapshot_csv": "SELECT * FROM documents",
        "snapshot_csv_events": "SELECT * FROM events",
        "snapshot_csv_lineitem": "SELECT * FROM lineitem",
        "snapshot_csv_split": "SELECT * FROM documents",
        "snapshot_numeric_fit": "WITH numbers AS (" + FS.NUMBERS.format(text="VARCHAR", lineitem="lineitem") + """)
SELECT l_orderkey, l_linenumber, CAST(price AS DOUBLE) AS price, wide,
       CASE WHEN odd <> 'NaN' THEN CAST(odd AS DOUBLE) END AS odd,
       CASE WHEN odd = 'NaN' THEN 'odd' END AS unfit FROM numbers""",
        "snapshot_verified": "\nUNION ALL\n".join(
            f"SELECT 'public' AS schema_name, '{t}' AS table_name, count(*) AS n_rows, true AS verified FROM {t}"
            for t in ("documents", "events", "lineitem")),
        "two_warehouses": _two_models_sql(),
        "snapshot_refresh": "SELECT * FROM orders",
        "snapshot_two_sources": _counts([
            ("billing", "orders", "r", "orders", _PLAIN["orders"]),
            ("public", "customer", "r", "customer", _PLAIN["customer"]),
            ("public", "part", "r", "part", _PLAIN["part"]),
        ]),
        "snapshot_matview": "SELECT * FROM orders",
        "view_replay": f"{W}\nSELECT p.id, p.date, bu.id_club, c.time_zone, "
                       f"CAST(p.amount AS VARCHAR) AS amount_label FROM payment p "
                       f"JOIN balance_user bu ON p.id_balance_user = bu.id "
                       f"JOIN (SELECT id, profit, method FROM payment_type WHERE state = 1) t "
                       f"ON t.id = p.id_payment_type LEFT JOIN club c ON c.id = bu.id_club",
        "model_refresh": O.model_sql("en"),
        "model_layout_lookup": O.model_sql(
            "en", where=f"id_club IN ({', '.join(map(str, LOOKUP_CLUBS))}) "
                        f"AND payment_time_local >= TIMESTAMP '{LOOKUP_FROM}' "
                        f"AND payment_time_local < TIMESTAMP '{LOOKUP_TO}'"),
    }
