"""Source systems assembled from the driver's testdata, for the snapshot checks.

Every object is a whole testdata table or a billing table derived from them
(see :mod:`cashbook.sources.fixtures`), so the copying work grows with the
data.  Objects in excluded schemas / on the exclusion list / of kinds that
are not copied are included on purpose and must not reach the warehouse.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cashbook.sources.fixtures import fixture_table
from cashbook.sources.snapshot import FrameSource, SourceObject
from cashbook.sources.testdata import read_table

# Source-side column types of lineitem: money columns are fixed-scale numerics
# (they land as text), flags are fixed-width characters (text as well).
LINEITEM_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint",
    "l_linenumber": "integer", "l_quantity": "double precision",
    "l_extendedprice": "numeric(12,2)", "l_discount": "numeric(12,2)", "l_tax": "numeric(12,2)",
    "l_returnflag": "character(1)", "l_linestatus": "character(1)",
    "l_shipdate": "timestamp without time zone",
}
PAYMENT_TYPES = {"amount": "numeric(12,2)"}

ACTIVE_PAYMENTS_VIEW = ("SELECT p.id, p.date, p.amount, pt.method FROM billing.payment p "
                        "JOIN billing.payment_type pt ON p.id_payment_type = pt.id WHERE pt.state = 1")

# listed first, depends on the view listed last; calls the `_` placeholder
CLUB_PAYMENTS_VIEW = ("SELECT v.id, v.date, v.id_club, c.time_zone, _(CAST(v.amount AS STRING)) "
                      "AS amount_label FROM reports.v_payments_local v "
                      "LEFT JOIN cntrl.club c ON c.id = v.id_club")
# an alias named like a schema, and an apostrophe and a schema name in comments and texts
ACTIVE_TYPES_VIEW = ("-- it's only the active ones, see billing.payment_type\n"
                     "SELECT billing.id, billing.profit, billing.method, 'billing.payment_type' AS \"from\"\n"
                     "FROM billing.payment_type billing /* the club's billing.x */ WHERE billing.state = 1")
PAYMENTS_LOCAL_VIEW = ("SELECT p.id, p.date, p.amount, bu.id_club FROM billing.payment p "
                       "JOIN billing.balance_user bu ON p.id_balance_user = bu.id "
                       "JOIN reports.v_active_types t ON t.id = p.id_payment_type")


def _t(spark, sf, name, kind="r", declared=None):
    # copies of small single-row-group files are spread over the cores
    return SourceObject(kind, lambda: read_table(spark, sf, name, spread=True), dict(declared or {}))


def _fx(spark, sf, name, declared=None):
    return SourceObject("r", lambda: fixture_table(spark, sf, name), dict(declared or {}))


def billing_objects(spark: SparkSession, sf: str) -> dict:
    return {
        ("billing", "payment"): _fx(spark, sf, "payment", PAYMENT_TYPES),
        ("billing", "payment_type"): _fx(spark, sf, "payment_type"),
        ("billing", "balance_user"): _fx(spark, sf, "balance_user"),
        ("billing", "balance"): _fx(spark, sf, "balance"),
        ("cntrl", "club"): _fx(spark, sf, "club"),
    }


def billing_source(spark: SparkSession, sf: str) -> FrameSource:
    """Only the five tables the model reads."""
    return FrameSource(spark, "billing", billing_objects(spark, sf))


def main_source(spark: SparkSession, sf: str) -> FrameSource:
    objs = billing_objects(spark, sf)
    objs.update({
        ("public", "orders"): _t(spark, sf, "orders"),
        ("public", "customer"): _t(spark, sf, "customer"),
        ("public", "lineitem"): _t(spark, sf, "lineitem", declared=LINEITEM_TYPES),
        ("reports", "orders_mv"): _t(spark, sf, "orders", kind="m"),
        ("billing", "v_active_payment"): SourceObject("v", sql=ACTIVE_PAYMENTS_VIEW),
        # never copied: excluded schemas, excluded pairs, partitioned parent
        ("tiger", "region"): _t(spark, sf, "region"),
        ("topology", "nation"): _t(spark, sf, "nation"),
        ("public", "spatial_ref_sys"): _t(spark, sf, "nation"),
        ("public", "pg_stat_statements"): _t(spark, sf, "supplier"),
        ("public", "parts_parent"): _t(spark, sf, "part", kind="p"),
    })
    return FrameSource(spark, "main", objs)


def lineitem_source(spark: SparkSession, sf: str) -> FrameSource:
    return FrameSource(spark, "main", {
        ("public", "lineitem"): _t(spark, sf, "lineitem", declared=LINEITEM_TYPES)})


# Numbers without a precision, as text: one column fits a decimal, one has values of over 38 digits, one has NaN.
NUMBERS = ("SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS {text}) AS price, "
           "CASE WHEN l_orderkey % 4 = 0 THEN concat(repeat('7', 30), CAST(l_orderkey AS {text}), '.', repeat('3', 12)) "
           "ELSE CAST(l_partkey AS {text}) END AS wide, "
           "CASE WHEN l_orderkey % 500 = 0 THEN 'NaN' ELSE CAST(CAST(l_discount AS DECIMAL(12,2)) AS {text}) END AS odd "
           "FROM {lineitem}")


def number_source(spark: SparkSession, sf: str) -> FrameSource:
    def frame():
        return spark.sql(NUMBERS.format(text="STRING", lineitem="{lineitem}"),
                         lineitem=read_table(spark, sf, "lineitem", spread=True))
    return FrameSource(spark, "numbers", {("public", "numbers"): SourceObject(
        "r", frame, {"price": "numeric", "wide": "numeric", "odd": "numeric"})})


def text_source(spark: SparkSession, sf: str) -> FrameSource:
    """Long prose, JSON strings and microsecond timestamps (CSV staging check)."""
    return FrameSource(spark, "docs", {
        ("public", "documents"): _t(spark, sf, "documents"),
        ("public", "events"): _t(spark, sf, "events"),
        ("public", "lineitem"): _t(spark, sf, "lineitem"),
    })


def matview_source(spark: SparkSession, sf: str) -> FrameSource:
    return FrameSource(spark, "main", {
        ("reports", "orders_mv"): _t(spark, sf, "orders", kind="m"),
        ("reports", "orders_parent"): _t(spark, sf, "orders", kind="p"),
    })


def view_source(spark: SparkSession, sf: str) -> FrameSource:
    objs = billing_objects(spark, sf)
    objs.update({
        ("reports", "v_club_payments"): SourceObject("v", sql=CLUB_PAYMENTS_VIEW),
        ("reports", "v_active_types"): SourceObject("v", sql=ACTIVE_TYPES_VIEW),
        ("reports", "v_payments_local"): SourceObject("v", sql=PAYMENTS_LOCAL_VIEW),
    })
    return FrameSource(spark, "main", objs)


def two_sources(spark: SparkSession, sf: str) -> list[FrameSource]:
    """Both systems hold billing.orders; the second (complete) copy must win."""
    first = FrameSource(spark, "main", {
        ("billing", "orders"): SourceObject(
            "r", lambda: read_table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")),
        ("public", "customer"): _t(spark, sf, "customer"),
    })
    second = FrameSource(spark, "shop", {
        ("billing", "orders"): _t(spark, sf, "orders"),
        ("public", "part"): _t(spark, sf, "part"),
    })
    return [first, second]
