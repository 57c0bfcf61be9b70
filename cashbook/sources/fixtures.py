"""Billing tables derived from the driver's testdata.

The model needs ``billing.payment``, ``billing.payment_type``,
``billing.balance_user``, ``billing.balance`` and ``cntrl.club``.  Each is one
SQL text over the TPC-H-style tables that runs unchanged in Spark SQL and in
DuckDB (the oracle): ``{name}`` placeholders become DataFrame parameters in
Spark and plain view names in DuckDB.  The derived tables exercise NULL,
zero, negative and text amounts, orphan accounts, missing clubs, inactive and
unknown payment types and both profit flags of the shared codes.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from cashbook.sources.testdata import read_table

FIXTURE_SQL = {
    "payment": """
SELECT l.l_orderkey * 8 + l.l_linenumber AS id, l.l_shipdate AS date,
 CAST(1 + (l.l_partkey * 7 + l.l_linenumber) % 190 AS INT) AS id_payment_type,
 CASE WHEN l.l_orderkey % 53 = 0 THEN NULL ELSE o.o_custkey END AS id_balance_user,
 CASE WHEN l.l_orderkey % 97 = 0 THEN NULL
      WHEN l.l_linenumber = 7 AND l.l_quantity < 10 THEN '0.00'
      WHEN l.l_returnflag = 'R' AND l.l_orderkey % 5 = 0 THEN CAST(CAST(-l.l_extendedprice AS DECIMAL(12,2)) AS STRING)
      ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS STRING) END AS amount,
 l.l_suppkey AS id_reservation_terminal,
 CASE WHEN l.l_linenumber = 2 THEN l.l_partkey ELSE NULL END AS id_subscription_user,
 CASE WHEN l.l_linenumber = 3 THEN l.l_partkey ELSE NULL END AS id_reservation_shop,
 CASE WHEN l.l_linenumber > 1 THEN l.l_orderkey * 8 + l.l_linenumber - 1 ELSE NULL END AS id_parent
 FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey""",
    "payment_type": """
SELECT CAST(CASE WHEN p_partkey > 185 THEN p_partkey + 5 ELSE p_partkey END AS INT) AS id,
 CASE WHEN p_partkey % 37 = 0 THEN CASE WHEN p_partkey BETWEEN 100 AND 164 OR p_partkey IN (170,173) THEN 1 ELSE 0 END
      WHEN p_partkey BETWEEN 100 AND 164 OR p_partkey IN (170,173) THEN 0 ELSE 1 END AS profit,
 CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 9 < 3 THEN 1 WHEN p_partkey % 9 < 6 THEN 2 ELSE 3 END AS method,
 CASE WHEN p_partkey % 10 = 1 THEN 0 ELSE 1 END AS state,
 p_size % 2 AS direct, CASE WHEN p_partkey > 1 THEN CAST(p_partkey - 1 AS INT) ELSE NULL END AS id_parent
 FROM {part}""",
    "balance_user": """
SELECT c_custkey AS id, CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_nationkey + 2 END AS id_club,
 CASE WHEN c_custkey % 4 = 0 THEN 2 ELSE 1 END AS id_balance FROM {customer}""",
    "balance": """
SELECT r_regionkey AS id FROM {region}""",
    "club": """
SELECT n_nationkey AS id, (n_nationkey - 12) * 1800 AS time_zone FROM {nation}""",
}

# warehouse (schema, name) of each fixture table
QUALIFIED = {
    "payment": ("billing", "payment"),
    "payment_type": ("billing", "payment_type"),
    "balance_user": ("billing", "balance_user"),
    "balance": ("billing", "balance"),
    "club": ("cntrl", "club"),
}

_INPUTS = {"payment": ("lineitem", "orders"), "payment_type": ("part",),
           "balance_user": ("customer",), "balance": ("region",), "club": ("nation",)}


class BillingTables(NamedTuple):
    payment: DataFrame
    payment_type: DataFrame
    balance_user: DataFrame
    balance: DataFrame
    club: DataFrame


_FIXTURES: dict = {}


def fixture_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table (a lazy plan, built once per session and input folder)."""
    key = (id(spark), sf_dir.rstrip("/"), name)
    df = _FIXTURES.get(key)
    if df is None or df.sparkSession is not spark:
        # the fact input is spread over the cores; dimension inputs are broadcast
        frames = {t: read_table(spark, sf_dir, t, spread=(t == "lineitem")) for t in _INPUTS[name]}
        df = _FIXTURES[key] = spark.sql(FIXTURE_SQL[name], **frames)
    return df


def fixture_tables(spark: SparkSession, sf_dir: str) -> BillingTables:
    return BillingTables(**{n: fixture_table(spark, sf_dir, n) for n in BillingTables._fields})


def catalog_tables(warehouse) -> BillingTables:
    """The same five tables read from a warehouse."""
    return BillingTables(**{n: warehouse.table(*QUALIFIED[n]) for n in BillingTables._fields})


def fixture_sql_plain(name: str) -> str:
    """The fixture text with plain table names (for the DuckDB oracle)."""
    text = FIXTURE_SQL[name]
    for t in _INPUTS[name]:
        text = text.replace("{" + t + "}", t)
    return text.strip()
