"""Long form in one pass: rule join instead of a 34-branch union.

    payments (amount NOT NULL, code in the rule codes)       -- scan, pushed filters
      JOIN broadcast(active types)                            -- J1 + F1
      JOIN accounts (broadcast if bounded, else shuffle)      -- J2-J4 + F2
      JOIN broadcast(rules) ON code = r_type AND profit = r_profit
                              AND (r_method IS NULL OR method = r_method)
    value = sign * amount::double
    keep rows where NOT nonzero OR value != 0

Why this equals the union of 34 branches: a joined row satisfies at most one
leaf condition, so each roll-up over that row is ``0 + ... + a + ... + 0 = a``
(``0 - a`` for an expense inside Profit) -- bit-identical in floating point.
A NULL amount makes every leaf NULL and every roll-up 0, hence no row at all,
which is why ``amount IS NOT NULL`` can be pushed into the scan.  The fan-out
to 1-4 metric rows happens after the only possible shuffle (the account join),
so the shuffle carries one row per payment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashbook.functions.scalar import local_time, to_double
from cashbook.operators.broadcast import ACCOUNT_MAX_ROWS, DIMENSION_MAX_ROWS
from cashbook.operators.feed import (active_types, dimension_sides, join_accounts_split, of_main_accounts,
                                     join_types)
from cashbook.operators.skew import DEFAULT_ROWS_PER_TASK
from cashbook.operators.rules import COL_METRIC, COL_ORDER, COL_VALUE, rule_codes, rule_table
from cashbook.sources.fixtures import BillingTables

LONG_COLUMNS = ("id_club", "payment_time", "payment_time_local", "id_payment_type",
                "id_grp_payment_type", COL_METRIC, COL_VALUE, COL_ORDER)


def rule_join_condition(x: DataFrame, rules: DataFrame):
    return ((x["id_payment_type"] == rules["r_type"]) & (x["pt_profit"] == rules["r_profit"])
            & (rules["r_method"].isNull() | (x["pt_method"] == rules["r_method"])))


def pnl_long(t: BillingTables, lang: str = "en",
             metrics: tuple[str, ...] | list[str] | None = None,
             dim_max_rows: int = DIMENSION_MAX_ROWS,
             account_max_rows: int = ACCOUNT_MAX_ROWS, skew: str = "auto",
             hot_rows_per_task: int = DEFAULT_ROWS_PER_TASK) -> DataFrame:
    """The long metric rows of the model (optionally only some metrics).

    ``dim_max_rows`` / ``account_max_rows`` bound what may be broadcast; an
    account side above its bound is joined by a shuffle on the account id,
    hot accounts split by AQE or by explicit salting (``skew``, see
    :func:`cashbook.operators.feed.join_accounts_split`).
    """
    spark = t.payment.sparkSession
    rules = rule_table(spark, lang, metrics)
    codes = rule_codes(metrics)

    payments = (t.payment
                .select("date", "id_payment_type", "id_balance_user", "amount")
                .filter(F.col("amount").isNotNull() & F.col("id_payment_type").isin(codes)))

    # Active types that can match some rule at all; the semi join runs on two
    # tiny tables while the broadcast side is built.
    active = (active_types(t.payment_type)
              .select(F.col("id").alias("pt_id"), F.col("method").alias("pt_method"),
                      F.col("profit").alias("pt_profit")))
    has_rule = ((active["pt_id"] == rules["r_type"]) & (active["pt_profit"] == rules["r_profit"])
                & (rules["r_method"].isNull() | (active["pt_method"] == rules["r_method"])))
    types = active.join(F.broadcast(rules), has_rule, "left_semi")

    # size probes of all four dimension sides, run concurrently (the active
    # types bound the semi-joined ones)
    types, accounts, small_acc = dimension_sides(t, types, dim_max_rows, account_max_rows,
                                                 types_probe=active)
    if not small_acc:
        payments = of_main_accounts(payments, t)
    x = join_accounts_split(join_types(payments, types), accounts, small_acc, skew,
                            hot_rows_per_task)
    # The rule table is built from the fixed catalogue: a few hundred rows,
    # bounded by construction, so it is broadcast without a probe.
    x = x.join(F.broadcast(rules), rule_join_condition(x, rules), "inner")
    value = F.col("sign") * to_double("amount")
    x = x.withColumn("_value", value).filter(~F.col("nonzero") | (F.col("_value") != 0))
    return x.select(
        F.col("id_club"),
        F.col("date").alias("payment_time"),
        local_time("date", "time_zone").alias("payment_time_local"),
        F.col("id_payment_type"),
        F.col("pt_method").alias("id_grp_payment_type"),
        F.col("metric").alias(COL_METRIC),
        F.col("_value").alias(COL_VALUE),
        F.col("ord").alias(COL_ORDER),
    )
