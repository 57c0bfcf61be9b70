"""Wide form: one conditional amount column per leaf metric.

A leaf column holds the payment's amount (as stored, text or number) when the
row satisfies the leaf's condition and NULL otherwise:

    CASE WHEN id_payment_type IN (<codes>) AND profit = <p> [AND method = <m>]
         THEN amount END

A row satisfies at most one leaf condition, so the leaf is found once per row
by a broadcast hash lookup of (code, profit[, method]) in the leaf rules; the
30 columns are then ``CASE WHEN leaf = k THEN amount END``.  Evaluating the 30
IN-list conditions inline instead makes the fused generated code too large
for the JIT and runs several times slower.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashbook.operators.rules import LEAF_BY_KEY, LEAVES, rule_table


def with_leaf_columns(feed: DataFrame, lang: str = "en",
                      keys: tuple[str, ...] | list[str] | None = None) -> DataFrame:
    """Append the leaf columns (named by their labels in ``lang``) to the feed."""
    leaves = LEAVES if keys is None else tuple(LEAF_BY_KEY[k] for k in keys)
    spark = feed.sparkSession
    # leaf rules only (no roll-ups): at most one match per row, so no fan-out;
    # constant size (117 rows), broadcast without a probe
    keys_in_order = [m.key for m in leaves]
    rules = rule_table(spark, lang, keys_in_order).select(
        "r_type", "r_profit", "r_method",
        F.array_position(F.array(*[F.lit(k) for k in keys_in_order]), F.col("metric_key"))
        .cast("int").alias("_leaf"))
    cond = ((feed["id_payment_type"] == rules["r_type"]) & (feed["profit"] == rules["r_profit"])
            & (rules["r_method"].isNull() | (feed["id_grp_payment_type"] == rules["r_method"])))
    x = feed.join(F.broadcast(rules), cond, "left")
    return x.select(*[feed[c] for c in feed.columns],
                    *[F.when(F.col("_leaf") == i, F.col("amount")).alias(leaf.label(lang))
                      for i, leaf in enumerate(leaves, start=1)])
