"""DuckDB oracle texts.

The oracle states the model the way it is written at the source -- a wide
``source`` CTE of CASE columns read by one ``UNION ALL`` branch per metric --
while the Spark side runs the single-pass rule join, so the two are formulated
independently.  The fixture tables come first in a leading ``WITH``.
"""

from __future__ import annotations

from cashbook.operators.rules import (BAR_CODES, COL_METRIC, COL_ORDER, COL_VALUE, GAMING_CODES,
                                      LEAF_BY_KEY, LEAVES, ROLLUP_BY_KEY, ROLLUPS, TOP_UP_CODES,
                                      rollup_members)
from cashbook.sources.fixtures import fixture_sql_plain

FIXTURES = ("payment", "payment_type", "balance_user", "balance", "club")

SOURCE_COLUMNS = [
    "bu.id_club", "p.id_balance_user", "bu.id_balance AS id_type_balance",
    "p.date AS payment_time", "p.id", "pt.direct", "p.id_payment_type",
    "pt.method AS id_grp_payment_type", "pt.profit", "p.amount", "p.id_reservation_terminal",
    "p.id_subscription_user", "p.id_reservation_shop", "p.id_parent",
    "pt.id_parent AS id_payment_type_parent",
    "p.date + (c.time_zone * INTERVAL '1 second') AS payment_time_local",
]
SOURCE_FROM = """FROM payment p
  JOIN payment_type pt ON p.id_payment_type = pt.id
  LEFT JOIN balance_user bu ON p.id_balance_user = bu.id
  LEFT JOIN balance b ON bu.id_balance = b.id
  LEFT JOIN club AS c ON c.id = bu.id_club
WHERE pt.state = 1 AND bu.id_balance = 1"""
KEYS = "id_club, payment_time, payment_time_local, id_payment_type, id_grp_payment_type"


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def fixtures_with(extra: list[str] | None = None) -> str:
    ctes = [f"{n} AS (\n{fixture_sql_plain(n)}\n)" for n in FIXTURES] + (extra or [])
    return "WITH " + ",\n".join(ctes)


def _codes(codes) -> str:
    return ", ".join(str(c) for c in codes)


def leaf_case(leaf) -> str:
    if leaf.codes == GAMING_CODES + BAR_CODES + TOP_UP_CODES:
        member = (f"(p.id_payment_type IN ({_codes(GAMING_CODES)}) OR p.id_payment_type IN "
                  f"({_codes(BAR_CODES)}) OR p.id_payment_type IN ({_codes(TOP_UP_CODES)}))")
    else:
        member = f"p.id_payment_type IN ({_codes(leaf.codes)})"
    cond = f"{member} AND pt.profit = {leaf.profit}"
    if leaf.method is not None:
        cond += f" AND pt.method = {leaf.method}"
    return f"CASE WHEN {cond} THEN p.amount ELSE NULL END"


def source_cte(lang: str) -> str:
    cols = SOURCE_COLUMNS + [f"{leaf_case(m)} AS {q(m.label(lang))}" for m in LEAVES]
    return "source AS (\nSELECT " + ",\n  ".join(cols) + "\n" + SOURCE_FROM + "\n)"


def _order(o) -> str:
    return f"CAST({o} AS DECIMAL(5,4))"


def leaf_branch(leaf, lang: str) -> str:
    col = q(leaf.label(lang))
    return (f"SELECT {KEYS}, '{leaf.label(lang)}' AS {q(COL_METRIC)}, "
            f"CAST({col} AS DOUBLE) AS {q(COL_VALUE)}, {_order(leaf.order)} AS {q(COL_ORDER)} "
            f"FROM source WHERE {col} IS NOT NULL")


def rollup_expr(key: str, lang: str) -> str:
    def total(sign):
        return " + ".join(f"COALESCE(CAST({q(m.label(lang))} AS DOUBLE), 0)"
                          for m, s in rollup_members(key) if s == sign)
    minus = total(-1)
    return f"(({total(1)}) - ({minus}))" if minus else f"({total(1)})"


def rollup_branch(r, lang: str) -> str:
    e = rollup_expr(r.key, lang)
    return (f"SELECT {KEYS}, '{r.label(lang)}' AS {q(COL_METRIC)}, {e} AS {q(COL_VALUE)}, "
            f"{_order(r.order)} AS {q(COL_ORDER)} FROM source WHERE {e} != 0")


def model_sql(lang: str = "en", metrics: list[str] | tuple[str, ...] | None = None,
              where: str | None = None) -> str:
    """The model (or some of its metrics) as the union of its branches."""
    keys = [m.key for m in LEAVES] + [r.key for r in ROLLUPS] if metrics is None else list(metrics)
    parts = []
    for k in keys:
        parts.append(leaf_branch(LEAF_BY_KEY[k], lang) if k in LEAF_BY_KEY
                     else rollup_branch(ROLLUP_BY_KEY[k], lang))
    body = "\nUNION ALL\n".join(parts)
    if where:
        body = f"SELECT * FROM (\n{body}\n) m WHERE {where}"
    return fixtures_with([source_cte(lang)]) + "\n" + body


def model_sql_over_tables(lang: str = "en") -> str:
    """The model over existing tables named payment, payment_type, balance_user,
    balance and club (no fixture CTEs)."""
    keys = [m.key for m in LEAVES] + [r.key for r in ROLLUPS]
    body = "\nUNION ALL\n".join(
        leaf_branch(LEAF_BY_KEY[k], lang) if k in LEAF_BY_KEY else rollup_branch(ROLLUP_BY_KEY[k], lang)
        for k in keys)
    return "WITH " + source_cte(lang) + "\n" + body


def source_sql(lang: str = "en", columns: list[str] | None = None,
               leaf_keys: list[str] | tuple[str, ...] | None = None) -> str:
    """Rows of the ``source`` CTE: chosen columns plus chosen leaf columns."""
    cols = list(columns) if columns else [c.split(" AS ")[-1].split(".")[-1] for c in SOURCE_COLUMNS]
    cols += [q(LEAF_BY_KEY[k].label(lang)) for k in (leaf_keys or [])]
    return fixtures_with([source_cte(lang)]) + "\nSELECT " + ", ".join(cols) + " FROM source"
