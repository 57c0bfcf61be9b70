"""Metric catalogue of the cash-flow / P&L model and the rule table built from it.

The model emits, per payment, one row for each metric the payment feeds.  A
payment feeds a *leaf* metric when its payment-type code is in the leaf's code
list and its type carries the leaf's ``profit`` flag (and, for the three sales
leaves, the leaf's payment ``method``).  Four *roll-up* metrics add leaves of
the same row; because no (code, profit, method) triple belongs to two leaves, a
roll-up over one row is simply the single leaf value it contains (or its
negation, for expenses inside Profit).

That lets the whole model run as one equi join against a small rule table
``(r_type, r_profit, r_method, metric, sign, nonzero, ord)`` instead of 34
separate scans: a leaf rule keeps zero amounts (``nonzero = false``), a roll-up
rule drops them (``nonzero = true``).
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# They must equal the published model exactly (labels, codes,
# profit flags, payment methods, display-order keys, output column names).
# ---------------------------------------------------------------------------
GAMING_CODES = (5, 8, 23, 38, 41, 44, 65, 68, 71, 11, 47, 74)
BAR_CODES = (26, 29, 32, 35)
TOP_UP_CODES = (17, 20, 98, 62, 185)
SALES_CODES = GAMING_CODES + BAR_CODES + TOP_UP_CODES

# key, English label, Russian label, payment-type codes, profit, method (None = any), order
_LEAF_ROWS = [
    ("cash", "Cash", "Наличка", SALES_CODES, 1, 1, "1.2"),
    ("pos", "POS", "Безнал", SALES_CODES, 1, 2, "1.3"),
    ("online_app", "Online (APP)", "Онлайн (APP)", SALES_CODES, 1, 3, "1.4"),
    ("gift_cards_revenue", "Gift cards (Revenue)", "Продажи подарочных карт (выручка)", (166, 167), 1, None, "1.51"),
    ("event_revenue", "Event (revenue)", "Оплата мероприятий (выручка)", (169, 170), 1, None, "1.52"),
    ("other_income_revenue", "Other (revenue)", "Оплата других доходов (выручка)", (172, 173), 1, None, "1.53"),
    ("staff_salaries", "Staff salaries (expense)", "Зарплата сотрудников (расход)", (103, 104), 0, None, "2.11"),
    ("manager_salaries", "Manager salaries (expense)", "Зарплата менеджеров (расход)", (106, 107), 0, None, "2.12"),
    ("utilities", "Utilities (expense)", "Коммунальные услуги (расход)", (100, 101), 0, None, "2.13"),
    ("internet", "Internet (expense)", "Интернет (расход)", (115, 116), 0, None, "2.14"),
    ("team_bonuses", "Team bonuses (expense)", "Бонусы команде (расход)", (109, 110), 0, None, "2.15"),
    ("marketing", "Marketing and advertising (expense)", "Маркетинг и реклама (расход)", (112, 113), 0, None, "2.16"),
    ("bar_expenses", "Bar expenses (expense)", "Расходы бара (расход)", (118, 119), 0, None, "2.17"),
    ("cleaning", "Cleaning (expense)", "Уборка (расход)", (121, 122), 0, None, "2.18"),
    ("crm_payments", "CRM and digital payments (expense)", "Оплата CRM и цифровых платежей (расход)", (124, 125), 0, None, "2.19"),
    ("banking", "Banking services (expense)", "Банковские услуги (расход)", (127, 128), 0, None, "2.191"),
    ("accounting", "Accounting services (expense)", "Бухгалтерские услуги (расход)", (130, 131), 0, None, "2.192"),
    ("equipment", "Equipment (expense)", "Оборудование (расход)", (133, 134), 0, None, "2.193"),
    ("repair", "Repair (expense)", "Ремонт (расход)", (136, 137), 0, None, "2.194"),
    ("household", "Household expenses (expense)", "Бытовые расходы (расход)", (139, 140), 0, None, "2.195"),
    ("prize_pool", "Tournament prize pool (expense)", "Призовой фонд турниров (расход)", (142, 143), 0, None, "2.196"),
    ("transportation", "Transportation expenses (expense)", "Транспортные расходы (расход)", (145, 146), 0, None, "2.197"),
    ("rent", "Rent (expense)", "Аренда (расход)", (148, 149), 0, None, "2.198"),
    ("legal", "Legal expenses (expense)", "Юридические расходы (расход)", (151, 152), 0, None, "2.199"),
    ("other_expenses", "Other expenses (expense)", "Прочие расходы (расход)", (154, 155), 0, None, "2.1991"),
    ("misc_expenses", "Miscellaneous expenses (expense)", "Другие расходов (расход)", (158, 159), 0, None, "2.1992"),
    ("vat", "VAT (expense)", "НДС (расход)", (160, 161), 0, None, "2.1993"),
    ("taxes_fees", "Taxes and fees (expense)", "Налоги и сборы (расход)", (163, 164), 0, None, "2.1994"),
    ("event_cash_expense", "Event payments in cash (expense)", "Оплата мероприятий наличными (расход)", (169, 170), 0, None, "2.1995"),
    ("other_income_expense", "Payments for other income (expense)", "Оплата других доходов (расход)", (172, 173), 0, None, "2.1996"),
]

# key, English label, Russian label, order
_ROLLUP_ROWS = [
    ("other_revenue", "Other revenue", "Прочая выручка", "1.5"),
    ("total_revenue", "Total revenue", "Выручка итого", "1.1"),
    ("total_expenses", "Total expenses", "Расходы итого", "2.1"),
    ("profit", "Profit", "Прибыль", "3.1"),
]

# Output column names; the model uses these names in both languages.
COL_METRIC = "Метрика"
COL_VALUE = "Значение"
COL_ORDER = "Порядок"

# Stored model names per language.
MODEL_TABLES = {
    "en": "cash_flow_p_and_l_uae_en",
    "ru": "dvizhenie_denezhnykh_sredstv_p_and_l_ru_ru",
}
# ---------------------------------------------------------------------------

LANGS = ("en", "ru")
ORDER_TYPE = T.DecimalType(5, 4)


@dataclass(frozen=True)
class Leaf:
    key: str
    en: str
    ru: str
    codes: tuple[int, ...]
    profit: int
    method: int | None
    order: Decimal

    def label(self, lang: str) -> str:
        return _label(self, lang)

    @property
    def revenue(self) -> bool:
        return self.profit == 1


@dataclass(frozen=True)
class Rollup:
    key: str
    en: str
    ru: str
    order: Decimal

    def label(self, lang: str) -> str:
        return _label(self, lang)


def _label(m, lang: str) -> str:
    if lang not in LANGS:
        raise ValueError(f"lang must be one of {LANGS}, got {lang!r}")
    return m.en if lang == "en" else m.ru


LEAVES: tuple[Leaf, ...] = tuple(
    Leaf(k, en, ru, tuple(codes), profit, method, Decimal(order))
    for k, en, ru, codes, profit, method, order in _LEAF_ROWS)
ROLLUPS: tuple[Rollup, ...] = tuple(Rollup(k, en, ru, Decimal(o)) for k, en, ru, o in _ROLLUP_ROWS)
LEAF_BY_KEY = {m.key: m for m in LEAVES}
ROLLUP_BY_KEY = {m.key: m for m in ROLLUPS}
METRIC_KEYS = tuple(m.key for m in LEAVES) + tuple(m.key for m in ROLLUPS)

SALES_KEYS = ("cash", "pos", "online_app")
OTHER_REVENUE_KEYS = tuple(m.key for m in LEAVES if m.revenue and m.method is None)
REVENUE_KEYS = tuple(m.key for m in LEAVES if m.revenue)
EXPENSE_KEYS = tuple(m.key for m in LEAVES if not m.revenue)


def rollup_members(key: str) -> list[tuple[Leaf, int]]:
    """Leaves summed by a roll-up, each with the sign it enters with."""
    if key == "other_revenue":
        return [(LEAF_BY_KEY[k], 1) for k in OTHER_REVENUE_KEYS]
    if key == "total_revenue":
        return [(LEAF_BY_KEY[k], 1) for k in REVENUE_KEYS]
    if key == "total_expenses":
        return [(LEAF_BY_KEY[k], 1) for k in EXPENSE_KEYS]
    if key == "profit":
        return ([(LEAF_BY_KEY[k], 1) for k in REVENUE_KEYS]
                + [(LEAF_BY_KEY[k], -1) for k in EXPENSE_KEYS])
    raise KeyError(key)


def metric(key: str) -> Leaf | Rollup:
    return LEAF_BY_KEY.get(key) or ROLLUP_BY_KEY[key]


def rule_rows(lang: str = "en", metrics: tuple[str, ...] | list[str] | None = None) -> list[tuple]:
    """Rows ``(r_type, r_profit, r_method, metric_key, metric, sign, nonzero, ord)``.

    One row per (code, leaf) and one per (code, roll-up containing the leaf).
    ``metrics`` restricts the table to some metric keys (all by default).
    """
    wanted = set(METRIC_KEYS if metrics is None else metrics)
    unknown = wanted - set(METRIC_KEYS)
    if unknown:
        raise KeyError(f"unknown metrics {sorted(unknown)}")
    rows = []
    for leaf in LEAVES:
        if leaf.key in wanted:
            rows += [(c, leaf.profit, leaf.method, leaf.key, leaf.label(lang), 1, False, leaf.order)
                     for c in leaf.codes]
    for r in ROLLUPS:
        if r.key in wanted:
            rows += [(c, leaf.profit, leaf.method, r.key, r.label(lang), sign, True, r.order)
                     for leaf, sign in rollup_members(r.key) for c in leaf.codes]
    return rows


RULE_SCHEMA = T.StructType([
    T.StructField("r_type", T.IntegerType(), False),
    T.StructField("r_profit", T.IntegerType(), False),
    T.StructField("r_method", T.IntegerType(), True),
    T.StructField("metric_key", T.StringType(), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("sign", T.IntegerType(), False),
    T.StructField("nonzero", T.BooleanType(), False),
    T.StructField("ord", ORDER_TYPE, False),
])


def _sql_text(s: str) -> str:
    if "'" in s or "\\" in s:
        raise ValueError(f"label needs escaping: {s!r}")
    return f"'{s}'"


_RULE_TABLES: dict = {}


def rule_table(spark: SparkSession, lang: str = "en",
               metrics: tuple[str, ...] | list[str] | None = None) -> DataFrame:
    """The rule table as a (tiny, constant-size) local relation.

    Built as an inline ``VALUES`` table, so the optimizer knows its exact size
    and no Python worker is needed to produce it.  The table is a constant, so
    one DataFrame per session, language and metric set is reused.
    """
    key = (id(spark), lang, None if metrics is None else tuple(metrics))
    df = _RULE_TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = _RULE_TABLES[key] = _build_rule_table(spark, lang, metrics)
    return df


def _build_rule_table(spark: SparkSession, lang: str,
                      metrics: tuple[str, ...] | list[str] | None) -> DataFrame:
    rows = rule_rows(lang, metrics)
    if not rows:
        return spark.createDataFrame([], RULE_SCHEMA)
    values = ",\n".join(
        f"({t}, {p}, {'NULL' if m is None else m}, {_sql_text(k)}, {_sql_text(label)}, {sign}, "
        f"{'true' if nz else 'false'}, '{o}')"
        for t, p, m, k, label, sign, nz, o in rows)
    return spark.sql(
        "SELECT CAST(col1 AS INT) AS r_type, CAST(col2 AS INT) AS r_profit, "
        "CAST(col3 AS INT) AS r_method, col4 AS metric_key, col5 AS metric, "
        "CAST(col6 AS INT) AS sign, col7 AS nonzero, CAST(col8 AS DECIMAL(5,4)) AS ord "
        f"FROM VALUES {values}")


def rule_codes(metrics: tuple[str, ...] | list[str] | None = None) -> list[int]:
    """Distinct payment-type codes that can produce any of ``metrics``."""
    return sorted({r[0] for r in rule_rows("en", metrics)})
