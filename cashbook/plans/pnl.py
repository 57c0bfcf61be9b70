"""The cash-flow / P&L model: public entry points.

``pnl_long``  - the model's rows (single pass, rule join); the flagship.
``pnl_wide``  - the model's ``source`` with its 30 conditional leaf columns.
``pnl_feed``  - the joined, filtered, projected payments without metrics.
``pnl_union`` - the same rows as ``pnl_long`` built branch by branch (check).
``pnl_rows``  - the same branches from one scan of the wide form (check).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cashbook.operators.feed import payment_feed
from cashbook.operators.rules import LANGS
from cashbook.operators.union import pnl_generated, pnl_union_form
from cashbook.operators.unpivot import pnl_long as _pnl_long
from cashbook.operators.wide import with_leaf_columns
from cashbook.sources.fixtures import BillingTables


def _check(lang: str) -> None:
    if lang not in LANGS:
        raise ValueError(f"lang must be one of {LANGS}")


def pnl_long(t: BillingTables, lang: str = "en",
             metrics: tuple[str, ...] | list[str] | None = None, **bounds) -> DataFrame:
    _check(lang)
    return _pnl_long(t, lang, metrics, **bounds)


def pnl_feed(t: BillingTables) -> DataFrame:
    return payment_feed(t)


def pnl_wide(t: BillingTables, lang: str = "en",
             keys: tuple[str, ...] | list[str] | None = None) -> DataFrame:
    _check(lang)
    return with_leaf_columns(payment_feed(t), lang, keys)


def pnl_union(t: BillingTables, lang: str = "en", stage: bool = True) -> DataFrame:
    _check(lang)
    return pnl_union_form(pnl_wide(t, lang), lang, stage)


def pnl_rows(t: BillingTables, lang: str = "en") -> DataFrame:
    return pnl_generated(pnl_wide(t, lang), lang)
