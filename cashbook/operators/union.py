"""UNION ALL form of the model (U1, U2): one branch per metric over the wide source.

This is the shape the model is written in, kept as an independent cross-check
of the single-pass form in :mod:`cashbook.operators.unpivot`.

:func:`pnl_generated` makes the branches' rows from one scan: a generator
turns every wide row into one number per branch, and the branch's condition
is tested after it.  :func:`pnl_union_form` is the literal
union, in which every branch reads the wide source again; that source is
written once as a Parquet table in the shared checkpoint folder, so the 34
branches scan the stored result (each reading only its key columns and one
leaf column) instead of re-running the joins 34 times.

Bag semantics: ``union`` keeps duplicates and matches columns by position;
the names come from the first branch, as in SQL.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashbook.functions.scalar import to_double, zero_if_null
from cashbook.operators.rules import (COL_METRIC, COL_ORDER, COL_VALUE, LEAVES, ORDER_TYPE,
                                      ROLLUPS, rollup_members)

KEY_COLUMNS = ("id_club", "payment_time", "payment_time_local", "id_payment_type",
               "id_grp_payment_type")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """SQL ``UNION ALL``: positional, duplicates kept, first frame names the columns."""
    return reduce(DataFrame.union, frames)


class Branch(NamedTuple):
    """One SELECT of the union: rows of the wide source it keeps, and its three own columns."""
    keep: Column
    label: str
    value: Column
    order: int

    def columns(self) -> list[Column]:
        return [F.lit(self.label).alias(COL_METRIC), self.value.alias(COL_VALUE),
                F.lit(self.order).cast(ORDER_TYPE).alias(COL_ORDER)]


def model_branches(lang: str = "en") -> list[Branch]:
    """The branches over the wide form (leaf columns named in ``lang``)."""
    out = []
    for leaf in LEAVES:
        col = F.col(f"`{leaf.label(lang)}`")
        out.append(Branch(col.isNotNull(), leaf.label(lang), to_double(col), leaf.order))
    for r in ROLLUPS:
        plus = [zero_if_null(to_double(F.col(f"`{leaf.label(lang)}`")))
                for leaf, s in rollup_members(r.key) if s > 0]
        minus = [zero_if_null(to_double(F.col(f"`{leaf.label(lang)}`")))
                 for leaf, s in rollup_members(r.key) if s < 0]
        total = reduce(lambda a, b: a + b, plus)
        if minus:
            total = total - reduce(lambda a, b: a + b, minus)
        out.append(Branch(total != 0, r.label(lang), total, r.order))
    return out


def branches(wide: DataFrame, lang: str = "en") -> list[DataFrame]:
    """One DataFrame per metric."""
    keys = [F.col(c) for c in KEY_COLUMNS]
    return [wide.filter(b.keep).select(*keys, *b.columns()) for b in model_branches(lang)]


def pnl_generated(wide: DataFrame, lang: str = "en") -> DataFrame:
    """The model's union from one scan of the wide source.

    The branches' numbers are columns first, and the generator runs over an
    array of them; a branch's place in it gives its label and order.  A struct
    per branch, with its own conversions, takes several times as long.  The
    flags of the leaves come from a higher-order function, which also keeps
    the many conversions out of the joins' generated code: together they are
    too large for the JIT.
    """
    found = model_branches(lang)                     # leaves first, then roll-ups
    leaves = F.array(*[F.col(f"`{leaf.label(lang)}`") for leaf in LEAVES])
    numbers = wide.select(*KEY_COLUMNS, F.transform(leaves, lambda x: x.isNotNull()).alias("_kept"),
                          *[b.value.alias(f"_{i}") for i, b in enumerate(found)])
    rows = numbers.select(*KEY_COLUMNS, "_kept", F.posexplode(F.array(*[F.col(f"_{i}") for i in range(len(found))]))
                          .alias("_at", "_n"))
    at = F.col("_at")
    keep = F.when(at < len(LEAVES), F.col("_kept")[at]).otherwise(F.col("_n") != 0)
    return rows.filter(keep).select(
        *KEY_COLUMNS, F.array(*[F.lit(b.label) for b in found])[at].alias(COL_METRIC), F.col("_n").alias(COL_VALUE),
        F.array(*[F.lit(b.order).cast(ORDER_TYPE) for b in found])[at].alias(COL_ORDER))


def pnl_union_form(wide: DataFrame, lang: str = "en", stage: bool = True) -> DataFrame:
    """The model as the literal union of its 34 branches.

    ``stage=True`` first writes the wide source to a fresh folder under the
    session's shared checkpoint folder and reads it back, cutting its lineage.
    """
    if stage:
        from cashbook.session import scratch_dir
        path = scratch_dir(wide.sparkSession, "wide")
        needed = list(KEY_COLUMNS) + [leaf.label(lang) for leaf in LEAVES]
        wide.select(*[F.col(f"`{c}`") for c in needed]).write.mode("errorifexists").parquet(path)
        wide = wide.sparkSession.read.parquet(path)
    return union_all(branches(wide, lang))
