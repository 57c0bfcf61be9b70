"""Numbers of unbounded digits: the decimal that holds a column, or text.

A source ``numeric`` without precision may hold more digits than a Spark
decimal, ``NaN`` and infinities.  Read as text, one aggregate over all such
columns of a table finds the most digits before and after the point; the
column becomes the decimal of just these digits where they are 38 or fewer.
Otherwise it stays text, which holds every value, unless few enough rows are
at fault: then it becomes a decimal, and those rows are set aside whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_DIGITS = 38
#: The decimal of columns whose widest values are set aside.
USUAL = (20, 18)
_PLAIN = r"^[+-]?(\d+\.?\d*|\.\d+)$"


def _digits(c: Column) -> tuple[Column, Column]:
    """Digits before the point (without leading zeros) and after it; null where the text is no finite number."""
    whole = F.regexp_extract(c, r"^[+-]?0*(\d*)", 1)
    fraction = F.regexp_extract(c, r"\.(\d*)$", 1)
    plain = F.regexp_like(c, F.lit(_PLAIN))
    return F.when(plain, F.length(whole)), F.when(plain, F.length(fraction))


def _within(c: Column, whole: int, fraction: int) -> Column:
    """Whether a text is null or a number of at most so many digits before and after the point."""
    i, f = _digits(c)
    return c.isNull() | F.coalesce((i <= whole) & (f <= fraction), F.lit(False))


def _ref(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class NumericFit:
    column: str
    target: T.DataType
    unfit: int                       # rows set aside for this column

    def holds(self) -> Column:
        """Rows whose value the target can hold exactly."""
        if isinstance(self.target, T.StringType):
            return F.lit(True)
        return _within(_ref(self.column), self.target.precision - self.target.scale, self.target.scale)


def fit_numeric(df: DataFrame, columns: list[str], most_unfit: float = 0.0) -> list[NumericFit]:
    """The target of each text column of numbers; ``most_unfit`` is the share of rows that may be set aside for it.

    An empty or all-null column is a decimal of one digit.
    """
    if not columns:
        return []
    asked = [F.count(F.lit(1)).alias("rows")]
    for k, name in enumerate(columns):
        c = _ref(name)
        i, f = _digits(c)
        asked += [F.max(i).alias(f"i{k}"), F.max(f).alias(f"f{k}"),
                  F.count_if(c.isNotNull() & i.isNull()).alias(f"odd{k}"),
                  F.count_if(~_within(c, *USUAL)).alias(f"wide{k}")]
    seen = df.agg(*asked).first()
    out = []
    for k, name in enumerate(columns):
        whole, fraction = seen[f"i{k}"] or 0, seen[f"f{k}"] or 0
        fits = whole + fraction <= MOST_DIGITS
        unfit = seen[f"odd{k}"] if fits else seen[f"wide{k}"]
        if unfit > most_unfit * seen["rows"]:
            out.append(NumericFit(name, T.StringType(), 0))
        elif fits:
            out.append(NumericFit(name, T.DecimalType(max(1, whole + fraction), fraction), unfit))
        else:
            out.append(NumericFit(name, T.DecimalType(sum(USUAL), USUAL[1]), unfit))
    return out


def split_unfit(df: DataFrame, fits: list[NumericFit]) -> tuple[DataFrame, DataFrame]:
    """Rows with their numbers as the targets, and the rows set aside.

    Those keep their columns as they came, with the names of the columns at
    fault in ``unfit_columns``.
    """
    good = F.lit(True)
    for fit in fits:
        good = good & fit.holds()
    targets = {fit.column: fit.target for fit in fits}
    kept = df.filter(good).select(*[
        (_ref(c).cast(targets[c]) if c in targets else _ref(c)).alias(c) for c in df.columns])
    at_fault = F.array_compact(F.array(*[F.when(~fit.holds(), F.lit(fit.column)) for fit in fits])) if fits else F.array()
    return kept, df.filter(~good).withColumn("unfit_columns", at_fault)
