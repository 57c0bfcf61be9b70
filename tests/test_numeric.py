"""Fitting of numbers without a precision."""
from collections import Counter
from decimal import Decimal

import pytest

from cashbook.functions.numeric import fit_numeric, split_unfit
from cashbook.session import scratch_dir
from cashbook.sources.snapshot import FileSource, FrameSource, SourceObject, copy_verified
from cashbook.sources.warehouse import Warehouse


def fits(spark, values, most_unfit=0.0):
    df = spark.createDataFrame([(v,) for v in values], "`n``x` string")
    (fit,) = fit_numeric(df, ["n`x"], most_unfit)
    kept, aside = split_unfit(df, [fit])
    return fit, [r[0] for r in kept.collect()], [tuple(r) for r in aside.collect()]


@pytest.mark.parametrize("values, target", [
    (["1", "-22.5", None, "0.125"], "decimal(5,3)"),
    (["0", "0.0", "-0"], "decimal(1,1)"), ([None, None], "decimal(1,0)"), ([], "decimal(1,0)"),
    (["9" * 38], "decimal(38,0)"), (["0." + "1" * 38], "decimal(38,38)"), (["000123", "+7", ".5", "5."], "decimal(4,1)"),
    (["9" * 39], "string"), (["9" * 20 + "." + "1" * 18, "1"], "decimal(38,18)"), (["9" * 21, "0." + "1" * 18], "string"),
    (["1", "NaN"], "string"), (["1", "Infinity", "-Infinity"], "string"), (["1", "1e5"], "string"), (["1", ""], "string"),
])
def test_target(spark, values, target):
    fit, kept, aside = fits(spark, values)
    assert fit.target.simpleString() == target and fit.unfit == 0 and aside == []
    if target == "string":
        assert Counter(kept) == Counter(values)
    else:
        assert Counter(kept) == Counter(None if v is None else Decimal(v) for v in values)


def test_few_unfit_rows_are_set_aside(spark):
    values = [str(i / 4) for i in range(98)] + ["NaN", None]
    fit, kept, aside = fits(spark, values, 0.01)
    assert fit.target.simpleString() == "decimal(4,2)" and fit.unfit == 1
    assert len(kept) == 99 and aside == [("NaN", ["n`x"])]
    wide = [str(i) for i in range(99)] + ["8" * 50]
    fit, kept, aside = fits(spark, wide, 0.01)
    assert fit.target.simpleString() == "decimal(38,18)" and aside == [("8" * 50, ["n`x"])]
    assert fits(spark, values, 0.009)[0].target.simpleString() == "string"


def test_a_row_is_set_aside_once_with_all_its_faults(spark):
    df = spark.createDataFrame([("1", "2", "keep")] * 8 + [("NaN", "x", "both"), ("3", "Infinity", "one")],
                               "a string, b string, c string")
    found = fit_numeric(df, ["a", "b"], 0.2)
    kept, aside = split_unfit(df, found)
    assert [f.unfit for f in found] == [1, 2] and kept.count() == 8
    assert Counter((r.c, tuple(r.unfit_columns)) for r in aside.collect()) == Counter(
        {("both", ("a", "b")): 1, ("one", ("b",)): 1})


def test_copy_of_a_dump_with_unbounded_numbers(spark, tmp_path):
    folder = tmp_path / "s" / "t"
    folder.mkdir(parents=True)
    (folder / "t.csv").write_text("1,1.50,NaN\n2," + "4" * 45 + ",2\n3,,3\n")
    columns = {("s", "t"): [("id", "bigint"), ("m", "numeric"), ("k", "numeric")]}
    src = FileSource(spark, "d", str(tmp_path), "csv", columns, numeric_as_text=True)
    wh = Warehouse(spark, scratch_dir(spark, "t-fit"), namespace="t_fit")
    copy_verified(src, "s", "t", wh, most_unfit=0.4)
    got = wh.table("s", "t")
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "decimal(38,18)", "decimal(1,0)"]
    assert [r.id for r in got.collect()] == [3]
    assert {(r.id, r.m, r.k, tuple(r.unfit_columns)) for r in wh.table("s", "t_unfit").collect()} == {
        (1, "1.50", "NaN", ("k",)), (2, "4" * 45, "2", ("m",))}
    copy_verified(src, "s", "t", wh, most_unfit=0.0)                  # all fit as text: the other table is emptied
    assert [f.dataType.simpleString() for f in wh.table("s", "t").schema] == ["bigint", "string", "string"]
    assert wh.table("s", "t").count() == 3 and wh.table("s", "t_unfit").count() == 0


def test_decimal_columns_of_a_source_are_left_alone(spark):
    df = spark.createDataFrame([(Decimal("1.5"),)], "m decimal(10,2)")
    src = FrameSource(spark, "a", {("s", "t"): SourceObject("r", lambda: df, {"m": "numeric"})})
    wh = Warehouse(spark, scratch_dir(spark, "t-fit2"), namespace="t_fit2")
    copy_verified(src, "s", "t", wh, most_unfit=0.0)
    assert wh.table("s", "t").schema["m"].dataType.simpleString() == "decimal(38,18)"
    assert not wh.exists("s", "t_unfit")
