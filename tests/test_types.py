import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from cashbook.functions.types import coerce, pg_type_of, spark_type


def test_kept_spellings():
    text = T.StringType()
    for spelling in ("numeric(12,2)", "character varying(40)", "timestamp(3) without time zone", "integer[]",
                     "interval", "numeric(50,10)"):
        assert spark_type(spelling) == text
    assert spark_type("integer") == T.IntegerType() and spark_type("jsonb") == text
    assert spark_type("numeric(50,10)", strict=True) == text


def test_text_of_wide_numbers_offsets_and_arrays(spark):
    df = spark.createDataFrame(
        [(Decimal("12345678901234567890.5"), ["a,b", "", "NULL", None, 'q"\\', "plain"], [[1, 2], [3, None]],
          [True, False])], "n decimal(38,10), s array<string>, m array<array<int>>, b array<boolean>").selectExpr(
        "*", "timestamp '2020-01-02 03:04:05.25+00' AS ts")
    r = coerce(df, [("n", "numeric(50,10)"), ("s", "text[]"), ("m", "integer[][]"), ("b", "boolean[]"),
                    ("ts", "timestamp(3) with time zone")]).first()
    assert r["n"] == "12345678901234567890.5000000000"
    assert r["s"] == '{"a,b","","NULL",NULL,"q\\"\\\\",plain}'
    assert r["m"] == "{{1,2},{3,NULL}}" and r["b"] == "{t,f}"
    assert r["ts"] == "2020-01-02 03:04:05.25+00"


def test_spark_types():
    assert spark_type("numeric") == T.DecimalType(38, 18)
    assert spark_type("timestamp without time zone") == T.TimestampNTZType()
    assert spark_type("timestamp with time zone") == T.TimestampType()
    assert spark_type("numeric(12,2)") == T.StringType()
    assert spark_type("numeric(12,2)", strict=True) == T.DecimalType(12, 2)
    assert spark_type("smallint") == T.ShortType()
    assert spark_type("geometry") == T.StringType()


def test_pg_type_of_roundtrip():
    assert pg_type_of(T.DecimalType(12, 2)) == "numeric(12,2)"
    assert pg_type_of(T.TimestampNTZType()) == "timestamp without time zone"
    assert pg_type_of(T.ArrayType(T.FloatType())) == "real[]"


def test_coerce_values(spark):
    df = spark.createDataFrame(
        [(1, 12.5, Decimal("3.10"), "R", [1.5, None], "x", dt.datetime(2020, 1, 2, 3, 4, 5, 6))],
        "a long, price double, d decimal(10,2), flag string, arr array<double>, s string, "
        "ts timestamp_ntz")
    cols = [("a", "integer"), ("price", "numeric(12,2)"), ("d", "numeric(10,2)"),
            ("flag", "character(3)"), ("arr", "double precision[]"), ("s", "character varying(5)"),
            ("ts", "timestamp without time zone")]
    out = coerce(df, cols)
    assert [f.name for f in out.schema] == [c for c, _ in cols]
    r = out.first()
    assert r["a"] == 1 and isinstance(r["a"], int)
    assert out.schema["a"].dataType == T.IntegerType()
    assert r["price"] == "12.50"
    assert r["d"] == "3.10"
    assert r["flag"] == "R  "
    assert r["arr"] == "{1.5,NULL}"
    assert r["s"] == "x"
    assert r["ts"] == dt.datetime(2020, 1, 2, 3, 4, 5, 6)
    strict = coerce(df, cols, strict=True)
    assert strict.schema["price"].dataType == T.DecimalType(12, 2)


def test_declared_scale_wins_over_source_scale(spark):
    df = spark.createDataFrame([(Decimal("3.100000"),)], "d decimal(20,6)")
    assert coerce(df, [("d", "numeric(10,2)")]).first()["d"] == "3.10"
    odd = spark.createDataFrame([(1,)], "`we``ird` int")
    assert coerce(odd, [("we`ird", "bigint")]).schema[0].dataType == T.LongType()
