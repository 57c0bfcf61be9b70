"""The driver contract: entry() smoke check and every query against its oracle."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["id_club", "payment_time", "payment_time_local", "id_payment_type",
                          "id_grp_payment_type", "Метрика", "Значение", "Порядок"]
    assert df.count() == 4007


def test_every_query_has_an_oracle():
    assert set(E._billing_queries()) == set(E._billing_sql())
    assert len(E._billing_queries()) >= 34
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", sorted(E._billing_queries()))
def test_query_matches_oracle(spark, sf_small, con, name):
    r = compare(spark, name, sf_small, con)
    assert r["schema_match"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["values_match"], r
