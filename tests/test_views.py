"""Names and dependencies of views, taken from their parsed plans."""
import pytest
from pyspark.errors import ParseException

from cashbook.session import scratch_dir
from cashbook.sources.views import _double_quoted_identifiers, creation_order, in_namespace, parse_view, replay_views
from cashbook.sources.warehouse import Warehouse

SCHEMAS = {"billing", "public", "reports", "s.t"}


@pytest.mark.parametrize("sql, expected", [
    ("SELECT billing.id FROM public.invoice billing", "SELECT billing.id FROM `x_public`.invoice billing"),
    ("SELECT 1 -- it's\nFROM billing.y", "SELECT 1 -- it's\nFROM `x_billing`.y"),
    ("SELECT billing.y.a, billing.y.* FROM billing.y", "SELECT `x_billing`.y.a, `x_billing`.y.* FROM `x_billing`.y"),
    ('SELECT "a" FROM "billing" . "y"', 'SELECT "a" FROM `x_billing` . "y"'),
    ("SELECT public._('billing.y') FROM other.t", "SELECT `x_public`._('billing.y') FROM other.t"),
    ("SELECT y.billing.z FROM reports.y y /* billing.y */", "SELECT y.billing.z FROM `x_reports`.y y /* billing.y */"),
    ("WITH billing AS (SELECT 1 AS q) SELECT billing.q FROM billing", None),
    ("SELECT (SELECT max(a) FROM billing.y) FROM reports.z WHERE EXISTS (SELECT 1 FROM PUBLIC.p WHERE b IN "
     "(SELECT c FROM billing.q))",
     "SELECT (SELECT max(a) FROM `x_billing`.y) FROM `x_reports`.z WHERE EXISTS (SELECT 1 FROM `x_PUBLIC`.p WHERE b IN "
     "(SELECT c FROM `x_billing`.q))"),
    ('SELECT 1 FROM "s.t".u', "SELECT 1 FROM `x_s.t`.u"),
    ("SELECT a FROM billing.y UNION ALL SELECT 'é' FROM billing.y",
     "SELECT a FROM `x_billing`.y UNION ALL SELECT 'é' FROM `x_billing`.y"),
])
def test_prefix_goes_where_a_schema_stands(spark, sql, expected):
    with _double_quoted_identifiers(spark):
        view = parse_view(spark, sql)
    assert in_namespace(view, SCHEMAS, "x_") == (sql if expected is None else expected)


def test_relations_of_a_view(spark):
    with _double_quoted_identifiers(spark):
        view = parse_view(spark, "WITH c AS (SELECT * FROM a.b) SELECT * FROM c JOIN d ON c.x = d.x")
        assert sorted(".".join(n) for _, n in view.relations) == ["a.b", "c", "d"] and view.ctes == {"c"}
        with pytest.raises(ParseException):
            parse_view(spark, "SELEC nothing")


def test_creation_order():
    order, cyclic = creation_order({"a": {"b", "t"}, "b": {"c"}, "c": set(), "x": {"y"}, "y": {"x"}, "z": {"y"}})
    assert order == ["c", "b", "a"] and cyclic == {"x", "y", "z"}


def test_one_attempt_a_view_and_reasons(spark):
    wh = Warehouse(spark, scratch_dir(spark, "t-order"), namespace="t_order")
    wh.replace("public", "t", spark.range(3))
    chain = [("public", f"v{i}", f"SELECT id FROM public.v{i - 1}" if i else "SELECT id FROM public.t")
             for i in range(12)]
    rep = replay_views(spark, chain[::-1] + [
        ("public", "bad", "SELECT nothing FROM public.t"), ("public", "above", "SELECT * FROM public.bad"),
        ("public", "odd", "SELEC 1"), ("public", "c1", "SELECT * FROM public.c2"),
        ("public", "c2", "SELECT * FROM public.c1"),
        # a common table expression hides the view of that name: no cycle
        ("public", "v20", "WITH above AS (SELECT id FROM t_order_public.t) SELECT * FROM above")], warehouse=wh)
    assert len(rep.created) == 13
    assert [n for _, n in rep.created if n != "v20"] == [f"v{i}" for i in range(12)]
    assert rep.attempts == 14                               # the views that could be tried, once each
    assert rep.failed[("public", "above")] == "needs views that failed: public.bad"
    assert "cycle" in rep.failed[("public", "c1")] and ("public", "odd") in rep.failed
    assert wh.table("public", "v11").count() == 3
