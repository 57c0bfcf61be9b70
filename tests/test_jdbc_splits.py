"""Splits of a database read: every row in exactly one, and of about equal size."""
import random
import re

import pytest
from pyspark.sql import functions as F

from cashbook.sources.readers import JDBC_SPLIT_BYTES, depth_predicates, page_predicates, quantile_query
from cashbook.sources.snapshot import PLACE, JdbcSource


def members(spark, keys, predicates):
    """How many keys meet each condition; none may meet two or none."""
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    conditions = [F.coalesce(F.expr(p.replace('"k"', "`k`")), F.lit(False)).cast("int") for p in predicates]
    met = df.select(sum(conditions[1:], conditions[0]).alias("n")).groupBy("n").count().collect()
    assert [r["n"] for r in met] == [1]
    return [df.filter(p.replace('"k"', "`k`")).count() for p in predicates]


def test_quantile_bounds_balance_skewed_and_sparse_keys(spark):
    r = random.Random(1)
    keys = [int(r.paretovariate(0.5)) for _ in range(3000)] + [10**15 + i for i in range(1000)] + [None] * 50
    known = sorted(k for k in keys if k is not None)
    bounds = [known[len(known) * i // 8] for i in range(1, 8)]
    sizes = members(spark, keys, depth_predicates("k", bounds))
    assert sum(sizes) == len(keys)
    # equal keys cannot be parted, and the nulls are in the first
    most = max(known.count(k) for k in set(known[:2000]))
    assert max(sizes) <= len(keys) // 8 + most + 50
    even = members(spark, keys, depth_predicates("k", [max(known) * i // 8 for i in range(1, 8)]))
    assert max(even) > 2 * max(sizes)                                 # even cuts of the range do not balance them


@pytest.mark.parametrize("bounds", [[], [5], [5, 5, 5], [9, -3, 4]])
def test_any_bounds_are_disjoint_and_complete(spark, bounds):
    predicates = depth_predicates("k", bounds)
    assert len(predicates) == len(set(bounds)) + 1
    members(spark, [None, -10, -3, 0, 4, 5, 6, 9, 100], predicates)


@pytest.mark.parametrize("pages, splits", [(1, 1), (1, 4), (3, 8), (1000, 7), (10, 10)])
def test_page_ranges_are_disjoint_and_complete(pages, splits):
    predicates = page_predicates("p", pages, splits)
    assert len(predicates) <= splits

    def holds(predicate, page):
        text = re.sub(r"'\((\d+),0\)'::tid", r"\1", predicate).replace('"p"', str(page)).replace(" AND ", " and ")
        return eval(text.replace("IS NOT NULL", "is not None"))  # noqa: S307 - the text is made above
    sizes = [sum(holds(p, page) for page in range(pages)) for p in predicates]
    for page in [*range(pages), pages, pages + 50]:                  # also pages added since
        assert sum(holds(p, page) for p in predicates) == 1
    assert max(sizes) - min(sizes) <= 1


class Canned(JdbcSource):
    """Answers of a source with a large keyed table, a large one without a key, and a small one."""
    pages = {"keyed": 5 * JDBC_SPLIT_BYTES // 8192, "heap": 3 * JDBC_SPLIT_BYTES // 8192 - 1, "small": 3, "view": 0}
    kinds = {"keyed": "bigint", "heap": "text", "small": "integer", "view": "integer"}

    def columns(self, schema, name):
        return [("key" if self.kinds[name] != "text" else "body", self.kinds[name])]

    def _query(self, sql):
        if "pg_relation_size" in sql:
            name = re.search(r'"\."(\w+)"', sql).group(1)
            size = self.pages[name] * 8192 or None
            return self.spark.createDataFrame([(size, 8192)], "bytes long, page long")
        assert sql == quantile_query('"s"."keyed"', "key", 5, self.pages["keyed"])
        return self.spark.createDataFrame([(10,), (10,), (70,), (None,)], "bound long")


def test_source_chooses_its_splits(spark):
    src = Canned(spark, "pg", "jdbc:postgresql://unused/db")
    assert src.splits("s", "keyed") == depth_predicates("key", [10, 70])
    heap = src.splits("s", "heap")
    assert len(heap) == 3 and all(PLACE in p for p in heap)
    assert src.splits("s", "small") == [] and src.splits("s", "view") == []


def test_sample_of_pages_is_small():
    sql = quantile_query('"s"."t"', "id", 4, 1_000_000)
    assert "ARRAY[0.250000, 0.500000, 0.750000]" in sql and "SYSTEM (0.006400)" in sql
    assert "SYSTEM (100.000000)" in quantile_query('"s"."t"', "id", 4, 3)
