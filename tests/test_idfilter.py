"""The bitmap of main-balance accounts in front of the account shuffle."""
import random

import pytest

from cashbook.operators import feed, idfilter
from cashbook.plans import pnl
from cashbook.sources.fixtures import fixture_tables
from helpers import bag


def test_bitmap_is_bounded():
    assert idfilter.bitmap_bits(0) == idfilter.LEAST_BITS
    assert idfilter.bitmap_bits(1_000_000) == 23
    assert idfilter.bitmap_bits(30_000_000) == idfilter.MOST_BITS
    assert idfilter.bitmap_bits(1 << 30) is None


@pytest.mark.parametrize("kind", ["int", "long"])
def test_no_partner_is_lost_and_few_others_pass(spark, kind):
    r = random.Random(6)
    known = r.sample(range(-10**6, 10**6), 2000)
    ids = spark.createDataFrame([(k,) for k in known], f"k {kind}")
    rows = spark.createDataFrame([(k, "in") for k in known] + [(None, "null")]
                                 + [(k, "out") for k in range(2 * 10**6, 2 * 10**6 + 20_000)], f"k {kind}, what string")
    bits = idfilter.bitmap_bits(2000)
    kept = {x["what"]: x["count"] for x in idfilter.maybe_in(
        rows, "k", idfilter.id_bitmap(ids, "k", bits), bits).groupBy("what").count().collect()}
    assert kept["in"] == 2000 and "null" not in kept and kept.get("out", 0) <= 20_000 // idfilter.SPREAD
    assert idfilter.id_bitmap(ids, "k", bits).count() <= 1 << (bits - 6)


def test_filter_lies_below_the_exchange_of_the_payments(spark, sf_small):
    t = fixture_tables(spark, sf_small)
    df = feed.payment_feed(t, account_rows=0)
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    # the payments' side: the semi join to the bitmap is deeper than the exchange by account
    exchange = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(id_balance_user" in x)
    semi = next(i for i, x in enumerate(lines) if "LeftSemi" in x and "word_" in x)
    assert semi > exchange
    assert "LeftSemi" not in feed.payment_feed(t)._jdf.queryExecution().executedPlan().toString()


def test_results_do_not_depend_on_the_filter(spark, sf_small, monkeypatch):
    t = fixture_tables(spark, sf_small)
    expected, rows = bag(feed.payment_feed(t)), bag(pnl.pnl_long(t))
    assert bag(feed.payment_feed(t, account_rows=0)) == expected
    assert bag(pnl.pnl_long(t, account_max_rows=0)) == rows
    monkeypatch.setattr(feed, "bitmap_bits", lambda ids: None)
    assert bag(feed.payment_feed(t, account_rows=0)) == expected
