"""Randomised tables: single pass == literal union form == DuckDB oracle."""

from collections import Counter

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cashbook.oracle import model_sql_over_tables
from cashbook.plans import pnl
from helpers import payments, tables
from oracle_compare import norm

CODES = [5, 8, 11, 17, 166, 169, 170, 172, 173, 103, 104, 160, 185, 200, 999]
AMOUNTS = [None, "0.00", "-0.00", "12.50", "-3.25", "1e2", "7", "0.10"]

type_rows = st.lists(st.tuples(
    st.sampled_from(CODES[:-1]), st.sampled_from([0, 1, None]), st.sampled_from([1, 2, 3, None]),
    st.sampled_from([0, 1]), st.just(0), st.just(None)), min_size=1, max_size=14)
bu_rows = st.lists(st.tuples(st.integers(1, 6), st.sampled_from([1, 2, 3, None]),
                             st.sampled_from([1, 2, None])), min_size=1, max_size=8)
pay_rows = st.lists(st.tuples(st.sampled_from(CODES), st.sampled_from([1, 2, 3, 4, 5, 6, 7, None]),
                              st.sampled_from(AMOUNTS)), min_size=1, max_size=30)
balance_ids = st.lists(st.sampled_from([1, 2]), min_size=0, max_size=3)
club_rows = st.lists(st.tuples(st.sampled_from([1, 2]), st.sampled_from([-3600, 0, 5400, None])),
                     min_size=0, max_size=3)


def duck_model(pays, types, bus, bals, clubs, lang):
    con = duckdb.connect()
    con.execute("CREATE TABLE payment (id BIGINT, date TIMESTAMP, id_payment_type INTEGER, "
                "id_balance_user BIGINT, amount VARCHAR, id_reservation_terminal BIGINT, "
                "id_subscription_user BIGINT, id_reservation_shop BIGINT, id_parent BIGINT)")
    con.execute("CREATE TABLE payment_type (id INTEGER, profit INTEGER, method INTEGER, "
                "state INTEGER, direct INTEGER, id_parent INTEGER)")
    con.execute("CREATE TABLE balance_user (id BIGINT, id_club INTEGER, id_balance INTEGER)")
    con.execute("CREATE TABLE balance (id INTEGER)")
    con.execute("CREATE TABLE club (id INTEGER, time_zone INTEGER)")
    if pays:
        con.executemany("INSERT INTO payment VALUES (?,?,?,?,?,?,?,?,?)", payments(pays))
    con.executemany("INSERT INTO payment_type VALUES (?,?,?,?,?,?)", types)
    con.executemany("INSERT INTO balance_user VALUES (?,?,?)", bus)
    if bals:
        con.executemany("INSERT INTO balance VALUES (?)", [(b,) for b in bals])
    if clubs:
        con.executemany("INSERT INTO club VALUES (?,?)", clubs)
    cur = con.execute(model_sql_over_tables(lang))
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in cur.fetchall())


def spark_bag(df):
    cols = sorted(df.columns)
    return Counter(tuple(norm(r[c]) for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect())


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(types=type_rows, bus=bu_rows, pays=pay_rows, bals=balance_ids, clubs=club_rows,
       lang=st.sampled_from(["en", "ru"]))
def test_model_matches_union_and_duckdb(spark, types, bus, pays, bals, clubs, lang):
    pays = [(i, t, a, amt) for i, (t, a, amt) in enumerate(pays, start=1)]
    t = tables(spark, pays, types, bus, balance_ids=tuple(bals), club_rows=tuple(clubs))
    single = spark_bag(pnl.pnl_long(t, lang))
    assert single == spark_bag(pnl.pnl_union(t, lang, stage=False))
    assert single == duck_model(pays, types, bus, bals, clubs, lang)
    # the shuffle path (accounts over the broadcast bound) gives the same rows,
    # with hot accounts left to AQE or split by explicit salting
    assert single == spark_bag(pnl.pnl_long(t, lang, account_max_rows=0))
    assert single == spark_bag(pnl.pnl_long(t, lang, account_max_rows=0, skew="salt",
                                            hot_rows_per_task=2))
