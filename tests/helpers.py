"""Hand-made billing tables for unit tests."""

import datetime as dt
from collections import Counter

from cashbook.sources.fixtures import BillingTables

PAYMENT_SCHEMA = ("id long, date timestamp_ntz, id_payment_type int, id_balance_user long, "
                  "amount string, id_reservation_terminal long, id_subscription_user long, "
                  "id_reservation_shop long, id_parent long")
TYPE_SCHEMA = "id int, profit int, method int, state int, direct int, id_parent int"
BU_SCHEMA = "id long, id_club int, id_balance int"

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def payments(rows):
    """rows: (id, type, account, amount)"""
    return [(i, T0 + dt.timedelta(minutes=i), t, a, amt, 1, None, None, None)
            for i, t, a, amt in rows]


def tables(spark, pay_rows, type_rows, bu_rows, balance_ids=(1, 2), club_rows=((1, 3600), (2, -1800))):
    return BillingTables(
        payment=spark.createDataFrame(payments(pay_rows), PAYMENT_SCHEMA),
        payment_type=spark.createDataFrame(list(type_rows), TYPE_SCHEMA),
        balance_user=spark.createDataFrame(list(bu_rows), BU_SCHEMA),
        balance=spark.createDataFrame([(b,) for b in balance_ids], "id int"),
        club=spark.createDataFrame(list(club_rows), "id int, time_zone int"),
    )


def bag(df):
    cols = sorted(df.columns)
    return Counter(tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
