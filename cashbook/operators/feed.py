"""Joins, filters and the projected payment feed (the model's ``source``).

    payment p
      JOIN      payment_type pt ON p.id_payment_type = pt.id      -- J1
      LEFT JOIN balance_user bu ON p.id_balance_user = bu.id      -- J2
      LEFT JOIN balance b       ON bu.id_balance = b.id           -- J3
      LEFT JOIN club c          ON c.id = bu.id_club              -- J4
    WHERE pt.state = 1                                            -- F1
      AND bu.id_balance = 1                                       -- F2

F2 rejects NULL, so J2 is an inner join; it is written as one here.  The
account side (bu with its balance and club) is built once -- it is far
smaller than the payments -- and joined to the payments with a single
equi join: broadcast when the probes of :func:`dimension_sides` bound it,
otherwise a shuffle join whose hot accounts are split (AQE skew join, or
explicit salting from :mod:`cashbook.operators.skew`).  ``balance`` is read by no
output column but counts: without declared keys a duplicate ``b.id``
multiplies rows, exactly as in the source model.  As every account here has
``id_balance = 1``, the number of balance rows with that id says it all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashbook.functions.scalar import local_time, numeric_offset
from cashbook.operators.broadcast import (ACCOUNT_MAX_ROWS, DIMENSION_MAX_ROWS,
                                          bounded_broadcast, counted, hint, one_row_each)
from cashbook.operators.idfilter import bitmap_bits, id_bitmap, maybe_in
from cashbook.operators.skew import DEFAULT_ROWS_PER_TASK, salted_join
from cashbook.sources.fixtures import BillingTables

# column order of the model's source projection
FEED_COLUMNS = (
    "id_club", "id_balance_user", "id_type_balance", "payment_time", "id", "direct",
    "id_payment_type", "id_grp_payment_type", "profit", "amount", "id_reservation_terminal",
    "id_subscription_user", "id_reservation_shop", "id_parent", "id_payment_type_parent",
    "payment_time_local",
)


def active_types(pt: DataFrame) -> DataFrame:
    """payment types in state 1."""
    return pt.filter(F.col("state") == 1)


def main_balance_accounts(bu: DataFrame) -> DataFrame:
    """accounts on the main balance (``id_balance = 1``)."""
    return bu.filter(F.col("id_balance") == 1)


def type_frame(pt: DataFrame) -> DataFrame:
    """Active payment types, renamed for the join."""
    return active_types(pt).select(
        F.col("id").alias("pt_id"), F.col("direct").alias("pt_direct"),
        F.col("method").alias("pt_method"), F.col("profit").alias("pt_profit"),
        F.col("id_parent").alias("pt_id_parent"))


def account_frames(t: BillingTables) -> tuple[DataFrame, DataFrame]:
    """Main-balance accounts and clubs, projected for the joins."""
    bu = main_balance_accounts(t.balance_user).select(
        F.col("id").alias("acc_id"), "id_club", "id_balance")
    c = t.club.select(F.col("id").alias("c_id"), numeric_offset(
        F.col("time_zone"), t.club.schema["time_zone"].dataType).alias("time_zone"))
    return bu, c


def attach_clubs(bu: DataFrame, balance_rows: int, c: DataFrame) -> DataFrame:
    """J3 + J4 on the account side: one row per account x balance row x club row.

    All accounts here are on balance 1, so the join to ``balance`` only
    repeats each account once per balance row with that id
    (``balance_rows``; a left join, so once at least).  A missing club leaves
    ``time_zone`` NULL and keeps the account.
    """
    if balance_rows > 1:
        bu = bu.select("*", F.explode(F.sequence(F.lit(1), F.lit(balance_rows))).alias("_copy"))
    return (bu.join(c, bu["id_club"] == c["c_id"], "left")
              .select("acc_id", "id_club", "id_balance", "time_zone"))


def dimension_sides(t: BillingTables, types: DataFrame, dim_rows: int = DIMENSION_MAX_ROWS,
                    account_rows: int = ACCOUNT_MAX_ROWS,
                    types_probe: DataFrame | None = None) -> tuple[DataFrame, DataFrame, bool]:
    """Size-check the dimension sides; return (types, accounts, accounts_small).

    Four concurrent aggregates, one row each: the number of types, of balance
    rows with id 1, of clubs with the most rows of one club id, and of
    main-balance accounts.  The account side's size is then bounded without
    running its joins:

        |accounts x balance x club| <= |accounts| * (balance rows with id 1)
                                                  * (most rows of one club id)

    (left joins keep an unmatched account once, hence the max(1, ...)).
    ``types_probe`` may be a cheaper superset of ``types`` to count.
    """
    bu, c = account_frames(t)
    n_types, n_balance, clubs, n_bu = one_row_each([
        counted(types if types_probe is None else types_probe),
        counted(t.balance.filter(F.col("id") == 1)),
        c.groupBy("c_id").agg(F.count(F.lit(1)).alias("rows")).agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("n"), F.max("rows").alias("most")),
        counted(bu)])
    balance_rows = max(1, n_balance["n"])
    small_acc = n_bu["n"] * balance_rows * max(1, clubs["most"] or 1) <= account_rows
    accounts = hint(attach_clubs(bu, balance_rows, hint(c, clubs["n"] <= dim_rows)), small_acc)
    return hint(types, n_types["n"] <= dim_rows), accounts, small_acc


def of_main_accounts(payments: DataFrame, t: BillingTables) -> DataFrame:
    """Payments that may belong to a main-balance account: what a shuffle to the accounts has to move.

    Where there are more such accounts than a bitmap of bounded size can tell
    from others, all payments stay.
    """
    ids = main_balance_accounts(t.balance_user).select("id")
    bits = bitmap_bits(ids.count())
    if bits is None:
        return payments
    return maybe_in(payments, "id_balance_user", id_bitmap(ids, "id", bits), bits)


def join_types(p: DataFrame, types: DataFrame) -> DataFrame:
    """J1 (+F1): inner join to the active payment types."""
    return p.join(types, p["id_payment_type"] == types["pt_id"], "inner")


def join_accounts(p: DataFrame, accounts: DataFrame) -> DataFrame:
    """J2-J4 (+F2): inner join to main-balance accounts carrying club time zones."""
    return p.join(accounts, p["id_balance_user"] == accounts["acc_id"], "inner")


def aqe_skew_join_on(spark) -> bool:
    conf = spark.conf
    return (conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
            and conf.get("spark.sql.adaptive.skewJoin.enabled", "true").lower() == "true")


def join_accounts_split(p: DataFrame, accounts: DataFrame, accounts_small: bool,
                        skew: str = "auto", rows_per_task: int = DEFAULT_ROWS_PER_TASK) -> DataFrame:
    """J2-J4 with a hot-account strategy for the shuffle case.

    A broadcast account side needs none.  Otherwise ``skew="aqe"`` leaves hot
    accounts to AQE's skew-join split, ``skew="salt"`` splits them explicitly
    (:mod:`cashbook.operators.skew`); ``"auto"`` salts only when AQE skew
    handling is off.
    """
    if skew not in ("auto", "aqe", "salt"):
        raise ValueError(f"unknown skew strategy {skew!r}")
    if accounts_small or skew == "aqe" or (skew == "auto" and aqe_skew_join_on(p.sparkSession)):
        return join_accounts(p, accounts)
    return salted_join(p, accounts, "id_balance_user", "acc_id", "inner", rows_per_task)


def payment_feed(t: BillingTables, dim_rows: int = DIMENSION_MAX_ROWS,
                 account_rows: int = ACCOUNT_MAX_ROWS, skew: str = "auto") -> DataFrame:
    """The model's ``source`` rows: 16 projected columns, one row per match."""
    types, accounts, small_acc = dimension_sides(t, type_frame(t.payment_type), dim_rows,
                                                 account_rows)
    payments = t.payment if small_acc else of_main_accounts(t.payment, t)
    x = join_accounts_split(join_types(payments, types), accounts, small_acc, skew)
    cols: dict[str, Column] = {
        "id_club": F.col("id_club"),
        "id_balance_user": F.col("id_balance_user"),
        "id_type_balance": F.col("id_balance"),
        "payment_time": F.col("date"),
        "id": F.col("id"),
        "direct": F.col("pt_direct"),
        "id_payment_type": F.col("id_payment_type"),
        "id_grp_payment_type": F.col("pt_method"),
        "profit": F.col("pt_profit"),
        "amount": F.col("amount"),
        "id_reservation_terminal": F.col("id_reservation_terminal"),
        "id_subscription_user": F.col("id_subscription_user"),
        "id_reservation_shop": F.col("id_reservation_shop"),
        "id_parent": F.col("id_parent"),
        "id_payment_type_parent": F.col("pt_id_parent"),
        "payment_time_local": local_time("date", "time_zone"),
    }
    return x.select(*[cols[n].alias(n) for n in FEED_COLUMNS])


# --- single joins, each as written in the model (for per-operator checks) ---

def payment_type_join(t: BillingTables) -> DataFrame:
    """J1 alone: payments with their (any-state) type row."""
    pt = bounded_broadcast(t.payment_type.select(
        F.col("id").alias("pt_id"), F.col("profit"), F.col("method"), F.col("state")))
    return t.payment.join(pt, t.payment["id_payment_type"] == pt["pt_id"], "inner").select(
        "id", "date", "id_payment_type", "amount", "profit", "method", "state")


def account_left_join(t: BillingTables) -> DataFrame:
    """J2 alone: every payment with its account row, if any (left outer)."""
    bu = t.balance_user.select(F.col("id").alias("bu_id"), "id_club", "id_balance")
    return t.payment.join(bu, t.payment["id_balance_user"] == bu["bu_id"], "left").select(
        "id", "date", "id_balance_user", "id_club", "id_balance")


def balance_left_join(t: BillingTables) -> DataFrame:
    """J2 + J3: payments, their account and matching balance rows (fan-out kept)."""
    b = bounded_broadcast(t.balance.select(F.col("id").alias("b_id")))
    return account_left_join(t).join(b, F.col("id_balance") == b["b_id"], "left").select(
        "id", "date", "id_balance_user", "id_balance", "b_id")


def club_left_join(t: BillingTables) -> DataFrame:
    """J2 + J4: payments, their account's club and its time-zone offset."""
    c = bounded_broadcast(t.club.select(F.col("id").alias("c_id"), "time_zone"))
    return account_left_join(t).join(c, F.col("id_club") == c["c_id"], "left").select(
        "id", "date", "id_balance_user", "id_club", "time_zone")
