"""Calendar queries (K10–K13) and building blocks with their own semantics
(D7, D8, D9, F1, H1) as standalone jobs over the ledger."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import joins as J
from ..operators.windows import global_row_number
from ..sources import rawtext as RT
from ..sources.ledger import Ledger
from .accounts import changed_account_keys


def k10_business_days(lg: Ledger) -> DataFrame:
    return lg.calendar.select("cal_date", "is_weekday", "is_holiday", "is_business")


def k11_next_business_day(lg: Ledger) -> DataFrame:
    return cal.with_next_business_day(lg.calendar).select("cal_date", "next_business_day")


def k12_nth_business_day(lg: Ledger, n: int = 5) -> DataFrame:
    return cal.nth_day_of_month(lg.calendar, n, "is_business")


def k13_fifth_weekday(lg: Ledger) -> DataFrame:
    return cal.nth_day_of_month(lg.calendar, 5, "is_weekday")


def d7_range_join_month(lg: Ledger) -> DataFrame:
    """Payments whose date falls inside a bill month of their building (the
    range join as an equi-join on building and yyyymm)."""
    months = lg.bill.select("id_building", F.col("month_start").alias("m_start")).distinct()
    p = lg.payment.select("id_building", "pay_date", "amount")
    j = J.range_join_month(p, "pay_date", months, "m_start", ["id_building"])
    return j.groupBy("id_building", "m_start").agg(F.count(F.lit(1)).alias("payments"),
                                                   F.sum("amount").cast("decimal(18,2)").alias("amount"))


def d8_latest_bill_of_month(lg: Ledger) -> DataFrame:
    """Each payment with the latest bill of its building in the payment's month
    (NULL when there is none), via a pre-ranked equi-join instead of a lateral."""
    from .ingest import bill_of_month
    p = lg.payment.select("id_payment", "id_building", "pay_date").withColumn("b_month", F.trunc("pay_date", "month"))
    return (p.join(bill_of_month(lg), ["id_building", "b_month"], "left")
            .select("id_payment", "pay_date", F.col("bill_match").alias("id_bill_of_month")))


def d9_unpivot(lg: Ledger) -> DataFrame:
    """CROSS APPLY VALUES over the expense categories = unpivot."""
    r = RT.raw_expenses(lg)
    return J.unpivot_columns(r, ["Nombre del consorcio", "anio", "Mes"], RT.EXPENSE_CATEGORIES,
                             "category", "amount_txt").withColumnRenamed("Nombre del consorcio", "building")


def f1_global_row_number(lg: Ledger) -> DataFrame:
    """ROW_NUMBER over all accounts ordered by (building, bill date, bill, unit),
    computed with per-building offsets."""
    a = lg.account.select("id_account", "id_building", "id_bill", "id_unit")
    b = lg.bill.select("id_bill", "issue_date")
    a = a.join(b, "id_bill")
    return global_row_number(a, ["id_building", "issue_date", "id_bill", "id_unit"]).select(
        "row_id", "id_account")


# Fixed rule of the adapter: the change set used by H1 / J5 / S1.
CHANGE_INSERTED = (dt.date(2001, 6, 1), dt.date(2001, 6, 30))
CHANGE_DELETED = (dt.date(2001, 5, 25), dt.date(2001, 6, 5))


def change_set(lg: Ledger) -> tuple[DataFrame, DataFrame]:
    p = lg.payment
    ins = p.filter(F.col("pay_date").between(*CHANGE_INSERTED))
    dele = p.filter(F.col("pay_date").between(*CHANGE_DELETED))
    return ins, dele


def h1_changed_keys(lg: Ledger) -> DataFrame:
    ins, dele = change_set(lg)
    return changed_account_keys(ins, dele)
