"""Business-day calendar (K10–K13) as one small table.

The reference walks day by day in scalar functions. Here the calendar is a
DataFrame with one row per day of a bounded span (its size depends on the
date range only, never on the data volume), and every calendar question is
a column of it, answered by a window over that small table or an equi-join
against it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The holiday rule used by the ledger adapter (month, day).
# The reference's holiday table is never populated; these three fixed dates
# per year make the "with holidays" rule observable.
HOLIDAYS_MONTH_DAY = [(1, 1), (5, 1), (12, 25)]


def is_weekday(d: Column) -> Column:
    """Not Saturday or Sunday (dayofweek: 1 = Sunday, 7 = Saturday)."""
    return ~F.dayofweek(d).isin(1, 7)


def is_fixed_holiday(d: Column) -> Column:
    cond = F.lit(False)
    for m, day in HOLIDAYS_MONTH_DAY:
        cond = cond | ((F.month(d) == m) & (F.dayofmonth(d) == day))
    return cond


def calendar_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi",
                     holidays: DataFrame | None = None) -> DataFrame:
    """One row per day from ``lo`` to ``hi`` of the single-row ``bounds``.

    Columns: cal_date, month_start, is_weekday, is_holiday, is_business (K10).
    ``holidays`` (column ``holiday``) overrides the fixed rule when given.
    """
    days = bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi))).alias("cal_date"))
    if holidays is None:
        days = days.withColumn("is_holiday", is_fixed_holiday(F.col("cal_date")))
    else:
        h = holidays.select(F.col("holiday").alias("cal_date")).distinct().withColumn("is_holiday", F.lit(True))
        days = days.join(h, "cal_date", "left").fillna(False, ["is_holiday"])
    return (days
            .withColumn("month_start", F.trunc("cal_date", "month"))
            .withColumn("is_weekday", is_weekday(F.col("cal_date")))
            .withColumn("is_business", F.col("is_weekday") & ~F.col("is_holiday")))


def with_next_business_day(cal: DataFrame) -> DataFrame:
    """Next business day on or after each calendar day.

    The window is unpartitioned, so it runs in one task; the calendar holds
    one row per day of the span (a few thousand rows), independent of data
    volume.
    """
    w = Window.orderBy("cal_date").rowsBetween(0, Window.unboundedFollowing)
    return cal.withColumn("next_business_day",
                          F.min(F.when(F.col("is_business"), F.col("cal_date"))).over(w))


def nth_day_of_month(cal: DataFrame, n: int, flag: str = "is_business") -> DataFrame:
    """K12 (flag=is_business) / K13 (flag=is_weekday): n-th such day per month.

    Months with fewer than n such days are absent (the reference returns NULL).
    """
    w = Window.partitionBy("month_start").orderBy("cal_date")
    return (cal.filter(F.col(flag))
            .withColumn("_n", F.row_number().over(w))
            .filter(F.col("_n") == n)
            .select("month_start", F.col("cal_date").alias("nth_day")))


def month_info(cal: DataFrame, nth: int = 5, due1_day: int = 10, due2_day: int = 22) -> DataFrame:
    """Per month: bill date (n-th business day) and due dates (next business
    day on or after day ``due1_day`` / ``due2_day``, clamped to month end, K21)."""
    nxt = with_next_business_day(cal).select("cal_date", "next_business_day")
    months = cal.select("month_start").distinct()
    months = (months
              .withColumn("_d1", F.least(F.date_add("month_start", due1_day - 1), F.last_day("month_start")))
              .withColumn("_d2", F.least(F.date_add("month_start", due2_day - 1), F.last_day("month_start"))))
    n1 = nxt.select(F.col("cal_date").alias("_d1"), F.col("next_business_day").alias("due1"))
    n2 = nxt.select(F.col("cal_date").alias("_d2"), F.col("next_business_day").alias("due2"))
    return (months.join(nth_day_of_month(cal, nth).withColumnRenamed("nth_day", "issue_date"), "month_start", "left")
            .join(n1, "_d1", "left").join(n2, "_d2", "left")
            .drop("_d1", "_d2"))


def date_lit(d: dt.date | str) -> Column:
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(d))
