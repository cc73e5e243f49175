"""Reports and views R1–R13.

Common shape: the big tables (payments, expenses, accounts) are aggregated
first with partial (map-side) aggregation down to bill, unit or period
grain; the stored bill table is joined into them; windows such as
running balances and averages run only on the aggregated rows.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from dateutil.relativedelta import relativedelta
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.windows import global_row_number, running_sum
from ..sources.ledger import Ledger
from .accounts import expense_totals
from .secure import person_bank_key

MONEY = "decimal(18,2)"
HALF = Decimal("0.5")


def bills_side(lg: Ledger, df: DataFrame | None = None) -> DataFrame:
    """The bill table (or a bill-grain frame) as a join side."""
    return lg.bill if df is None else df


def week_start(d: Column) -> Column:
    """Monday of the week, with Sunday counted in the following week."""
    return F.to_date(F.date_trunc("week", F.date_add(d, 1)))


# ------------------------------------------------------------------- R1
def financial_status(lg: Ledger) -> DataFrame:
    """Per bill billed / on-time / late / advance / in / out, running balance."""
    exp = lg.expense.groupBy("id_bill").agg(F.sum("amount").alias("_out"))
    b = lg.bill.select("id_bill", "id_building", "issue_date", "due1", "total")
    pay = lg.payment.select("id_bill", "pay_date", "amount").join(bills_side(lg, b.drop("total", "id_building")), "id_bill")
    d, a = F.col("pay_date"), F.col("amount")
    zero = F.lit(0)
    pagg = pay.groupBy("id_bill").agg(
        F.sum(F.when(d.between(F.col("issue_date"), F.col("due1")), a).otherwise(zero)).alias("_on_time"),
        F.sum(F.when(d > F.col("due1"), a).otherwise(zero)).alias("_late"),
        F.sum(F.when(d < F.col("issue_date"), a).otherwise(zero)).alias("_advance"),
        F.sum(a).alias("_in"))
    m = (b.join(exp, "id_bill", "left").join(pagg, "id_bill", "left")
         .select("id_bill", "id_building", "issue_date", F.col("total").alias("bill_total"),
                 F.coalesce("_on_time", F.lit(0)).cast(MONEY).alias("on_time"),
                 F.coalesce("_late", F.lit(0)).cast(MONEY).alias("late"),
                 F.coalesce("_advance", F.lit(0)).cast(MONEY).alias("advance"),
                 F.coalesce("_in", F.lit(0)).cast(MONEY).alias("total_in"),
                 F.coalesce("_out", F.lit(0)).cast(MONEY).alias("total_out")))
    m = m.withColumn("_delta", (F.col("total_in") - F.col("total_out")).cast(MONEY))
    order = ["issue_date", "id_bill"]
    m = m.withColumn("closing", running_sum("_delta", ["id_building"], order).cast(MONEY))
    w = Window.partitionBy("id_building").orderBy(*order)
    m = m.withColumn("previous", F.lag("closing", 1, 0).over(w).cast(MONEY))
    m = global_row_number(m, ["id_building", *order])
    names = lg.building.select("id_building", F.col("name").alias("building_name"))
    return (m.join(names, "id_building")
            .select("row_id", "id_building", "building_name", "id_bill", "issue_date", "bill_total",
                    "previous", "on_time", "late", "advance", "total_in", "total_out", "closing"))


# ------------------------------------------------------------ R3 / R5
def bill_proportions(lg: Ledger, bills: DataFrame) -> DataFrame:
    """Ordinary / extraordinary totals of the given bills: expense totals when
    non-zero (each part separately), else account totals, else 0. Only the
    expenses of these bills are read, and only the accounts of those among
    them that lack a part."""
    bills = bills.join(lg.bill.select("id_bill"), "id_bill", "left_semi")
    g = bills.join(expense_totals(lg.expense.join(bills, "id_bill", "left_semi")), "id_bill", "left")
    g = g.select("id_bill", F.nullif("tot_ord", F.lit(0)).alias("_o"), F.nullif("tot_ext", F.lit(0)).alias("_e"))
    lacking = g.filter(F.col("_o").isNull() | F.col("_e").isNull()).select("id_bill")
    ec = lg.account.join(lacking, "id_bill", "left_semi").groupBy("id_bill").agg(
        F.sum(F.coalesce("ord_amount", F.lit(0))).alias("ord_ec"),
        F.sum(F.coalesce("ext_amount", F.lit(0))).alias("ext_ec"))
    return g.join(ec, "id_bill", "left").select(
        "id_bill", F.coalesce("_o", "ord_ec", F.lit(0)).alias("p_ord"), F.coalesce("_e", "ext_ec", F.lit(0)).alias("p_ext"))


def _share(part: str) -> Column:
    o, e = F.col("p_ord"), F.col("p_ext")
    return (F.when(F.coalesce(o, F.lit(0)) + F.coalesce(e, F.lit(0)) > 0,
                   F.col(part).cast("decimal(18,6)") / (o + e))
            .otherwise(F.lit(HALF)))


def payments_with_proportion(lg: Ledger, date_from: dt.date, date_to: dt.date,
                             building: int | None = None) -> DataFrame:
    p = lg.payment.select("id_bill", "id_building", "pay_date", "amount").filter(
        (F.col("pay_date") >= F.lit(date_from)) & (F.col("pay_date") < F.lit(date_to + dt.timedelta(days=1))))
    if building is not None:
        p = p.filter(F.col("id_building") == building)
    # the two shares once per bill, not per payment
    pr = bill_proportions(lg, p.select("id_bill").distinct()).select(
        "id_bill", _share("p_ord").alias("_so"), _share("p_ext").alias("_se"))
    return (p.join(pr, "id_bill")
            .withColumn("part_ord", F.col("amount") * F.col("_so"))
            .withColumn("part_ext", F.col("amount") * F.col("_se")))


def weekly_cash_flow(lg: Ledger, date_from: dt.date | None = None, date_to: dt.date | None = None,
                     building: int | None = None) -> DataFrame:
    """Payments per Monday week split ordinary / extraordinary, with the
    average over the weeks and the running total."""
    date_to = date_to or lg.as_of
    date_from = date_from or (date_to - relativedelta(months=3))
    p = payments_with_proportion(lg, date_from, date_to, building)
    wk = (p.groupBy(week_start(F.col("pay_date")).alias("week_start"))
          .agg(F.sum("part_ord").alias("_o"), F.sum("part_ext").alias("_e"), F.sum("amount").alias("_t")))
    all_rows = Window.partitionBy()
    run = Window.orderBy("week_start").rowsBetween(Window.unboundedPreceding, 0)
    return wk.select(
        "week_start",
        F.col("_o").cast(MONEY).alias("ordinary"),
        F.col("_e").cast(MONEY).alias("extraordinary"),
        F.col("_t").cast(MONEY).alias("total"),
        F.avg("_t").over(all_rows).cast(MONEY).alias("weekly_avg"),
        F.sum("_t").over(run).cast(MONEY).alias("running_total"))


def collection_by_origin(lg: Ledger, date_from: dt.date | None = None, date_to: dt.date | None = None,
                         grouping: str = "MES") -> DataFrame:
    """Collection by payment month ('MES') or quarter ('TRIMESTRE')."""
    date_to = date_to or lg.as_of
    date_from = date_from or (date_to - relativedelta(years=1))
    p = payments_with_proportion(lg, date_from, date_to)
    d = F.col("pay_date")
    if grouping == "TRIMESTRE":
        period_date = F.make_date(F.year(d), 1 + 3 * (F.quarter(d) - 1), F.lit(1))
    elif grouping == "MES":
        period_date = F.trunc(d, "month")
    else:
        raise ValueError("grouping must be 'MES' or 'TRIMESTRE'")
    g = p.groupBy(period_date.alias("period_date")).agg(F.sum("part_ord").alias("_o"), F.sum("part_ext").alias("_e"))
    if grouping == "TRIMESTRE":
        label = F.concat(F.year("period_date").cast("string"), F.lit("-T"),
                         (F.floor((F.month("period_date") - 1) / 3) + 1).cast("string"))
    else:
        label = F.date_format("period_date", "yyyy-MM")
    o, e = F.coalesce("_o", F.lit(0)), F.coalesce("_e", F.lit(0))
    tot = F.col("_o") + F.col("_e")
    return g.select(
        label.alias("period"),
        o.cast(MONEY).alias("ordinary"),
        e.cast(MONEY).alias("extraordinary"),
        (o + e).cast(MONEY).alias("total"),
        F.when(tot > 0, F.col("_o") / tot * 100).otherwise(0).cast("decimal(5,2)").alias("pct_ordinary"),
        F.when(tot > 0, F.col("_e") / tot * 100).otherwise(0).cast("decimal(5,2)").alias("pct_extraordinary"))


# ------------------------------------------------------------------- R4
def collection_by_month_department(lg: Ledger, year: int | None = None, building: int | None = None) -> DataFrame:
    """Collected per month of the bill date x floor+department label."""
    year = year or lg.as_of.year
    b = lg.bill.filter((F.col("issue_date") >= F.lit(dt.date(year, 1, 1)))
                       & (F.col("issue_date") < F.lit(dt.date(year + 1, 1, 1))))
    if building is not None:
        b = b.filter(F.col("id_building") == building)
    b = bills_side(lg, b.select("id_bill", F.trunc("issue_date", "month").alias("period_date")))
    per_unit = (lg.payment.select("id_bill", "id_unit", "amount").join(b, "id_bill")
                .groupBy("period_date", "id_unit").agg(F.sum("amount").alias("_s")))
    u = lg.unit.select("id_unit", F.concat(F.coalesce(F.col("floor"), F.lit(0)).cast("string"),
                                           F.coalesce("dept", F.lit(""))).alias("department"))
    return (per_unit.join(u, "id_unit")
            .groupBy("period_date", "department").agg(F.sum("_s").cast(MONEY).alias("total_collected"))
            .select(F.date_format("period_date", "yyyy-MM").alias("period"), "department", "total_collected"))


# ------------------------------------------------------------------- R6
def latest_quotes(lg: Ledger) -> DataFrame:
    """K8: latest sell quote per type (max_by over the quote time)."""
    return lg.fx_quote.groupBy("fx_type").agg(F.max_by("sell", F.struct("quote_ts", "id_quote")).alias("quote"))


def to_dollars(amount: Column, quote: Column) -> Column:
    """K9: amount / quote, NULL when there is no positive quote."""
    return F.when(quote > 0, amount / quote).cast(MONEY)


def _month_sums(df: DataFrame, date: str, year: int | None, building: int | None) -> DataFrame:
    if year:
        df = df.filter((F.col(date) >= F.lit(dt.date(year, 1, 1))) & (F.col(date) < F.lit(dt.date(year + 1, 1, 1))))
    if building is not None:
        df = df.filter(F.col("id_building") == building)
    return df.groupBy(F.trunc(date, "month").alias("period_date")).agg(F.sum("amount").alias("_amt"))


def _top(lg: Ledger, months: DataFrame, kind: str, fx_type: str, n: int) -> DataFrame:
    q = latest_quotes(lg).filter(F.col("fx_type") == fx_type)
    t = months.orderBy(F.col("_amt").desc(), F.col("period_date")).limit(n)
    t = t.withColumn("fx_type", F.lit(fx_type)).join(q, "fx_type", "left")
    quote = F.coalesce("quote", F.lit(0)).cast("decimal(10,2)")
    return t.select(F.lit(kind).alias("movement"),
                    F.date_format("period_date", "yyyy-MM").alias("period"),
                    F.col("_amt").cast(MONEY).alias("pesos"),
                    to_dollars(F.col("_amt"), quote).alias("dollars"),
                    "fx_type", quote.alias("quote_used"))


def top_expense_months(lg: Ledger, year: int | None = None, building: int | None = None,
                       fx_type: str = "blue", n: int = 5) -> DataFrame:
    """R6's first result set: top-n months of expenses (payments are not read)."""
    exp = _month_sums(lg.expense.select("id_building", "issue_date", "amount"), "issue_date", year, building)
    return _top(lg, exp, "GASTOS", fx_type, n)


def top_income_months(lg: Ledger, year: int | None = None, building: int | None = None,
                      fx_type: str = "blue", n: int = 5) -> DataFrame:
    """R6's second result set: top-n months of income (expenses are not read)."""
    pay = lg.payment.select("id_bill", "id_building", "pay_date", "amount").join(
        bills_side(lg, lg.bill.select("id_bill")), "id_bill")
    return _top(lg, _month_sums(pay, "pay_date", year, building), "INGRESOS", fx_type, n)


def top_months(lg: Ledger, year: int | None = None, building: int | None = None,
               fx_type: str = "blue", n: int = 5) -> DataFrame:
    """Top-n months of expenses and of income, in pesos and dollars at the
    latest quote of ``fx_type`` (NULL dollars when there is none)."""
    return top_expense_months(lg, year, building, fx_type, n).unionByName(top_income_months(lg, year, building, fx_type, n))


# ------------------------------------------------------------------- R7
def risk_band(days: Column) -> Column:
    return (F.when(days > 180, "CRITICO").when(days > 90, "ALTO")
            .when(days > 30, "MEDIO").otherwise("BAJO"))


def delinquent_owners(lg: Ledger, building: int | None = None, cut: dt.date | None = None,
                      n: int | None = 3) -> DataFrame:
    """Owners with unpaid accounts due before ``cut``, matched to units by
    the bank id that their stored cipher gives (the plain one without), top ``n`` by amount due then days late (``n=None``: all)."""
    cut = cut or lg.as_of
    b = lg.bill.select("id_bill", "due1").filter(F.col("due1") < F.lit(cut))
    acc = lg.account.filter(F.col("debt") > 0)
    if building is not None:
        acc = acc.filter(F.col("id_building") == building)
    acc = acc.join(bills_side(lg, b), "id_bill")
    # who holds a unit is settled at unit grain, so the accounts are shuffled once, by unit
    units = lg.unit.select("id_unit", "id_building", "cbu")
    owners = lg.occupancy.filter(~F.col("is_tenant")).select("id_person", "id_building").distinct()
    people = person_bank_key(lg)                               # D13
    holders = units.join(people, "cbu").join(owners, ["id_person", "id_building"]).select("id_unit", "id_building", "id_person")
    m = (acc.join(holders, ["id_unit", "id_building"])
         .groupBy("id_person", "id_building")
         .agg(F.countDistinct("id_bill").alias("unpaid_bills"),
              F.sum("debt").cast(MONEY).alias("debt_total"),
              F.sum("interest").cast(MONEY).alias("interest_total"),
              F.sum("total_due").cast(MONEY).alias("total_due"),
              F.max("due1").alias("last_due")))
    days = F.datediff(F.lit(cut), F.col("last_due")).cast("bigint")
    m = m.withColumn("days_late", days)
    if n is not None:
        m = m.orderBy(F.col("total_due").desc(), F.col("days_late").desc(), F.col("id_person")).limit(n)
    p = lg.person.select("id_person", F.concat(F.coalesce("last_name", F.lit("")), F.lit(", "),
                                                         F.coalesce("first_name", F.lit(""))).alias("full_name"),
                         "dni", "email", "phone")
    names = lg.building.select("id_building", F.col("name").alias("building_name"))
    return (m.join(p, "id_person").join(names, "id_building")
            .select("id_person", "full_name", "dni", "email", "phone", "building_name", "debt_total",
                    "interest_total", "total_due", "unpaid_bills", "last_due", "days_late",
                    risk_band(F.col("days_late")).alias("risk_level")))


# ------------------------------------------------------------------- R8
def days_between_payments(lg: Ledger, building: int | None = None, date_from: dt.date | None = None,
                          date_to: dt.date | None = None) -> DataFrame:
    """Per unit, each payment with the previous one in the range and the gap.
    The range filter comes before the LAG, so a unit's first payment in the
    range has no previous one and is dropped, as in the reference."""
    from ..operators.windows import previous_event
    date_to = date_to or lg.as_of
    date_from = date_from or (date_to - relativedelta(years=1))
    p = lg.payment.select("id_payment", "id_unit", "pay_date", "amount").filter(
        (F.col("pay_date") >= F.lit(date_from)) & (F.col("pay_date") < F.lit(date_to + dt.timedelta(days=1))))
    u = lg.unit.select("id_unit", "id_building", "floor", "dept")
    if building is not None:
        u = u.filter(F.col("id_building") == building)
    p = previous_event(p.join(u, "id_unit"), "id_unit", "pay_date", "id_payment")
    names = lg.building.select("id_building", F.col("name").alias("building_name"))
    label = F.concat(F.lit("UF-"), F.col("id_unit").cast("string"), F.lit(" (Piso "),
                     F.coalesce(F.col("floor"), F.lit(0)).cast("string"), F.coalesce("dept", F.lit("")), F.lit(")"))
    return (p.filter(F.col("prev_date").isNotNull())
            .join(names, "id_building")
            .select("building_name", "id_payment", label.alias("unit_label"), "pay_date", "prev_date",
                    F.datediff("pay_date", "prev_date").cast("bigint").alias("days_between"), "amount"))


# ------------------------------------------------------------------- R9
def monthly_status(lg: Ledger, year: int, building: int | None = None, m1: int = 1, m2: int = 12) -> DataFrame:
    """For each building month with a bill: income by payment month split by
    the bill's month (same / earlier / later), expenses by emission month,
    running balance from ``m1``."""
    if not (1 <= m1 <= 12 and 1 <= m2 <= 12 and m1 <= m2):
        raise ValueError("invalid month range")
    lo, hi = dt.date(year, m1, 1), dt.date(year, m2, 1) + relativedelta(months=1)
    b = lg.bill.filter((F.col("issue_date") >= F.lit(lo)) & (F.col("issue_date") < F.lit(hi)))
    if building is not None:
        b = b.filter(F.col("id_building") == building)
    months = b.select("id_building", F.trunc("issue_date", "month").alias("m_start")).distinct()
    bill_dates = bills_side(lg, lg.bill.select("id_bill", F.col("issue_date").alias("bill_date")))
    pay = (lg.payment.select("id_bill", "id_building", "pay_date", "amount")
           .filter((F.col("pay_date") >= F.lit(lo)) & (F.col("pay_date") < F.lit(hi)))
           .withColumn("m_start", F.trunc("pay_date", "month"))
           .join(months, ["id_building", "m_start"])
           .join(bill_dates, "id_bill", "left"))
    gen, ms = F.col("bill_date"), F.col("m_start")
    a = F.col("amount")
    inc = pay.groupBy("id_building", "m_start").agg(
        F.sum(F.when((gen >= ms) & (gen <= F.last_day(ms)), a).otherwise(0)).alias("_same"),
        F.sum(F.when(gen < ms, a).otherwise(0)).alias("_owed"),
        F.sum(F.when(gen > F.last_day(ms), a).otherwise(0)).alias("_ahead"),
        F.sum(a).alias("_in"))
    out = (lg.expense.select("id_building", "issue_date", "amount")
           .filter((F.col("issue_date") >= F.lit(lo)) & (F.col("issue_date") < F.lit(hi)))
           .withColumn("m_start", F.trunc("issue_date", "month"))
           .join(months, ["id_building", "m_start"])
           .groupBy("id_building", "m_start").agg(F.sum("amount").alias("_out")))
    c = (months.join(inc, ["id_building", "m_start"], "left").join(out, ["id_building", "m_start"], "left")
         .select("id_building", "m_start",
                 *[F.coalesce(x, F.lit(0)).cast(MONEY).alias(x) for x in ("_same", "_owed", "_ahead", "_in", "_out")]))
    w = Window.partitionBy("id_building").orderBy("m_start")
    c = c.withColumn("closing", F.sum(F.col("_in") - F.col("_out")).over(w).cast(MONEY))
    c = c.withColumn("previous", F.lag("closing", 1, 0).over(w).cast(MONEY))
    names = lg.building.select("id_building", F.col("name").alias("building_name"))
    return (c.join(names, "id_building")
            .select("id_building", "building_name", F.year("m_start").cast("bigint").alias("year"),
                    F.month("m_start").cast("bigint").alias("month"), "previous",
                    F.col("_same").alias("income_on_time"), F.col("_owed").alias("income_owed"),
                    F.col("_ahead").alias("income_ahead"), F.col("_out").alias("expenses"), "closing"))


# ------------------------------------------------------------------ R10
def account_statement(lg: Ledger, building: int | None = None, year: int | None = None,
                      month: int | None = None, bill_no: int | None = None) -> DataFrame:
    """Account x unit x building x bill with the owner name by bank id."""
    b = lg.bill.select("id_bill", "issue_date")
    if year is not None:
        b = b.filter((F.col("issue_date") >= F.lit(dt.date(year, 1, 1)))
                     & (F.col("issue_date") < F.lit(dt.date(year + 1, 1, 1))))
    if month is not None:
        b = b.filter(F.month("issue_date") == month)
    if bill_no is not None:
        b = b.filter(F.col("id_bill") == bill_no)
    acc = lg.account
    if building is not None:
        acc = acc.filter(F.col("id_building") == building)
    acc = acc.join(bills_side(lg, b), "id_bill")
    # who owns a unit is settled at unit grain, so the accounts are shuffled once, by unit
    owner = F.coalesce(F.concat("last_name", F.lit(", "), "first_name"), "first_name", "last_name")
    p = lg.person.select("cbu", owner.alias("owner"))
    u = (lg.unit.select("id_unit", "share", "floor", "dept", "storage_m2", "garage_m2", "cbu")
         .join(p, "cbu", "left").drop("cbu"))
    names = lg.building.select("id_building", F.col("name").alias("building_name"))
    return (acc.join(u, "id_unit")
            .join(names, "id_building")
            .select("id_building", "building_name", "id_bill", "issue_date", "id_unit", "share", "floor", "dept",
                    F.when(F.coalesce("garage_m2", F.lit(0)) > 0, 1).otherwise(0).alias("has_garage"),
                    F.when(F.coalesce("storage_m2", F.lit(0)) > 0, 1).otherwise(0).alias("has_storage"),
                    "owner", "prev_balance", "paid", "debt", "interest", "ord_amount",
                    "ext_amount", "total_due"))


# ------------------------------------------------------------------ R12
def quote_age(lg: Ledger, now: dt.datetime) -> DataFrame:
    """Every quote with the minutes since it was taken (minute
    boundaries crossed, as DATEDIFF(MINUTE) counts them). Computed from the
    wall-clock fields of the zone-less timestamps, so the session time zone
    does not matter."""
    def minute(c: Column) -> Column:
        return (F.unix_date(F.to_date(c)).cast("long") * 1440 + F.hour(c) * 60 + F.minute(c)).cast("bigint")
    now_c = F.to_timestamp_ntz(F.lit(now.isoformat(sep=" ")))
    return lg.fx_quote.select("fx_type", "buy", "sell", "quote_ts",
                              (minute(now_c) - minute(F.col("quote_ts"))).alias("minutes_since"))


# ------------------------------------------------------------------ R11
def recent_bills(lg: Ledger, new_bills: DataFrame | None = None, n: int = 50, building: int | None = None) -> DataFrame:
    """The n most recent bills (with any just generated by J6)."""
    cols = ["id_building", "id_bill", "issue_date", "due1", "due2"]
    b = lg.bill.select(*cols)
    if new_bills is not None:
        b = b.unionByName(new_bills.select(*cols))
    if building is not None:
        b = b.filter(F.col("id_building") == building)
    return b.orderBy(F.col("issue_date").desc(), F.col("id_bill").desc()).limit(n)


def bills_in_dollars(lg: Ledger, fx_type: str = "blue") -> DataFrame:
    """K9 over the bill table: total / latest quote of the type (NULL without one)."""
    q = latest_quotes(lg).filter(F.col("fx_type") == fx_type)
    b = lg.bill.select("id_bill", "total").withColumn("fx_type", F.lit(fx_type))
    # q: grouped by type, filtered to one type -> at most one row
    return b.join(F.broadcast(q), "fx_type", "left").select("id_bill", "total",
                                                            to_dollars(F.col("total"), F.col("quote")).alias("dollars"))
