"""Ledger jobs J1–J8: accounts, proration, interest, next bill.

Plan shape of the account recompute (J2), the widest job:

  bills ⟕ expense totals per bill ⟕ share sum per building
        -> per-bill row, stored: bounded by the bill count, joined map side
  payments -> partial agg per account -> one map account -> totals per unit
  units ⟕ that map (shuffle join on the unit)
        ⋈ per-bill with the building's bill before it (LAG over the bills)
        = skeleton, each row taking its own totals and those of the bill
          before it from the map

A unit has every bill of its building, so the bill before a row's is known
per bill: the previous balance is worked out in the row itself. The rows of
units x bills are made behind the last shuffle and never sorted; only units
and payment totals move.

A building holding a third of all units only makes the broadcast join
longer for the tasks that read those units; no shuffle is keyed by building.
Units are few bytes and many rows behind the join, so they are dealt out by
the rows that they become (``deals``), not by their bytes.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.interest import MONEY, interest_cents
from ..operators.joins import store, unbounded
from ..sources.ledger import EXTRAORDINARY, ORDINARY, Ledger, account_id, account_unit

DUMMY_DATE = dt.date(1900, 1, 1)
# Rows of units x bills that one task makes.
ROWS_A_TASK = 500_000


def filter_bills(bill: DataFrame, building: int | None = None, bill_no: int | None = None,
                 date_from: dt.date | None = None, date_to: dt.date | None = None,
                 include_dummy: bool = False) -> DataFrame:
    """A10 optional filters, built only for the parameters given (better pruning
    than ``@p IS NULL OR col = @p``); C10 drops dummy bills."""
    preds: list[Column] = []
    if building is not None:
        preds.append(F.col("id_building") == building)
    if bill_no is not None:
        preds.append(F.col("id_bill") == bill_no)
    if date_from is not None:
        preds.append(F.col("issue_date") >= F.lit(date_from))
    if date_to is not None:
        preds.append(F.col("issue_date") <= F.lit(date_to))
    if not include_dummy:
        preds.append((F.col("issue_date") != F.lit(DUMMY_DATE)) & (F.coalesce("total", F.lit(0)) != 0))
    for p in preds:
        bill = bill.filter(p)
    return bill


def expense_totals(expense: DataFrame) -> DataFrame:
    """Ordinary / extraordinary totals per bill."""
    return expense.groupBy("id_bill").agg(
        F.sum(F.when(F.col("kind") == ORDINARY, F.col("amount")).otherwise(0)).cast(MONEY).alias("tot_ord"),
        F.sum(F.when(F.col("kind") == EXTRAORDINARY, F.col("amount")).otherwise(0)).cast(MONEY).alias("tot_ext"))


def share_sums(unit: DataFrame) -> DataFrame:
    return unit.groupBy("id_building").agg(F.sum(F.col("share").cast("decimal(18,6)")).alias("sum_share"))


def cents(amount: Column) -> Column:
    """Money with 2 decimals as an exact count of cents (long)."""
    return (amount * 100).cast("long")


def prorate_cents(total_cents: Column, weight: Column, weight_sum: Column) -> Column:
    """J3 on integers: round_half_away(total * weight / weight_sum) in cents,
    with the weights as longs (share * 100); NULL when the sum is 0 or NULL.

    Only integer division (``div``) and remainders, so the result is exact for
    every total that a long of cents holds: the whole quotient and the
    remainder of the total are multiplied by the weight on their own, and only
    remainder * weight (below weight_sum * weight) is rounded.
    """
    t, z = F.abs(total_cents), F.nullif(weight_sum, F.lit(0).cast("long"))
    part = F.call_function("div", (t % z) * weight * 2 + z, z * 2)
    return F.signum(total_cents).cast("long") * (F.call_function("div", t, z) * weight + part)


def base_cents(ord_cents: Column, ext_cents: Column, weight: Column, weight_sum: Column) -> Column:
    """A row's ord+ext in cents, an amount that cannot be prorated counting as 0."""
    return F.coalesce(prorate_cents(ord_cents, weight, weight_sum), F.lit(0)) + F.coalesce(prorate_cents(ext_cents, weight, weight_sum), F.lit(0))


def from_cents(c: Column) -> Column:
    """Cents back to money: a multiplication by 0.01 (a decimal division
    would again take the BigDecimal path)."""
    return (c.cast("decimal(18,0)") * F.lit(0.01).cast("decimal(2,2)")).cast(MONEY)


def prorate(total: Column, share: Column, sum_share: Column) -> Column:
    """round(total * share / sum(share of building), 2); zero sum -> NULL."""
    return from_cents(prorate_cents(cents(total), cents(share), cents(sum_share)))


def per_bill_raw(lg: Ledger, bills: DataFrame) -> DataFrame:
    """Bills with expense totals and the building's share sum.

    Row count = bills (left joins on unique keys).
    """
    return (bills.join(expense_totals(lg.expense), "id_bill", "left")
            .join(share_sums(lg.unit), "id_building", "left"))


def per_bill(lg: Ledger, bills: DataFrame) -> DataFrame:
    return per_bill_raw(lg, bills)


# What a row needs of the bill before its own.
BILL_PARTS = ["month_start", "due1", "due2", "_ord_c", "_ext_c", "_sum_w"]


def skeleton(lg: Ledger, bills: DataFrame, units: DataFrame | None = None, previous: bool = False) -> DataFrame:
    """One row per unit x bill of its building, with prorated amounts.
    ``units`` (default: the ledger's) may bring further columns, which stay.
    ``previous`` (for units of ``with_copies``) adds the row's base in cents and
    the account number, due dates and base of the unit's row before."""
    units = lg.unit.select("id_unit", "id_building", "share") if units is None else units
    more = [c for c in units.columns if c not in ("id_unit", "id_building", "share")]
    pb = (per_bill_raw(lg, bills)
          .select("id_bill", "id_building", "month_start", "issue_date", "due1", "due2",
                  cents(F.coalesce("tot_ord", F.lit(0))).alias("_ord_c"),
                  cents(F.coalesce("tot_ext", F.lit(0))).alias("_ext_c"),
                  cents(F.col("sum_share")).alias("_sum_w")))
    if previous:
        w = Window.partitionBy("id_building").orderBy("issue_date", "id_bill")
        pb = pb.withColumn("_before", F.lag(F.struct(*BILL_PARTS)).over(w))
    pb = store(pb, f"{lg.root}/per-bill-{uuid.uuid4().hex}")        # its size is known: one row per bill
    u = units.select("id_unit", "id_building", cents(F.col("share")).alias("_w"), *more)
    s = u.join(pb, "id_building")
    if previous:
        s = s.withColumn("_row_before", F.when(F.col("_copy") == 1, F.col("_before")).otherwise(F.struct(*BILL_PARTS)))
        b, w = F.col("_row_before"), cents(F.col("_share_before"))
        more = [*more, account_id(F.col("id_unit"), b["month_start"]).alias("_before_account"),
                b["due1"].alias("_before_due1"), b["due2"].alias("_before_due2"),
                base_cents(b["_ord_c"], b["_ext_c"], w, b["_sum_w"]).alias("_before_base_c"),
                base_cents(F.col("_ord_c"), F.col("_ext_c"), F.col("_w"), F.col("_sum_w")).alias("_base_c")]
    return s.select(
        account_id(F.col("id_unit"), F.col("month_start")).alias("id_account"),
        "id_unit", "id_building", "id_bill", "issue_date", "due1", "due2",
        F.coalesce("due1", "issue_date").alias("acct_date"),
        from_cents(prorate_cents(F.col("_ord_c"), F.col("_w"), F.col("_sum_w"))).alias("ord_amount"),
        from_cents(prorate_cents(F.col("_ext_c"), F.col("_w"), F.col("_sum_w"))).alias("ext_amount"), *more)


def with_copies(units: DataFrame) -> DataFrame:
    """``units`` with their number among the rows of the same unit (_copy, 1 for a
    unit that is there once) and the share of the row before it, of the last one
    for the first: the rows of a repeated unit follow each other in each bill."""
    w = Window.partitionBy("id_building", "id_unit").orderBy("share")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    copy = F.row_number().over(w)
    return units.withColumns({"_copy": copy, "_share_before": F.when(copy == 1, F.last("share").over(whole)).otherwise(F.lag("share").over(w))})


def deals(units: DataFrame, bills: DataFrame) -> int:
    """Into how many partitions units go before they meet the bills of their
    building. Adaptive execution would put together the partitions of units by
    their bytes, and a few tasks would make all rows of units x bills."""
    per_building = units.groupBy("id_building").agg(F.count(F.lit(1)).alias("_units")).join(
        bills.groupBy("id_building").agg(F.count(F.lit(1)).alias("_bills")), "id_building")
    rows = per_building.agg(F.sum(F.col("_units") * F.col("_bills"))).first()[0] or 0
    return -(-rows // ROWS_A_TASK) or 1


def units_with_totals(lg: Ledger, parts: int | None = None) -> DataFrame:
    """Units with a map account -> (paid_sum, last_pay) of their payments, by
    unit (a shuffle join at any size, which later steps by unit build on), in
    ``parts`` partitions if given. A unit has at most one account per month."""
    paid = payment_totals(lg.payment).filter(F.col("id_account").isNotNull()).withColumn("id_unit", account_unit(F.col("id_account")))
    units = lg.unit.select("id_unit", "id_building", "share")
    if parts:
        paid, units = paid.repartition(parts, "id_unit"), units.repartition(parts, "id_unit")
    paid = paid.groupBy("id_unit").agg(
        F.map_from_entries(F.collect_list(F.struct("id_account", F.struct("paid_sum", "last_pay")))).alias("_totals"))
    return units.join(unbounded(paid), "id_unit", "left")


def payment_totals(payment: DataFrame) -> DataFrame:
    """paid / last payment per account (partial aggregation before the shuffle)."""
    return payment.groupBy("id_account").agg(F.sum("amount").cast(MONEY).alias("paid_sum"),
                                             F.max("pay_date").alias("last_pay"))


def settle(acc: DataFrame, rule: str, as_of: dt.date) -> DataFrame:
    """Step (4): paid, debt, interest, total from base and payment totals
    (exact cents on longs; see functions.interest for the rule table). The base
    and what was paid may be there already, in cents."""
    if "_base_c" not in acc.columns:
        acc = acc.withColumn("_base_c", cents(F.coalesce("ord_amount", F.lit(0))) + cents(F.coalesce("ext_amount", F.lit(0))))
    base = F.col("_base_c")
    paid = F.col("_paid_c")
    inter = interest_cents(base, paid, F.col("last_pay"), F.col("due1"), F.col("due2"), rule, as_of)
    paid0 = F.coalesce(paid, F.lit(0).cast("long"))
    debt_c = F.when(base <= paid0, F.lit(0).cast("long")).otherwise(base - paid0)
    if "_paid_c" not in acc.columns:
        acc = acc.withColumn("_paid_c", cents(F.col("paid_sum")))
    return (acc.withColumn("_debt_c", debt_c)
            .withColumn("_int_c", inter)
            .withColumn("paid", from_cents(paid0))
            .withColumn("debt", from_cents(F.col("_debt_c")))
            .withColumn("interest", from_cents(F.col("_int_c")))
            .withColumn("total_due", from_cents(F.col("_debt_c") + F.col("_int_c")))
            .drop("_base_c", "_paid_c", "_debt_c", "_int_c"))


def previous_balance(acc: DataFrame, rule: str | None, as_of: dt.date) -> DataFrame:
    """Step (3): the own ord+ext+interest-paid (F5) of the unit's row before, 0
    without one; ``rule`` None: without interest and payments."""
    own = F.col("_before_base_c")
    if rule is not None:
        paid = F.col("_before_paid_c")
        own = own + interest_cents(own, paid, F.col("_before_last_pay"), F.col("_before_due1"), F.col("_before_due2"), rule, as_of) - F.coalesce(paid, F.lit(0))
    return acc.withColumn("prev_balance", from_cents(own))


ACCOUNT_COLS = ["id_account", "id_unit", "id_building", "id_bill", "acct_date", "prev_balance",
                "ord_amount", "ext_amount", "paid", "debt", "interest", "total_due"]


def recompute_accounts(lg: Ledger, rule: str = "M1", building: int | None = None,
                       bill_no: int | None = None, date_from: dt.date | None = None,
                       date_to: dt.date | None = None, include_dummy: bool = False,
                       balance: str = "settled") -> DataFrame:
    """Recompute every account of the filtered bills.

    ``balance='settled'`` chains the previous balance from the refreshed
    interest and payments (step 4 before step 3). ``'reference'`` reproduces
    the reference order on a fresh ledger, where step 3 still sees the zero
    interest and payments of the skeleton, so every previous balance is the
    previous bill's ord + ext.
    """
    bills = filter_bills(lg.bill, building, bill_no, date_from, date_to, include_dummy)
    if balance not in ("settled", "reference"):
        raise ValueError(balance)
    acc = skeleton(lg, bills, with_copies(units_with_totals(lg, deals(lg.unit, bills))), previous=True)
    # Each lookup is a step of its own, which parts the generated code of the row: in
    # one piece it passes the 8,000 bytes up to which the JVM compiles a method.
    def total(account: Column) -> Column:
        t = F.try_element_at(F.col("_totals"), account)
        return F.struct(cents(t["paid_sum"]).alias("paid_c"), t["last_pay"].alias("last_pay"))

    def lookup(name: str) -> Column:
        return F.transform(F.array(name), total)

    before, own = F.col("_t_before")[0], F.col("_t_own")[0]
    acc = acc.withColumn("_t_before", lookup("_before_account")).withColumns({"_before_paid_c": before["paid_c"], "_before_last_pay": before["last_pay"]})
    acc = previous_balance(acc, rule if balance == "settled" else None, lg.as_of).withColumn("_t_own", lookup("id_account"))
    acc = settle(acc.withColumns({"_paid_c": own["paid_c"], "last_pay": own["last_pay"]}), rule, lg.as_of)
    return acc.select(*ACCOUNT_COLS)


def generate_accounts(lg: Ledger, year: int | None, existing: DataFrame | None = None) -> DataFrame:
    """Unit x bill of the year (None: of all years, but for dummy bills) for
    rows not yet present; amounts NULL."""
    if year is None:
        bills = lg.bill.filter(F.col("issue_date") != F.lit(DUMMY_DATE))
    else:
        y0, y1 = dt.date(year, 1, 1), dt.date(year + 1, 1, 1)
        bills = lg.bill.filter((F.col("issue_date") >= F.lit(y0)) & (F.col("issue_date") < F.lit(y1)))
    sk = (lg.unit.select("id_unit", "id_building").repartition(deals(lg.unit, bills)).join(bills, "id_building")
          .select(account_id(F.col("id_unit"), F.col("month_start")).alias("id_account"),
                  "id_unit", "id_building", "id_bill",
                  F.coalesce("due1", "issue_date").alias("acct_date")))
    if existing is not None:
        sk = sk.join(unbounded(existing.select("id_unit", "id_bill")), ["id_unit", "id_bill"], "left_anti")
    return sk


def recompute_interest(lg: Ledger, accounts: DataFrame, rule: str = "M2") -> DataFrame:
    """J4 (M2, all accounts) / J5 body (M3): refresh paid, debt, interest, total
    from the current payments, keeping amounts and previous balance."""
    b = lg.bill.select("id_bill", "due1", "due2")
    acc = (accounts.drop("paid", "debt", "interest", "total_due")
           .join(b, "id_bill")
           .join(unbounded(payment_totals(lg.payment)), "id_account", "left"))
    return settle(acc, rule, lg.as_of).select(*ACCOUNT_COLS)


# ------------------------------------------------------------------ J5
def changed_account_keys(inserted: DataFrame, deleted: DataFrame) -> DataFrame:
    """H1: account ids touched by a change set (inserted UNION deleted, distinct)."""
    return (inserted.select("id_account").filter(F.col("id_account").isNotNull())
            .union(deleted.select("id_account").filter(F.col("id_account").isNotNull()))
            .distinct())


def recompute_changed(lg: Ledger, keys: DataFrame, payments: DataFrame | None = None,
                      totals: DataFrame | None = None) -> DataFrame:
    """Refresh only the accounts in ``keys`` with rule M3 (as-of date
    ladder on the remaining debt); accounts without payments get paid 0.
    ``totals`` gives known payment totals per account in place of payments."""
    acc = lg.account.join(keys, "id_account", "left_semi")
    if totals is None:
        payments = lg.payment if payments is None else payments
        totals = payment_totals(payments.join(keys, "id_account", "left_semi"))
    b = lg.bill.select("id_bill", "due1", "due2")
    acc = (acc.drop("paid", "debt", "interest", "total_due").join(b, "id_bill")
           .join(totals, "id_account", "left"))
    return settle(acc, "M3", lg.as_of).select(*ACCOUNT_COLS)


# ------------------------------------------------------------------ J6 / J7 / J8
def due_bills(lg: Ledger, building: int | None = None, due1_day: int = 10, due2_day: int | None = 22) -> DataFrame:
    """Per building, the bill of the month after its last payment (or after
    as_of without payments): 5th business day, due dates = next business day
    of the due days (``due2_day`` None: no second one) pushed to at least the
    bill date; total 0. It may exist already."""
    from ..functions import calendar as cal
    from ..sources.ledger import bill_id
    last = lg.payment.groupBy("id_building").agg(F.max("pay_date").alias("last_pay"))
    b = lg.building.select("id_building")
    if building is not None:
        b = b.filter(F.col("id_building") == building)
    base = (b.join(last, "id_building", "left")
            .withColumn("month_start", F.trunc(F.add_months(F.coalesce("last_pay", F.lit(lg.as_of)), 1), "month")))
    months = lg.months_b.df if (due1_day, due2_day) == (10, 22) else cal.month_info(lg.calendar, 5, due1_day, due2_day or due1_day)
    second = F.col("due2") if due2_day else F.lit(None).cast("date")
    m = months.select("month_start", F.col("issue_date").alias("gen"), F.col("due1").alias("v1"), second.alias("v2"))
    f = base.join(m, "month_start", "left")
    due1 = F.when(F.col("v1").isNull() | (F.col("v1") < F.col("gen")), F.col("gen")).otherwise(F.col("v1"))
    due2 = (F.when(F.col("v2").isNull(), F.lit(None))
            .when(F.col("v1").isNotNull() & (F.col("v2") < F.col("v1")), F.col("v1"))
            .when(F.col("v2") < F.col("gen"), F.col("gen")).otherwise(F.col("v2")))
    return f.select(bill_id(F.col("id_building"), F.col("month_start")).alias("id_bill"), "id_building",
                    F.col("gen").alias("issue_date"), due1.alias("due1"), due2.alias("due2"),
                    F.lit(0).cast(MONEY).alias("total"))


def next_bills(lg: Ledger, building: int | None = None, due1_day: int = 10, due2_day: int | None = 22) -> DataFrame:
    """The due bills that do not exist at their (building, date)."""
    existing = lg.bill.select("id_building", "issue_date")
    return due_bills(lg, building, due1_day, due2_day).join(existing, ["id_building", "issue_date"], "left_anti")


def dispatches(lg: Ledger, targets: DataFrame) -> DataFrame:
    """One dispatch per person linked to the building of each target bill:
    EMAIL if an e-mail, else WHATSAPP if a phone, else IMPRESO."""
    t = targets.select("id_building", "id_bill")
    occ = lg.occupancy.join(t, "id_building")
    p = lg.person.select("id_person", "email", "phone")
    email = F.nullif(F.trim("email"), F.lit(""))
    phone = F.nullif(F.trim("phone"), F.lit(""))
    return (occ.join(p, "id_person")
            .select("id_building", "id_bill", "id_person",
                    F.when(email.isNotNull(), "EMAIL").when(phone.isNotNull(), "WHATSAPP").otherwise("IMPRESO")
                    .alias("channel"),
                    email.alias("email"), phone.alias("phone"),
                    F.when(F.col("is_tenant"), "Inquilino").otherwise("Propietario").alias("note")))


def bill_totals(lg: Ledger) -> DataFrame:
    """Bill total recomputed as the sum of its expenses (0 when none)."""
    s = lg.expense.groupBy("id_bill").agg(F.sum("amount").alias("_s"))
    return (lg.bill.select("id_bill", "id_building", "issue_date").join(s, "id_bill", "left")
            .select("id_bill", "id_building", "issue_date", F.coalesce("_s", F.lit(0)).cast(MONEY).alias("total")))
