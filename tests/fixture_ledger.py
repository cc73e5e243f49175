"""The reference's seed data (FIXTURES.md §2, intended version) as a ledger.

Built from literal rows; every job takes it exactly like the ledger derived
from the driver tables.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from decimal import Decimal as D

from pyspark.sql import functions as F

from condoledger.functions import calendar as cal
from condoledger.operators.joins import Bounded, store
from condoledger.session import checkpoint_dir
from condoledger.sources.ledger import Ledger

d = dt.date
LAYOUT = ["0A", "0B", "0C", "1A", "1B", "2A", "2B", "3A", "3B", "3C"]
SHARES = {1: [4, 6, 8, 12, 10, 9, 11, 13, 14, 13], 2: [5, 7, 10, 11, 12, 9, 9, 14, 14, 9],
          3: [7, 10, 13, 11, 10, 10, 10, 11, 8, 8], 4: [7, 10, 13, 11, 10, 10, 10, 11, 8, 8]}
PROFILE = {1: (2, 12), 2: (0, 0), 3: (2, 0), 4: (0, 12)}      # storage m2, garage m2 per unit
BILLS = [(1, d(2025, 1, 7), d(2025, 1, 15), d(2025, 1, 25), D("500000")),
         (2, d(2025, 2, 7), d(2025, 2, 15), d(2025, 2, 25), D("520000")),
         (3, d(2025, 3, 7), d(2025, 3, 15), d(2025, 3, 25), D("600000"))]
EXPENSES = {1: ("Ordinario", [1500, 80000, 15000, 60000, 30000, 10000, 20000, 25000, 20000, 15000]),
            2: ("Ordinario", [1500, 60000, 30000, 10000, 28000, 22000, 15000]),
            3: ("Extraordinario", [200000, 120000])}
ACCOUNT_SEED = {1: (D("50000"), D("0")), 2: (D("52000"), D("0")), 3: (D("53000"), D("15000"))}
PAYMENTS = [("0A", d(2025, 2, 10), D("52000")), ("1A", d(2025, 2, 18), D("40000")), ("3B", d(2025, 3, 1), D("30000"))]
PEOPLE = [(1, "Jose", "Perez", 1, False, "jose@mail.com", "1111"), (2, "Maria", "Gomez", 2, False, None, "2222"),
          (3, "Carlos", "Ruiz", 3, False, "carlos@mail.com", None), (4, "Ana", "Diaz", 4, False, "ana@mail.com", None),
          (5, "Lucia", "Sosa", 1, True, "lucia@mail.com", "5555"), (6, "Diego", "Paz", 2, True, None, "6666")]


def unit_id(building: int, pos: int) -> int:
    return (building - 1) * 10 + pos + 1


def fixture_ledger(spark, as_of: dt.date = d(2025, 12, 1)) -> Ledger:
    lg = Ledger.__new__(Ledger)
    lg.spark, lg.sf_dir, lg.as_of = spark, "fixture", as_of
    lg.root = os.path.join(checkpoint_dir(spark), "fixture", uuid.uuid4().hex)
    p = lg._path

    buildings = spark.createDataFrame(
        [(1, "FULL_BC", "Calle 1", D("1000")), (2, "SIN_BC", "Calle 2", D("800")),
         (3, "SOLO_BAULERA", "Calle 3", D("600")), (4, "SOLO_COCHERA", "Calle 4", D("900"))],
        "id_building long, name string, address string, total_area decimal(10,2)")
    units = [(unit_id(b, i), b, int(fd[0]), fd[1], D("50"), D(PROFILE[b][0]), D(PROFILE[b][1]), D(SHARES[b][i]),
              str(unit_id(b, i)).zfill(22)) for b in SHARES for i, fd in enumerate(LAYOUT)]
    unit = spark.createDataFrame(units, "id_unit long, id_building long, floor int, dept string, area decimal(7,2), "
                                        "storage_m2 decimal(5,2), garage_m2 decimal(5,2), share decimal(5,2), cbu string")
    person = spark.createDataFrame(
        [(pid, fn, ln, 10_000_000 + pid, em, ph, str(10_000 + pid).zfill(22)) for pid, fn, ln, _, _, em, ph in PEOPLE],
        "id_person long, first_name string, last_name string, dni long, email string, phone string, cbu string")
    occupancy = spark.createDataFrame([(pid, b, t) for pid, _, _, b, t, _, _ in PEOPLE],
                                      "id_person long, id_building long, is_tenant boolean")
    bill = spark.createDataFrame([(n, 1, g.replace(day=1), g, v1, v2, tot) for n, g, v1, v2, tot in BILLS],
                                 "id_bill long, id_building long, month_start date, issue_date date, due1 date, "
                                 "due2 date, total decimal(18,2)")
    exp_rows, k = [], 0
    for n, (kind, amounts) in EXPENSES.items():
        g = BILLS[n - 1][1]
        for a in amounts:
            k += 1
            exp_rows.append((k, n, 1, kind, "SERVICIOS", f"Proveedor {k}", f"Gasto {k}", g, D(a)))
    expense = spark.createDataFrame(exp_rows, "id_expense long, id_bill long, id_building long, kind string, "
                                              "category string, supplier string, description string, "
                                              "issue_date date, amount decimal(10,2)")
    acc_rows = []
    for n, (o, e) in ACCOUNT_SEED.items():
        g = BILLS[n - 1]
        for i in range(10):
            u = unit_id(1, i)
            acc_rows.append((u * 1_000_000 + g[1].year * 100 + g[1].month, u, 1, n, g[2], D(0), o, e, D(0), D(0),
                             D(0), D(0)))
    account = spark.createDataFrame(acc_rows, "id_account long, id_unit long, id_building long, id_bill long, "
                                              "acct_date date, prev_balance decimal(18,2), ord_amount decimal(18,2), "
                                              "ext_amount decimal(18,2), paid decimal(18,2), debt decimal(18,2), "
                                              "interest decimal(18,2), total_due decimal(18,2)")
    pay_rows = []
    for j, (fd, day, amt) in enumerate(PAYMENTS):
        u = unit_id(1, LAYOUT.index(fd))
        pay_rows.append((f"P{j + 1}", u * 1_000_000 + 202502, u, 1, 2, day, amt, str(u).zfill(22)))
    payment = spark.createDataFrame(pay_rows, "id_payment string, id_account long, id_unit long, id_building long, "
                                              "id_bill long, pay_date date, amount decimal(10,2), cbu string")
    fx = spark.createDataFrame([], "id_quote long, quote_ts timestamp_ntz, fx_type string, buy decimal(10,2), "
                                   "sell decimal(10,2)")
    bounds = spark.createDataFrame([(d(2025, 1, 1), d(2025, 6, 30))], "lo date, hi date")
    no_holidays = spark.createDataFrame([], "holiday date")
    calendar = cal.calendar_between(bounds, holidays=no_holidays)

    lg.__dict__.update({
        "calendar_b": Bounded(calendar, p("calendar")),
        "building_b": Bounded(buildings, p("building")),
        "bill_b": Bounded(bill, p("bill")),
        "unit": store(unit, p("unit")), "person": store(person, p("person")),
        "occupancy": store(occupancy, p("occupancy")), "expense": store(expense, p("expense")),
        "payment": store(payment, p("payment")), "fx_quote": store(fx, p("fx_quote")),
        "account": store(account, p("account")),
    })
    lg.__dict__["months_b"] = Bounded(cal.month_info(lg.calendar), p("months"))
    return lg


def by(df, key, *cols):
    """Rows of ``df`` keyed by ``key`` -> tuple of ``cols``."""
    return {r[key]: tuple(r[c] for c in cols) for r in df.select(key, *cols).collect()}


__all__ = ["fixture_ledger", "by", "unit_id", "LAYOUT", "F"]
