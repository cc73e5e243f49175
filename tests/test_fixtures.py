"""Golden results of FIXTURES.md §3 on the reference's (intended) seed data."""

import datetime as dt
from decimal import Decimal as D

import pytest
from fixture_ledger import LAYOUT, by, fixture_ledger, unit_id
from pyspark.sql import functions as F

from condoledger.functions import calendar as cal
from condoledger.plans import accounts as A
from condoledger.plans import quality as Q
from condoledger.plans import reports as R

d = dt.date


@pytest.fixture(scope="module")
def lg(spark):
    return fixture_ledger(spark)


def test_q4_q5_q7(lg):
    assert by(Q.q4_building_profile(lg), "id_building", "has_storage", "has_garage") == {
        1: (1, 1), 2: (0, 0), 3: (1, 0), 4: (0, 1)}
    assert {v[0] for v in by(Q.q5_unit_count(lg), "id_building", "units").values()} == {10}
    assert by(Q.q7_accounts_per_bill(lg), "id_bill", "accounts") == {1: (10,), 2: (10,), 3: (10,)}


def test_j4_interest_m2_on_b2(lg):
    acc = A.recompute_interest(lg, lg.account, "M2").filter(F.col("id_bill") == 2)
    got = by(acc, "id_unit", "paid", "debt", "interest", "total_due")
    u = {fd: unit_id(1, i) for i, fd in enumerate(LAYOUT)}
    assert got[u["0A"]] == (D("52000.00"), D("0.00"), D("0.00"), D("0.00"))
    assert got[u["1A"]] == (D("40000.00"), D("12000.00"), D("240.00"), D("12240.00"))
    assert got[u["3B"]] == (D("30000.00"), D("22000.00"), D("1100.00"), D("23100.00"))
    others = [v for k, v in got.items() if k not in (u["0A"], u["1A"], u["3B"])]
    assert len(others) == 7 and all(v == (D("0.00"), D("52000.00"), D("0.00"), D("52000.00")) for v in others)


def test_r1_financial_status(lg):
    got = by(R.financial_status(lg), "id_bill", "on_time", "late", "advance", "total_in", "total_out", "closing",
             "previous")
    assert got[1] == (0, 0, 0, 0, D("276500.00"), D("-276500.00"), D("0.00"))
    assert got[2] == (D("52000.00"), D("70000.00"), 0, D("122000.00"), D("166500.00"), D("-321000.00"),
                      D("-276500.00"))
    assert got[3] == (0, 0, 0, 0, D("320000.00"), D("-641000.00"), D("-321000.00"))
    assert sorted(r["row_id"] for r in R.financial_status(lg).collect()) == [1, 2, 3]


def test_r3_weekly_cash_flow(lg):
    rows = R.weekly_cash_flow(lg, d(2025, 2, 7), d(2025, 12, 1)).orderBy("week_start").collect()
    assert [(r.week_start, r.total, r.ordinary, r.extraordinary, r.running_total) for r in rows] == [
        (d(2025, 2, 10), D("52000.00"), D("52000.00"), D("0.00"), D("52000.00")),
        (d(2025, 2, 17), D("40000.00"), D("40000.00"), D("0.00"), D("92000.00")),
        (d(2025, 2, 24), D("30000.00"), D("30000.00"), D("0.00"), D("122000.00"))]
    assert {r.weekly_avg for r in rows} == {D("40666.67")}


def test_r4_r5_r6(lg):
    assert by(R.collection_by_month_department(lg, 2025), "department", "period", "total_collected") == {
        "0A": ("2025-02", D("52000.00")), "1A": ("2025-02", D("40000.00")), "3B": ("2025-02", D("30000.00"))}
    assert by(R.collection_by_origin(lg, grouping="MES"), "period", "total", "pct_ordinary") == {
        "2025-02": (D("92000.00"), D("100.00")), "2025-03": (D("30000.00"), D("100.00"))}
    assert by(R.collection_by_origin(lg, grouping="TRIMESTRE"), "period", "total") == {"2025-T1": (D("122000.00"),)}
    top = R.top_months(lg, 2025).collect()
    exp = [(r.period, r.pesos, r.dollars) for r in top if r.movement == "GASTOS"]
    inc = [(r.period, r.pesos, r.dollars) for r in top if r.movement == "INGRESOS"]
    assert sorted(exp) == [("2025-01", D("276500.00"), None), ("2025-02", D("166500.00"), None),
                           ("2025-03", D("320000.00"), None)]
    assert sorted(inc) == [("2025-02", D("92000.00"), None), ("2025-03", D("30000.00"), None)]


def test_r7_r8_empty(lg):
    assert R.delinquent_owners(lg, n=3).count() == 0
    assert R.days_between_payments(lg, date_from=d(2025, 1, 1)).count() == 0


def test_r9_monthly_status(lg):
    got = by(R.monthly_status(lg, 2025, m1=1, m2=3), "month", "income_on_time", "income_owed", "income_ahead",
             "expenses", "closing")
    assert got == {1: (0, 0, 0, D("276500.00"), D("-276500.00")),
                   2: (D("92000.00"), 0, 0, D("166500.00"), D("-351000.00")),
                   3: (0, D("30000.00"), 0, D("320000.00"), D("-641000.00"))}


def test_j3_prorate_b1(lg):
    sk = A.skeleton(lg, lg.bill.filter(F.col("id_bill") == 1))
    got = by(sk, "id_unit", "ord_amount")
    assert got[unit_id(1, LAYOUT.index("0A"))] == (D("11060.00"),)
    assert got[unit_id(1, LAYOUT.index("1A"))] == (D("33180.00"),)
    assert got[unit_id(1, LAYOUT.index("3B"))] == (D("38710.00"),)
    assert sum(v[0] for v in got.values()) == D("276500.00")     # shares of building 1 sum to 100


def test_k12_and_j6_j7(lg):
    k12 = by(cal.nth_day_of_month(lg.calendar, 5), "month_start", "nth_day")
    assert [k12[d(2025, m, 1)][0] for m in (1, 2, 3)] == [d(2025, 1, 7), d(2025, 2, 7), d(2025, 3, 7)]
    nb = A.next_bills(lg, building=1).collect()
    assert [(r.issue_date, r.due1, r.due2, r.total) for r in nb] == [
        (d(2025, 4, 7), d(2025, 4, 10), d(2025, 4, 22), D("0.00"))]
    disp = A.dispatches(lg, A.next_bills(lg, building=1)).collect()
    names = dict(lg.person.select("id_person", "first_name").collect())
    assert sorted((names[r.id_person], r.channel, r.note) for r in disp) == [
        ("Jose", "EMAIL", "Propietario"), ("Lucia", "EMAIL", "Inquilino")]
