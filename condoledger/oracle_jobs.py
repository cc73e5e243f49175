"""DuckDB oracle SQL for calendar queries, building blocks and ledger jobs J1, J5–J8, R11."""

from __future__ import annotations

from .oracle import AS_OF, accounts_sql, interest_sql, with_ledger, ym
from .oracle_clean import RAW_EXPENSES
from .sources.rawtext import EXPENSE_CATEGORIES


def k_cal_sql(name: str) -> str:
    if name == "k10_business_days":
        return with_ledger(select="SELECT cal_date, is_weekday, is_holiday, is_business FROM cal")
    if name == "k11_next_business_day":
        return with_ledger(select="SELECT cal_date, next_business_day FROM cal")
    if name == "k12_nth_business_day":
        return with_ledger(select="SELECT month_start, issue_date AS nth_day FROM nth5")
    if name == "k13_fifth_weekday":
        return with_ledger(select="""
SELECT month_start, cal_date AS nth_day FROM (
  SELECT month_start, cal_date, row_number() OVER (PARTITION BY month_start ORDER BY cal_date) AS rn
  FROM cal WHERE is_weekday) WHERE rn = 5""")
    raise KeyError(name)


def d7_sql() -> str:
    return with_ledger(select="""
SELECT m.id_building, m.m_start, count(*) AS payments, CAST(sum(p.amount) AS DECIMAL(18,2)) AS amount
FROM (SELECT DISTINCT id_building, month_start AS m_start FROM bill) m
JOIN payment p ON p.id_building = m.id_building AND p.pay_date BETWEEN m.m_start AND last_day(m.m_start)
GROUP BY m.id_building, m.m_start""")


BOM = """
bom AS (SELECT id_building, b_month, id_bill AS bill_match FROM (
          SELECT id_bill, id_building, CAST(date_trunc('month', issue_date) AS DATE) AS b_month,
                 row_number() OVER (PARTITION BY id_building, date_trunc('month', issue_date)
                                    ORDER BY issue_date DESC, id_bill DESC) AS rn FROM bill) WHERE rn = 1)"""


def d8_sql() -> str:
    return with_ledger(BOM, select="""
SELECT p.id_payment, p.pay_date, b.bill_match AS id_bill_of_month FROM payment p
LEFT JOIN bom b ON b.id_building = p.id_building AND b.b_month = CAST(date_trunc('month', p.pay_date) AS DATE)""")


def d9_sql() -> str:
    parts = [f"""SELECT "Nombre del consorcio" AS building, anio, "Mes", '{c}' AS category, "{c}" AS amount_txt
FROM raw_expenses""" for c in EXPENSE_CATEGORIES]
    return with_ledger(RAW_EXPENSES, select="\nUNION ALL\n".join(parts))


def f1_sql() -> str:
    return with_ledger(accounts_sql(), select="""
SELECT row_number() OVER (ORDER BY a.id_building, b.issue_date, a.id_bill, a.id_unit) AS row_id, a.id_account
FROM account a JOIN bill b ON b.id_bill = a.id_bill""")


CHANGES = """
ins AS (SELECT * FROM payment WHERE pay_date BETWEEN DATE '2001-06-01' AND DATE '2001-06-30'),
del AS (SELECT * FROM payment WHERE pay_date BETWEEN DATE '2001-05-25' AND DATE '2001-06-05'),
chg AS (SELECT id_account FROM ins WHERE id_account IS NOT NULL
        UNION SELECT id_account FROM del WHERE id_account IS NOT NULL)"""


def h1_sql() -> str:
    return with_ledger(CHANGES, select="SELECT id_account FROM chg")


def j5_sql(changes: str = CHANGES, paid_from: str = "payment") -> str:
    return with_ledger(accounts_sql(), changes, f"""
tp AS (SELECT id_account, CAST(sum(amount) AS DECIMAL(18,2)) AS paid_sum, max(pay_date) AS last_pay
       FROM {paid_from} WHERE id_account IN (SELECT id_account FROM chg) GROUP BY id_account),
r AS (SELECT a.id_account, a.id_unit, a.id_building, a.id_bill, a.acct_date, a.prev_balance, a.ord_amount, a.ext_amount,
             b.due1, b.due2, tp.paid_sum, tp.last_pay, coalesce(a.ord_amount, 0) + coalesce(a.ext_amount, 0) AS base
      FROM account a JOIN bill b ON b.id_bill = a.id_bill LEFT JOIN tp ON tp.id_account = a.id_account
      WHERE a.id_account IN (SELECT id_account FROM chg))""", select=f"""
SELECT id_account, id_unit, id_building, id_bill, acct_date, prev_balance, ord_amount, ext_amount,
       CAST(coalesce(paid_sum, 0) AS DECIMAL(18,2)) AS paid,
       CAST(CASE WHEN base <= coalesce(paid_sum, 0) THEN 0 ELSE base - coalesce(paid_sum, 0) END AS DECIMAL(18,2)) AS debt,
       {interest_sql('M3')} AS interest,
       CAST(CAST(CASE WHEN base <= coalesce(paid_sum, 0) THEN 0 ELSE base - coalesce(paid_sum, 0) END AS DECIMAL(18,2))
            + {interest_sql('M3')} AS DECIMAL(18,2)) AS total_due
FROM r""")


def j1_sql(year: int = 2001, known_before: str = "DATE '2001-04-01'") -> str:
    return with_ledger(accounts_sql(), f"""
known AS (SELECT a.id_unit, a.id_bill FROM account a JOIN bill b ON b.id_bill = a.id_bill
          WHERE b.issue_date < {known_before})""", select=f"""
SELECT u.id_unit * 1000000 + {ym('b.month_start')} AS id_account, u.id_unit, u.id_building, b.id_bill,
       coalesce(b.due1, b.issue_date) AS acct_date
FROM unit u JOIN bill b ON b.id_building = u.id_building
WHERE b.issue_date >= DATE '{year}-01-01' AND b.issue_date < DATE '{year + 1}-01-01'
  AND NOT EXISTS (SELECT 1 FROM known k WHERE k.id_unit = u.id_unit AND k.id_bill = b.id_bill)""")


J6 = f"""
lastp AS (SELECT id_building, max(pay_date) AS last_pay FROM payment GROUP BY id_building),
j6b AS (SELECT bd.id_building, CAST(date_trunc('month', coalesce(l.last_pay, {AS_OF}) + INTERVAL 1 MONTH) AS DATE)
               AS month_start
        FROM building bd LEFT JOIN lastp l ON l.id_building = bd.id_building),
j6f AS (SELECT j.id_building, j.month_start, m.issue_date AS gen, m.due1 AS v1, m.due2 AS v2
        FROM j6b j LEFT JOIN months m ON m.month_start = j.month_start),
j6 AS (SELECT id_building * 1000000 + {ym('month_start')} AS id_bill, id_building, gen AS issue_date,
              CASE WHEN v1 IS NULL OR v1 < gen THEN gen ELSE v1 END AS due1,
              CASE WHEN v2 IS NULL THEN NULL WHEN v1 IS NOT NULL AND v2 < v1 THEN v1 WHEN v2 < gen THEN gen ELSE v2 END
                AS due2,
              CAST(0 AS DECIMAL(18,2)) AS total
       FROM j6f f WHERE NOT EXISTS (SELECT 1 FROM bill e WHERE e.id_building = f.id_building AND e.issue_date = f.gen))"""


def j6_sql() -> str:
    return with_ledger(J6, select="SELECT * FROM j6")


_J7 = """
SELECT o.id_building, t.id_bill, o.id_person,
       CASE WHEN nullif(trim(p.email), '') IS NOT NULL THEN 'EMAIL'
            WHEN nullif(trim(p.phone), '') IS NOT NULL THEN 'WHATSAPP' ELSE 'IMPRESO' END AS channel,
       nullif(trim(p.email), '') AS email, nullif(trim(p.phone), '') AS phone,
       CASE WHEN o.is_tenant THEN 'Inquilino' ELSE 'Propietario' END AS note
FROM j6 t JOIN occupancy o ON o.id_building = t.id_building JOIN person p ON p.id_person = o.id_person"""


def j7_sql() -> str:
    return with_ledger(J6, select=_J7)


def j7_register_sql() -> str:
    return with_ledger(J6, f"j7 AS ({_J7})", select="""
SELECT row_number() OVER (ORDER BY id_building, id_bill, id_person) AS id_dispatch, * FROM j7""")


def r11_dispatches_sql(n: int = 50) -> str:
    return j7_register_sql() + f" ORDER BY id_dispatch DESC LIMIT {n}"


def j6_other_days_sql(day: int) -> str:
    return with_ledger(J6, select=f"""
SELECT id_bill, id_building, issue_date, greatest(c.next_business_day, issue_date) AS due1, CAST(NULL AS DATE) AS due2, total
FROM j6 JOIN cal c ON c.cal_date = date_trunc('month', issue_date) + INTERVAL {day - 1} DAY""")


def j8_sql() -> str:
    return with_ledger(select="""
SELECT b.id_bill, b.id_building, b.issue_date, CAST(coalesce(s.s, 0) AS DECIMAL(18,2)) AS total
FROM bill b LEFT JOIN (SELECT id_bill, sum(amount) AS s FROM expense GROUP BY id_bill) s ON s.id_bill = b.id_bill""")


def r11_sql(n: int = 50) -> str:
    return with_ledger(J6, select=f"""
SELECT id_building, id_bill, issue_date, due1, due2 FROM (
  SELECT id_building, id_bill, issue_date, due1, due2 FROM bill UNION ALL
  SELECT id_building, id_bill, issue_date, due1, due2 FROM j6)
ORDER BY issue_date DESC, id_bill DESC LIMIT {n}""")


STREAMED = """
sp AS (SELECT * FROM payment),
chg AS (SELECT DISTINCT id_account FROM sp)"""


def s1_sql() -> str:
    return j5_sql(STREAMED, "sp")


def s2_sql() -> str:
    from .oracle_ingest import _l7_ctes
    return with_ledger(*_l7_ctes(), select="SELECT * FROM ok0")


def s3_sql() -> str:
    from .oracle_ingest import l8_sql
    return f"SELECT fx_type, arg_max(sell, quote_ts) AS quote FROM ({l8_sql('quotes')}) GROUP BY fx_type"


def s4_sql() -> str:
    return with_ledger(select="""
SELECT CAST(date_trunc('week', pay_date + 1) AS DATE) AS week_start, CAST(sum(amount) AS DECIMAL(18,2)) AS total,
       count(*) AS payments
FROM payment GROUP BY 1""")
