"""DuckDB oracle SQL for the quality jobs Q1–Q10 and the decrypted views."""

from __future__ import annotations

from .oracle import accounts_sql, with_ledger


def _v(tbl: str, rule: str, cond: str) -> str:
    return (f"SELECT '{tbl}' AS tbl, '{rule}' AS rule, "
            f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM {tbl}")


def _digits(c: str) -> str:
    return f"{c} IS NOT NULL AND NOT regexp_matches({c}, '^[0-9]*$')"


def q1_sql() -> str:
    rules = [
        ("person", "dni_range", "NOT (dni > 0 AND dni < 100000000)"), ("person", "cbu_digits", _digits("cbu")),
        ("building", "total_area_positive", "total_area <= 0"),
        ("unit", "area_non_negative", "area < 0"), ("unit", "storage_non_negative", "storage_m2 < 0"),
        ("unit", "garage_non_negative", "garage_m2 < 0"), ("unit", "share_range", "share <= 0 OR share > 100"),
        ("unit", "cbu_digits", _digits("cbu")),
        ("bill", "due1_after_issue", "due1 < issue_date"), ("bill", "due2_after_due1", "due2 < due1"),
        ("bill", "total_non_negative", "total < 0"),
        ("expense", "kind_enum", "NOT kind IN ('Ordinario', 'Extraordinario')"),
        ("expense", "amount_non_negative", "amount < 0"),
        ("account", "interest_non_negative", "interest < 0"),
        ("payment", "amount_positive", "amount <= 0"), ("payment", "cbu_digits", _digits("cbu")),
    ]
    return with_ledger(accounts_sql(), select="\nUNION ALL\n".join(_v(*r) for r in rules))


def q2_sql() -> str:
    def d(tbl, key, cols, where=""):
        w = f"WHERE {where}" if where else ""
        return (f"SELECT '{tbl}' AS tbl, '{key}' AS key, count(*) AS duplicate_keys FROM "
                f"(SELECT {cols} FROM {tbl} {w} GROUP BY {cols} HAVING count(*) > 1)")
    parts = [d("unit", "cbu", "cbu", "cbu IS NOT NULL"), d("unit", "id_unit", "id_unit"),
             d("person", "id_person", "id_person"), d("occupancy", "id_person", "id_person"),
             d("bill", "issue_date+building", "issue_date, id_building"), d("bill", "id_bill", "id_bill"),
             d("expense", "id_expense", "id_expense"), d("account", "id_account", "id_account"),
             d("payment", "id_payment", "id_payment"), d("fx_quote", "quote_ts+fx_type", "quote_ts, fx_type")]
    return with_ledger(accounts_sql(), select="\nUNION ALL\n".join(parts))


def q3_sql() -> str:
    def o(fk, child, ck, parent, pk):
        return (f"SELECT '{fk}' AS fk, count(*) AS orphans FROM {child} c WHERE c.{ck} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{ck})")
    parts = [o("unit.building", "unit", "id_building", "building", "id_building"),
             o("occupancy.person", "occupancy", "id_person", "person", "id_person"),
             o("occupancy.building", "occupancy", "id_building", "building", "id_building"),
             o("bill.building", "bill", "id_building", "building", "id_building"),
             o("expense.bill", "expense", "id_bill", "bill", "id_bill"),
             o("account.unit", "account", "id_unit", "unit", "id_unit"),
             o("account.bill", "account", "id_bill", "bill", "id_bill"),
             o("payment.account", "payment", "id_account", "account", "id_account"),
             o("payment.bill", "payment", "id_bill", "bill", "id_bill")]
    return with_ledger(accounts_sql(), select="\nUNION ALL\n".join(parts))


def q4_sql() -> str:
    return with_ledger(select="""
SELECT b.id_building, b.name, max(CASE WHEN u.storage_m2 > 0 THEN 1 ELSE 0 END) AS has_storage,
       max(CASE WHEN u.garage_m2 > 0 THEN 1 ELSE 0 END) AS has_garage
FROM building b JOIN unit u ON u.id_building = b.id_building GROUP BY b.id_building, b.name""")


def q5_sql() -> str:
    return with_ledger(select="""
SELECT b.id_building, b.name, count(*) AS units, count(*) >= 10 AS at_least_10
FROM building b JOIN unit u ON u.id_building = b.id_building GROUP BY b.id_building, b.name""")


def q6_sql(year: int = 2000) -> str:
    return with_ledger(select=f"""
SELECT b.id_bill, b.id_building, b.issue_date, b.due1, b.due2, b.total, e.first_extra, e.n_extra
FROM bill b JOIN (SELECT id_bill, min(issue_date) AS first_extra, count(*) AS n_extra FROM expense
                  WHERE kind = 'Extraordinario' GROUP BY id_bill) e ON e.id_bill = b.id_bill
WHERE b.issue_date >= DATE '{year}-01-01' AND b.issue_date < DATE '{year + 1}-01-01'""")


def q7_sql() -> str:
    return with_ledger(accounts_sql(), select="SELECT id_bill, count(*) AS accounts FROM account GROUP BY id_bill")


def q8_sql() -> str:
    return with_ledger(accounts_sql(), """
lp AS (SELECT id_account, max(pay_date) AS last_pay FROM payment GROUP BY id_account),
q AS (SELECT a.*, b.due1, b.due2, lp.last_pay, u.floor, u.dept, u.share,
             CAST(CASE WHEN lp.last_pay IS NULL OR lp.last_pay <= b.due1 THEN 0
                  WHEN lp.last_pay > b.due1 AND (b.due2 IS NULL OR lp.last_pay <= b.due2) THEN round(0.02 * a.debt, 2)
                  WHEN b.due2 IS NOT NULL AND lp.last_pay > b.due2 THEN round(0.05 * a.debt, 2) END AS DECIMAL(18,2))
               AS expected
      FROM account a JOIN bill b ON b.id_bill = a.id_bill LEFT JOIN lp ON lp.id_account = a.id_account
      JOIN unit u ON u.id_unit = a.id_unit)""", select="""
SELECT id_account, floor, dept, share, id_bill, due1, due2, last_pay, CAST(ord_amount + ext_amount AS DECIMAL(18,2)) AS base,
       paid, debt, interest,
       CASE WHEN last_pay IS NULL THEN 'Sin pago' WHEN last_pay <= due1 THEN '0% (En término)'
            WHEN last_pay > due1 AND (due2 IS NULL OR last_pay <= due2) THEN '2% (Entre vtos)'
            WHEN due2 IS NOT NULL AND last_pay > due2 THEN '5% (Después 2do vto)' END AS category,
       expected, CASE WHEN interest = expected THEN 'OK' ELSE 'ERROR' END AS validation
FROM q""")


def q10_sql(n: int = 5) -> str:
    return with_ledger(accounts_sql(), f"""
bd AS (SELECT id_building, sum(debt) AS d FROM account GROUP BY id_building),
per AS (SELECT o.id_person, CAST(sum(bd.d) AS DECIMAL(18,2)) AS debt_total FROM occupancy o
        JOIN bd ON bd.id_building = o.id_building WHERE NOT o.is_tenant GROUP BY o.id_person),
top AS (SELECT * FROM per ORDER BY debt_total DESC, id_person LIMIT {n})""", select="""
SELECT t.id_person, t.debt_total, p.last_name, p.first_name, p.dni, p.email, p.phone
FROM top t JOIN person p ON p.id_person = t.id_person""")


def person_plain_sql() -> str:
    return with_ledger(select="""
SELECT id_person, first_name, last_name, CAST(dni AS VARCHAR) AS dni, email, phone FROM person""")


def person_cipher_roundtrip_sql() -> str:
    return with_ledger(select="SELECT id_person, CAST(dni AS VARCHAR) AS dni, email, phone, cbu FROM person")


def k14_sql() -> str:
    return with_ledger(select="SELECT id_person, email FROM person")


def q9_sql() -> str:
    return with_ledger(select="SELECT id_payment, pay_date, amount, id_bill, id_building, cbu FROM payment")


def j10_sql() -> str:
    from .oracle_clean import RAW_PEOPLE
    from .oracle_ingest import P_STG
    return with_ledger(RAW_PEOPLE, P_STG, select="""
SELECT id_person, action, CAST(dni AS VARCHAR) AS dni, email, phone, cbu FROM p_all""")


def j9_counts_sql() -> str:
    """What J9 writes and keeps on people of the kinds id % 6 = 0..5 (see plans/secure.py), and on its own result."""
    parts = []
    for c in ("dni", "email", "phone", "cbu"):
        parts.append(f"""
SELECT 1::BIGINT AS run, '{c}' AS col_name, count(*) FILTER (id_person % 6 >= 2 AND {c} IS NOT NULL) AS written,
       count(*) FILTER (id_person % 6 < 2 AND {c} IS NOT NULL) AS kept, count(*) FILTER ({c} IS NULL) AS empty FROM person
UNION ALL SELECT 2, '{c}', 0, count({c}), count(*) FILTER ({c} IS NULL) FROM person""")
    return with_ledger(select="\nUNION ALL".join(parts))
