"""DuckDB oracle SQL of L10: the same steps over the same files, each as a
query in whose scope the ledger's table names stand for the state before it."""

from __future__ import annotations

from .oracle import accounts_sql, interest_sql, with_ledger
from .oracle_clean import FILE_BASE, RAW_AREA_ROWS, RAW_BUILDINGS, RAW_EXPENSES, RAW_PAY, RAW_PEOPLE, RAW_UNIT_ROWS
from .oracle_expenses import RAW_SUPPLIERS, RAW_WORKS, l2_ctes, l3_ctes, l9_ctes
from .oracle_ingest import A_STG, B_STG, P_STG, l4_steps, l5_steps, l7_steps, u_staged

# totals that the account rules read, over the tables in scope
TOTALS = """
exp_tot AS (
  SELECT id_bill, CAST(sum(CASE WHEN kind = 'Ordinario' THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS tot_ord,
         CAST(sum(CASE WHEN kind = 'Extraordinario' THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS tot_ext FROM expense GROUP BY id_bill),
share_sum AS (SELECT id_building, sum(CAST(share AS DECIMAL(18,6))) AS sum_share FROM unit GROUP BY id_building),
pay_tot AS (SELECT id_account, CAST(sum(amount) AS DECIMAL(18,2)) AS paid_sum, max(pay_date) AS last_pay FROM payment GROUP BY id_account)"""

EMPTY = """
z_building AS (SELECT id_building, name, address, CAST(total_area AS DECIMAL(10,2)) AS total_area FROM building WHERE false),
z_unit AS (SELECT id_unit, id_building, floor, dept, area, storage_m2, garage_m2, share, cbu FROM unit WHERE false),
z_person AS (SELECT * FROM person WHERE false), z_occupancy AS (SELECT * FROM occupancy WHERE false),
z_bill AS (SELECT * FROM bill WHERE false),
z_expense AS (SELECT id_expense, id_bill, id_building, kind, description, issue_date, CAST(amount AS DECIMAL(28,2)) AS amount FROM expense WHERE false),
z_ordinary AS (SELECT id_expense, supplier, category, supplier AS invoice FROM expense WHERE false),
z_extraordinary AS (SELECT id_expense, 1::BIGINT AS instalment, 1::BIGINT AS instalments FROM expense WHERE false),
z_payment AS (SELECT id_bill AS id_payment, id_account, id_unit, id_building, id_bill, pay_date, CAST(amount AS DECIMAL(12,2)) AS amount, cbu
              FROM payment WHERE false)"""


class Chain:
    """CTEs of the steps so far, and the name of each table's current state."""

    def __init__(self):
        self.ctes: list[str] = [EMPTY]
        self.now = {t: f"z_{t}" for t in ("building", "unit", "person", "occupancy", "bill", "expense", "ordinary", "extraordinary", "payment")}

    def step(self, tag: str, ctes: list[str], outputs: dict[str, str]) -> None:
        """One step: ``outputs`` are tables as selects over ``ctes`` and the state."""
        scope = ",\n".join([*(f"{t} AS (SELECT * FROM {name})" for t, name in self.now.items()), *(c.strip() for c in ctes)])
        for table, select in outputs.items():
            self.ctes.append(f"{tag}_{table} AS (WITH {scope}\n{select})")
        self.now.update({t: f"{tag}_{t}" for t in outputs if t != "reject"})


def _plus(table: str, new: str) -> str:
    return f"SELECT * FROM {table} UNION ALL BY NAME {new}"


def chain() -> Chain:
    c = Chain()
    c.step("s1", [B_STG], {"building": "SELECT * FROM b_prior UNION ALL SELECT * FROM b_new"})
    c.step("s2", l2_ctes(), {"bill": "SELECT * EXCLUDE (action) FROM l2_bill", "expense": _plus("expense", "SELECT * FROM l2_exp"),
                             "ordinary": _plus("ordinary", "SELECT * FROM l2_ord")})
    c.step("s3", [u_staged("SELECT * FROM unit"), *l4_steps()], {
        "building": "SELECT * EXCLUDE (action) FROM u_bld",
        "unit": """SELECT id_unit, l4.id_building, l4.floor, l4.dept, area, storage_m2, garage_m2, share, l4.cbu
                   FROM l4 LEFT JOIN unit USING (id_unit)""",
        "reject": """SELECT reason, CAST(unit AS VARCHAR) AS field1,
                            coalesce(building_name, '') || '|' || coalesce(CAST(floor AS VARCHAR), '') || '|' || coalesce(dept, '') AS field2,
                            cbu AS field3, 'units.txt' AS file FROM l4_rej"""})
    c.step("s4", [A_STG, *l5_steps("SELECT id_unit, id_building, floor, dept, share, area, storage_m2, garage_m2 FROM unit")], {
        "building": "SELECT * EXCLUDE (action) FROM a_bld",
        "unit": "SELECT l5.* EXCLUDE (action), cbu FROM l5 LEFT JOIN (SELECT id_unit, cbu FROM unit) USING (id_unit)"})
    c.step("s5", [P_STG, """
links AS (SELECT pa.id_person, u.id_building, bool_or(s.is_tenant = 1) AS is_tenant
          FROM p_stg s JOIN p_all pa ON pa.cbu = s.cbu JOIN unit u ON u.cbu = s.cbu GROUP BY ALL)"""],
           {"person": "SELECT * EXCLUDE (action) FROM p_all", "occupancy": "SELECT * FROM links"})
    c.step("s6", l3_ctes(), {"building": "SELECT * EXCLUDE (action) FROM x_bld", "bill": "SELECT * EXCLUDE (action) FROM mrg2",
                             "expense": _plus("expense", "SELECT * FROM x_new"),
                             "ordinary": _plus("ordinary", "SELECT id_expense, NULL AS supplier, description AS category, NULL AS invoice FROM x_new")})
    c.step("s7", [TOTALS, accounts_sql()], {"account": "SELECT * FROM account"})
    # Every bill with a date has its accounts after J2, unless its total is 0
    c.step("s8", [], {"account": """
SELECT * FROM account UNION ALL BY NAME
SELECT u.id_unit * 1000000 + year(b.month_start) * 100 + month(b.month_start) AS id_account, u.id_unit, u.id_building, b.id_bill,
       coalesce(b.due1, b.issue_date) AS acct_date
FROM unit u JOIN bill b ON b.id_building = u.id_building
WHERE b.issue_date <> DATE '1900-01-01' AND NOT EXISTS (SELECT 1 FROM account k WHERE k.id_unit = u.id_unit AND k.id_bill = b.id_bill)"""})
    ok, rejects = l7_steps()
    order = "pay_date, id_unit, id_bill, amount, cbu, id_account"
    c.step("s9", ok, {"payment": _plus("payment", f"""
SELECT coalesce((SELECT max(id_payment) FROM payment), 0) + row_number() OVER (ORDER BY {order}) AS id_payment,
       id_account, id_unit, id_building, id_bill, pay_date, amount, cbu FROM ok WHERE action = 'INSERT'"""),
                      "reject": f"SELECT reason, date_txt AS field1, cbu_txt AS field2, amount_txt AS field3, 'payments.csv' AS file FROM ({rejects})"})
    c.step("s10", l9_ctes(), {"building": "SELECT * EXCLUDE (action) FROM w_bld", "bill": "SELECT * EXCLUDE (action) FROM w_bill2",
                              "expense": _plus("expense", "SELECT * FROM w_new"), "extraordinary": _plus("extraordinary", "SELECT * FROM w_ext")})
    c.step("s11", [TOTALS, """
r AS (SELECT a.*, b.due1, b.due2, tp.paid_sum, tp.last_pay, coalesce(a.ord_amount, 0) + coalesce(a.ext_amount, 0) AS base
      FROM account a JOIN bill b ON b.id_bill = a.id_bill LEFT JOIN pay_tot tp ON tp.id_account = a.id_account),
d AS (SELECT *, CAST(CASE WHEN base <= coalesce(paid_sum, 0) THEN 0 ELSE base - coalesce(paid_sum, 0) END AS DECIMAL(18,2)) AS new_debt FROM r)"""],
           {"account": f"""
SELECT id_account, id_unit, id_building, id_bill, acct_date, prev_balance, ord_amount, ext_amount,
       CAST(coalesce(paid_sum, 0) AS DECIMAL(18,2)) AS paid, new_debt AS debt, {interest_sql('M2')} AS interest,
       CAST(new_debt + {interest_sql('M2')} AS DECIMAL(18,2)) AS total_due FROM d"""})
    return c


RAW = [FILE_BASE, RAW_BUILDINGS, RAW_SUPPLIERS, RAW_UNIT_ROWS, RAW_AREA_ROWS, RAW_PEOPLE, RAW_EXPENSES, RAW_PAY, RAW_WORKS]


def l10_sql(which: str) -> str:
    c = chain()
    select = {
        "expense": f"""SELECT e.*, o.supplier, o.category, x.instalment, x.instalments FROM {c.now['expense']} e
                       LEFT JOIN {c.now['ordinary']} o USING (id_expense) LEFT JOIN {c.now['extraordinary']} x USING (id_expense)""",
        "reject": "SELECT * FROM s3_reject UNION ALL SELECT * FROM s9_reject",
        "log": "\nUNION ALL\n".join(_log_rows()),
    }.get(which) or f"SELECT * FROM {c.now[which]}"
    return with_ledger(*RAW, *c.ctes, select=select)


def _log_rows() -> list[str]:
    """The run log from the tables after each step and their state before it."""
    from .plans.load_run import DONE, INFO, REJECTED, STEPS, WARN
    before = {t: f"z_{t}" for t in ("building", "unit", "person", "occupancy", "bill", "expense", "ordinary", "extraordinary", "payment")}
    key = {"occupancy": "id_person, id_building"}
    wrote = [["building"], ["bill", "+expense", "+ordinary"], ["building", "unit"], ["building", "unit"], ["person", "occupancy"],
             ["building", "bill", "+expense", "+ordinary", "+extraordinary"], ["*account"], ["+account"], ["+payment"],
             ["building", "bill", "+expense", "+ordinary", "+extraordinary"], ["*account"]]
    out = []
    for n, ((proc, source, _), tables) in enumerate(zip(STEPS, wrote), 1):
        src = f"'{source}'" if source else "CAST(NULL AS VARCHAR)"

        def row(level, message, detail):
            out.append(f"SELECT {n}::BIGINT AS step_no, '{proc}' AS proc, '{level}' AS level, '{message}' AS message, {detail} AS detail, {src} AS source")
        for t in tables:
            name, after = t.lstrip("+*"), f"s{n}_{t.lstrip('+*')}"
            if t == "+extraordinary" and n == 6:
                after = "z_extraordinary"
            if t in ("+ordinary",) and n == 10:
                after = before["ordinary"]
            old, k = before.get(name), key.get(name, f"id_{name}")
            if t[0] == "+":
                rows = inserted = f"(SELECT count(*) FROM {after}) - (SELECT count(*) FROM {old})"
                updated = "0"
            elif t[0] == "*":
                rows = inserted = f"(SELECT count(*) FROM {after})"
                updated = "0"
            else:
                rows = f"(SELECT count(*) FROM {after})"
                inserted = f"{rows} - (SELECT count(*) FROM {old})"
                updated = f"(SELECT count(*) FROM ((SELECT * FROM {old} EXCEPT SELECT * FROM {after})))"
            row(INFO, DONE, f"'{name}: rows=' || {rows} || '; inserted=' || ({inserted}) || '; updated=' || {updated}")
            before[name] = after
        if n in (3, 9):
            row(WARN, REJECTED, f"'rejects=' || (SELECT count(*) FROM s{n}_reject)")
    return out
