"""DuckDB oracle SQL for the ingestion jobs."""

from __future__ import annotations

from .oracle import accounts_sql, with_ledger
from .oracle_clean import (K3_RESULT, NB, RAW_AREAS, RAW_BUILDINGS, RAW_PAY, RAW_PEOPLE, RAW_UNITS, k1, k2,
                           k3_ctes, k6b, k7, k7b, k16_dept, k16_floor, k17, k18, k19, trim_sp)
from .plans import unit_loads as UL
from .plans.ingest import (REASON_BLANK, REASON_NO_ACCOUNT, REASON_NO_BILL, REASON_NO_BUILDING, REASON_NO_UNIT,
                           REASON_PARSE)


def _l7_ctes() -> list[str]:
    return [accounts_sql(), RAW_PAY, f"""
n AS (SELECT {trim_sp('c1')} AS c1, {trim_sp('c2')} AS c2, {trim_sp('c3')} AS c3, {trim_sp('c4')} AS c4 FROM raw_pay),
n2 AS (SELECT *, nullif(c4, '') IS NULL AS blank FROM n)""", k3_ctes("n2", "c4", "c1, c2, c3, blank"), f"""
p AS (SELECT c1, c2, c3, raw AS c4, blank, TRY_CAST({K3_RESULT} AS DECIMAL(12,2)) AS amount,
             {k19('c2')} AS pay_date, {k7b('c3')} AS cbu FROM k3e),
p2 AS (SELECT *, coalesce(pay_date IS NOT NULL AND amount IS NOT NULL AND cbu IS NOT NULL
                          AND cbu <> repeat('0', 22), false) AS valid FROM p),
units AS (SELECT right(repeat('0', 22) || regexp_replace(upper({trim_sp('cbu')}), '[{NB}\t \\-]', '', 'g'), 22) AS ucbu,
                 id_unit, id_building FROM unit),
bom AS (SELECT id_building, b_month, id_bill AS bill_match FROM (
          SELECT id_bill, id_building, CAST(date_trunc('month', issue_date) AS DATE) AS b_month,
                 row_number() OVER (PARTITION BY id_building, date_trunc('month', issue_date)
                                    ORDER BY issue_date DESC, id_bill DESC) AS rn FROM bill) WHERE rn = 1),
m AS (
  SELECT p2.pay_date, p2.amount, p2.cbu, u.id_unit, u.id_building, b.bill_match AS id_bill, a.id_account
  FROM p2 LEFT JOIN units u ON u.ucbu = p2.cbu
  LEFT JOIN bom b ON b.id_building = u.id_building AND b.b_month = CAST(date_trunc('month', p2.pay_date) AS DATE)
  LEFT JOIN account a ON a.id_unit = u.id_unit AND a.id_building = u.id_building AND a.id_bill = b.bill_match
  WHERE NOT p2.blank AND p2.valid),
m2 AS (SELECT *, CASE WHEN id_unit IS NULL THEN '{REASON_NO_UNIT}' WHEN id_building IS NULL THEN '{REASON_NO_BUILDING}'
                      WHEN id_bill IS NULL THEN '{REASON_NO_BILL}' WHEN id_account IS NULL THEN '{REASON_NO_ACCOUNT}'
                 END AS reason FROM m),
ok0 AS (SELECT DISTINCT id_account, id_unit, id_building, id_bill, pay_date, CAST(amount AS DECIMAL(12,2)) AS amount, cbu
        FROM m2 WHERE reason IS NULL),
known AS (SELECT DISTINCT id_account, id_unit, id_building, id_bill, pay_date, CAST(amount AS DECIMAL(12,2)) AS amount,
                 cbu, true AS k FROM payment),
ok AS (SELECT o.*, CASE WHEN k.k THEN 'KEEP' ELSE 'INSERT' END AS action FROM ok0 o LEFT JOIN known k
       ON k.id_account = o.id_account AND k.id_unit = o.id_unit AND k.id_building = o.id_building
      AND k.id_bill = o.id_bill AND k.pay_date = o.pay_date AND k.amount = o.amount AND k.cbu = o.cbu)"""]


def l7_ok_sql() -> str:
    return with_ledger(*_l7_ctes(), select="SELECT * FROM ok")


_L7_REJECTS = f"""
SELECT CASE WHEN blank THEN '{REASON_BLANK}' ELSE '{REASON_PARSE}' END AS reason,
       nullif(c2, '') AS date_txt, nullif(c3, '') AS cbu_txt, nullif(c4, '') AS amount_txt
FROM p2 WHERE blank OR NOT valid
UNION ALL
SELECT reason, strftime(pay_date, '%Y-%m-%d') AS date_txt, cbu AS cbu_txt, CAST(amount AS VARCHAR) AS amount_txt
FROM m2 WHERE reason IS NOT NULL"""


def l7_rejects_sql() -> str:
    return with_ledger(*_l7_ctes(), select=_L7_REJECTS)


def l7_steps() -> tuple[list[str], str]:
    """(CTEs of L7 over raw_pay and the tables unit, bill, account, payment, ending in ok; its rejects)."""
    return _l7_ctes()[2:], _L7_REJECTS


def l7_summary_sql() -> str:
    return with_ledger(*_l7_ctes(), select="""
SELECT (SELECT count(*) FROM p2) AS raw, (SELECT count(*) FROM p2 WHERE NOT blank) AS norm,
       (SELECT count(*) FROM p2 WHERE NOT blank AND valid) AS valid,
       (SELECT count(*) FROM p2 WHERE NOT blank AND NOT valid) AS parse_err,
       (SELECT count(*) FROM p2 WHERE blank) AS blank,
       (SELECT count(*) FROM m2 WHERE reason IS NOT NULL) AS match_err,
       (SELECT count(*) FROM ok) AS ok, (SELECT count(*) FROM ok WHERE action = 'INSERT') AS inserted""")


# ------------------------------------------------------------ loaders

B_STG = f"""
b_stg AS (SELECT {k1('nombre', 50)} AS name, {k1('domicilio', 100)} AS address, {k2('m2_totales')} AS total_area
          FROM raw_buildings WHERE {k1('nombre', 50)} IS NOT NULL),
b_prior AS (SELECT id_building, name, address, total_area FROM building WHERE id_building < 20),
b_new0 AS (SELECT s.* FROM b_stg s WHERE NOT EXISTS (
             SELECT 1 FROM b_prior t WHERE lower(t.name) = lower(s.name)
               AND lower(coalesce(t.address, '')) = lower(coalesce(s.address, '')))),
b_new AS (SELECT coalesce((SELECT max(id_building) FROM b_prior), 0) + row_number() OVER (ORDER BY name) AS id_building,
                 name, address, total_area FROM b_new0)"""


def l1_sql() -> str:
    return with_ledger(RAW_BUILDINGS, B_STG, select="""
SELECT id_building, name, address, total_area, 'KEEP' AS action FROM b_prior
UNION ALL SELECT id_building, name, address, total_area, 'INSERT' AS action FROM b_new""")


def u4_sql() -> str:
    return with_ledger(RAW_BUILDINGS, B_STG, select="SELECT name, address, total_area FROM b_new0")


def u10_sql() -> str:
    return with_ledger(RAW_BUILDINGS, B_STG, select="SELECT name, address, total_area, id_building FROM b_new")


def u8_sql() -> str:
    return with_ledger(RAW_BUILDINGS, B_STG, """
prior AS (SELECT id_building, name, CASE WHEN id_building % 3 = 0 THEN NULL ELSE address END AS address,
                 CASE WHEN id_building % 4 = 0 THEN NULL ELSE total_area END AS total_area FROM building)""",
                       select="""
SELECT t.id_building, t.name, coalesce(t.address, s.address) AS address, coalesce(t.total_area, s.total_area) AS total_area,
       CASE WHEN (t.address IS NULL AND s.address IS NOT NULL) OR (t.total_area IS NULL AND s.total_area IS NOT NULL)
            THEN 'UPDATE' ELSE 'KEEP' END AS action
FROM prior t LEFT JOIN b_stg s ON lower(s.name) = lower(t.name)""")


# names equal without regard to case, accents and trailing blanks
def nk(x: str) -> str:
    return f"strip_accents(lower(rtrim({x})))"


def ensured(staged: str, out: str) -> str:
    return f"""
{out}_new AS (SELECT min(building_name) AS name FROM {staged} WHERE building_name IS NOT NULL AND NOT EXISTS (
                SELECT 1 FROM building b WHERE {nk('b.name')} = {nk('building_name')}) GROUP BY {nk('building_name')}),
{out} AS (SELECT id_building, name, address, total_area, 'KEEP' AS action FROM building
          UNION ALL SELECT coalesce((SELECT max(id_building) FROM building), 0) + row_number() OVER (ORDER BY name), name, NULL, NULL, 'INSERT'
          FROM {out}_new),
{out}_ids AS (SELECT {nk('name')} AS k, min(id_building) AS id_building FROM {out} GROUP BY ALL)"""


_UNIT_ID = f"CASE WHEN regexp_matches({trim_sp('unit')}, '^[0-9]+$') THEN TRY_CAST({trim_sp('unit')} AS BIGINT) END"
# one whole row of those that mean one unit
_FIRST = "cbu IS NULL, cbu, floor IS NULL, floor, dept IS NULL, dept, building_name"
def u_staged(prior: str) -> str:
    """The units file staged, its buildings, and its rows for known units by id."""
    return f"""
u_stg AS (SELECT DISTINCT {_UNIT_ID} AS unit, {k1('building', 50)} AS building_name, {k16_floor('piso')} AS floor,
                 {k16_dept('departamento')} AS dept, {k7('cbu')} AS cbu FROM raw_units),
u_prior AS ({prior}),
{ensured('u_stg', 'u_bld').strip()},
u_rows AS (SELECT u_stg.*, id_building FROM u_stg JOIN u_bld_ids ON k = {nk('building_name')}),
u_home AS (SELECT r.*, p.id_unit FROM u_rows r JOIN u_prior p ON p.id_unit = r.unit AND p.id_building = r.id_building),
by_id AS (SELECT * FROM u_home QUALIFY row_number() OVER (PARTITION BY id_unit ORDER BY {_FIRST}) = 1)"""


U_STG = u_staged("""SELECT id_unit, id_building, CASE WHEN id_unit % 9 = 0 THEN NULL ELSE floor END AS floor, dept,
                   CASE WHEN id_unit % 10 = 3 THEN NULL ELSE cbu END AS cbu FROM unit""")


def _u6(src: str) -> str:
    return f"""
u6 AS (SELECT t.* REPLACE (coalesce(s.floor, t.floor) AS floor, coalesce(s.dept, t.dept) AS dept),
              coalesce(s.floor, t.floor) IS DISTINCT FROM t.floor OR coalesce(s.dept, t.dept) IS DISTINCT FROM t.dept AS a1
       FROM {src} t LEFT JOIN by_id s ON s.id_unit = t.id_unit)"""


def _u7(src: str, claims: str, out: str, flag: str) -> str:
    """Bank ids of one pass: free before it, and the lowest claiming unit's."""
    return f"""
{out}_set AS (
  SELECT c.id_unit, c.cbu FROM (SELECT min(id_unit) AS id_unit, cbu FROM {claims} WHERE cbu IS NOT NULL GROUP BY cbu) c
  JOIN {src} t ON t.id_unit = c.id_unit
  WHERE t.cbu IS DISTINCT FROM c.cbu AND NOT EXISTS (SELECT 1 FROM {src} o WHERE o.cbu = c.cbu AND o.id_unit <> c.id_unit)),
{out} AS (SELECT t.* REPLACE (coalesce(s.cbu, t.cbu) AS cbu), s.cbu IS NOT NULL AS {flag}
          FROM {src} t LEFT JOIN {out}_set s ON s.id_unit = t.id_unit)"""


def u6_sql() -> str:
    return with_ledger(RAW_UNITS, U_STG, _u6("u_prior"), select="""
SELECT id_unit, id_building, floor, dept, cbu, CASE WHEN a1 THEN 'UPDATE' ELSE 'KEEP' END AS action FROM u6""")


def u7_sql() -> str:
    return with_ledger(RAW_UNITS, U_STG, _u7("u_prior", "by_id", "u7", "a2"), select="""
SELECT id_unit, id_building, floor, dept, cbu, CASE WHEN a2 THEN 'UPDATE' ELSE 'KEEP' END AS action FROM u7""")


def l4_steps() -> list[str]:
    """The three passes of L4 over u_staged."""
    same = "x.id_building = r.id_building AND x.floor IS NOT DISTINCT FROM r.floor AND x.dept IS NOT DISTINCT FROM r.dept"
    row = "unit, building_name, floor, dept, cbu"
    key = "id_building, floor IS NULL, floor, dept IS NULL, dept, cbu IS NULL, cbu, unit IS NULL, unit"
    return [_u6("u_prior"), _u7("u6", "by_id", "s1", "a2"), f"""
place AS (SELECT id_building, floor, dept, min(id_unit) AS id_unit FROM s1 GROUP BY ALL),
at_place AS (SELECT r.*, x.id_unit FROM u_rows r JOIN place x ON {same} WHERE r.unit IS NULL),
by_place AS (SELECT * FROM at_place QUALIFY row_number() OVER (PARTITION BY id_unit ORDER BY {_FIRST}) = 1)""",
            _u7("s1", "by_place", "s2", "a3"), f"""
rest AS (SELECT r.* FROM u_rows r WHERE NOT EXISTS (SELECT 1 FROM s2 x WHERE x.id_unit = r.unit)),
no_place AS (SELECT r.* FROM rest r WHERE NOT EXISTS (SELECT 1 FROM s2 x WHERE {same})),
asked AS (SELECT *, EXISTS (SELECT 1 FROM s2 x WHERE x.cbu = r.cbu) AS held FROM no_place r),
claim AS (SELECT *, CASE WHEN cbu IS NULL OR held THEN 1 ELSE row_number() OVER (PARTITION BY cbu, held
            ORDER BY id_building, floor IS NULL, floor, dept IS NULL, dept, unit IS NULL, unit, building_name) END AS nth FROM asked),
ins AS (SELECT coalesce((SELECT max(id_unit) FROM s2), 0) + row_number() OVER (ORDER BY {key}) AS id_unit, * FROM claim WHERE NOT held AND nth = 1),
l4 AS (SELECT id_unit, id_building, floor, dept, cbu, CASE WHEN a1 OR a2 OR a3 THEN 'UPDATE' ELSE 'KEEP' END AS action FROM s2
       UNION ALL SELECT id_unit, id_building, floor, dept, cbu, 'INSERT' FROM ins),
l4_rej AS (
  SELECT '{UL.NO_BUILDING}' AS reason, {row} FROM u_stg WHERE building_name IS NULL
  UNION ALL SELECT '{UL.OTHER_BUILDING}', {row.replace('unit,', 'r.unit,', 1).replace('floor', 'r.floor').replace('dept', 'r.dept').replace('cbu', 'r.cbu')}
    FROM u_rows r JOIN u_prior p ON p.id_unit = r.unit AND p.id_building <> r.id_building
  UNION ALL (SELECT '{UL.REPEATED}', {row} FROM (SELECT {row}, id_unit FROM u_home EXCEPT SELECT {row}, id_unit FROM by_id))
  UNION ALL (SELECT '{UL.REPEATED}', {row} FROM (SELECT {row}, id_unit FROM at_place EXCEPT SELECT {row}, id_unit FROM by_place))
  UNION ALL SELECT '{UL.BANK_ID_TAKEN}', c.unit, building_name, c.floor, c.dept, c.cbu FROM by_id c JOIN s1 USING (id_unit)
    WHERE c.cbu IS NOT NULL AND s1.cbu IS DISTINCT FROM c.cbu
  UNION ALL SELECT '{UL.BANK_ID_TAKEN}', c.unit, building_name, c.floor, c.dept, c.cbu FROM by_place c JOIN s2 USING (id_unit)
    WHERE c.cbu IS NOT NULL AND s2.cbu IS DISTINCT FROM c.cbu
  UNION ALL SELECT '{UL.KNOWN_PLACE}', {row} FROM rest r WHERE unit IS NOT NULL AND EXISTS (SELECT 1 FROM s2 x WHERE {same})
  UNION ALL SELECT '{UL.BANK_ID_TAKEN}', {row} FROM claim WHERE held OR nth > 1)"""]


def l4_sql(which: str) -> str:
    return with_ledger(RAW_UNITS, U_STG, *l4_steps(), select={
        "units": "SELECT * FROM l4", "rejects": "SELECT * FROM l4_rej", "buildings": "SELECT * FROM u_bld",
        "summary": """
SELECT (SELECT count(*) FROM raw_units) AS rows_read, (SELECT count(*) FROM u_stg) AS rows_staged,
       (SELECT count(*) FROM l4 WHERE action = 'INSERT') AS inserted, (SELECT count(*) FROM l4 WHERE action = 'UPDATE') AS updated,
       (SELECT count(*) FROM u_bld WHERE action = 'INSERT') AS new_buildings, (SELECT count(*) FROM l4_rej) AS rejected"""}[which])


A_STG = f"""
a0 AS (SELECT {k1('building', 50)} AS building_name, {k16_floor('piso')} AS floor, {k16_dept('departamento')} AS dept,
              CAST({k2('coeficiente')} AS DECIMAL(5,2)) AS share, CAST({k2('m2_unidad')} AS DECIMAL(7,2)) AS area,
              CAST({k2('m2_baulera')} AS DECIMAL(5,2)) AS storage_m2, CAST({k2('m2_cochera')} AS DECIMAL(5,2)) AS garage_m2
       FROM raw_areas),
a_stg AS (SELECT building_name, floor, dept, max(share) AS share, max(area) AS area, max(storage_m2) AS storage_m2,
                 max(garage_m2) AS garage_m2 FROM a0 WHERE building_name IS NOT NULL GROUP BY building_name, floor, dept)"""


def e5_sql() -> str:
    return with_ledger(RAW_AREAS, A_STG, select="SELECT * FROM a_stg")


def l5_steps(prior: str) -> list[str]:
    """L5 over a_stg and the units before it."""
    cols = ["share", "area", "storage_m2", "garage_m2"]
    sel = ", ".join(f"coalesce(s.{c}, t.{c}) AS {c}" for c in cols)
    chg = " OR ".join(f"coalesce(s.{c}, t.{c}) IS DISTINCT FROM t.{c}" for c in cols)
    return [ensured("a_stg", "a_bld"), f"""
a_rows AS (SELECT id_building, floor, dept, {", ".join(f"max({c}) AS {c}" for c in cols)}
           FROM a_stg JOIN a_bld_ids ON k = {nk('building_name')} GROUP BY id_building, floor, dept),
a_prior AS ({prior}),
a_ins AS (SELECT coalesce((SELECT max(id_unit) FROM a_prior), 0)
                 + row_number() OVER (ORDER BY id_building, floor IS NULL, floor, dept IS NULL, dept) AS id_unit, *
          FROM a_rows s WHERE NOT EXISTS (SELECT 1 FROM a_prior t WHERE t.id_building = s.id_building
            AND t.floor IS NOT DISTINCT FROM s.floor AND t.dept IS NOT DISTINCT FROM s.dept)),
l5 AS (SELECT t.id_unit, t.id_building, t.floor, t.dept, {sel}, CASE WHEN {chg} THEN 'UPDATE' ELSE 'KEEP' END AS action
       FROM a_prior t LEFT JOIN a_rows s ON t.id_building = s.id_building AND t.floor IS NOT DISTINCT FROM s.floor
         AND t.dept IS NOT DISTINCT FROM s.dept
       UNION ALL SELECT *, 'INSERT' FROM a_ins)"""]


def l5_sql(which: str) -> str:
    prior = """SELECT id_unit, id_building, floor, dept, CASE WHEN id_unit % 8 = 0 THEN NULL ELSE share END AS share, area,
                   storage_m2, garage_m2 FROM unit"""
    return with_ledger(RAW_AREAS, A_STG, *l5_steps(prior), select={"units": "SELECT * FROM l5", "summary": """
SELECT (SELECT count(*) FROM raw_areas) AS rows_read, (SELECT count(*) FROM a0 WHERE building_name IS NOT NULL) AS rows_staged,
       (SELECT count(*) FROM l5 WHERE action = 'INSERT') AS inserted, (SELECT count(*) FROM l5 WHERE action = 'UPDATE') AS updated,
       (SELECT count(*) FROM a_bld WHERE action = 'INSERT') AS new_buildings, 0::BIGINT AS rejected"""}[which])


P_STG = f"""
p0 AS (SELECT DISTINCT {k7('cbu')} AS cbu, {k17('inquilino')} AS is_tenant,
              CASE WHEN regexp_matches({trim_sp('dni')}, '^[0-9]+$') THEN TRY_CAST({trim_sp('dni')} AS BIGINT) END AS dni,
              {k1('nombre', 50)} AS first_name, {k1('apellido', 50)} AS last_name, {k6b('email')} AS email,
              {k18('telefono')} AS phone FROM raw_people),
p_stg AS (SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY cbu ORDER BY dni, last_name, first_name, email) AS rn FROM p0
            WHERE cbu IS NOT NULL AND is_tenant IS NOT NULL AND dni IS NOT NULL) WHERE rn = 1),
p_upd AS (SELECT t.id_person,
                 {", ".join(f"coalesce(s.{c}, t.{c}) AS {c}" for c in ["first_name", "last_name", "dni", "email", "phone"])},
                 t.cbu,
                 CASE WHEN s.cbu IS NOT NULL AND ({" OR ".join(f"coalesce(s.{c}, t.{c}) IS DISTINCT FROM t.{c}" for c in ["first_name", "last_name", "dni", "email", "phone"])})
                      THEN 'UPDATE' ELSE 'KEEP' END AS action
          FROM person t LEFT JOIN p_stg s ON s.cbu = t.cbu),
p_new AS (SELECT coalesce((SELECT max(id_person) FROM person), 0) + row_number() OVER (ORDER BY s.cbu) AS id_person,
                 s.first_name, s.last_name, s.dni, s.email, s.phone, s.cbu, 'INSERT' AS action
          FROM p_stg s WHERE NOT EXISTS (SELECT 1 FROM person t WHERE t.cbu = s.cbu)),
p_all AS (SELECT * FROM p_upd UNION ALL SELECT * FROM p_new)"""


def l6_sql() -> str:
    return with_ledger(RAW_PEOPLE, P_STG, select="SELECT * FROM p_all")


def u9_sql() -> str:
    return with_ledger(RAW_PEOPLE, P_STG, """
links AS (SELECT DISTINCT pa.id_person, u.id_building, s.is_tenant = 1 AS is_tenant
          FROM p_stg s JOIN p_all pa ON pa.cbu = s.cbu JOIN unit u ON u.cbu = s.cbu)""", select="""
SELECT t.id_person, t.id_building,
       CASE WHEN l.id_person IS NOT NULL THEN coalesce(l.is_tenant, t.is_tenant) ELSE t.is_tenant END AS is_tenant,
       CASE WHEN l.id_person IS NOT NULL AND coalesce(l.is_tenant, t.is_tenant) IS DISTINCT FROM t.is_tenant
            THEN 'UPDATE' ELSE 'KEEP' END AS action
FROM occupancy t LEFT JOIN links l ON l.id_person = t.id_person AND l.id_building = t.id_building
UNION ALL
SELECT l.id_person, l.id_building, l.is_tenant, 'INSERT' AS action FROM links l
WHERE NOT EXISTS (SELECT 1 FROM occupancy t WHERE t.id_person = l.id_person AND t.id_building = l.id_building)""")


def l7b_sql(which: str = "errors") -> str:
    sw = "nullif(" + trim_sp("c4") + ", '') IS NOT NULL"
    return with_ledger(RAW_PAY, f"""
bn AS (SELECT CASE WHEN {sw} THEN c2 ELSE c1 END AS date_txt, CASE WHEN {sw} THEN c3 ELSE c2 END AS cbu_txt,
              CASE WHEN {sw} THEN c4 ELSE c3 END AS amount_txt FROM raw_pay),
bn2 AS (SELECT *, right(repeat('0', 22) || regexp_replace({trim_sp('cbu_txt')}, '[{NB}\t .\\-]', '', 'g'), 22) AS cbu,
               {k19('date_txt')} AS pay_date,
               nullif({trim_sp(f"translate(translate(amount_txt, '{NB}' || chr(9), '  '), '$', '')")}, '') AS vv FROM bn)""",
                       k3_ctes("bn2", "vv", "date_txt, cbu_txt, amount_txt, cbu, pay_date"), f"""
bp AS (SELECT date_txt, cbu_txt, amount_txt, cbu, pay_date, TRY_CAST({K3_RESULT} AS DECIMAL(10,2)) AS amount FROM k3e),
bok AS (SELECT pay_date, cbu, amount FROM bp WHERE pay_date IS NOT NULL AND amount IS NOT NULL AND cbu IS NOT NULL
          AND cbu <> repeat('0', 22))""", select="SELECT * FROM bok" if which == "parsed" else f"""
SELECT '{REASON_PARSE}' AS reason, nullif(date_txt, '') AS date_txt, nullif(cbu_txt, '') AS cbu_txt,
       nullif(amount_txt, '') AS amount_txt
FROM bp n WHERE NOT EXISTS (SELECT 1 FROM bok p WHERE p.cbu = n.cbu AND p.pay_date = n.pay_date)""")


def l8_sql(which: str = "quotes") -> str:
    return with_ledger("""
qd AS (SELECT fx_type, quote_ts,
              CASE WHEN id_quote % 23 = 0 THEN replace(CAST(buy AS VARCHAR), '.', ',') ELSE CAST(buy AS VARCHAR) END AS compra,
              CASE WHEN id_quote % 17 = 0 THEN NULL ELSE CAST(sell AS VARCHAR) END AS venta FROM fx_quote),
qt AS (SELECT fx_type, quote_ts, compra, venta,
              CASE WHEN regexp_matches(compra, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') THEN TRY_CAST(compra AS DECIMAL(10,2)) END AS buy,
              CASE WHEN regexp_matches(venta, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') THEN TRY_CAST(venta AS DECIMAL(10,2)) END AS sell
       FROM qd)""", select=("SELECT fx_type, quote_ts, buy, sell FROM qt WHERE buy IS NOT NULL AND sell IS NOT NULL"
                            if which == "quotes" else
                            "SELECT 'JSON sin campos esperados' AS reason, fx_type, compra, venta FROM qt "
                            "WHERE buy IS NULL OR sell IS NULL"))


def b3_sql(year: int = 2001) -> str:
    from .oracle import r4_sql
    return f"SELECT period || '-01' AS period, department, total_collected FROM ({r4_sql(year)})"


def b4_sql() -> str:
    from .oracle import r8_sql
    return f"SELECT building_name, id_payment, unit_label, pay_date, prev_date, days_between, amount FROM ({r8_sql()})"
