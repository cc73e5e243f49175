"""DuckDB oracle SQL for the raw-text adapter and the cleaning rules K1–K21."""

from __future__ import annotations

from .functions.clean import EMAIL_FIXES, MONTHS_ES, TENANT_NO, TENANT_YES
from .oracle import with_ledger

NB = "\u00a0"
DEC = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trim_sp(x: str) -> str:
    return f"regexp_replace({x}, '^ +| +$', '', 'g')"


def try_dec(t: str, p: int, s: int) -> str:
    return f"(CASE WHEN regexp_matches({t}, '{DEC}') THEN TRY_CAST({t} AS DECIMAL({p},{s})) END)"


def fmt2(x: str) -> str:
    return f"format('{{:,.2f}}', CAST({x} AS DOUBLE))"


def local2(x: str) -> str:
    return f"translate({fmt2(x)}, ',.', '.,')"


RAW_PAY = f"""
raw_pay0 AS (SELECT *, CAST((day(pay_date) + id_unit) % 8 AS INTEGER) AS st FROM payment),
raw_pay AS (
  SELECT id_payment AS c1,
         CASE st WHEN 1 THEN strftime(pay_date, '%Y-%m-%d')
                 WHEN 2 THEN CAST(day(pay_date) AS VARCHAR) || '/' || CAST(month(pay_date) AS VARCHAR) || '/'
                             || CAST(year(pay_date) AS VARCHAR)
                 WHEN 3 THEN strftime(pay_date, '%Y%m%d')
                 WHEN 5 THEN strftime(pay_date, '%d') || '/13/' || strftime(pay_date, '%Y')
                 ELSE strftime(pay_date, '%d/%m/%Y') END AS c2,
         CASE st WHEN 1 THEN substr(cbu, 1, 8) || '-' || substr(cbu, 9, 14)
                 WHEN 2 THEN substr(cbu, 1, 4) || ' ' || substr(cbu, 5, 18)
                 WHEN 3 THEN substr(cbu, 2, 21)
                 WHEN 7 THEN '9' || substr(cbu, 2, 21)
                 ELSE cbu END AS c3,
         CASE st WHEN 1 THEN {local2('amount')}
                 WHEN 2 THEN '$ ' || {fmt2('amount')}
                 WHEN 3 THEN 'ARS ' || CAST(CAST(amount AS BIGINT) AS VARCHAR)
                 WHEN 4 THEN '(' || replace(CAST(amount AS VARCHAR), '.', ',') || ')'
                 WHEN 6 THEN ''
                 ELSE CAST(amount AS VARCHAR) END AS c4
  FROM raw_pay0)
"""

RAW_PEOPLE = """
raw_people AS (
  SELECT '  ' || upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) || ' ' AS nombre,
         c_name AS apellido,
         CASE WHEN c_custkey % 11 = 0 THEN '' ELSE CAST(10000000 + c_custkey AS VARCHAR) END AS dni,
         CASE c_custkey % 8 WHEN 0 THEN NULL
              WHEN 1 THEN upper(lower(replace(c_name, '#', '.')) || ' @ Gmail,com')
              WHEN 2 THEN lower(replace(c_name, '#', '.')) || '@hotmail com ar'
              WHEN 3 THEN lower(replace(c_name, '#', '.')) || '(at)yahoo com'
              WHEN 4 THEN lower(replace(c_name, '#', '.')) || ' arroba gmail.com'
              WHEN 5 THEN lower(replace(c_name, '#', '.')) || '@mail.com'
              WHEN 6 THEN 'x..' || lower(replace(c_name, '#', '.')) || '@mail.com'
              ELSE ' ' || lower(replace(c_name, '#', '.')) || '@outlookcom ' END AS email,
         CASE WHEN c_custkey % 9 = 0 THEN ''
              ELSE '(011) 4' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || '-'
                   || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS telefono,
         CASE WHEN c_custkey % 4 = 0 THEN '9' || substr(lpad(CAST(c_custkey AS VARCHAR), 22, '0'), 2, 21)
              WHEN c_custkey % 5 = 1 THEN substr(lpad(CAST(c_custkey AS VARCHAR), 22, '0'), 1, 11) || '-'
                                          || substr(lpad(CAST(c_custkey AS VARCHAR), 22, '0'), 12, 11)
              WHEN c_custkey % 13 = 0 THEN substr(lpad(CAST(c_custkey AS VARCHAR), 22, '0'), 3, 20)
              ELSE lpad(CAST(c_custkey AS VARCHAR), 22, '0') END AS cbu,
         CASE c_custkey % 6 WHEN 0 THEN 'Sí' WHEN 1 THEN 'no' WHEN 2 THEN 'propietario' WHEN 3 THEN 'INQUILINO'
              WHEN 4 THEN 'x' ELSE 'true' END AS inquilino
  FROM customer)
"""

FLOOR_TXT = ("CASE WHEN c_custkey % 10 = 0 AND c_custkey % 3 = 0 THEN 'PB' WHEN c_custkey % 10 = 0 THEN 'P.B.' "
             "ELSE CAST(c_custkey % 10 AS VARCHAR) END")

_OWN = "CASE WHEN k % 13 = 0 THEN translate(lower(name), 'aeiou', 'áéíóú') || ' ' ELSE name END"
FILE_BASE = f"""
file_base AS (
  SELECT c_custkey AS k, n.n_name AS name, m.n_name AS next_name, {FLOOR_TXT} AS floor_txt,
         chr(CAST(65 + c_custkey % 5 AS INTEGER)) AS letter
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN nation m ON m.n_nationkey = (n.n_nationkey + 1) % 25)"""


def _unit_row(where: str, cbu: str, building: str, unit: str, floor: str, dept: str) -> str:
    if len(cbu) == 1:
        cbu = f"'{cbu}' || lpad(CAST(k AS VARCHAR), 21, '0')"
    return (f"SELECT {cbu} AS cbu, ' ' || {building} AS building, {unit} AS unit, {floor} AS piso, {dept} || ' ' AS departamento "
            f"FROM file_base WHERE {where}")


_DOTTED = ("CASE WHEN k % 7 = 3 THEN substr(lpad(CAST(k AS VARCHAR), 22, '0'), 1, 10) || '.' || "
           "substr(lpad(CAST(k AS VARCHAR), 22, '0'), 11, 12) ELSE lpad(CAST(k AS VARCHAR), 22, '0') END")
RAW_UNIT_ROWS = "raw_units AS (" + "\nUNION ALL ".join([
    _unit_row("true", _DOTTED, _OWN, "CAST(k AS VARCHAR)", "floor_txt", "letter"),
    _unit_row("k % 20 = 0", "6", _OWN, "''", "floor_txt", "letter"),
    _unit_row("k % 25 = 3", "5", "next_name", "CAST(k AS VARCHAR)", "floor_txt", "letter"),
    _unit_row("k % 30 = 4", "8", _OWN, "CAST(k + 10000000 AS VARCHAR)", "CAST(10 + k % 90 AS VARCHAR)", "letter"),
    _unit_row("k % 45 = 5", "7", _OWN, "''", "''", "''"),
    _unit_row("k % 60 = 6", "4", f"{_OWN} || ' II'", "CAST(k + 20000000 AS VARCHAR)", "'1'", "'A'"),
    _unit_row("k % 35 = 7", _DOTTED, _OWN, "CAST(k + 30000000 AS VARCHAR)", "CAST(100 + k % 50 AS VARCHAR)", "letter"),
    _unit_row("k % 55 = 8", "3", _OWN, "CAST(k + 40000000 AS VARCHAR)", "CAST(150 + k % 50 AS VARCHAR)", "letter"),
    _unit_row("k % 55 = 8", "3", _OWN, "CAST(k + 50000000 AS VARCHAR)", "CAST(150 + k % 50 AS VARCHAR)", "letter"),
    _unit_row("k % 70 = 9", _DOTTED, _OWN, "CAST(k AS VARCHAR)", "'200'", "'Z'"),
    _unit_row("k % 80 = 10", "2", "'  '", "CAST(k + 60000000 AS VARCHAR)", "'1'", "'A'")]) + ")"


RAW_UNITS = FILE_BASE.strip() + ",\n" + RAW_UNIT_ROWS


def _area_row(where: str, building: str, unit: str, floor: str, dept: str) -> str:
    return f"""SELECT {building} AS building, {unit} AS unit, {floor} AS piso, {dept} AS departamento,
       CASE WHEN k % 50 = 11 THEN '' ELSE CAST(1 + k % 7 AS VARCHAR) || ',00' END AS coeficiente,
       CAST(40 + k % 61 AS VARCHAR) || ',5' AS m2_unidad,
       CASE WHEN k % 4 = 1 THEN 'SI' ELSE 'NO' END AS bauleras, CASE WHEN k % 6 = 2 THEN 'SI' ELSE 'NO' END AS cochera,
       CASE WHEN k % 4 = 1 THEN '3,5' ELSE '0' END AS m2_baulera, CASE WHEN k % 6 = 2 THEN '12' ELSE '0' END AS m2_cochera
FROM file_base WHERE {where}"""


RAW_AREA_ROWS = "raw_areas AS (" + "\nUNION ALL ".join([
    _area_row("k % 11 <> 3", _OWN, "CAST(k AS VARCHAR)", "floor_txt", "letter"),
    _area_row("k % 30 = 4", _OWN, "''", "CAST(10 + k % 90 AS VARCHAR)", "letter"),
    _area_row("k % 45 = 5", _OWN, "''", "''", "''"),
    _area_row("k % 60 = 6", "name || ' II'", "''", "'1'", "'A'")]) + ")"
RAW_AREAS = FILE_BASE.strip() + ",\n" + RAW_AREA_ROWS

RAW_BUILDINGS = """
raw_buildings AS (
  SELECT ' ' || n_name || ' ' AS nombre, 'Av. ' || n_name AS domicilio,
         CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE CAST(1000 + n_nationkey * 37 AS VARCHAR) || ',50' END AS m2_totales
  FROM nation)
"""


def _raw_expenses() -> str:
    from .sources.rawtext import PRIORITY_CATEGORY
    months = " ".join(f"WHEN {i} THEN '{m[0].upper() + m[1:]}'" for i, m in enumerate(MONTHS_ES, 1) if i != 5)
    sums = ",\n         ".join(
        f"sum(CASE WHEN o_orderpriority = '{p}' THEN CAST(o_totalprice AS DECIMAL(10,2)) END) AS \"{c}\""
        for p, c in PRIORITY_CATEGORY.items())
    cols = ",\n         ".join(
        f"CASE WHEN \"{c}\" IS NOT NULL THEN {local2(chr(34) + c + chr(34))} END AS \"{c}\""
        for c in PRIORITY_CATEGORY.values())
    return f"""
rexp0 AS (
  SELECT id_building, month_start,
         {sums}
  FROM ob GROUP BY id_building, month_start),
raw_expenses AS (
  SELECT CASE WHEN month(month_start) = 12 AND n.n_nationkey % 9 = 4 THEN n.n_name || ' III'
              WHEN month(month_start) = 7 THEN translate(lower(n.n_name), 'aeiou', 'áéíóú') || ' ' ELSE n.n_name END
           AS "Nombre del consorcio", CAST(year(month_start) AS INTEGER) AS anio,
         CASE month(month_start) WHEN 5 THEN 'Ma yo' {months} END AS "Mes",
         {cols},
         CAST(NULL AS VARCHAR) AS "SERVICIOS PUBLICOS-Agua", CAST(NULL AS VARCHAR) AS "SERVICIOS PUBLICOS-Luz"
  FROM rexp0 g JOIN nation n ON g.id_building = n.n_nationkey)
"""


RAW_EXPENSES = _raw_expenses()


# ---------------------------------------------------------------- rules
def k1(x: str, n: int | None) -> str:
    t = trim_sp(f"coalesce({x}, '')")
    if n:
        t = f"substr({t}, 1, {n})"
    return f"nullif({t}, '')"


def k2(x: str) -> str:
    t = f"replace(regexp_replace({trim_sp(x)}, '[{NB} ]', '', 'g'), ',', '.')"
    return try_dec(t, 10, 2)


def k3_ctes(src: str, col: str, keep: str) -> str:
    """CTE chain computing K3 of ``col``; the last CTE is k3e with columns
    ``keep``, raw, and the intermediate steps; the result expression is K3_RESULT."""
    return f"""
k3a AS (SELECT {keep}, {col} AS raw,
               regexp_replace(regexp_replace(regexp_replace({col}, '{NB}', ' ', 'g'), '(?i)ARS', '', 'g'),
                              '[$ \t]', '', 'g') AS t FROM {src}),
k3b AS (SELECT *, CASE WHEN starts_with(t, '(') AND ends_with(t, ')') AND length(t) >= 2
                       THEN '-' || substr(t, 2, length(t) - 2) ELSE t END AS t2 FROM k3a),
k3c AS (SELECT *, regexp_replace(t2, '[^0-9.,-]', '', 'g') AS u FROM k3b),
k3d AS (SELECT *, CASE WHEN starts_with(u, '-') THEN '-' ELSE '' END AS sgn, replace(u, '-', '') AS v FROM k3c),
k3e AS (SELECT *, regexp_replace(regexp_extract(v, '^(.*)[.,]([^.,]*)$', 1), '[.,]', '', 'g') AS lft,
               regexp_extract(v, '^(.*)[.,]([^.,]*)$', 2) AS rgt FROM k3d)
"""


K3_RESULT = (f"CAST(CASE WHEN raw IS NULL OR {trim_sp('raw')} = '' THEN NULL WHEN u = '' THEN NULL "
             f"WHEN NOT regexp_matches(v, '[.,]') THEN {try_dec('sgn || v', 18, 2)} "
             f"ELSE {try_dec(chr(40) + 'sgn || CASE WHEN lft = ' + q('') + ' THEN ' + q('0') + ' ELSE lft END || ' + q('.') + ' || rgt' + chr(41), 18, 2)} END "
             f"AS DECIMAL(18,2))")


def k4_ctes(src: str, col: str, keep: str) -> str:
    return f"""
k4a AS (SELECT {keep}, {col} AS raw,
               upper({trim_sp(f"regexp_replace(replace(replace({col}, '{NB}', ' '), chr(9), ' '), '(?i)AR\\$|ARS|U\\$S|\\$|\"', '', 'g')")}) AS v0
        FROM {src}),
k4b AS (SELECT *, starts_with(v0, '(') AND ends_with(v0, ')') AS neg,
               replace(regexp_replace(v0, '[()]', '', 'g'), ' ', '') AS v2 FROM k4a),
k4c AS (SELECT *, replace(replace(v2, '.', ''), ',', '.') AS cc, replace(v2, ',', '') AS cp,
               replace(replace(v2, '.', ''), ',', '') AS cs FROM k4b),
k4d AS (SELECT *, CASE WHEN instr(cp, '.') > 0 THEN length(cp) - instr(reverse(cp), '.') END AS dp,
               CASE WHEN instr(cc, '.') > 0 THEN length(cc) - instr(reverse(cc), '.') END AS dc,
               CASE WHEN neg THEN '-' ELSE '' END AS sg FROM k4c)
"""


K4_RESULT = (f"coalesce(CASE WHEN dp = 2 THEN {try_dec('sg || cp', 12, 2)} END, "
             f"CASE WHEN dc = 2 THEN {try_dec('sg || cc', 12, 2)} END, {try_dec('sg || cp', 12, 2)}, "
             f"{try_dec('sg || cc', 12, 2)}, {try_dec('sg || cs', 12, 2)})")


def k5(x: str) -> str:
    e = trim_sp(f"coalesce({x}, '')")
    e = f"lower(replace({e}, '{NB}', ' '))"
    e = f"regexp_replace({e}, '[\t\n\r]', '', 'g')"
    e = f"translate({e}, ',;', '..')"
    for a, b in [(" @ ", "@"), (" @", "@"), ("@ ", "@"), (" ", "")] + EMAIL_FIXES:
        e = f"replace({e}, {q(a)}, {q(b)})"
    return trim_sp(e)


def k6_ctes(src: str, col: str, keep: str) -> str:
    return f"""
k6a AS (SELECT {keep}, replace({trim_sp(f"coalesce({col}, '')")}, '{NB}', ' ') AS e FROM {src}),
k6b AS (SELECT *, split_part(e, '@', 1) AS loc, substr(e, instr(e, '@') + 1) AS dom FROM k6a),
k6c AS (SELECT *, regexp_extract(dom, '([^.]*)$', 1) AS tld FROM k6b)
"""


K6_RESULT = f"""CASE WHEN e <> '' AND NOT regexp_matches(e, '[\t\n\r ]')
  AND NOT starts_with(e, '.') AND NOT ends_with(e, '.') AND NOT contains(e, '..')
  AND length(e) - length(replace(e, '@', '')) = 1 AND length(e) <= 254
  AND length(loc) BETWEEN 1 AND 64 AND length(dom) BETWEEN 1 AND 255
  AND regexp_matches(loc, '^[-0-9A-Za-z._+]+$')
  AND NOT starts_with(loc, '.') AND NOT ends_with(loc, '.') AND NOT contains(loc, '..')
  AND contains(dom, '.') AND regexp_matches(dom, '^[-0-9A-Za-z.]+$') AND NOT regexp_matches(dom, '^[.-]|[.-]$')
  AND NOT contains(dom, '..') AND NOT contains(dom, '.-') AND NOT contains(dom, '-.')
  AND list_bool_and(list_transform(string_split(dom, '.'), lambda lb: length(lb) >= 1
        AND NOT starts_with(substr(lb, 1, 63), '-') AND NOT ends_with(substr(lb, 1, 63), '-')))
  AND length(substr(tld, 1, 24)) >= 2 AND regexp_matches(substr(tld, 1, 24), '^[A-Za-z]+$')
  THEN 1 ELSE 0 END"""


def k6b(x: str) -> str:
    e = f"nullif({k5(x)}, '')"
    return f"CASE WHEN regexp_matches({e}, '@.*\\.') THEN substr({e}, 1, 255) END"


def k7(x: str) -> str:
    t = f"regexp_replace({trim_sp(x)}, '[ \\-./\\\\_()\t{NB}]', '', 'g')"
    return f"CASE WHEN regexp_matches({t}, '^[0-9]{{22}}$') THEN {t} END"


def k7b(x: str) -> str:
    t = f"regexp_replace(upper({trim_sp(x)}), '[{NB}\t .\\-]', '', 'g')"
    return f"right(repeat('0', 22) || {t}, 22)"


def k15(x: str) -> str:
    parts = []
    for i, m in enumerate(MONTHS_ES, 1):
        if m == "mayo":
            parts.append(f"WHEN starts_with(lower(replace({x}, ' ', '')), 'mayo') THEN {i}")
        else:
            parts.append(f"WHEN lower({trim_sp(x)}) = '{m}' THEN {i}")
    return "CASE " + " ".join(parts) + " END"


def k16_floor(x: str) -> str:
    t = trim_sp(x)
    n = f"(CASE WHEN regexp_matches({t}, '^[+-]?[0-9]+$') THEN TRY_CAST({t} AS INTEGER) END)"
    return (f"CAST(CASE WHEN upper({t}) IN ('PB', 'P.B', 'P.B.', 'PLANTA BAJA') THEN 0 "
            f"WHEN {n} BETWEEN 0 AND 255 THEN {n} END AS INTEGER)")


def k16_dept(x: str) -> str:
    return f"substr(nullif({trim_sp(x)}, ''), 1, 1)"


def k17(x: str) -> str:
    yes = ", ".join(q(v) for v in TENANT_YES)
    no = ", ".join(q(v) for v in TENANT_NO)
    return f"CASE WHEN lower({x}) IN ({yes}) THEN 1 WHEN lower({x}) IN ({no}) THEN 0 END"


def k18(x: str) -> str:
    return f"substr(nullif(regexp_replace({x}, '[ \\-()]', '', 'g'), ''), 1, 50)"


def k19(x: str) -> str:
    t = f"nullif({trim_sp(x)}, '')"
    return (f"coalesce(CASE WHEN regexp_matches({t}, '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}$') "
            f"THEN CAST(try_strptime({t}, '%d/%m/%Y') AS DATE) END, "
            f"CASE WHEN regexp_matches({t}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') "
            f"THEN CAST(try_strptime({t}, '%Y-%m-%d') AS DATE) END, "
            f"CASE WHEN regexp_matches({t}, '^[0-9]{{8}}$') THEN CAST(try_strptime({t}, '%Y%m%d') AS DATE) END)")


# ---------------------------------------------------------------- queries
def k_sql(name: str) -> str:
    if name == "k1_text":
        return with_ledger(RAW_PEOPLE, select=f"""
SELECT nombre AS raw_name, apellido AS raw_surname, {k1('nombre', 50)} AS name, {k1('apellido', 10)} AS surname_10
FROM raw_people""")
    if name == "k2_decimal":
        return with_ledger(RAW_AREAS, select=f"""
SELECT unit, coeficiente, m2_unidad, m2_baulera, {k2('coeficiente')} AS share, {k2('m2_unidad')} AS area,
       {k2('m2_baulera')} AS storage_m2 FROM raw_areas""")
    if name == "k3_amount_flexible":
        return with_ledger(RAW_PAY, k3_ctes("raw_pay", "c4", "c1"), select=f"""
SELECT c1 AS id, raw AS raw_amount, {K3_RESULT} AS amount FROM k3e""")
    if name == "k4_amount_candidates":
        return with_ledger(RAW_PAY, k4_ctes("raw_pay", "c4", "c1"), select=f"""
SELECT c1 AS id, raw AS raw_amount, {K4_RESULT} AS amount FROM k4d""")
    if name == "k5_email_normalise":
        return with_ledger(RAW_PEOPLE, select=f"SELECT apellido, email AS raw_email, {k5('email')} AS email FROM raw_people")
    if name == "k6_email_valid":
        return with_ledger(RAW_PEOPLE, f"rp AS (SELECT apellido, email AS raw_email, {k5('email')} AS norm FROM raw_people)",
                           k6_ctes("rp", "norm", "apellido, raw_email, norm"), select=f"""
SELECT apellido, raw_email, norm AS email, {K6_RESULT} AS is_valid FROM k6c""")
    if name == "k6b_email_light":
        return with_ledger(RAW_PEOPLE, select=f"SELECT apellido, email AS raw_email, {k6b('email')} AS email FROM raw_people")
    if name == "k7_cbu_strict":
        return with_ledger(RAW_PEOPLE, RAW_UNITS, select=f"""
SELECT 'person' AS source, cbu AS raw_cbu, {k7('cbu')} AS cbu FROM raw_people
UNION ALL SELECT 'unit' AS source, cbu AS raw_cbu, {k7('cbu')} AS cbu FROM raw_units""")
    if name == "k7b_cbu_padded":
        return with_ledger(RAW_PAY, select=f"SELECT c1 AS id, c3 AS raw_cbu, {k7b('c3')} AS cbu FROM raw_pay")
    if name == "k15_month_name":
        return with_ledger(RAW_EXPENSES, select=f"""
SELECT "Nombre del consorcio" AS building, anio, "Mes" AS raw_month, {k15('"Mes"')} AS month FROM raw_expenses""")
    if name == "k16_floor":
        return with_ledger(RAW_UNITS, select=f"""
SELECT unit, piso AS raw_floor, departamento AS raw_dept, {k16_floor('piso')} AS floor,
       {k16_dept('departamento')} AS dept FROM raw_units""")
    if name == "k17_tenant_flag":
        return with_ledger(RAW_PEOPLE, select=f"""
SELECT apellido, inquilino AS raw_flag, {k17('inquilino')} AS is_tenant FROM raw_people""")
    if name == "k18_phone":
        return with_ledger(RAW_PEOPLE, select=f"SELECT apellido, telefono AS raw_phone, {k18('telefono')} AS phone FROM raw_people")
    if name == "k19_date":
        return with_ledger(RAW_PAY, select=f"SELECT c1 AS id, c2 AS raw_date, {k19('c2')} AS pay_date FROM raw_pay")
    if name == "k20_clamp":
        return with_ledger(select="""
SELECT id_bill, CAST(total * 100 AS DECIMAL(18,2)) AS raw_total,
       CAST(least(greatest(total * 100, -99999999.99), 99999999.99) AS DECIMAL(10,2)) AS total FROM bill""")
    if name == "k21_due_day":
        return with_ledger(select="""
SELECT id_bill, least(month_start + 9, last_day(month_start)) AS due_10,
       least(month_start + 30, last_day(month_start)) AS due_31, last_day(month_start) AS due_null FROM bill""")
    raise KeyError(name)
