"""DuckDB oracle SQL for the expense loaders (L2, L3, L9), U1–U3, K8, K9."""

from __future__ import annotations

from .oracle import AS_OF, div_money_sql, with_ledger
from .oracle_clean import RAW_EXPENSES, K3_RESULT, k1, k3_ctes, k15
from .oracle_ingest import ensured, nk
from .plans.expenses import SUPPLIER_TYPES
from .sources.rawtext import EXPENSE_CATEGORIES


def l3_ctes() -> list[str]:
    """L3 over the tables building, bill, expense and cal; raw_expenses is given."""
    unp = "\nUNION ALL\n".join(
        f"""SELECT "Nombre del consorcio" AS bname, anio, "Mes" AS mes, '{c}' AS category, "{c}" AS amount_txt
FROM raw_expenses""" for c in EXPENSE_CATEGORIES)
    return [f"""
x0 AS ({unp}),
x1 AS (SELECT {k1('bname', None)} AS building_name, anio, {k15('mes')} AS month, category, amount_txt FROM x0
       WHERE {k1('bname', None)} IS NOT NULL)""",
            k3_ctes("x1", "amount_txt", "building_name, anio, month, category, amount_txt AS atxt"), f"""
x_stg AS (SELECT building_name, anio, month, category,
                 CASE WHEN atxt IS NULL OR atxt = '' THEN NULL ELSE {K3_RESULT} END AS amount FROM k3e),
{ensured('x_stg', 'x_bld').strip()},
x_rows0 AS (SELECT id_building, make_date(anio, CAST(month AS INTEGER), 1) AS month_start, category, amount
            FROM x_stg JOIN x_bld_ids ON k = {nk('building_name')} WHERE amount IS NOT NULL AND month BETWEEN 1 AND 12),
x_sum AS (SELECT id_building, month_start, sum(amount) AS total FROM x_rows0 GROUP BY ALL),
nth5w AS (SELECT month_start, cal_date FROM (
            SELECT month_start, cal_date, row_number() OVER (PARTITION BY month_start ORDER BY cal_date) AS rn
            FROM cal WHERE is_weekday) WHERE rn = 5),
x_src AS (SELECT s.id_building, s.month_start, n.cal_date AS issue_date,
                 least(make_date(year(n.cal_date), month(n.cal_date), 10), last_day(n.cal_date)) AS due1,
                 least(make_date(year(n.cal_date), month(n.cal_date), 20), last_day(n.cal_date)) AS due2,
                 CAST(s.total AS DECIMAL(28,2)) AS total
          FROM x_sum s LEFT JOIN nth5w n ON n.month_start = s.month_start),
mrg AS (SELECT t.id_bill, coalesce(t.id_building, s.id_building) AS id_building,
               coalesce(t.month_start, s.month_start) AS month_start, coalesce(t.issue_date, s.issue_date) AS issue_date,
               CASE WHEN s.id_building IS NOT NULL THEN s.due1 ELSE t.due1 END AS due1,
               CASE WHEN s.id_building IS NOT NULL THEN s.due2 ELSE t.due2 END AS due2,
               CAST(CASE WHEN s.id_building IS NOT NULL THEN s.total ELSE t.total END AS DECIMAL(28,2)) AS total,
               CASE WHEN t.id_building IS NULL THEN 'INSERT' WHEN s.id_building IS NULL THEN 'KEEP' ELSE 'UPDATE' END
                 AS action
        FROM bill t FULL JOIN x_src s ON t.id_building = s.id_building AND t.issue_date = s.issue_date),
mrg2 AS (SELECT * FROM mrg WHERE action <> 'INSERT'
         UNION ALL
         SELECT coalesce((SELECT max(id_bill) FROM bill), 0) + row_number() OVER (ORDER BY id_building, issue_date) AS id_bill,
                id_building, month_start, issue_date, due1, due2, total, action FROM mrg WHERE action = 'INSERT'),
x_rows AS (SELECT m.id_bill, m.id_building, 'Ordinario' AS kind, s.category AS description, s.month_start AS issue_date,
                  CAST(s.amount AS DECIMAL(28,2)) AS amount
           FROM x_rows0 s JOIN mrg2 m ON m.id_building = s.id_building AND date_trunc('month', m.issue_date) = s.month_start),
x_new AS (SELECT coalesce((SELECT max(id_expense) FROM expense), 0) + row_number() OVER (ORDER BY id_bill, kind, description, amount)
                 AS id_expense, r.* FROM x_rows r WHERE NOT EXISTS (
            SELECT 1 FROM expense e WHERE e.id_bill = r.id_bill AND e.id_building = r.id_building AND e.kind = r.kind
              AND coalesce(e.description, '') = coalesce(r.description, '')))"""]


def l3_sql(which: str) -> str:
    return with_ledger(RAW_EXPENSES, *l3_ctes(), select={
        "bills": "SELECT * FROM mrg2", "expenses": "SELECT * FROM x_new", "buildings": "SELECT * FROM x_bld",
        "ordinary": "SELECT id_expense, CAST(NULL AS VARCHAR) AS supplier, description AS category, CAST(NULL AS VARCHAR) AS invoice FROM x_new",
        "merged": """
SELECT id_expense, id_bill, id_building, kind, description, issue_date, CAST(amount AS DECIMAL(28,2)) AS amount, 'KEEP' AS action FROM expense
UNION ALL SELECT id_expense, id_bill, id_building, kind, description, issue_date, amount, 'INSERT' FROM x_new"""}[which])


def _raw_suppliers() -> str:
    tipo = "CASE s_suppkey % 5 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(SUPPLIER_TYPES)) + " END"
    return f"""
raw_suppliers AS (SELECT {tipo} AS tipo, ' Servicio ' || CAST(s_suppkey AS VARCHAR) AS descripcion, s_name AS proveedor,
              n_name || ' ' AS consorcio FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)"""


RAW_SUPPLIERS = _raw_suppliers()
# the subtype rows of the derived ledger's own expenses
DETAILS = """
ordinary AS (SELECT id_expense, supplier, category FROM expense WHERE kind = 'Ordinario'),
extraordinary AS (SELECT id_expense, 1::BIGINT AS instalment, 1::BIGINT AS instalments FROM expense WHERE kind = 'Extraordinario')"""


def l2_ctes() -> list[str]:
    return [f"""
ss AS (SELECT {k1('tipo', 35)} AS category, {k1('descripcion', 200)} AS description, {k1('proveedor', 100)} AS supplier,
              {k1('consorcio', 50)} AS building_name FROM raw_suppliers),
bld_ids AS (SELECT {nk('name')} AS k, min(id_building) AS id_building FROM building GROUP BY ALL),
sb AS (SELECT ss.*, id_building FROM ss JOIN bld_ids ON k = {nk('building_name')}),
need AS (SELECT DISTINCT id_building FROM sb WHERE NOT EXISTS (
           SELECT 1 FROM bill b WHERE b.id_building = sb.id_building AND b.issue_date = DATE '1900-01-01')),
l2_bill AS (SELECT id_bill, id_building, month_start, issue_date, due1, due2, CAST(total AS DECIMAL(28,2)) AS total, 'KEEP' AS action FROM bill
            UNION ALL SELECT coalesce((SELECT max(id_bill) FROM bill), 0) + row_number() OVER (ORDER BY id_building), id_building,
                   DATE '1900-01-01', DATE '1900-01-01', NULL, NULL, 0, 'INSERT' FROM need),
l2_rows AS (SELECT b.id_bill, sb.* FROM sb JOIN l2_bill b ON b.id_building = sb.id_building AND b.issue_date = DATE '1900-01-01'),
l2_new AS (SELECT coalesce((SELECT max(id_expense) FROM expense), 0)
                  + row_number() OVER (ORDER BY id_bill, description, supplier, category) AS id_expense, r.*
           FROM l2_rows r WHERE NOT EXISTS (
             SELECT 1 FROM expense e LEFT JOIN ordinary o ON o.id_expense = e.id_expense
             WHERE e.id_building = r.id_building AND e.id_bill = r.id_bill
               AND coalesce(e.description, '') = coalesce(r.description, '') AND coalesce(o.supplier, '') = coalesce(r.supplier, '')
               AND coalesce(o.category, '') = coalesce(r.category, ''))),
l2_exp AS (SELECT id_expense, id_bill, id_building, 'Ordinario' AS kind, description, {AS_OF} AS issue_date,
                  CAST(0 AS DECIMAL(28,2)) AS amount FROM l2_new),
l2_ord AS (SELECT id_expense, supplier, category, CAST(NULL AS VARCHAR) AS invoice FROM l2_new)"""]


def l2_sql(which: str) -> str:
    return with_ledger(RAW_SUPPLIERS, DETAILS, *l2_ctes(), select={"expenses": "SELECT * FROM l2_exp", "ordinary": "SELECT * FROM l2_ord"}[which])


RAW_WORKS = """
raw_works AS (SELECT n_name AS building_name, m.issue_date, 'Obra ' || strftime(o.month_start, '%Y-%m') AS description,
                     CAST(sum(CAST(o_totalprice AS DECIMAL(10,2))) AS DECIMAL(28,2)) AS amount,
                     CAST(month(o.month_start) % 3 + 1 AS BIGINT) AS instalment, CAST(3 AS BIGINT) AS instalments
              FROM ob o JOIN nation ON n_nationkey = id_building JOIN months m ON m.month_start = o.month_start
              WHERE o_orderpriority = '1-URGENT' GROUP BY n_name, o.month_start, m.issue_date)"""


def l9_ctes() -> list[str]:
    return [f"""
{ensured('raw_works', 'w_bld').strip()},
w_rows0 AS (SELECT w.*, id_building FROM raw_works w JOIN w_bld_ids ON k = {nk('building_name')}),
w_need AS (SELECT DISTINCT id_building, issue_date FROM w_rows0 w WHERE NOT EXISTS (
             SELECT 1 FROM bill b WHERE b.id_building = w.id_building AND b.issue_date = w.issue_date)),
w_bill AS (SELECT id_bill, id_building, month_start, issue_date, due1, due2, CAST(total AS DECIMAL(28,2)) AS total, 'KEEP' AS action FROM bill
           UNION ALL SELECT coalesce((SELECT max(id_bill) FROM bill), 0) + row_number() OVER (ORDER BY id_building, issue_date),
                  id_building, CAST(date_trunc('month', issue_date) AS DATE), issue_date, NULL, NULL, 0, 'INSERT' FROM w_need),
w_rows AS (SELECT b.id_bill, w.* FROM w_rows0 w JOIN w_bill b ON b.id_building = w.id_building AND b.issue_date = w.issue_date),
w_new AS (SELECT coalesce((SELECT max(id_expense) FROM expense), 0) + row_number() OVER (ORDER BY id_bill, description, amount) AS id_expense,
                 id_bill, id_building, 'Extraordinario' AS kind, description, issue_date, amount
          FROM w_rows r WHERE NOT EXISTS (
            SELECT 1 FROM expense e WHERE e.id_building = r.id_building AND e.id_bill = r.id_bill AND e.kind = 'Extraordinario'
              AND coalesce(e.description, '') = coalesce(r.description, ''))),
w_sum AS (SELECT id_bill, CAST(sum(amount) AS DECIMAL(28,2)) AS s FROM (SELECT id_bill, amount FROM expense UNION ALL SELECT id_bill, amount FROM w_new)
          WHERE id_bill IN (SELECT id_bill FROM w_rows) GROUP BY id_bill),
w_bill2 AS (SELECT b.* REPLACE (coalesce(s, total) AS total,
                     CASE WHEN s IS NOT NULL AND action = 'KEEP' AND s IS DISTINCT FROM total THEN 'UPDATE' ELSE action END AS action)
            FROM w_bill b LEFT JOIN w_sum USING (id_bill)),
w_ext AS (SELECT e.id_expense, min(instalment) AS instalment, min(instalments) AS instalments
          FROM (SELECT id_expense, id_bill, kind, description FROM expense UNION ALL SELECT id_expense, id_bill, kind, description FROM w_new) e
          JOIN w_rows w ON w.id_bill = e.id_bill AND e.kind = 'Extraordinario' AND coalesce(e.description, '') = coalesce(w.description, '')
          WHERE e.id_expense NOT IN (SELECT id_expense FROM extraordinary) GROUP BY e.id_expense)"""]


def l9_sql(which: str) -> str:
    return with_ledger(RAW_WORKS, DETAILS, *l9_ctes(), select={
        "expenses": "SELECT * FROM w_new JOIN w_ext USING (id_expense)",
        "bills": "SELECT * REPLACE (CAST(total AS DECIMAL(18,2)) AS total) FROM w_bill2", "totals": """
SELECT id_bill, count(*) AS works, max(instalment) AS instalment, max(instalments) AS instalments,
       CAST(any_value(b.total) AS DECIMAL(18,2)) AS total
FROM w_new JOIN w_ext USING (id_expense) JOIN w_bill2 b USING (id_bill) GROUP BY id_bill"""}[which])


def k8_sql() -> str:
    return with_ledger(select="SELECT fx_type, arg_max(sell, quote_ts) AS quote FROM fx_quote GROUP BY fx_type")


def k9_sql(fx: str = "blue") -> str:
    return with_ledger(f"""
q AS (SELECT arg_max(sell, quote_ts) AS quote FROM fx_quote WHERE fx_type = '{fx}')""", select=f"""
SELECT b.id_bill, b.total, CASE WHEN q.quote > 0 THEN {div_money_sql('b.total', 'q.quote')} END AS dollars
FROM bill b LEFT JOIN q ON TRUE""")
