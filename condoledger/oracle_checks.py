"""DuckDB oracle SQL of the full row, key and foreign-key checks."""

from __future__ import annotations

from .oracle import accounts_sql, with_ledger
from .oracle_expenses import DETAILS
from .oracle_jobs import j7_register_sql
from .oracle_load import RAW, chain
from .plans.checks import DAMAGE, FOREIGN, KEYS

CBU = "NOT regexp_full_match(cbu, '[0-9]*')"
BROKEN = [("person", "id_person", "dni_range", "dni <= 0 OR dni >= 100000000"), ("person", "id_person", "cbu_digits", CBU),
          ("building", "id_building", "total_area_positive", "total_area <= 0"),
          ("unit", "id_unit", "area_non_negative", "area < 0"), ("unit", "id_unit", "storage_non_negative", "storage_m2 < 0"),
          ("unit", "id_unit", "garage_non_negative", "garage_m2 < 0"), ("unit", "id_unit", "share_range", "share <= 0 OR share > 100"),
          ("unit", "id_unit", "cbu_digits", CBU),
          ("bill", "id_bill", "due1_after_issue", "due1 < issue_date"), ("bill", "id_bill", "due2_after_due1", "due2 < due1"),
          ("bill", "id_bill", "total_non_negative", "total < 0"),
          ("expense", "id_expense", "kind_enum", "kind <> 'Ordinario' AND kind <> 'Extraordinario'"),
          ("expense", "id_expense", "amount_non_negative", "amount < 0"),
          ("extraordinary", "id_expense", "instalment_positive", "instalment <= 0"),
          ("extraordinary", "id_expense", "instalments_positive", "instalments <= 0"),
          ("extraordinary", "id_expense", "instalment_within", "instalment > instalments"),
          ("account", "id_account", "interest_non_negative", "interest < 0"),
          ("payment", "id_payment", "amount_positive", "amount <= 0"), ("payment", "id_payment", "cbu_digits", CBU),
          ("dispatch", "id_dispatch", "channel_enum", "channel NOT IN ('EMAIL', 'WHATSAPP', 'IMPRESO')"),
          ("log", "step_no", "level_enum", "level NOT IN ('INFO', 'WARN', 'ERROR')")]
TABLES = ["person", "building", "unit", "occupancy", "bill", "expense", "ordinary", "extraordinary", "account", "payment", "dispatch"]


def _damaged(table: str) -> str:
    rules = ", ".join(f"CASE WHEN {cond} THEN {value} ELSE {c} END AS {c}" for c, (cond, value) in DAMAGE.get(table, {}).items())
    return f"SELECT * {f'REPLACE ({rules})' if rules else ''} FROM {table}"


def _scope(select: str) -> str:
    """``select`` over the damaged tables d_<table> of the ledger."""
    register = j7_register_sql()
    dispatch = f"dispatch AS ({register})"
    return with_ledger(accounts_sql(), DETAILS, dispatch, *[f"d_{t} AS ({_damaged(t)})" for t in TABLES], select=select)


def _report(tbl: str, rule: str, ids: str) -> str:
    return f"""SELECT '{tbl}' AS tbl, '{rule}' AS rule, count(*) AS violations,
       coalesce((SELECT string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FROM (SELECT id FROM ({ids}) ORDER BY id LIMIT 5)), '') AS sample
FROM ({ids})"""


def _rows(tables, prefix: str) -> list[str]:
    return [_report(t, rule, f"SELECT {key} AS id FROM {prefix}{t} WHERE {cond}") for t, key, rule, cond in BROKEN if t in tables]


def _orphans(tables, prefix: str) -> list[str]:
    out = []
    for child, cols, parent, key in FOREIGN:
        if child in tables:
            on = " AND ".join(f"p.{c} = c.{c}" for c in cols)
            given = " AND ".join(f"c.{c} IS NOT NULL" for c in cols)
            ids = f"SELECT c.{key} AS id FROM {prefix}{child} c WHERE {given} AND NOT EXISTS (SELECT 1 FROM {prefix}{parent} p WHERE {on})"
            out.append(_report(child, f"{'+'.join(cols)} in {parent}", ids))
    return out


def q1_bad_rows_sql() -> str:
    return _scope("\nUNION ALL\n".join(_rows(TABLES, "d_")))


def q3_orphan_rows_sql() -> str:
    return _scope("\nUNION ALL\n".join(_orphans(TABLES, "d_")))


def q2_repeated_keys_sql() -> str:
    parts = []
    for table, cols, skip_null in KEYS:
        where = "WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols) if skip_null else ""
        k = ", ".join(cols)
        parts.append(f"""SELECT '{table}' AS tbl, '{"+".join(cols)}' AS key, count(*) AS repeated, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows
FROM (SELECT count(*) AS n FROM d_{table} {where} GROUP BY {k} HAVING count(*) > 1)""")
    return _scope("\nUNION ALL\n".join(parts))


def whole_load_checks_sql() -> str:
    from .oracle_load import _log_rows
    c = chain()
    state = [f"d_{t} AS (SELECT * FROM {name})" for t, name in c.now.items()]
    log = "d_log AS (" + "\nUNION ALL\n".join(_log_rows()) + ")"
    tables = [*c.now, "log"]
    return with_ledger(*RAW, *c.ctes, *state, log, select="\nUNION ALL\n".join([*_rows(tables, "d_"), *_orphans(tables, "d_")]))
