"""Q1-Q3 in full over a set of ledger tables: row checks, keys, foreign keys.

Each table is read once for all of its row checks: a row gives one (rule, id)
per rule that it breaks, stored; the counts and a bounded sample of ids per
rule (the SAMPLE smallest) come from those. Samples are cut before the shuffle
(a ranking window with a limit), so a rule that most rows break costs no more
than its count. A check holds where its column is NULL, as in SQL.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import store, unbounded
from ..sources.ledger import Ledger
from . import dispatch as DP
from .expenses import ExpenseState

SAMPLE = 5
DIGITS = "[0-9]*"

# table -> (id, rule -> what breaks it)
ROW_CHECKS: dict[str, tuple[str, dict[str, str]]] = {
    "person": ("id_person", {"dni_range": "NOT (dni > 0 AND dni < 100000000)", "cbu_digits": f"NOT cbu RLIKE '^{DIGITS}$'"}),
    "building": ("id_building", {"total_area_positive": "total_area <= 0"}),
    "unit": ("id_unit", {"area_non_negative": "area < 0", "storage_non_negative": "storage_m2 < 0", "garage_non_negative": "garage_m2 < 0",
                         "share_range": "NOT (share > 0 AND share <= 100)", "cbu_digits": f"NOT cbu RLIKE '^{DIGITS}$'"}),
    "bill": ("id_bill", {"due1_after_issue": "due1 < issue_date", "due2_after_due1": "due2 < due1", "total_non_negative": "total < 0"}),
    "expense": ("id_expense", {"kind_enum": "kind NOT IN ('Ordinario', 'Extraordinario')", "amount_non_negative": "amount < 0"}),
    "extraordinary": ("id_expense", {"instalment_positive": "instalment <= 0", "instalments_positive": "instalments <= 0",
                                     "instalment_within": "instalment > instalments"}),
    "account": ("id_account", {"interest_non_negative": "interest < 0"}),
    "payment": ("id_payment", {"amount_positive": "amount <= 0", "cbu_digits": f"NOT cbu RLIKE '^{DIGITS}$'"}),
    "dispatch": ("id_dispatch", {"channel_enum": "channel NOT IN ('EMAIL', 'WHATSAPP', 'IMPRESO')"}),
    "log": ("step_no", {"level_enum": "level NOT IN ('INFO', 'WARN', 'ERROR')"}),
}
# table, key columns; a key with a NULL is none where it says so
KEYS: list[tuple[str, list[str], bool]] = [
    ("unit", ["id_unit", "id_building"], False), ("unit", ["cbu"], True), ("person", ["id_person"], False), ("person", ["cbu"], True),
    ("occupancy", ["id_person"], False), ("building", ["id_building"], False), ("bill", ["id_bill"], False),
    ("bill", ["issue_date", "id_building"], False), ("expense", ["id_expense"], False), ("ordinary", ["id_expense"], False),
    ("extraordinary", ["id_expense"], False), ("account", ["id_account", "id_unit", "id_building"], False),
    ("payment", ["id_payment"], False), ("dispatch", ["id_dispatch"], False), ("dispatch", ["id_building", "id_bill", "id_person"], False)]
# Parents whose keys grow with the ledger: sorted for the join, not hashed or broadcast.
GROWING = {"person", "unit", "expense", "account"}
# child, columns, parent (whose columns have the same names), id of the child row
FOREIGN: list[tuple[str, list[str], str, str]] = [
    ("unit", ["id_building"], "building", "id_unit"), ("occupancy", ["id_person"], "person", "id_person"),
    ("occupancy", ["id_building"], "building", "id_person"), ("bill", ["id_building"], "building", "id_bill"),
    ("expense", ["id_building"], "building", "id_expense"), ("expense", ["id_bill"], "bill", "id_expense"),
    ("ordinary", ["id_expense"], "expense", "id_expense"), ("extraordinary", ["id_expense"], "expense", "id_expense"),
    ("account", ["id_unit", "id_building"], "unit", "id_account"), ("account", ["id_bill"], "bill", "id_account"),
    ("account", ["id_building"], "building", "id_account"), ("payment", ["id_account", "id_unit", "id_building"], "account", "id_payment"),
    ("payment", ["id_bill"], "bill", "id_payment"), ("dispatch", ["id_building"], "building", "id_dispatch"),
    ("dispatch", ["id_bill"], "bill", "id_dispatch"), ("dispatch", ["id_person"], "person", "id_dispatch")]


def _report(broken: DataFrame, rules: list[str], table: str) -> DataFrame:
    """(tbl, rule, violations, sample) of stored (rule, id) rows, for every rule."""
    w = Window.partitionBy("rule").orderBy("id")
    sample = (broken.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= SAMPLE).groupBy("rule")
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("id")), lambda x: x.cast("string")), ",").alias("sample")))
    counts = broken.groupBy("rule").agg(F.count(F.lit(1)).alias("violations"))
    every = broken.sparkSession.createDataFrame([(r,) for r in rules], "rule string")
    return (every.join(counts, "rule", "left").join(sample, "rule", "left")
            .select(F.lit(table).alias("tbl"), "rule", F.coalesce("violations", F.lit(0)).alias("violations"), F.coalesce("sample", F.lit("")).alias("sample")))


def row_checks(tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Q1: for each check its violations and a sample of the rows' ids."""
    parts = []
    for table, (key, rules) in ROW_CHECKS.items():
        if table in tables:
            names = [F.when(F.expr(cond), rule) for rule, cond in rules.items()]
            bad = tables[table].select(F.col(key).alias("id"), F.explode(F.array_compact(F.array(*names))).alias("rule"))
            parts.append(_report(store(bad, f"{folder}/q1-{table}"), list(rules), table))
    return reduce(DataFrame.unionByName, parts)


def key_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Q2: for each key the values that several rows have, and how many rows."""
    parts = []
    for table, cols, skip_null in KEYS:
        if table in tables:
            df = tables[table].dropna(subset=cols) if skip_null else tables[table]
            twice = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            parts.append(twice.agg(F.count(F.lit(1)).alias("repeated"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
                         .select(F.lit(table).alias("tbl"), F.lit("+".join(cols)).alias("key"), "repeated", "n_rows"))
    return reduce(DataFrame.unionByName, parts)


def foreign_checks(tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Q3: for each foreign key its orphans and a sample of their ids; a key with
    a NULL refers to nothing and holds."""
    parts = []
    for n, (child, cols, parent, key) in enumerate(FOREIGN):
        if child in tables:
            rule = f"{'+'.join(cols)} in {parent}"
            refers = tables[child].dropna(subset=cols)
            keys = tables[parent].select(*cols)
            orphans = refers.join(unbounded(keys) if parent in GROWING else keys.distinct(), cols, "left_anti")
            orphans = store(orphans.select(F.lit(rule).alias("rule"), F.col(key).alias("id")), f"{folder}/q3-{n}")
            parts.append(_report(orphans, [rule], child))
    return reduce(DataFrame.unionByName, parts)


# What the checks are tried on: the ledger with damage by a fixed rule of the
# adapter (column -> condition, value), as plain expressions.
DAMAGE: dict[str, dict[str, tuple[str, str]]] = {
    "person": {"dni": ("id_person % 53 = 1", "0"), "cbu": ("id_person % 59 = 2", "'22X'")},
    "building": {"total_area": ("id_building % 9 = 1", "0")},
    "unit": {"share": ("id_unit % 53 = 1", "101"), "area": ("id_unit % 59 = 2", "-1"), "storage_m2": ("id_unit % 61 = 3", "-1"),
             "garage_m2": ("id_unit % 67 = 4", "-1"), "cbu": ("id_unit % 71 = 5", "'1-2'"), "id_building": ("id_unit % 73 = 6", "-1")},
    "occupancy": {"id_person": ("id_person % 53 = 1", "-1"), "id_building": ("id_person % 59 = 2", "-1")},
    "bill": {"due1": ("id_bill % 53 = 1", "DATE '1990-01-01'"), "due2": ("id_bill % 59 = 2", "DATE '1990-01-01'"),
             "total": ("id_bill % 61 = 3", "-1"), "id_building": ("id_bill % 67 = 4", "-1")},
    "expense": {"kind": ("id_expense % 53 = 1", "'Otro'"), "amount": ("id_expense % 59 = 2", "-1"), "id_bill": ("id_expense % 61 = 3", "-1"),
                "id_building": ("id_expense % 67 = 4", "NULL")},
    "extraordinary": {"instalment": ("id_expense % 53 = 1", "0"), "instalments": ("id_expense % 59 = 2", "0"), "id_expense": ("id_expense % 61 = 3", "-1")},
    "account": {"interest": ("id_unit % 53 = 1", "-1"), "id_unit": ("id_unit % 59 = 2", "-1"), "id_bill": ("id_unit % 61 = 3", "-1")},
    "payment": {"amount": ("id_unit % 53 = 1", "0"), "cbu": ("id_unit % 59 = 2", "'x'"), "id_account": ("id_unit % 61 = 3", "-1"),
                "id_bill": ("id_unit % 67 = 4", "NULL")},
    "dispatch": {"channel": ("id_dispatch % 53 = 1", "'FAX'"), "id_person": ("id_dispatch % 59 = 2", "-1")},
}


def _damaged(df: DataFrame, rules: dict[str, tuple[str, str]]) -> DataFrame:
    def cell(c: str) -> Column:
        cond, value = rules[c]
        return F.expr(f"CASE WHEN {cond} THEN {value} ELSE {c} END").cast(df.schema[c].dataType).alias(c)
    return df.select(*[cell(c) if c in rules else F.col(c) for c in df.columns])


def ledger_tables(lg: Ledger) -> dict[str, DataFrame]:
    e = ExpenseState.of(lg)
    return {"person": lg.person, "building": lg.building, "unit": lg.unit, "occupancy": lg.occupancy, "bill": lg.bill, "expense": lg.expense,
            "ordinary": e.ordinary, "extraordinary": e.extraordinary, "account": lg.account, "payment": lg.payment,
            "dispatch": DP.registered_twice(lg).dispatch}


def damaged_tables(lg: Ledger) -> dict[str, DataFrame]:
    return {name: _damaged(df, DAMAGE.get(name, {})) for name, df in ledger_tables(lg).items()}


def _folder(lg: Ledger) -> str:
    return f"{lg.root}/checks-{uuid.uuid4().hex}"


def q1_bad_rows(lg: Ledger) -> DataFrame:
    return row_checks(damaged_tables(lg), _folder(lg))


def q2_repeated_keys(lg: Ledger) -> DataFrame:
    return key_checks(damaged_tables(lg))


def q3_orphan_rows(lg: Ledger) -> DataFrame:
    return foreign_checks(damaged_tables(lg), _folder(lg))


def whole_load_checks(lg: Ledger) -> DataFrame:
    """Q1 and Q3 over the tables that L10 leaves, none of them damaged."""
    from . import load_run as LR
    st = LR.whole_load(lg)
    tables = {t: getattr(st, t) for t in LR.TABLES if t != "reject"}
    return row_checks(tables, _folder(lg)).unionByName(foreign_checks(tables, _folder(lg)))
