"""Expense loaders: L2 (supplier sheet), L3 (monthly JSON), L9 (extraordinary
works), and the merges they drive: U1 (bills), U2 (expenses), E8 (totals).

Each load works on an ``ExpenseState`` and returns what it adds or changes:
parents first (buildings, bills) with keys given in the load, then expenses
under those keys, then the subtype rows (supplier and category of an ordinary
expense, instalments of an extraordinary one) under the expenses' keys.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import clean as K
from ..functions.collation import name_key
from ..operators import upsert as U
from ..operators.joins import store
from ..sources import landing
from ..sources import rawtext as RT
from ..sources.ledger import EXTRAORDINARY, ORDINARY, Ledger
from .accounts import MONEY, DUMMY_DATE
from .unit_loads import building_ids, ensure_buildings

BILL = ["id_bill", "id_building", "month_start", "issue_date", "due1", "due2", "total"]
EXPENSE = ["id_expense", "id_bill", "id_building", "kind", "description", "issue_date", "amount"]
AMOUNT = "decimal(28,2)"


@dataclass
class ExpenseState:
    """The ledger tables that an expense load reads."""
    root: str
    calendar: DataFrame
    building: DataFrame
    bill: DataFrame
    expense: DataFrame
    ordinary: DataFrame        # id_expense, supplier, category, invoice
    extraordinary: DataFrame   # id_expense, instalment, instalments
    as_of: dt.date

    @staticmethod
    def of(lg: Ledger) -> ExpenseState:
        e = lg.expense
        return ExpenseState(lg.root, lg.calendar, lg.building, lg.bill.select(*BILL), e.select(*EXPENSE),
                            e.filter(F.col("kind") == ORDINARY).select("id_expense", "supplier", "category",
                                                                       F.lit(None).cast("string").alias("invoice")),
                            e.filter(F.col("kind") == EXTRAORDINARY).select("id_expense", F.lit(1).cast("bigint").alias("instalment"),
                                                                            F.lit(1).cast("bigint").alias("instalments")), lg.as_of)


@dataclass
class ExpenseLoad:
    """New state of buildings and bills with actions; the rows to insert into
    expenses and their subtype tables."""
    buildings: DataFrame
    bills: DataFrame
    expenses: DataFrame
    ordinary: DataFrame
    extraordinary: DataFrame


def _folder(state: ExpenseState, name: str) -> str:
    return f"{state.root}/{name}-{uuid.uuid4().hex}"


def _money(amount: Column, clamp: bool) -> Column:
    """A loaded amount in full, or clamped to the reference's column width."""
    return (K.clamp_amount(amount) if clamp else amount).cast(AMOUNT)


def _named(rows: DataFrame, buildings: DataFrame) -> DataFrame:
    """Rows with the building of their ``building_name``; unknown names go."""
    return rows.withColumn("_k", name_key("building_name")).join(building_ids(buildings), "_k").drop("_k")


def ensure_bills(bill: DataFrame, wanted: DataFrame) -> DataFrame:
    """U4 + U10: the bills, and an empty one for each (building, date) without one."""
    new = U.insert_absent(bill, wanted.select("id_building", "issue_date").distinct(), ["id_building", "issue_date"])
    new = U.surrogate_keys(new, bill, "id_bill", ["id_building", "issue_date"])
    new = new.select("id_bill", "id_building", F.trunc("issue_date", "month").alias("month_start"), "issue_date",
                     F.lit(None).cast("date").alias("due1"), F.lit(None).cast("date").alias("due2"),
                     F.lit(0).cast(bill.schema["total"].dataType).alias("total"), F.lit(U.INSERT).alias("action"))
    return bill.withColumn("action", F.lit(U.KEEP)).unionByName(new)


def _blank(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


# ------------------------------------------------------------------ L3
def expense_staging(raw: DataFrame, folder: str) -> DataFrame:
    """L3 staging: the JSON rows unpivoted over the categories (D9), building
    name trimmed, year of the row, K15 month, K3 amount (NULL for blank text).
    Stored once: bills and expenses read it, and a filter on the amount is not
    pushed into the parse expressions."""
    u = raw.unpivot(["Nombre del consorcio", "anio", "Mes"], RT.EXPENSE_CATEGORIES, "category", "amount_txt")
    blank = u.amount_txt.isNull() | (u.amount_txt == "")
    parsed = (u.select(K.clean_text("Nombre del consorcio").alias("building_name"), F.col("anio").alias("year"),
                       K.month_number("Mes").alias("month"), "category", "amount_txt")
              .filter(F.col("building_name").isNotNull())
              .transform(K.amount_flexible_on("amount_txt", "_amt"))
              .withColumn("amount", F.when(blank, F.lit(None)).otherwise(F.col("_amt"))).drop("_amt"))
    return store(parsed, f"{folder}/staged")


def monthly_bills(state: ExpenseState, rows: DataFrame, due1_day: int | None, due2_day: int | None, clamp: bool) -> DataFrame:
    """L3 bills: total per building, year and month; date = 5th weekday (K13, no
    holidays); due days clamped to the month (K21)."""
    sums = rows.groupBy("id_building", "month_start").agg(F.sum("amount").alias("total"))
    j = sums.join(cal.nth_day_of_month(state.calendar, 5, "is_weekday"), "month_start", "left")
    y, m = F.year("nth_day"), F.month("nth_day")
    return j.select("id_building", "month_start", F.col("nth_day").alias("issue_date"),
                    K.due_day(y, m, F.lit(due1_day) if due1_day else None).alias("due1"),
                    K.due_day(y, m, F.lit(due2_day) if due2_day else None).alias("due2"),
                    _money(F.col("total"), clamp).alias("total"))


def load_monthly(state: ExpenseState, raw: DataFrame, due1_day: int | None = 10, due2_day: int | None = 20,
                 clamp: bool = False, extraordinary: list[str] | None = None) -> ExpenseLoad:
    """L3 over all years of the file. ``clamp`` cuts amounts to the reference's
    column width (K20); off, they keep every digit. ``extraordinary`` names the
    categories that are extraordinary expenses (none in the reference)."""
    folder = _folder(state, "l3")
    staged = expense_staging(raw, folder)
    buildings = store(ensure_buildings(state.building, staged), f"{folder}/buildings")
    rows = _named(staged, buildings).filter(F.col("amount").isNotNull() & F.col("month").between(1, 12)).withColumn(
        "month_start", F.make_date("year", "month", F.lit(1)))
    rows = store(rows, f"{folder}/rows")
    target = state.bill.withColumn("total", F.col("total").cast(AMOUNT))
    merged = U.merge_upsert(target, monthly_bills(state, rows, due1_day, due2_day, clamp), ["id_building", "issue_date"],
                            ["due1", "due2", "total"], unique=True)        # one bill per building and month
    merged = store(merged, f"{folder}/merged")
    new = U.surrogate_keys(merged.filter(F.col("action") == U.INSERT).drop("id_bill"), target, "id_bill", ["id_building", "issue_date"])
    bills = store(merged.filter(F.col("action") != U.INSERT).unionByName(new.select(*merged.columns)), f"{folder}/bills")
    bill_of = bills.filter(F.col("issue_date").isNotNull()).select("id_bill", "id_building", F.trunc("issue_date", "month").alias("month_start"))
    kind = F.when(F.col("category").isin(extraordinary or []), EXTRAORDINARY).otherwise(ORDINARY)
    found = rows.join(bill_of, ["id_building", "month_start"]).select(
        "id_bill", "id_building", kind.alias("kind"), F.col("category").alias("description"),
        F.col("month_start").alias("issue_date"), _money(F.col("amount"), clamp).alias("amount"))
    keys = {"_b": F.col("id_bill"), "_g": F.col("id_building"), "_t": F.col("kind"), "_d": _blank("description")}
    new = U.insert_absent(state.expense, found, key_exprs=keys)
    new = store(U.surrogate_keys(new, state.expense, "id_expense", ["id_bill", "kind", "description", "amount"]).select(*EXPENSE), f"{folder}/expenses")
    none = F.lit(None).cast("string")
    one = F.lit(1).cast("bigint")
    return ExpenseLoad(buildings, bills, new,
                       new.filter(F.col("kind") == ORDINARY).select("id_expense", none.alias("supplier"), F.col("description").alias("category"),
                                                                    none.alias("invoice")),
                       new.filter(F.col("kind") == EXTRAORDINARY).select("id_expense", one.alias("instalment"), one.alias("instalments")))


# ------------------------------------------------------------------ L2
# Fixed rule of the adapter: supplier -> service category of the sheet.
SUPPLIER_TYPES = ["GASTOS BANCARIOS", "GASTOS DE LIMPIEZA", "GASTOS DE ADMINISTRACION", "SEGUROS",
                  "SERVICIOS PUBLICOS"]


def raw_suppliers(lg: Ledger) -> DataFrame:
    """Supplier sheet (A2 layout) from the supplier table."""
    s = lg.raw("supplier", "s_suppkey", "s_name", "s_nationkey")
    n = lg.building.select(F.col("id_building").alias("n_nationkey"), F.col("name").alias("n_name"))
    t = F.element_at(F.array(*[F.lit(x) for x in SUPPLIER_TYPES]), (F.col("s_suppkey") % 5 + 1).cast("int"))
    return (s.join(n, s.s_nationkey == n.n_nationkey)
            .select(t.alias("tipo"), F.concat(F.lit(" Servicio "), F.col("s_suppkey").cast("string")).alias("descripcion"),
                    F.col("s_name").alias("proveedor"), F.concat(F.col("n_name"), F.lit(" ")).alias("consorcio")))


def load_suppliers(state: ExpenseState, raw: DataFrame, bill_date: dt.date = DUMMY_DATE) -> ExpenseLoad:
    """L2: suppliers attached to their building's bill at ``bill_date`` (a dummy
    bill by default, created when absent), as zero-amount ordinary expenses
    dated as_of, inserted unless (building, bill, description, supplier,
    category) exists."""
    folder = _folder(state, "l2")
    s = raw.select(K.clean_text("tipo", 35).alias("category"), K.clean_text("descripcion", 200).alias("description"),
                   K.clean_text("proveedor", 100).alias("supplier"), K.clean_text("consorcio", 50).alias("building_name"))
    s = store(_named(s.filter(F.col("building_name").isNotNull()), state.building).withColumn("issue_date", F.lit(bill_date)), f"{folder}/rows")
    bills = store(ensure_bills(state.bill, s), f"{folder}/bills")
    rows = s.join(bills.select("id_bill", "id_building", "issue_date"), ["id_building", "issue_date"])
    keys = {"_g": F.col("id_building"), "_b": F.col("id_bill"), "_d": _blank("description"), "_s": _blank("supplier"), "_c": _blank("category")}
    known = state.expense.join(state.ordinary, "id_expense", "left")
    new = U.insert_absent(known, rows, key_exprs=keys)
    new = U.surrogate_keys(new, state.expense, "id_expense", ["id_bill", "description", "supplier", "category"])
    new = store(new.select("id_expense", "id_bill", "id_building", F.lit(ORDINARY).alias("kind"), "description",
                           F.lit(state.as_of).alias("issue_date"), F.lit(0).cast(AMOUNT).alias("amount"), "supplier", "category"), f"{folder}/expenses")
    return ExpenseLoad(state.building.withColumn("action", F.lit(U.KEEP)), bills, new.select(*EXPENSE),
                       new.select("id_expense", "supplier", "category", F.lit(None).cast("string").alias("invoice")),
                       state.extraordinary.limit(0))


# ------------------------------------------------------------------ L9
def extraordinary_works(lg: Ledger) -> DataFrame:
    """Extraordinary works per building and month of all years, from the urgent
    orders: date (the month's 5th business day), description, amount,
    instalment n of 3."""
    o = lg.orders_b.filter(F.col("o_orderpriority") == "1-URGENT")
    g = o.groupBy("id_building", "month_start").agg(F.sum(F.col("o_totalprice").cast("decimal(10,2)")).alias("amount"))
    names = lg.building.select("id_building", F.col("name").alias("building_name"))
    return (g.join(names, "id_building").join(lg.months_b.df.select("month_start", "issue_date"), "month_start")
            .select("building_name", "issue_date", F.concat(F.lit("Obra "), F.date_format("month_start", "yyyy-MM")).alias("description"),
                    F.col("amount").cast(AMOUNT).alias("amount"), (F.month("month_start") % 3 + 1).cast("bigint").alias("instalment"),
                    F.lit(3).cast("bigint").alias("instalments")))


def load_works(state: ExpenseState, works: DataFrame) -> ExpenseLoad:
    """Buildings and bills made sure of; each work inserted as an
    'Extraordinario' expense of the bill of its date when absent, with its
    instalments; the totals of the works' bills recomputed (E8)."""
    folder = _folder(state, "l9")
    buildings = store(ensure_buildings(state.building, works), f"{folder}/buildings")
    rows = store(_named(works, buildings), f"{folder}/rows")
    bills = store(ensure_bills(state.bill, rows), f"{folder}/bills")
    rows = rows.join(bills.select("id_bill", "id_building", "issue_date"), ["id_building", "issue_date"]).withColumn("kind", F.lit(EXTRAORDINARY))
    keys = {"_g": F.col("id_building"), "_b": F.col("id_bill"), "_t": F.col("kind"), "_d": _blank("description")}
    new = U.insert_absent(state.expense, rows, key_exprs=keys)
    new = store(U.surrogate_keys(new, state.expense, "id_expense", ["id_bill", "description", "amount"]), f"{folder}/expenses")
    sums = state.expense.select("id_bill", "amount").unionByName(new.select("id_bill", "amount")).groupBy("id_bill").agg(F.sum("amount").alias("_sum"))
    touched = rows.select("id_bill").distinct().join(sums, "id_bill").withColumn("_sum", F.col("_sum").cast(state.bill.schema["total"].dataType))
    j = bills.join(touched, "id_bill", "left")
    changed = F.col("_sum").isNotNull() & (F.col("action") == U.KEEP) & ~F.col("_sum").eqNullSafe(F.col("total"))
    bills = j.select(*[F.coalesce("_sum", "total").alias("total") if c == "total" else F.col(c) for c in BILL],
                     F.when(changed, F.lit(U.UPDATE)).otherwise(F.col("action")).alias("action"))
    # details for the works' expenses, new or known, that have none
    of_work = rows.select("id_bill", "kind", "description", "instalment", "instalments")
    both = state.expense.select("id_expense", "id_bill", "kind", "description").unionByName(new.select("id_expense", "id_bill", "kind", "description"))
    detail = (both.join(of_work.withColumnsRenamed({"description": "_work"}), ["id_bill", "kind"])
              .filter(_blank("description") == _blank("_work")).groupBy("id_expense").agg(F.min(F.struct("instalment", "instalments")).alias("_i"))
              .select("id_expense", "_i.instalment", "_i.instalments")
              .join(state.extraordinary.select("id_expense"), "id_expense", "left_anti"))
    return ExpenseLoad(buildings, bills, new.select(*EXPENSE), state.ordinary.limit(0), detail)


# ------------------------------------------------------------------ jobs on the ledger
def _once(lg: Ledger, name: str, make) -> ExpenseLoad:
    loads = lg.__dict__.setdefault("_expense_loads", {})
    if name not in loads:
        loads[name] = make()
    return loads[name]


def monthly_load(lg: Ledger) -> ExpenseLoad:
    return _once(lg, "l3", lambda: load_monthly(ExpenseState.of(lg), landing.expenses(lg)))


def supplier_load(lg: Ledger) -> ExpenseLoad:
    return _once(lg, "l2", lambda: load_suppliers(ExpenseState.of(lg), landing.suppliers(lg, raw_suppliers(lg))))


def works_load(lg: Ledger) -> ExpenseLoad:
    return _once(lg, "l9", lambda: load_works(ExpenseState.of(lg), extraordinary_works(lg)))


def merge_expenses(lg: Ledger) -> DataFrame:
    """The expenses after the monthly file, with their actions."""
    old = lg.expense.select(*EXPENSE).withColumn("amount", F.col("amount").cast(AMOUNT)).withColumn("action", F.lit(U.KEEP))
    return old.unionByName(monthly_load(lg).expenses.withColumn("action", F.lit(U.INSERT)))


def work_totals(lg: Ledger) -> DataFrame:
    """E8 of L9: works and new total of each bill that got some."""
    load = works_load(lg)
    per = load.expenses.join(load.extraordinary, "id_expense").groupBy("id_bill").agg(
        F.count(F.lit(1)).alias("works"), F.max("instalment").alias("instalment"), F.max("instalments").alias("instalments"))
    return per.join(load.bills.select("id_bill", F.col("total").cast(MONEY).alias("total")), "id_bill")
