"""The whole load as steps over versioned tables, with run log (B5) and
reject sink (B6).

Starting from an empty ledger, each step reads what the step before it
committed: buildings, suppliers, units, areas, people, monthly expenses,
accounts (J2, J1), payments, extraordinary works, interest (J4). A run that
stops anywhere goes on at the step that did not commit, and gives the tables
that an undisturbed run gives.

The log gets one row per table a step wrote, with the counts taken during the
write, and a warning per step with rejects; rows of a step count with its
commit. An error is logged on its own and raised. The reject sink only ever
grows: a reject equal in reason, three fields and file to one that is there
is not added, so a replayed file adds none.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import upsert as U
from ..operators.joins import store, unbounded
from ..sources import landing
from ..sources.ledger import Ledger
from ..sources.versions import Versions
from . import accounts as A
from . import expenses as X
from . import ingest as I
from . import loaders as LD
from . import unit_loads as UL

TABLES = {
    "building": "id_building bigint, name string, address string, total_area decimal(10,2)",
    "unit": "id_unit bigint, id_building bigint, floor int, dept string, area decimal(7,2), storage_m2 decimal(5,2), "
            "garage_m2 decimal(5,2), share decimal(5,2), cbu string",
    "person": "id_person bigint, first_name string, last_name string, dni bigint, email string, phone string, cbu string",
    "occupancy": "id_person bigint, id_building bigint, is_tenant boolean",
    "bill": "id_bill bigint, id_building bigint, month_start date, issue_date date, due1 date, due2 date, total decimal(28,2)",
    "expense": "id_expense bigint, id_bill bigint, id_building bigint, kind string, description string, issue_date date, amount decimal(28,2)",
    "ordinary": "id_expense bigint, supplier string, category string, invoice string",
    "extraordinary": "id_expense bigint, instalment bigint, instalments bigint",
    "account": "id_account bigint, id_unit bigint, id_building bigint, id_bill bigint, acct_date date, prev_balance decimal(18,2), "
               "ord_amount decimal(18,2), ext_amount decimal(18,2), paid decimal(18,2), debt decimal(18,2), interest decimal(18,2), "
               "total_due decimal(18,2)",
    "payment": "id_payment bigint, id_account bigint, id_unit bigint, id_building bigint, id_bill bigint, pay_date date, "
               "amount decimal(12,2), cbu string",
    "reject": "reason string, field1 string, field2 string, field3 string, file string",
    "log": "step_no bigint, proc string, level string, message string, detail string, source string",
}
# Levels and messages of the run log.
INFO, WARN, ERROR = "INFO", "WARN", "ERROR"
DONE, REJECTED = "Fin OK", "Filas rechazadas"


class State:
    """The committed tables, under the names the plans know from a ledger."""

    def __init__(self, lg: Ledger, versions: Versions):
        self.spark, self.root, self.as_of = lg.spark, versions.root, lg.as_of
        self.calendar, self.files, self.versions = lg.calendar, lg, versions

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.versions.read(name)
        raise AttributeError(name)

    def expenses(self) -> X.ExpenseState:
        return X.ExpenseState(self.root, self.calendar, self.building, self.bill, self.expense, self.ordinary, self.extraordinary, self.as_of)


@dataclass
class Step:
    """What a step leaves: tables to replace, rows to append, rejects."""
    replace: dict[str, DataFrame] = field(default_factory=dict)
    append: dict[str, DataFrame] = field(default_factory=dict)
    rejects: DataFrame | None = None


def _rejects(df: DataFrame, f1: Column, f2: Column, f3: Column, file: Column) -> DataFrame:
    return df.select("reason", f1.cast("string").alias("field1"), f2.cast("string").alias("field2"), f3.cast("string").alias("field3"),
                     file.alias("file"))


def buildings(st: State) -> Step:
    return Step({"building": LD.upsert_buildings(st.building, LD.buildings_staging(st.files))})


def suppliers(st: State) -> Step:
    load = X.load_suppliers(st.expenses(), landing.suppliers(st.files, X.raw_suppliers(st.files)))
    return Step({"bill": load.bills}, {"expense": load.expenses, "ordinary": load.ordinary})


def units(st: State) -> Step:
    load = UL.load_units(st, landing.units(st.files), st.unit, st.building)
    place = F.concat_ws("|", F.coalesce("building_name", F.lit("")), F.coalesce(F.col("floor").cast("string"), F.lit("")),
                        F.coalesce("dept", F.lit("")))
    return Step({"building": load.buildings, "unit": load.units}, {},
                _rejects(load.rejects, F.col("unit"), place, F.col("cbu"), F.lit("units.txt")))


def areas(st: State) -> Step:
    load = UL.load_areas(st, landing.areas(st.files), st.unit, st.building)
    return Step({"building": load.buildings, "unit": load.units})


def people(st: State) -> Step:
    staged = store(LD.people_staging(st.files), f"{UL._folder(st, 'l6')}/staged")
    person = store(LD.upsert_people(st.person, staged), f"{UL._folder(st, 'l6')}/person")
    return Step({"person": person, "occupancy": LD.upsert_occupancy(st.occupancy, staged, person, st.unit)})


def _expense_step(load: X.ExpenseLoad) -> Step:
    return Step({"building": load.buildings, "bill": load.bills},
                {"expense": load.expenses, "ordinary": load.ordinary, "extraordinary": load.extraordinary})


def monthly(st: State) -> Step:
    return _expense_step(X.load_monthly(st.expenses(), landing.expenses(st.files)))


def recompute(st: State) -> Step:
    """J2 after the expenses: the accounts of all bills with a total."""
    new = A.recompute_accounts(st)
    return Step({"account": new.unionByName(st.account.join(unbounded(new.select("id_account")), "id_account", "left_anti"))})


def missing_accounts(st: State) -> Step:
    """Accounts of the units and bills that have none, without amounts."""
    new = store(A.generate_accounts(st, None, st.account), f"{UL._folder(st, 'j1')}/new")
    if not new.isEmpty():                      # else the numbers of all accounts need not move
        new = new.join(unbounded(st.account.select("id_account")), "id_account", "left_anti")
    rest = [c for c in A.ACCOUNT_COLS if c not in new.columns]
    return Step({}, {"account": new.select("*", *[F.lit(None).alias(c) for c in rest])})


def payments(st: State) -> Step:
    load = I.load_payments(st, landing.payments(st.files), keep=True)
    new = U.surrogate_keys(load.ok.filter(F.col("action") == U.INSERT), st.payment, "id_payment",
                           ["pay_date", "id_unit", "id_bill", "amount", "cbu", "id_account"])
    return Step({}, {"payment": new}, _rejects(load.rejects, F.col("date_txt"), F.col("cbu_txt"), F.col("amount_txt"), F.col("file")))


def works(st: State) -> Step:
    return _expense_step(X.load_works(st.expenses(), X.extraordinary_works(st.files)))


def interest(st: State) -> Step:
    return Step({"account": A.recompute_interest(st, st.account, "M2")})


# (procedure, source file, step)
STEPS: list[tuple[str, str | None, Callable[[State], Step]]] = [
    ("L1 buildings", "buildings.csv", buildings), ("L2 suppliers", "suppliers.csv", suppliers), ("L4 units", "units.txt", units),
    ("L5 areas", "areas.txt", areas), ("L6 people", "people.csv", people), ("L3 monthly expenses", "expenses.json", monthly),
    ("J2 accounts", None, recompute), ("J1 missing accounts", None, missing_accounts), ("L7 payments", "payments.csv", payments),
    ("L9 extraordinary works", None, works), ("J4 interest", None, interest)]


def new_rejects(known: DataFrame, rejects: DataFrame) -> DataFrame:
    """The rejects that the sink does not have, blanks equal to blanks."""
    names = ["reason", "field1", "field2", "field3", "file"]
    return U.insert_absent(known, rejects, key_exprs={f"_{c}": F.coalesce(c, F.lit("\0")) for c in names})


def run_step(st: State, number: int, proc: str, source: str | None, step: Callable[[State], Step]) -> None:
    """Run one step, write what it leaves and commit it with its log rows."""
    v = st.versions
    result, written, log = step(st), {}, []
    for appended, tables in ((False, result.replace), (True, result.append)):
        for name, df in tables.items():
            path, n = v.write(number, name, df)
            written[name] = (path, appended)
            log.append((number, proc, INFO, DONE, f"{name}: rows={n['rows']}; inserted={n['inserted']}; updated={n['updated']}", source))
    if result.rejects is not None:
        path, n = v.write(number, "reject", new_rejects(st.reject, result.rejects))
        written["reject"] = (path, True)
        if n["rows"]:
            log.append((number, proc, WARN, REJECTED, f"rejects={n['rows']}", source))
    path, _ = v.write(number, "log", st.spark.createDataFrame(log, TABLES["log"]).coalesce(1))
    written["log"] = (path, True)
    v.commit(number, written)


def run(lg: Ledger, root: str, steps=None) -> State:
    """Run the steps that ``root`` has not committed, in order."""
    st = State(lg, Versions(lg.spark, root, TABLES))
    for number, (proc, source, step) in enumerate(steps or STEPS, 1):
        if number <= st.versions.done:
            continue
        try:
            run_step(st, number, proc, source, step)
        except Exception as e:
            row = [(number, proc, ERROR, type(e).__name__, str(e)[:4000], source)]
            lg.spark.createDataFrame(row, TABLES["log"]).write.mode("append").parquet(f"{root}/errors")
            raise
    return st


def errors(spark: SparkSession, root: str) -> DataFrame:
    """Errors that stopped earlier runs of ``root`` (to be read where there was one)."""
    return spark.read.schema(TABLES["log"]).parquet(f"{root}/errors")


def whole_load(lg: Ledger) -> State:
    """L10 over the landed files of a ledger, once."""
    if "_whole_load" not in lg.__dict__:
        lg.__dict__["_whole_load"] = run(lg, f"{lg.root}/l10")
    return lg.__dict__["_whole_load"]
