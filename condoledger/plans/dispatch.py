"""J6 with J7 as a job that may run again, and R11's two lists.

Each run makes sure of the bill of the month after a building's last payment
(J6) and registers a dispatch of that bill for every person of the building
(J7). Bills and dispatches are versioned tables that only grow: a dispatch
equal in building, bill and person to a registered one is not registered
again, whether the bill is new or was there before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import upsert as U
from ..sources.ledger import Ledger
from ..sources.versions import Versions
from . import accounts as A

TABLES = {
    "bill": "id_bill bigint, id_building bigint, issue_date date, due1 date, due2 date, total decimal(18,2)",
    "dispatch": "id_dispatch bigint, id_building bigint, id_bill bigint, id_person bigint, channel string, email string, phone string, note string",
}


@dataclass
class Register:
    """The committed bills (those that runs added) and dispatches."""
    versions: Versions

    @property
    def bill(self) -> DataFrame:
        return self.versions.read("bill")

    @property
    def dispatch(self) -> DataFrame:
        return self.versions.read("dispatch")


def run(lg: Ledger, root: str, building: int | None = None, due1_day: int = 10, due2_day: int | None = 22,
        register: bool = True) -> Register:
    """One run over ``root``'s register; ``register`` False only makes the bills."""
    reg = Register(Versions(lg.spark, root, TABLES))
    step = reg.versions.done + 1
    known = lg.bill.select("id_bill", "id_building", "issue_date").unionByName(reg.bill.select("id_bill", "id_building", "issue_date"))
    due = A.due_bills(lg, building, due1_day, due2_day)
    keys = ["id_building", "issue_date"]
    written = {"bill": (reg.versions.write(step, "bill", due.join(known, keys, "left_anti"))[0], True)}
    if register:
        # the bills of that date, made now or before
        targets = due.select(*keys).join(known, keys).unionByName(
            lg.spark.read.parquet(written["bill"][0]).select("id_building", "issue_date", "id_bill"))
        new = U.insert_absent(reg.dispatch, A.dispatches(lg, targets), ["id_building", "id_bill", "id_person"])
        new = U.surrogate_keys(new, reg.dispatch, "id_dispatch", ["id_building", "id_bill", "id_person"])
        written["dispatch"] = (reg.versions.write(step, "dispatch", new)[0], True)
    reg.versions.commit(step, written)
    return reg


def recent_dispatches(reg: Register, n: int = 50, building: int | None = None) -> DataFrame:
    """The n dispatches registered last."""
    d = reg.dispatch
    if building is not None:
        d = d.filter(F.col("id_building") == building)
    return d.orderBy(F.col("id_dispatch").desc()).limit(n)


def registered_twice(lg: Ledger) -> Register:
    """The ledger's register after two runs, the second of which finds all done."""
    if "_register" not in lg.__dict__:
        run(lg, f"{lg.root}/dispatch")
        lg.__dict__["_register"] = run(lg, f"{lg.root}/dispatch")
    return lg.__dict__["_register"]
