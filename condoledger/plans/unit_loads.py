"""Unit loaders in full: L4 (units and bank ids), L5 (shares and areas).

Both read a file, make sure its buildings exist (U4, U10), match its rows to
units and insert the rest. L4 runs three passes, each on the state that the
one before it left:

  by id        rows with a unit id, in that unit's own building: floor and
               department (U6, each under its own guard, a blank keeps the
               old value) and the bank id (U7)
  by place     rows without a unit id, by building, floor and department,
               blanks matching blanks (C7): the bank id (U7)
  insert       rows of no unit by id nor by place, under new keys (the file's
               ids are not forced)

Where several units share a place, the lowest one is meant. Where several
rows mean one unit, one whole row is taken, the first by bank id, floor and
department with blanks last. A bank id belongs to one unit over all passes: a
row loses its bank id where a unit holds it before the pass, or a lower unit
(in the insert pass: a lower row by building, floor, department and id)
claims it in the same pass. Whatever a row asked for and did not get is a
reject with its reason. Names are equal under the ledger's collation (D12).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean as K
from ..functions.collation import name_key
from ..operators import upsert as U
from ..operators.joins import store, unbounded
from ..sources import landing
from ..sources.ledger import Ledger

NO_BUILDING = "no building name"
REPEATED = "another row of the file stands for this unit"
OTHER_BUILDING = "unit of another building"
KNOWN_PLACE = "a unit of this building, floor and department exists"
BANK_ID_TAKEN = "bank id belongs to another unit"

ROW = ["unit", "building_name", "floor", "dept", "cbu"]
AREAS = ["share", "area", "storage_m2", "garage_m2"]


@dataclass
class Load:
    """What a load leaves: the units and buildings with their actions, the
    rejected rows with reasons, and one row of counts (B7)."""
    units: DataFrame
    buildings: DataFrame
    rejects: DataFrame
    summary: DataFrame


def _folder(lg: Ledger, name: str) -> str:
    return f"{lg.root}/{name}-{uuid.uuid4().hex}"


def unit_number(c: Column | str) -> Column:
    """A unit id of digits, else NULL."""
    t = K.trim_spaces(c)
    return F.when(t.rlike("^[0-9]+$"), t).try_cast("bigint")


def ensure_buildings(buildings: DataFrame, names: DataFrame) -> DataFrame:
    """U4 + U10: the buildings, and one new one for each name that none has."""
    new = (names.select(F.col("building_name").alias("name"), name_key("building_name").alias("_k"))
           .groupBy("_k").agg(F.min("name").alias("name")))
    known = buildings.select(name_key("name").alias("_k"))
    new = new.join(known, "_k", "left_anti").select("name")
    numbered = U.surrogate_keys(new, buildings, "id_building", ["name"])
    return (buildings.withColumn("action", F.lit(U.KEEP))
            .unionByName(numbered.withColumn("action", F.lit(U.INSERT)), allowMissingColumns=True))


def building_ids(buildings: DataFrame) -> DataFrame:
    """(name key, id) of each building name; the lowest id of equal names."""
    return buildings.groupBy(name_key("name").alias("_k")).agg(F.min("id_building").alias("id_building"))


# ------------------------------------------------------------------ L4
def units_staging(raw: DataFrame) -> DataFrame:
    """K7 bank id, K1 building name, unit id, K16 floor and department; distinct."""
    return raw.select(unit_number("unit").alias("unit"), K.clean_text("building", 50).alias("building_name"),
                      K.floor_number("piso").alias("floor"), K.department("departamento").alias("dept"),
                      K.cbu_strict("cbu").alias("cbu")).distinct()


def _place_first() -> Column:
    """Order of the rows that mean one unit: bank id, floor, department; blanks last."""
    return F.struct(F.col("cbu").isNull(), "cbu", F.col("floor").isNull(), "floor", F.col("dept").isNull(), "dept", "building_name")


def _one_row(rows: DataFrame, key: list[str]) -> DataFrame:
    """One whole row per key."""
    return rows.groupBy(*key).agg(F.min(_place_first()).alias("_r")).select(
        *key, *[F.col(f"_r.{c}").alias(c) for c in ("cbu", "floor", "dept", "building_name") if c not in key])


def _lowest_of_place(units: DataFrame) -> DataFrame:
    return units.groupBy("id_building", "floor", "dept").agg(F.min("id_unit").alias("id_unit"))


def _refused(chosen: DataFrame, units: DataFrame) -> DataFrame:
    """Chosen rows whose bank id their unit did not get."""
    got = units.select("id_unit", F.col("cbu").alias("_now"))
    return chosen.filter(F.col("cbu").isNotNull()).join(unbounded(got), "id_unit").filter(~F.col("cbu").eqNullSafe(F.col("_now")))


def match_by_id(rows: DataFrame, units: DataFrame) -> DataFrame:
    """Rows with an id, of units of their own building, one per unit."""
    own = rows.join(unbounded(units.select(F.col("id_unit").alias("unit"), "id_building")), ["unit", "id_building"], "left_semi")
    return _one_row(own.withColumnRenamed("unit", "id_unit"), ["id_unit"])


def match_by_place(rows: DataFrame, units: DataFrame) -> DataFrame:
    """Rows without an id by building, floor and department (C7), one per unit:
    both sides are reduced to one row a place before they meet."""
    r = _one_row(rows.filter(F.col("unit").isNull()), ["id_building", "floor", "dept"])
    u = _lowest_of_place(units).select(F.col("id_unit"), *[F.col(c).alias(f"_u_{c}") for c in ("id_building", "floor", "dept")])
    on = [r[c].eqNullSafe(u[f"_u_{c}"]) for c in ("id_building", "floor", "dept")]
    return r.join(unbounded(u), on).select("id_unit", *r.columns)


def load_units(lg: Ledger, raw: DataFrame, units: DataFrame, buildings: DataFrame) -> Load:
    """L4 on a file's rows and the units and buildings before it."""
    folder = _folder(lg, "l4")
    staged = store(units_staging(raw), f"{folder}/staged")
    named = staged.filter(F.col("building_name").isNotNull())
    after = store(ensure_buildings(buildings, named), f"{folder}/buildings")
    ids = building_ids(after)
    rows = store(named.withColumn("_k", name_key("building_name")).join(ids, "_k").drop("_k"), f"{folder}/rows")

    # by id
    chosen = store(match_by_id(rows, units), f"{folder}/by_id")
    s1 = U.update_changed(units, chosen, ["id_unit"], ["floor", "dept"]).withColumnRenamed("action", "_a1")
    s1 = store(U.update_guarded_unique(s1, chosen, "id_unit", "cbu").withColumnRenamed("action", "_a2"), f"{folder}/state1")
    # by place
    placed = store(match_by_place(rows, s1), f"{folder}/by_place")
    s2 = store(U.update_guarded_unique(s1, placed, "id_unit", "cbu").withColumnRenamed("action", "_a3"), f"{folder}/state2")
    # insert
    new, lost = _unmatched(rows, s2)
    new = store(new, f"{folder}/new")
    inserted = U.surrogate_keys(new, s2, "id_unit", ["id_building", "_f", "floor", "_d", "dept", "_c", "cbu", "_u", "unit"])
    changed = (F.col("_a1") == U.UPDATE) | (F.col("_a2") == U.UPDATE) | (F.col("_a3") == U.UPDATE)
    out = s2.select(*units.columns, F.when(changed, F.lit(U.UPDATE)).otherwise(F.lit(U.KEEP)).alias("action")).unionByName(
        inserted.select("id_unit", "id_building", "floor", "dept", "cbu", F.lit(U.INSERT).alias("action")), allowMissingColumns=True)
    out = store(out, f"{folder}/units")

    def rejected(df: DataFrame, reason: str) -> DataFrame:
        return df.select(F.lit(reason).alias("reason"), *ROW)
    by_id = rows.filter(F.col("unit").isNotNull()).join(
        unbounded(units.select(F.col("id_unit").alias("unit"), F.col("id_building").alias("_own"))), "unit")
    at_home = by_id.filter(F.col("_own") == F.col("id_building"))
    at_place = null_safe_rows(rows.filter(F.col("unit").isNull()), placed.select("id_building", "floor", "dept"), "left_semi")
    rejects = (rejected(staged.filter(F.col("building_name").isNull()), NO_BUILDING)
               .unionByName(rejected(by_id.filter(F.col("_own") != F.col("id_building")), OTHER_BUILDING))
               .unionByName(rejected(_not_chosen(at_home.withColumnRenamed("unit", "id_unit"), chosen, ["id_unit"]).withColumnRenamed("id_unit", "unit"), REPEATED))
               .unionByName(rejected(_refused(chosen, s1).withColumn("unit", F.col("id_unit")), BANK_ID_TAKEN))
               .unionByName(rejected(_not_chosen(at_place, placed, ["id_building", "floor", "dept"]), REPEATED))
               .unionByName(rejected(_refused(placed, s2).withColumn("unit", F.lit(None).cast("bigint")), BANK_ID_TAKEN))
               .unionByName(lost))
    rejects = store(rejects, f"{folder}/rejects")
    return Load(out, after, rejects, summary(raw, staged, out, after, rejects))


def null_safe_rows(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on all columns of ``right``, blanks matching blanks."""
    names = {c: f"_n_{c}" for c in right.columns}
    r = right.distinct().withColumnsRenamed(names)
    on = [left[c].eqNullSafe(r[n]) for c, n in names.items()]
    return left.join(unbounded(r), on, how)


def _not_chosen(rows: DataFrame, chosen: DataFrame, key: list[str]) -> DataFrame:
    """Rows that mean the unit of a chosen row and are not that row."""
    return null_safe_rows(rows, chosen.select(*key, *[c for c in ("cbu", "floor", "dept", "building_name") if c not in key]), "left_anti")


def _unmatched(rows: DataFrame, units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to insert, rows that are refused with their reason) of the insert pass."""
    by_id = units.select(F.col("id_unit").alias("unit"))
    rest = rows.join(unbounded(by_id), "unit", "left_anti")            # a blank id is no unit's id
    places = units.select("id_building", "floor", "dept")
    # rows without an id at a known place were matched there
    known = null_safe_rows(rest.filter(F.col("unit").isNotNull()), places, "left_semi")
    rest = null_safe_rows(rest, places, "left_anti")
    held = units.filter(F.col("cbu").isNotNull()).select("cbu").distinct()
    taken = rest.join(unbounded(held), "cbu", "left_semi")
    free = rest.join(unbounded(held), "cbu", "left_anti")
    order = ["id_building", "_f", "floor", "_d", "dept", "_u", "unit", "building_name"]
    free = free.withColumns({"_f": F.col("floor").isNull(), "_d": F.col("dept").isNull(), "_u": F.col("unit").isNull(), "_c": F.col("cbu").isNull()})
    first = free.filter(F.col("cbu").isNotNull()).groupBy("cbu").agg(F.min(F.struct(*order)).alias("_first"))
    claimed = free.join(unbounded(first), "cbu", "left").withColumn("_wins", F.col("_first").isNull() | F.col("_first").eqNullSafe(F.struct(*order)))
    lost = (known.select(F.lit(KNOWN_PLACE).alias("reason"), *ROW)
            .unionByName(taken.select(F.lit(BANK_ID_TAKEN).alias("reason"), *ROW))
            .unionByName(claimed.filter(~F.col("_wins")).select(F.lit(BANK_ID_TAKEN).alias("reason"), *ROW)))
    return claimed.filter("_wins").drop("_wins", "_first"), lost


COUNTS = ["rows_read", "rows_staged", "inserted", "updated", "new_buildings", "rejected"]


def summary(raw: DataFrame, staged: DataFrame, units: DataFrame, buildings: DataFrame, rejects: DataFrame) -> DataFrame:
    """One row of counts: rows read and staged, units inserted and
    updated, buildings inserted, rows rejected."""
    def actions(df: DataFrame, action: str) -> DataFrame:
        return df.filter(F.col("action") == action)
    parts = [raw, staged, actions(units, U.INSERT), actions(units, U.UPDATE), actions(buildings, U.INSERT), rejects]
    counts = reduce(DataFrame.unionAll, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("c"), "n") for c, df in zip(COUNTS, parts)])
    return counts.agg(*[F.max(F.when(F.col("c") == c, F.col("n"))).alias(c) for c in COUNTS])


# ------------------------------------------------------------------ L5
def areas_staging(raw: DataFrame) -> DataFrame:
    """K1, K16, K2; consolidated with MAX by building, floor and department (E5)."""
    s = raw.select(K.clean_text("building", 50).alias("building_name"), K.floor_number("piso").alias("floor"),
                   K.department("departamento").alias("dept"),
                   K.to_decimal("coeficiente").cast("decimal(5,2)").alias("share"),
                   K.to_decimal("m2_unidad").cast("decimal(7,2)").alias("area"),
                   K.to_decimal("m2_baulera").cast("decimal(5,2)").alias("storage_m2"),
                   K.to_decimal("m2_cochera").cast("decimal(5,2)").alias("garage_m2"))
    return s


def consolidate(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """E5: MAX as non-null consolidation of several rows per key."""
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cols])


def load_areas(lg: Ledger, raw: DataFrame, units: DataFrame, buildings: DataFrame) -> Load:
    """One row per building, floor and department; all units of that place
    take its shares and areas (U6, a blank keeps the old value), and a place
    without a unit becomes one."""
    folder = _folder(lg, "l5")
    staged = areas_staging(raw)
    named = staged.filter(F.col("building_name").isNotNull()).withColumn("_k", name_key("building_name"))
    after = store(ensure_buildings(buildings, named), f"{folder}/buildings")
    keyed = named.join(building_ids(after), "_k")
    place = ["id_building", "floor", "dept"]
    rows = store(consolidate(keyed, place, AREAS), f"{folder}/rows")
    r = rows.select(*[F.col(c).alias(f"_n_{c}") for c in rows.columns], F.lit(True).alias("_m"))
    j = units.join(unbounded(r), [F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in place], "left")
    changed = F.lit(False)
    for c in AREAS:
        changed = changed | (F.col(f"_n_{c}").isNotNull() & ~F.col(f"_n_{c}").eqNullSafe(F.col(c)))
    updated = j.select(*[F.coalesce(F.col(f"_n_{c}"), F.col(c)).alias(c) if c in AREAS else F.col(c) for c in units.columns],
                       F.when(changed, F.lit(U.UPDATE)).otherwise(F.lit(U.KEEP)).alias("action"))
    new = null_safe_rows(rows, units.select(*place), "left_anti")
    new = store(new.withColumns({"_f": F.col("floor").isNull(), "_d": F.col("dept").isNull()}), f"{folder}/new")
    new = U.surrogate_keys(new, units, "id_unit", ["id_building", "_f", "floor", "_d", "dept"]).drop("_f", "_d")
    out = updated.unionByName(new.withColumn("action", F.lit(U.INSERT)), allowMissingColumns=True)
    out = store(out, f"{folder}/units")
    rejects = staged.filter(F.col("building_name").isNull()).select(F.lit(NO_BUILDING).alias("reason"), "floor", "dept")
    return Load(out, after, rejects, summary(raw, named, out, after, rejects))


# ------------------------------------------------------------------ jobs on the derived files
def units_prior(lg: Ledger) -> DataFrame:
    """The units that the ledger knows before the file: floor unknown for
    id % 9 = 0, bank id unknown for id % 10 = 3."""
    return lg.unit.select("id_unit", "id_building",
                          F.when(F.col("id_unit") % 9 == 0, F.lit(None)).otherwise(F.col("floor")).alias("floor"), "dept",
                          F.when(F.col("id_unit") % 10 == 3, F.lit(None)).otherwise(F.col("cbu")).alias("cbu"))


def areas_prior(lg: Ledger) -> DataFrame:
    """Share unknown for id % 8 = 0."""
    return lg.unit.select("id_unit", "id_building", "floor", "dept",
                          F.when(F.col("id_unit") % 8 == 0, F.lit(None)).otherwise(F.col("share")).alias("share"), *AREAS[1:])


def _buildings(lg: Ledger) -> DataFrame:
    return lg.building.select("id_building", "name", "address", "total_area")


def _once(lg: Ledger, name: str, make) -> Load:
    loads = lg.__dict__.setdefault("_unit_loads", {})
    if name not in loads:
        loads[name] = make()
    return loads[name]


def units_load(lg: Ledger) -> Load:
    return _once(lg, "l4", lambda: load_units(lg, landing.units(lg), units_prior(lg), _buildings(lg)))


def areas_load(lg: Ledger) -> Load:
    return _once(lg, "l5", lambda: load_areas(lg, landing.areas(lg), areas_prior(lg), _buildings(lg)))


def _rows_by_id(lg: Ledger) -> DataFrame:
    """The file's rows for known units of their own building, one per unit."""
    rows = units_staging(landing.units(lg)).filter(F.col("building_name").isNotNull()).withColumn("_k", name_key("building_name"))
    return match_by_id(rows.join(building_ids(lg.building), "_k").drop("_k"), units_prior(lg))


def update_units(lg: Ledger) -> DataFrame:
    """Floor / department updated where they changed (own guard each)."""
    return U.update_changed(units_prior(lg), _rows_by_id(lg), ["id_unit"], ["floor", "dept"])


def update_unit_bank_ids(lg: Ledger) -> DataFrame:
    """Bank id set only where no other unit already holds it."""
    return U.update_guarded_unique(units_prior(lg), _rows_by_id(lg), "id_unit", "cbu")


def consolidated_areas(lg: Ledger) -> DataFrame:
    """E5 over the areas file, by building name, floor and department."""
    s = areas_staging(landing.areas(lg)).filter(F.col("building_name").isNotNull())
    return consolidate(s, ["building_name", "floor", "dept"], AREAS)
