"""Master-data loaders L1 and L6 and the upserts they exercise.

Each loader reads and cleans a landed file (derived from the driver tables), then
upserts it into a *prior state* of the ledger table. The prior states are
fixed rules of the adapter (which rows the ledger is assumed to know before
the file arrives), so that inserts, updates and keeps all occur:

  buildings  ids < 20 known; the file brings all 25
  buildings  (fill-nulls) address unknown for id % 3 = 0, area for id % 4 = 0
  people     as in the ledger; the file brings normalised e-mails and phones
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as K
from ..functions.collation import name_key
from ..operators import upsert as U
from ..operators.joins import store, unbounded
from ..sources import landing
from ..sources.ledger import Ledger


# ------------------------------------------------------------------ L1
def buildings_staging(lg: Ledger) -> DataFrame:
    """L1 staging: K1 name (50), K1 address (100), K2 area; blank names dropped."""
    r = landing.buildings(lg)
    return (r.select(K.clean_text("nombre", 50).alias("name"), K.clean_text("domicilio", 100).alias("address"),
                     K.to_decimal("m2_totales").alias("total_area"))
            .filter(F.col("name").isNotNull()))


def buildings_prior(lg: Ledger) -> DataFrame:
    return lg.building.filter(F.col("id_building") < 20).select("id_building", "name", "address", "total_area")


def _name_keys() -> dict:
    return {"_k_name": name_key("name"), "_k_addr": name_key(F.coalesce("address", F.lit("")))}


def new_buildings(lg: Ledger) -> DataFrame:
    """U4: staged buildings absent by (name, address)."""
    return U.insert_absent(buildings_prior(lg), buildings_staging(lg), key_exprs=_name_keys())


def upsert_buildings(prior: DataFrame, staged: DataFrame) -> DataFrame:
    """U4 + U10: the known buildings, and the absent ones under new keys."""
    new = U.insert_absent(prior, staged, key_exprs=_name_keys())
    new = U.surrogate_keys(new, prior, "id_building", ["name"])
    return (prior.withColumn("action", F.lit(U.KEEP))
            .unionByName(new.select(*prior.columns).withColumn("action", F.lit(U.INSERT))))


def load_buildings(lg: Ledger) -> DataFrame:
    """L1: prior state + absent buildings with new surrogate ids."""
    return upsert_buildings(buildings_prior(lg), buildings_staging(lg))


def fill_building_nulls(lg: Ledger) -> DataFrame:
    """U8: fill only the unknown address / area of known buildings from the file."""
    b = lg.building
    prior = b.select("id_building", "name",
                     F.when(F.col("id_building") % 3 == 0, F.lit(None)).otherwise(F.col("address")).alias("address"),
                     F.when(F.col("id_building") % 4 == 0, F.lit(None)).otherwise(F.col("total_area"))
                     .alias("total_area"))
    src = buildings_staging(lg)
    t = prior.withColumn("_k", name_key("name"))
    s = src.withColumn("_k", name_key("name")).drop("name")
    return U.fill_nulls(t, s, ["_k"], ["address", "total_area"]).drop("_k")


# ------------------------------------------------------------------ L6
def people_staging(lg: Ledger) -> DataFrame:
    """L6 staging: K7 strict bank id, K17 tenant word, DNI, K1 names (cut to
    the target's 50), K6b e-mail, K18 phone; rows without a valid bank id or
    tenant word dropped, NULL DNI rejected, one row per bank id (lowest DNI)."""
    r = landing.people(lg)
    dni = F.when(K.trim_spaces("dni").rlike("^[0-9]+$"), K.trim_spaces("dni")).try_cast("bigint")
    s = (r.select(K.cbu_strict("cbu").alias("cbu"), K.tenant_flag("inquilino").alias("is_tenant"),
                  dni.alias("dni"), K.clean_text("nombre", 50).alias("first_name"),
                  K.clean_text("apellido", 50).alias("last_name"), K.email_light("email").alias("email"),
                  K.phone("telefono").alias("phone"))
         .filter(F.col("cbu").isNotNull() & F.col("is_tenant").isNotNull() & F.col("dni").isNotNull())
         .distinct())
    return U.dedupe_first(s, ["cbu"], ["dni", "last_name", "first_name", "email"])


PERSON_COLS = ["first_name", "last_name", "dni", "email", "phone"]


def upsert_people(prior: DataFrame, staged: DataFrame) -> DataFrame:
    """Known bank ids take COALESCE(new, old); new ones are inserted."""
    upd = U.update_nonnull(prior, staged, ["cbu"], PERSON_COLS)
    new = U.surrogate_keys(U.insert_absent(prior, staged, ["cbu"]), prior, "id_person", ["cbu"])
    return upd.unionByName(new.select(*prior.columns).withColumn("action", F.lit(U.INSERT)))


def load_people(lg: Ledger) -> DataFrame:
    """L6 over the landed people file, stored once per ledger."""
    if "_people_load" not in lg.__dict__:
        lg.__dict__["_people_load"] = store(upsert_people(lg.person, people_staging(lg)), f"{lg.root}/people-load")
    return lg.__dict__["_people_load"]


def upsert_occupancy(prior: DataFrame, staged: DataFrame, people: DataFrame, units: DataFrame) -> DataFrame:
    """Person-unit match by bank id -> (person, building) link; the tenant
    flag is updated when it changed, new links inserted. A person with units
    of both flags in a building is a tenant there."""
    flags = staged.select("cbu", (F.col("is_tenant") == 1).alias("is_tenant"))
    links = (flags.join(unbounded(people.select("id_person", "cbu")), "cbu").join(unbounded(units.select("cbu", "id_building")), "cbu")
             .groupBy("id_person", "id_building").agg(F.max("is_tenant").alias("is_tenant")))
    upd = U.update_changed(prior, links, ["id_person", "id_building"], ["is_tenant"])
    new = U.insert_absent(prior, links, ["id_person", "id_building"])
    return upd.unionByName(new.select(*prior.columns).withColumn("action", F.lit(U.INSERT)))


def link_occupancy(lg: Ledger) -> DataFrame:
    return upsert_occupancy(lg.occupancy, people_staging(lg), load_people(lg), lg.unit)
