"""Cleaning jobs: each K rule applied to a whole raw column derived from
the driver's tables (sources/rawtext.py), raw value beside clean value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean as K
from ..sources import rawtext as RT
from ..sources.ledger import Ledger


def k1_text(lg: Ledger) -> DataFrame:
    r = RT.raw_people(lg)
    return r.select(F.col("nombre").alias("raw_name"), F.col("apellido").alias("raw_surname"),
                    K.clean_text("nombre", 50).alias("name"), K.clean_text("apellido", 10).alias("surname_10"))


def k2_decimal(lg: Ledger) -> DataFrame:
    r = RT.raw_areas(lg)
    return r.select("unit", "coeficiente", "m2_unidad", "m2_baulera", K.to_decimal("coeficiente").alias("share"),
                    K.to_decimal("m2_unidad").alias("area"), K.to_decimal("m2_baulera").alias("storage_m2"))


def k3_amount_flexible(lg: Ledger) -> DataFrame:
    r = RT.raw_payments(lg)
    return (r.select(F.col("c1").alias("id"), F.col("c4").alias("raw_amount"))
            .transform(K.amount_flexible_on("raw_amount", "amount")))


def k4_amount_candidates(lg: Ledger) -> DataFrame:
    r = RT.raw_payments(lg)
    return (r.select(F.col("c1").alias("id"), F.col("c4").alias("raw_amount"))
            .transform(K.amount_candidates_on("raw_amount", "amount")))


def k5_email_normalise(lg: Ledger) -> DataFrame:
    r = RT.raw_people(lg)
    return r.select("apellido", F.col("email").alias("raw_email"), K.email_normalise("email").alias("email"))


def k6_email_valid(lg: Ledger) -> DataFrame:
    r = RT.raw_people(lg).select("apellido", F.col("email").alias("raw_email"),
                                 K.email_normalise("email").alias("email"))
    return r.transform(K.email_valid_on("email", "is_valid"))


def k6b_email_light(lg: Ledger) -> DataFrame:
    r = RT.raw_people(lg)
    return r.select("apellido", F.col("email").alias("raw_email"), K.email_light("email").alias("email"))


def k7_cbu_strict(lg: Ledger) -> DataFrame:
    p = RT.raw_people(lg).select(F.lit("person").alias("source"), F.col("cbu").alias("raw_cbu"))
    u = RT.raw_units(lg).select(F.lit("unit").alias("source"), F.col("cbu").alias("raw_cbu"))
    return p.unionByName(u).withColumn("cbu", K.cbu_strict("raw_cbu"))


def k7b_cbu_padded(lg: Ledger) -> DataFrame:
    r = RT.raw_payments(lg)
    return r.select(F.col("c1").alias("id"), F.col("c3").alias("raw_cbu"), K.cbu_padded("c3").alias("cbu"))


def k15_month_name(lg: Ledger) -> DataFrame:
    r = RT.raw_expenses(lg)
    return r.select(F.col("Nombre del consorcio").alias("building"), "anio", F.col("Mes").alias("raw_month"),
                    K.month_number("Mes").alias("month"))


def k16_floor(lg: Ledger) -> DataFrame:
    r = RT.raw_units(lg)
    return r.select("unit", F.col("piso").alias("raw_floor"), F.col("departamento").alias("raw_dept"),
                    K.floor_number("piso").alias("floor"), K.department("departamento").alias("dept"))


def k17_tenant_flag(lg: Ledger) -> DataFrame:
    r = RT.raw_people(lg)
    return r.select("apellido", F.col("inquilino").alias("raw_flag"), K.tenant_flag("inquilino").alias("is_tenant"))


def k18_phone(lg: Ledger) -> DataFrame:
    r = RT.raw_people(lg)
    return r.select("apellido", F.col("telefono").alias("raw_phone"), K.phone("telefono").alias("phone"))


def k19_date(lg: Ledger) -> DataFrame:
    r = RT.raw_payments(lg)
    return r.select(F.col("c1").alias("id"), F.col("c2").alias("raw_date"), K.parse_date("c2").alias("pay_date"))


def k20_clamp(lg: Ledger) -> DataFrame:
    raw = (F.col("total") * 100).cast("decimal(18,2)")
    return lg.bill.select("id_bill", raw.alias("raw_total"), K.clamp_amount(raw).alias("total"))


def k21_due_day(lg: Ledger) -> DataFrame:
    y, m = F.year("month_start"), F.month("month_start")
    return lg.bill.select("id_bill", K.due_day(y, m, F.lit(10)).alias("due_10"),
                          K.due_day(y, m, F.lit(31)).alias("due_31"),
                          K.due_day(y, m, F.lit(None).cast("int")).alias("due_null"))


JOBS = {name: fn for name, fn in globals().items() if name.startswith("k") and callable(fn) and name[1].isdigit()}
