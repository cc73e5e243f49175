"""Raw input "files" derived from the driver's tables.

The reference loads spreadsheet exports, delimited files and JSON whose
contents are not published. To exercise the cleaning and loading jobs on
data that grows with the tables, every raw file is derived here, row for
from the rows of a driver table, with all cells as text in several messy styles
(the styles below are a fixed rule of the adapter, not reference values):

  raw_payments  lineitem x orders (one line per payment): id, date, bank id, amount
  raw_people    customer: name, surname, DNI, e-mail, phone, bank id, tenant word
  raw_units     customer: bank id, building name, unit, floor, department (several rows each)
  raw_areas     customer: building, unit, floor, department, share, areas (several rows each)
  raw_buildings nation: name, address, total m2
  raw_expenses  orders per (nation, month), one amount column per category
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ledger import Ledger


def _local(amount: Column) -> Column:
    """12,345.67 -> 12.345,67 (thousands '.', decimals ',')."""
    return F.translate(F.format_number(amount.cast("double"), 2), ",.", ".,")


def _names(lg: Ledger) -> DataFrame:
    """Building names from the stored building table (nation key and name)."""
    return lg.building.select(F.col("id_building").alias("n_nationkey"), F.col("name").alias("n_name"))


def payment_style(pay_date: Column, unit: Column) -> Column:
    return ((F.dayofmonth(pay_date) + unit) % 8).cast("int")


def raw_payments(lg: Ledger) -> DataFrame:
    """Bank payment lines as text: c1 id, c2 date, c3 bank id, c4 amount.

    style 0 plain; 1 ISO date, dashed bank id, local amount; 2 d/M/yyyy,
    spaced bank id, '$ 1,234.00'; 3 yyyyMMdd, 21-digit bank id, 'ARS 1234';
    4 '(1234,00)' negative; 5 month 13 (bad date); 6 blank amount;
    7 bank id of no unit.
    """
    p = lg.payment.select("id_payment", "id_unit", "pay_date", "amount", "cbu")
    st = payment_style(F.col("pay_date"), F.col("id_unit"))
    d = F.col("pay_date")
    date_txt = (F.when(st == 1, F.date_format(d, "yyyy-MM-dd"))
                .when(st == 2, F.date_format(d, "d/M/yyyy"))
                .when(st == 3, F.date_format(d, "yyyyMMdd"))
                .when(st == 5, F.concat(F.date_format(d, "dd"), F.lit("/13/"), F.date_format(d, "yyyy")))
                .otherwise(F.date_format(d, "dd/MM/yyyy")))
    cbu = F.col("cbu")
    cbu_txt = (F.when(st == 1, F.concat_ws("-", F.substring(cbu, 1, 8), F.substring(cbu, 9, 14)))
               .when(st == 2, F.concat_ws(" ", F.substring(cbu, 1, 4), F.substring(cbu, 5, 18)))
               .when(st == 3, F.substring(cbu, 2, 21))
               .when(st == 7, F.concat(F.lit("9"), F.substring(cbu, 2, 21)))
               .otherwise(cbu))
    a = F.col("amount")
    amt_txt = (F.when(st == 1, _local(a))
               .when(st == 2, F.concat(F.lit("$ "), F.format_number(a.cast("double"), 2)))
               .when(st == 3, F.concat(F.lit("ARS "), a.cast("bigint").cast("string")))
               .when(st == 4, F.concat(F.lit("("), F.translate(a.cast("string"), ".", ","), F.lit(")")))
               .when(st == 6, F.lit(""))
               .otherwise(a.cast("string")))
    return p.select(F.col("id_payment").alias("c1"), date_txt.alias("c2"), cbu_txt.alias("c3"),
                    amt_txt.alias("c4"))


def raw_people(lg: Ledger) -> DataFrame:
    """People file (A6 layout) from customer, with messy e-mails, phones,
    bank ids and tenant words."""
    c = lg.raw("customer", "c_custkey", "c_name", "c_mktsegment")
    k = F.col("c_custkey")
    local = F.lower(F.regexp_replace("c_name", "#", "."))
    m8 = k % 8
    email = (F.when(m8 == 0, F.lit(None).cast("string"))
             .when(m8 == 1, F.upper(F.concat(local, F.lit(" @ Gmail,com"))))
             .when(m8 == 2, F.concat(local, F.lit("@hotmail com ar")))
             .when(m8 == 3, F.concat(local, F.lit("(at)yahoo com")))
             .when(m8 == 4, F.concat(local, F.lit(" arroba gmail.com")))
             .when(m8 == 5, F.concat(local, F.lit("@mail.com")))
             .when(m8 == 6, F.concat(F.lit("x.."), local, F.lit("@mail.com")))
             .otherwise(F.concat(F.lit(" "), local, F.lit("@outlookcom "))))
    phone = (F.when(k % 9 == 0, F.lit(""))
             .otherwise(F.concat(F.lit("(011) 4"), F.lpad((k % 1000).cast("string"), 3, "0"),
                                 F.lit("-"), F.lpad((k % 10000).cast("string"), 4, "0"))))
    cbu = F.lpad(k.cast("string"), 22, "0")
    cbu_txt = (F.when(k % 4 == 0, F.concat(F.lit("9"), F.substring(cbu, 2, 21)))
               .when(k % 5 == 1, F.concat_ws("-", F.substring(cbu, 1, 11), F.substring(cbu, 12, 11)))
               .when(k % 13 == 0, F.substring(cbu, 3, 20))
               .otherwise(cbu))
    m6 = k % 6
    tenant = (F.when(m6 == 0, F.lit("Sí")).when(m6 == 1, F.lit("no")).when(m6 == 2, F.lit("propietario"))
              .when(m6 == 3, F.lit("INQUILINO")).when(m6 == 4, F.lit("x")).otherwise(F.lit("true")))
    return c.select(
        F.concat(F.lit("  "), F.initcap("c_mktsegment"), F.lit(" ")).alias("nombre"),
        F.col("c_name").alias("apellido"),
        F.when(k % 11 == 0, F.lit("")).otherwise((10_000_000 + k).cast("string")).alias("dni"),
        email.alias("email"), phone.alias("telefono"), cbu_txt.alias("cbu"), tenant.alias("inquilino"))


def floor_text(k: Column) -> Column:
    f = k % 10
    return (F.when((f == 0) & (k % 3 == 0), F.lit("PB")).when(f == 0, F.lit("P.B."))
            .otherwise(f.cast("string")))


def _accented(name: Column) -> Column:
    """A building name in another spelling: lower case, accents, trailing blanks."""
    return F.concat(F.translate(F.lower(name), "aeiou", "áéíóú"), F.lit(" "))


def _hard_rows(lg: Ledger, row) -> DataFrame:
    """Customers with the names of their building and the next one; ``row(k, name,
    next_name)`` lists (condition, struct) of the file rows each of them gives."""
    c = lg.raw("customer", "c_custkey", "c_nationkey")
    n = _names(lg)
    after = n.select(((F.col("n_nationkey") + 24) % 25).alias("before"), F.col("n_name").alias("next_name"))
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(after, F.col("n_nationkey") == F.col("before"))
    rows = [F.when(cond, cells) for cond, cells in row(F.col("c_custkey"), F.col("n_name"), F.col("next_name"))]
    return j.select(F.explode(F.filter(F.array(*rows), lambda x: x.isNotNull())).alias("r")).select("r.*")


def raw_units(lg: Ledger) -> DataFrame:
    """Units file (A4 layout): bank id, building name, unit id, floor, department.

    Beside one row per customer the file holds what such files do: rows with
    a blank unit id, of another building than the unit's, of new units and
    buildings, with blank floor and department, with a bank id that another
    unit has or another row claims, a second row for one unit, no building.
    """
    letter = F.expr("char(65 + c_custkey % 5)")

    def cells(cbu, building, unit, floor, dept):
        return F.struct(cbu.alias("cbu"), F.concat(F.lit(" "), building).alias("building"), unit.alias("unit"),
                        floor.alias("piso"), F.concat(dept, F.lit(" ")).alias("departamento"))

    def rows(k, name, next_name):
        cbu = F.lpad(k.cast("string"), 22, "0")
        dotted = F.when(k % 7 == 3, F.concat_ws(".", F.substring(cbu, 1, 10), F.substring(cbu, 11, 12))).otherwise(cbu)
        own = F.when(k % 13 == 0, _accented(name)).otherwise(name)
        blank = F.lit("")

        def fresh(digit):
            return F.concat(F.lit(digit), F.lpad(k.cast("string"), 21, "0"))

        def unit(shift):
            return (k + shift).cast("string")

        def floor(base, span):
            return (base + k % span).cast("string")
        return [(F.lit(True), cells(dotted, own, unit(0), floor_text(k), letter)),
                (k % 20 == 0, cells(fresh("6"), own, blank, floor_text(k), letter)),
                (k % 25 == 3, cells(fresh("5"), next_name, unit(0), floor_text(k), letter)),
                (k % 30 == 4, cells(fresh("8"), own, unit(10_000_000), floor(10, 90), letter)),
                (k % 45 == 5, cells(fresh("7"), own, blank, blank, blank)),
                (k % 60 == 6, cells(fresh("4"), F.concat(own, F.lit(" II")), unit(20_000_000), F.lit("1"), F.lit("A"))),
                (k % 35 == 7, cells(dotted, own, unit(30_000_000), floor(100, 50), letter)),
                (k % 55 == 8, cells(fresh("3"), own, unit(40_000_000), floor(150, 50), letter)),
                (k % 55 == 8, cells(fresh("3"), own, unit(50_000_000), floor(150, 50), letter)),
                (k % 70 == 9, cells(dotted, own, unit(0), F.lit("200"), F.lit("Z"))),
                (k % 80 == 10, cells(fresh("2"), F.lit("  "), unit(60_000_000), F.lit("1"), F.lit("A")))]
    return _hard_rows(lg, rows)


def raw_areas(lg: Ledger) -> DataFrame:
    """Unit areas file (A5 layout): decimals with comma; also blank cells, new
    units, units without floor and department, new buildings."""
    letter = F.expr("char(65 + c_custkey % 5)")

    def cells(k, building, unit, floor, dept):
        return F.struct(building.alias("building"), unit.alias("unit"), floor.alias("piso"), dept.alias("departamento"),
                        F.when(k % 50 == 11, F.lit("")).otherwise(F.concat((1 + k % 7).cast("string"), F.lit(",00"))).alias("coeficiente"),
                        F.concat((40 + k % 61).cast("string"), F.lit(",5")).alias("m2_unidad"),
                        F.when(k % 4 == 1, "SI").otherwise("NO").alias("bauleras"),
                        F.when(k % 6 == 2, "SI").otherwise("NO").alias("cochera"),
                        F.when(k % 4 == 1, "3,5").otherwise("0").alias("m2_baulera"),
                        F.when(k % 6 == 2, "12").otherwise("0").alias("m2_cochera"))

    def rows(k, name, next_name):
        own = F.when(k % 13 == 0, _accented(name)).otherwise(name)
        return [(k % 11 != 3, cells(k, own, k.cast("string"), floor_text(k), letter)),
                (k % 30 == 4, cells(k, own, F.lit(""), (10 + k % 90).cast("string"), letter)),
                (k % 45 == 5, cells(k, own, F.lit(""), F.lit(""), F.lit(""))),
                (k % 60 == 6, cells(k, F.concat(name, F.lit(" II")), F.lit(""), F.lit("1"), F.lit("A")))]
    return _hard_rows(lg, rows)


def raw_buildings(lg: Ledger) -> DataFrame:
    """Buildings sheet (A1 layout) from nation."""
    n = lg.raw("nation", "n_nationkey", "n_name")
    k = F.col("n_nationkey")
    return n.select(F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("nombre"),
                    F.concat(F.lit("Av. "), F.col("n_name")).alias("domicilio"),
                    F.when(k % 5 == 0, F.lit("")).otherwise(F.concat((1000 + k * 37).cast("string"), F.lit(",50")))
                    .alias("m2_totales"))


# Expense categories of the monthly JSON (column names of the file).
EXPENSE_CATEGORIES = ["BANCARIOS", "LIMPIEZA", "ADMINISTRACION", "SEGUROS", "GASTOS GENERALES",
                      "SERVICIOS PUBLICOS-Agua", "SERVICIOS PUBLICOS-Luz"]
# Adapter rule: order priority -> category column.
PRIORITY_CATEGORY = {"1-URGENT": "BANCARIOS", "2-HIGH": "LIMPIEZA", "3-MEDIUM": "ADMINISTRACION",
                     "4-NOT SPECIFIED": "SEGUROS", "5-LOW": "GASTOS GENERALES"}


def raw_expenses(lg: Ledger) -> DataFrame:
    """Monthly expenses "JSON" rows (A3 layout): building, Spanish month name,
    one local-format amount text per category (NULL when none)."""
    from ..functions.clean import MONTHS_ES
    o = lg.orders_b
    cat = F.col("o_orderpriority")
    pivot_cols = []
    for prio, name in PRIORITY_CATEGORY.items():
        pivot_cols.append(F.sum(F.when(cat == prio, F.col("o_totalprice").cast("decimal(10,2)"))).alias(name))
    g = o.groupBy("id_building", "month_start").agg(*pivot_cols)
    n = _names(lg)
    # other spellings, and a building that no other file has
    name = (F.when((F.month("month_start") == 12) & (n.n_nationkey % 9 == 4), F.concat("n_name", F.lit(" III")))
            .when(F.month("month_start") == 7, _accented(F.col("n_name"))).otherwise(F.col("n_name")))
    month_name = F.element_at(F.array(*[F.lit(m) for m in MONTHS_ES]), F.month("month_start"))
    cols = [F.when(F.col(name).isNotNull(), _local(F.col(name))).alias(name) for name in PRIORITY_CATEGORY.values()]
    return (g.join(n, g.id_building == n.n_nationkey)
            .select(name.alias("Nombre del consorcio"),
                    F.year("month_start").alias("anio"),
                    F.when(F.month("month_start") == 5, F.lit("Ma yo")).otherwise(F.initcap(month_name)).alias("Mes"),
                    *cols,
                    F.lit(None).cast("string").alias("SERVICIOS PUBLICOS-Agua"),
                    F.lit(None).cast("string").alias("SERVICIOS PUBLICOS-Luz")))
