"""Ingestion jobs L1–L10: file -> clean -> reject -> upsert.

Every loader returns its outputs as DataFrames (accepted rows with the
merge action, rejected rows with their reason, and counts); nothing is
written in place. Accepted + rejected always account for every input row.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean as K
from ..operators.joins import shuffles_freed, store, unbounded
from ..session import checkpoint_dir
from ..sources import files as FL
from ..sources import rawtext as RT
from ..sources.ledger import Ledger

# Reject reasons of the payment loader, in the order they are tested.
REASON_PARSE = "Fila inválida (fecha/valor/CBU)"
REASON_NO_UNIT = "No se encontró UF para ese CBU"
REASON_NO_BUILDING = "No se determinó Consorcio"
REASON_NO_BILL = "No hay expensa del mes para el consorcio"
REASON_NO_ACCOUNT = "No existe EstadoCuenta para UF/Consorcio/Expensa"
# Ours: rows with a blank amount are reported instead of vanishing.
REASON_BLANK = "Valor en blanco"

PAYMENT_KEY = ["id_account", "id_unit", "id_building", "id_bill", "pay_date", "amount", "cbu"]


def landed(lg: Ledger, name: str, make) -> str:
    """A raw file derived from the tables, written once per ledger into the
    session's shared checkpoint folder (never a machine-local path on a cluster)."""
    cache = lg.__dict__.setdefault("_landed", {})
    if name not in cache:
        path = os.path.join(checkpoint_dir(lg.spark), "landed", f"{name}_{uuid.uuid4().hex}")
        make(path)
        cache[name] = path
    return cache[name]


def unit_bank_key(cbu) -> F.Column:
    """Unit bank id as the payment loader compares it: upper, trimmed, NBSP, tab,
    space and '-' removed, zero-padded keeping the right 22 characters."""
    t = F.translate(F.upper(K.trim_spaces(cbu)), K.NBSP + "\t -", "")
    return F.substring(F.concat(F.lit("0" * 22), t), -22, 22)


def bill_of_month(lg: Ledger) -> DataFrame:
    """The latest bill per (building, month of its date), ties by bill number."""
    w = Window.partitionBy("id_building", "b_month").orderBy(F.col("issue_date").desc(), F.col("id_bill").desc())
    b = (lg.bill.select("id_bill", "id_building", "issue_date")
         .withColumn("b_month", F.trunc("issue_date", "month"))
         .withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
         .select("id_building", "b_month", F.col("id_bill").alias("bill_match")))
    return b


@dataclass
class PaymentLoad:
    ok: DataFrame        # accepted rows (distinct) with action INSERT / KEEP
    rejects: DataFrame   # reason + raw or normalised texts
    summary: DataFrame   # one row of counts
    months: list[dt.date]    # the months of the file's valid rows


@dataclass
class PaymentKeys:
    """What payment rows are looked up in."""
    units: DataFrame     # cbu (as the loader compares it), id_unit, id_building
    accounts: DataFrame  # id_account, _unit, _bill and _first, the first month of that bill
    firsts: DataFrame    # that month for each month of a bill


def unit_bank_keys(lg: Ledger) -> DataFrame:
    return lg.unit.select(unit_bank_key(F.col("cbu")).alias("cbu"), "id_unit", "id_building")


def stored_keys(lg: Ledger, folder: str) -> PaymentKeys:
    """The keys for a file that comes in many parts: made once, the accounts in
    folders by month, so that a part reads only those of its own months."""
    bills = store(bill_of_month(lg), os.path.join(folder, "bills"))
    first = bills.groupBy(F.col("bill_match").alias("_bill")).agg(F.min("b_month").alias("_first"))
    accounts = lg.account.select("id_account", F.col("id_unit").alias("_unit"), F.col("id_bill").alias("_bill")).join(first, "_bill")
    path = os.path.join(folder, "accounts")
    with shuffles_freed(lg.spark):
        accounts.repartitionByRange("_first", "_unit", "id_account").write.mode("overwrite").partitionBy("_first").parquet(path)
    return PaymentKeys(store(unit_bank_keys(lg), os.path.join(folder, "units")), lg.spark.read.schema(accounts.schema).parquet(path),
                       bills.join(first, F.col("bill_match") == F.col("_bill")).select("b_month", "_first").distinct())


def load_payments(lg: Ledger, raw: DataFrame, amount_rule: str = "K3", existing: DataFrame | None = None,
                  keys: PaymentKeys | None = None, keep: bool = False) -> PaymentLoad:
    """Parse, reconcile to unit / bill / account, reject with reasons, merge.

    ``raw`` has text cells c1 (id), c2 (date), c3 (bank id), c4 (amount).
    ``amount_rule`` K3 (flexible, default) or K4 (the reference loader's own).
    A ``file`` column of ``raw`` goes with its rows into the rejects.
    ``existing`` payments (default: the ledger's) make the merge insert-only
    and idempotent: a row equal on all key columns is kept, not re-inserted.
    ``keys`` (default: from the ledger's tables) are those of ``stored_keys``.
    ``keep`` stores the reconciled rows, for a caller of more than one output.
    """
    existing = lg.payment if existing is None else existing
    of_file = [c for c in raw.columns if c == "file"]
    n = raw.select(*[K.trim_spaces(c).alias(c) for c in ["c1", "c2", "c3", "c4"]], *of_file)
    n = n.withColumn("_blank", F.nullif(F.col("c4"), F.lit("")).isNull())
    amount = K.amount_flexible_on("c4", "_amt") if amount_rule == "K3" else K.amount_candidates_on("c4", "_amt")
    p = (n.transform(amount)
         .withColumn("pay_date", K.parse_date("c2"))
         .withColumn("cbu", K.cbu_padded("c3"))
         .withColumn("amount", F.col("_amt").try_cast("decimal(12,2)")).drop("_amt")
         .withColumn("_valid", F.col("pay_date").isNotNull() & F.col("amount").isNotNull()
                     & F.col("cbu").isNotNull() & (F.col("cbu") != "0" * 22)))
    # The parsed rows are written once (as the reference's #pagos step table)
    # as Parquet in the shared checkpoint folder: three outputs read them, and
    # a filter on the parse results must not be pushed back into the parse
    # expressions (one write; an RDD checkpoint would compute the parse twice).
    # Only rejects show the texts.
    folder = os.path.join(checkpoint_dir(lg.spark), "parsed", uuid.uuid4().hex)
    refused = F.col("_blank") | ~F.col("_valid")
    p = store(p.select(*[F.when(refused, F.col(c)).alias(c) for c in ("c2", "c3", "c4")], "_blank", "pay_date", "cbu", "amount", "_valid", *of_file),
              f"{folder}/rows")

    units = unit_bank_keys(lg) if keys is None else keys.units
    # only bills of the file's months can be those of its rows: a file of few
    # days does not shuffle the accounts of all months
    of_month = p.filter("_valid").groupBy(F.trunc("pay_date", "month")).agg(F.min("pay_date"), F.max("pay_date")).collect()
    months, lo, hi = [r[0] for r in of_month], min((r[1] for r in of_month), default=None), max((r[2] for r in of_month), default=None)
    bills = bill_of_month(lg).filter(F.col("b_month").between(F.trunc(F.lit(lo), "month"), F.lit(hi))).withColumnRenamed("id_building", "_building")
    if keys is None:
        acc = lg.account.select("id_account", F.col("id_unit").alias("_unit"), F.col("id_bill").alias("_bill"))
        acc = acc.join(bills.select(F.col("bill_match").alias("_bill")), "_bill", "left_semi")
    else:
        firsts = [r[0] for r in keys.firsts.filter(F.col("b_month").isin(months)).select("_first").distinct().collect()]
        acc = keys.accounts.filter(F.col("_first").isin(firsts)).drop("_first")
    # Rows without a unit would all meet in one task as the NULL key of the
    # next joins: they get spread negative keys, which no building or unit has.
    spread = F.col("_spread")
    m = (p.filter(~F.col("_blank") & F.col("_valid"))
         .select("pay_date", "cbu", "amount", (-F.pmod(F.xxhash64("pay_date", "cbu", "amount"), F.lit(1 << 40)) - 1).alias("_spread"), *of_file)
         .join(unbounded(units), "cbu", "left")
         .withColumn("b_month", F.trunc("pay_date", "month"))
         .withColumn("_building", F.coalesce("id_building", spread))
         .join(bills, ["_building", "b_month"], "left")
         .withColumnRenamed("bill_match", "id_bill")
         .withColumn("_unit", F.coalesce("id_unit", spread)).withColumn("_bill", F.coalesce("id_bill", spread))
         .join(unbounded(acc), ["_unit", "_bill"], "left"))
    reason = (F.when(F.col("id_unit").isNull(), REASON_NO_UNIT)
              .when(F.col("id_building").isNull(), REASON_NO_BUILDING)
              .when(F.col("id_bill").isNull(), REASON_NO_BILL)
              .when(F.col("id_account").isNull(), REASON_NO_ACCOUNT))
    m = m.withColumn("reason", reason)
    if keep:
        m = store(m.select("reason", "id_account", "id_unit", "id_building", "id_bill", "pay_date", "amount", "cbu", *of_file), f"{folder}/reconciled")

    text = ["c2", "c3", "c4"]
    rej_raw = p.filter(refused).select(
        F.when(F.col("_blank"), REASON_BLANK).otherwise(REASON_PARSE).alias("reason"),
        *[F.nullif(F.col(c), F.lit("")).alias(t) for c, t in zip(text, ["date_txt", "cbu_txt", "amount_txt"])], *of_file)
    rej_match = m.filter(F.col("reason").isNotNull()).select(
        "reason", F.date_format("pay_date", "yyyy-MM-dd").alias("date_txt"), F.col("cbu").alias("cbu_txt"),
        F.col("amount").cast("string").alias("amount_txt"), *of_file)
    rejects = rej_raw.unionByName(rej_match)

    ok = (m.filter(F.col("reason").isNull())
          .select("id_account", "id_unit", "id_building", "id_bill", "pay_date",
                  F.col("amount").cast("decimal(12,2)").alias("amount"), "cbu")
          .distinct())
    # only payments of the file's dates can be equal to its rows; payments are
    # range-partitioned by date, so the others' files are not read
    existing = existing.filter(F.col("pay_date").between(F.lit(lo), F.lit(hi)))
    known = existing.select(*[F.col(c).cast("decimal(12,2)") if c == "amount" else F.col(c) for c in PAYMENT_KEY]) \
        .distinct().withColumn("_known", F.lit(True))
    ok = (ok.join(unbounded(known), PAYMENT_KEY, "left")
          .withColumn("action", F.when(F.col("_known"), F.lit("KEEP")).otherwise(F.lit("INSERT")))
          .drop("_known"))

    counts = (p.select(F.lit(1).alias("raw"), (~F.col("_blank")).cast("int").alias("norm"),
                       (~F.col("_blank") & F.col("_valid")).cast("int").alias("valid"),
                       (~F.col("_blank") & ~F.col("_valid")).cast("int").alias("parse_err"),
                       F.col("_blank").cast("int").alias("blank"),
                       F.lit(0).alias("match_err"), F.lit(0).alias("ok"), F.lit(0).alias("inserted"))
              .unionByName(m.select(*[F.lit(0).alias(c) for c in ["raw", "norm", "valid", "parse_err", "blank"]],
                                    F.col("reason").isNotNull().cast("int").alias("match_err"),
                                    F.lit(0).alias("ok"), F.lit(0).alias("inserted")))
              .unionByName(ok.select(*[F.lit(0).alias(c) for c in ["raw", "norm", "valid", "parse_err", "blank",
                                                                     "match_err"]],
                                     F.lit(1).alias("ok"), (F.col("action") == "INSERT").cast("int").alias("inserted"))))
    summary = counts.agg(*[F.sum(c).cast("bigint").alias(c) for c in
                           ["raw", "norm", "valid", "parse_err", "blank", "match_err", "ok", "inserted"]])
    return PaymentLoad(ok, rejects, summary, months)


def payment_load(lg: Ledger, amount_rule: str = "K3") -> PaymentLoad:
    """L7 over the landed bank file, once per ledger (the three outputs share it)."""
    cache = lg.__dict__.setdefault("_payment_loads", {})
    if amount_rule not in cache:
        cache[amount_rule] = load_payments(lg, payments_from_landed_csv(lg), amount_rule, keep=True)
    return cache[amount_rule]


def payments_from_landed_csv(lg: Ledger) -> DataFrame:
    """The derived bank file written as a real CSV and read back through A7."""
    path = landed(lg, "payments_csv", lambda p: FL.land_csv(RT.raw_payments(lg), p))
    return FL.read_payments_csv(lg.spark, path)


# ------------------------------------------------------------------ L7b
def legacy_parse(lg: Ledger, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The older loader. Layout switch on a blank 4th cell (A7b); bank id
    cleaned without upper-casing; '$' stripped before K3; parse errors found
    by (bank id, date) only, so a bad amount with a valid twin row on the
    same bank id and date goes unreported (kept as in the reference).
    Returns (parsed rows, parse errors)."""
    n = FL.legacy_payment_layout(raw).select(F.col("c2").alias("date_txt"), F.col("c3").alias("cbu_txt"),
                                             F.col("c4").alias("amount_txt"))
    cbu = F.regexp_replace(K.trim_spaces("cbu_txt"), "[" + K.NBSP + "\t .\\-]", "")
    n = (n.withColumn("cbu", F.substring(F.concat(F.lit("0" * 22), cbu), -22, 22))
         .withColumn("pay_date", K.parse_date("date_txt"))
         .withColumn("_v", F.nullif(K.trim_spaces(F.translate(F.translate("amount_txt", K.NBSP + "\t", "  "), "$", "")),
                                    F.lit(""))))
    n = n.transform(K.amount_flexible_on("_v", "_amt")).withColumn("amount", F.col("_amt").try_cast("decimal(10,2)"))
    n = store(n.drop("_v", "_amt"), os.path.join(checkpoint_dir(lg.spark), "parsed", uuid.uuid4().hex))
    ok = n.filter(F.col("pay_date").isNotNull() & F.col("amount").isNotNull() & F.col("cbu").isNotNull()
                  & (F.col("cbu") != "0" * 22)).select("pay_date", "cbu", "amount")
    errs = (n.join(ok.select("cbu", "pay_date").distinct(), ["cbu", "pay_date"], "left_anti")
            .select(F.lit(REASON_PARSE).alias("reason"),
                    *[F.nullif(F.col(c), F.lit("")).alias(c) for c in ["date_txt", "cbu_txt", "amount_txt"]]))
    return ok, errs


# ------------------------------------------------------------------ L8
QUOTE_REJECT = "JSON sin campos esperados"


def raw_quote_docs(lg: Ledger) -> DataFrame:
    """One quote document per purchase event: tipo, fecha, compra, venta as
    text; every 17th lacks 'venta', every 23rd has a comma decimal."""
    q = lg.fx_quote
    k = F.col("id_quote")
    compra = F.when(k % 23 == 0, F.translate(F.col("buy").cast("string"), ".", ",")).otherwise(F.col("buy").cast("string"))
    venta = F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("sell").cast("string"))
    return q.select(F.col("fx_type").alias("tipo"), F.col("quote_ts").cast("string").alias("fecha"),
                    compra.alias("compra"), venta.alias("venta"))


def load_quotes(lg: Ledger) -> tuple[DataFrame, DataFrame]:
    """Landed quote documents read through A8; both values must cast to
    DECIMAL(10,2), else the document is rejected. Returns (quotes, rejects);
    the quotes are the whole new quote table (U11: reset + reload)."""
    path = landed(lg, "quotes_json", lambda p: raw_quote_docs(lg).write.mode("overwrite").json(p))
    d = FL.read_fx_quotes_json(lg.spark, path)
    buy = K.try_decimal(F.col("compra"), 10, 2)
    sell = K.try_decimal(F.col("venta"), 10, 2)
    typed = d.select(F.col("tipo").alias("fx_type"), F.to_timestamp_ntz("fecha").alias("quote_ts"),
                     buy.alias("buy"), sell.alias("sell"), "compra", "venta")
    good = typed.filter(F.col("buy").isNotNull() & F.col("sell").isNotNull()).select("fx_type", "quote_ts", "buy", "sell")
    bad = typed.filter(F.col("buy").isNull() | F.col("sell").isNull()).select(
        F.lit(QUOTE_REJECT).alias("reason"), "fx_type", F.col("compra"), F.col("venta"))
    return good, bad


# ------------------------------------------------------------ B3 / B4
def export_month_department_xml(lg: Ledger, year: int = 2001) -> DataFrame:
    """R4 written as XML (RecaudacionMensual / Departamento with
    attributes) and read back with the same schema."""
    from pyspark.sql import types as T

    from .reports import collection_by_month_department
    r = collection_by_month_department(lg, year)
    out = r.select(F.concat(F.col("period"), F.lit("-01")).alias("_Periodo"), F.col("department").alias("_Departamento"),
                   F.col("total_collected").alias("_Total"))
    path = landed(lg, f"xml_r4_{year}", lambda p: out.write.mode("overwrite").format("xml")
                  .option("rootTag", "RecaudacionMensual").option("rowTag", "Departamento").save(p))
    schema = T.StructType([T.StructField("_Periodo", T.StringType()), T.StructField("_Departamento", T.StringType()),
                           T.StructField("_Total", T.DecimalType(18, 2))])
    back = lg.spark.read.format("xml").option("rowTag", "Departamento").schema(schema).load(path)
    return back.select(F.col("_Periodo").alias("period"), F.col("_Departamento").alias("department"),
                       F.col("_Total").alias("total_collected"))


def export_payment_history_xml(lg: Ledger) -> DataFrame:
    """R8 written as XML (HistorialPagos / Pago: attributes plus child
    elements) and read back."""
    from pyspark.sql import types as T

    from .reports import days_between_payments
    r = days_between_payments(lg)
    out = r.select(F.col("building_name").alias("_Consorcio"), F.col("unit_label").alias("_UnidadFuncional"),
                   F.col("id_payment").alias("_Id"),
                   F.col("pay_date").cast("string").alias("FechaPago"), F.col("prev_date").cast("string").alias("PagoAnterior"),
                   F.col("days_between").alias("DiasEntrePagos"), F.col("amount").alias("Monto"))
    path = landed(lg, "xml_r8", lambda p: out.write.mode("overwrite").format("xml")
                  .option("rootTag", "HistorialPagos").option("rowTag", "Pago").save(p))
    schema = T.StructType([T.StructField("_Consorcio", T.StringType()), T.StructField("_UnidadFuncional", T.StringType()),
                           T.StructField("_Id", T.StringType()), T.StructField("FechaPago", T.StringType()),
                           T.StructField("PagoAnterior", T.StringType()), T.StructField("DiasEntrePagos", T.LongType()),
                           T.StructField("Monto", T.DecimalType(10, 2))])
    back = lg.spark.read.format("xml").option("rowTag", "Pago").schema(schema).load(path)
    return back.select(F.col("_Consorcio").alias("building_name"), F.col("_Id").alias("id_payment"),
                       F.col("_UnidadFuncional").alias("unit_label"), F.to_date("FechaPago").alias("pay_date"),
                       F.to_date("PagoAnterior").alias("prev_date"), F.col("DiasEntrePagos").alias("days_between"),
                       F.col("Monto").alias("amount"))
