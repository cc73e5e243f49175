"""Registered queries: name -> (spark job over (spark, sf_dir), oracle SQL or None)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .plans import accounts as A
from .plans import reports as R
from .sources.ledger import ledger

Job = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Job] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Job) -> Job:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- reports
@register("r3_weekly_cash_flow", O.r3_sql())
def r3_weekly_cash_flow(spark, sf_dir):
    return R.weekly_cash_flow(ledger(spark, sf_dir))


@register("r3_weekly_one_building", O.r3_sql("DATE '2000-07-15'", O.AS_OF, "7"))
def r3_weekly_one_building(spark, sf_dir):
    return R.weekly_cash_flow(ledger(spark, sf_dir), dt.date(2000, 7, 15), None, 7)


@register("r1_financial_status", O.r1_sql())
def r1_financial_status(spark, sf_dir):
    return R.financial_status(ledger(spark, sf_dir))


@register("r4_month_department", O.r4_sql(2001))
def r4_month_department(spark, sf_dir):
    return R.collection_by_month_department(ledger(spark, sf_dir), 2001)


@register("r5_origin_month", O.r5_sql("MES"))
def r5_origin_month(spark, sf_dir):
    return R.collection_by_origin(ledger(spark, sf_dir), grouping="MES")


@register("r5_origin_quarter", O.r5_sql("TRIMESTRE"))
def r5_origin_quarter(spark, sf_dir):
    return R.collection_by_origin(ledger(spark, sf_dir), grouping="TRIMESTRE")


@register("r6_top_months", O.r6_sql("blue"))
def r6_top_months(spark, sf_dir):
    return R.top_months(ledger(spark, sf_dir), fx_type="blue")


@register("r6_top_months_2000", O.r6_sql("oficial", 5, 2000))
def r6_top_months_2000(spark, sf_dir):
    return R.top_months(ledger(spark, sf_dir), year=2000, fx_type="oficial")


@register("r7_delinquent_owners", O.r7_sql(3))
def r7_delinquent_owners(spark, sf_dir):
    return R.delinquent_owners(ledger(spark, sf_dir), n=3)


@register("r7_delinquent_owners_all", O.r7_sql(None))
def r7_delinquent_owners_all(spark, sf_dir):
    return R.delinquent_owners(ledger(spark, sf_dir), n=None)


@register("r8_days_between_payments", O.r8_sql())
def r8_days_between_payments(spark, sf_dir):
    return R.days_between_payments(ledger(spark, sf_dir))


@register("r9_monthly_status", O.r9_sql(2000))
def r9_monthly_status(spark, sf_dir):
    return R.monthly_status(ledger(spark, sf_dir), 2000)


@register("r10_statement", O.r10_sql())
def r10_statement(spark, sf_dir):
    return R.account_statement(ledger(spark, sf_dir))


@register("r12_quote_age", O.r12_sql())
def r12_quote_age(spark, sf_dir):
    return R.quote_age(ledger(spark, sf_dir), dt.datetime(2024, 2, 1))


# ------------------------------------------------------------ ledger jobs
@register("j2_recompute_accounts", O.j2_sql("M1"))
def j2_recompute_accounts(spark, sf_dir):
    return A.recompute_accounts(ledger(spark, sf_dir))


@register("j3_prorate", O.j3_sql())
def j3_prorate(spark, sf_dir):
    lg = ledger(spark, sf_dir)
    return A.skeleton(lg, A.filter_bills(lg.bill)).select("id_account", "id_unit", "id_bill", "ord_amount", "ext_amount")


@register("j4_interest_m2", O.j4_sql("M2"))
def j4_interest_m2(spark, sf_dir):
    lg = ledger(spark, sf_dir)
    return A.recompute_interest(lg, lg.account, "M2")


@register("j4_interest_m1", O.j4_sql("M1"))
def j4_interest_m1(spark, sf_dir):
    lg = ledger(spark, sf_dir)
    return A.recompute_interest(lg, lg.account, "M1")


@register("j4_interest_m3", O.j4_sql("M3"))
def j4_interest_m3(spark, sf_dir):
    lg = ledger(spark, sf_dir)
    return A.recompute_interest(lg, lg.account, "M3")


# --------------------------------------------------------------- cleaning
def _register_cleaning():
    from . import oracle_clean as OC
    from .plans import cleaning as C

    for name, fn in C.JOBS.items():
        register(name, OC.k_sql(name))(lambda spark, sf_dir, fn=fn: fn(ledger(spark, sf_dir)))


_register_cleaning()


# -------------------------------------------------------------- ingestion
def _register_ingest():
    from . import oracle_ingest as OI
    from .plans import ingest as I

    def l7(spark, sf_dir):
        return I.payment_load(ledger(spark, sf_dir))

    register("l7_payments_ok", OI.l7_ok_sql())(lambda spark, sf_dir: l7(spark, sf_dir).ok)
    register("l7_payments_rejects", OI.l7_rejects_sql())(lambda spark, sf_dir: l7(spark, sf_dir).rejects)
    register("l7_load_summary", OI.l7_summary_sql())(lambda spark, sf_dir: l7(spark, sf_dir).summary)


_register_ingest()


def _register_loaders():
    from . import oracle_ingest as OI
    from .plans import loaders as LD
    from .plans import unit_loads as UL

    jobs = {
        "l1_buildings": (LD.load_buildings, OI.l1_sql()),
        "u4_insert_absent": (LD.new_buildings, OI.u4_sql()),
        "u10_surrogate_keys": (lambda lg: LD.U.surrogate_keys(LD.new_buildings(lg), LD.buildings_prior(lg),
                                                              "id_building", ["name"]), OI.u10_sql()),
        "u8_fill_nulls": (LD.fill_building_nulls, OI.u8_sql()),
        "l4_units": (lambda lg: UL.units_load(lg).units, OI.l4_sql("units")),
        "l4_rejects": (lambda lg: UL.units_load(lg).rejects, OI.l4_sql("rejects")),
        "l4_new_buildings": (lambda lg: UL.units_load(lg).buildings, OI.l4_sql("buildings")),
        "l4_load_summary": (lambda lg: UL.units_load(lg).summary, OI.l4_sql("summary")),
        "u6_update_changed": (UL.update_units, OI.u6_sql()),
        "u7_update_guarded": (UL.update_unit_bank_ids, OI.u7_sql()),
        "e5_consolidate": (UL.consolidated_areas, OI.e5_sql()),
        "l5_unit_areas": (lambda lg: UL.areas_load(lg).units, OI.l5_sql("units")),
        "l5_load_summary": (lambda lg: UL.areas_load(lg).summary, OI.l5_sql("summary")),
        "l6_people": (LD.load_people, OI.l6_sql()),
        "u5_update_nonnull": (LD.load_people, OI.l6_sql()),
        "u9_link_upsert": (LD.link_occupancy, OI.u9_sql()),
    }
    for name, (fn, sql) in jobs.items():
        register(name, sql)(lambda spark, sf_dir, fn=fn: fn(ledger(spark, sf_dir)))


_register_loaders()


def _register_jobs():
    from . import oracle_jobs as OJ
    from .plans import blocks as BL
    from .plans import dispatch as DP

    for name in ["k10_business_days", "k11_next_business_day", "k12_nth_business_day", "k13_fifth_weekday"]:
        register(name, OJ.k_cal_sql(name))(lambda spark, sf_dir, fn=getattr(BL, name): fn(ledger(spark, sf_dir)))
    jobs = {
        "d7_range_join_month": (BL.d7_range_join_month, OJ.d7_sql()),
        "d8_latest_bill_of_month": (BL.d8_latest_bill_of_month, OJ.d8_sql()),
        "d9_unpivot": (BL.d9_unpivot, OJ.d9_sql()),
        "f1_global_row_number": (BL.f1_global_row_number, OJ.f1_sql()),
        "h1_changed_keys": (BL.h1_changed_keys, OJ.h1_sql()),
        "j1_accounts": (lambda lg: A.generate_accounts(
            lg, 2001, lg.account.join(lg.bill.filter(F.col("issue_date") < F.lit(dt.date(2001, 4, 1)))
                                      .select("id_bill"), "id_bill")), OJ.j1_sql()),
        "j5_changed_accounts": (lambda lg: A.recompute_changed(lg, BL.h1_changed_keys(lg)), OJ.j5_sql()),
        "j6_next_bill": (A.next_bills, OJ.j6_sql()),
        "j7_dispatch": (lambda lg: A.dispatches(lg, A.next_bills(lg)), OJ.j7_sql()),
        "j6_next_bill_other_days": (lambda lg: A.next_bills(lg, None, 15, None), OJ.j6_other_days_sql(15)),
        "j7_dispatch_register": (lambda lg: DP.registered_twice(lg).dispatch, OJ.j7_register_sql()),
        "r11_recent_dispatches": (lambda lg: DP.recent_dispatches(DP.registered_twice(lg)), OJ.r11_dispatches_sql()),
        "j8_bill_total": (A.bill_totals, OJ.j8_sql()),
        "r11_recent_bills": (lambda lg: R.recent_bills(lg, A.next_bills(lg)), OJ.r11_sql()),
    }
    for name, (fn, sql) in jobs.items():
        register(name, sql)(lambda spark, sf_dir, fn=fn: fn(ledger(spark, sf_dir)))


_register_jobs()


def _register_quality():
    from . import oracle_checks as OC
    from . import oracle_quality as OQ
    from .plans import checks as CH
    from .plans import quality as Q

    jobs = {
        "q1_row_checks": (Q.q1_row_checks, OQ.q1_sql()),
        "q2_uniqueness": (Q.q2_uniqueness, OQ.q2_sql()),
        "q3_referential": (Q.q3_referential, OQ.q3_sql()),
        "q1_bad_rows": (CH.q1_bad_rows, OC.q1_bad_rows_sql()),
        "q2_repeated_keys": (CH.q2_repeated_keys, OC.q2_repeated_keys_sql()),
        "q3_orphan_rows": (CH.q3_orphan_rows, OC.q3_orphan_rows_sql()),
        "q1_q3_whole_load": (CH.whole_load_checks, OC.whole_load_checks_sql()),
        "q4_building_profile": (Q.q4_building_profile, OQ.q4_sql()),
        "q5_unit_count": (Q.q5_unit_count, OQ.q5_sql()),
        "q6_extraordinary_bills": (Q.q6_extraordinary_bills, OQ.q6_sql()),
        "q7_accounts_per_bill": (Q.q7_accounts_per_bill, OQ.q7_sql()),
        "q8_interest_audit": (Q.q8_interest_audit, OQ.q8_sql()),
        "q10_owner_debt": (Q.q10_owner_debt, OQ.q10_sql()),
        "r2_safe_person": (Q.r2_safe_person, OQ.person_plain_sql()),
        "j9_encrypt_roundtrip": (Q.j9_encrypt_roundtrip, OQ.person_cipher_roundtrip_sql()),
        "k14_encrypt_roundtrip": (Q.k14_encrypt_roundtrip, OQ.k14_sql()),
        "q9_payments_decrypted": (Q.q9_payments_decrypted, OQ.q9_sql()),
        "j9_refreshed": (lambda lg: Q.S.refreshed(lg, "person"), OQ.j9_counts_sql()),
        "j10_sync_roundtrip": (Q.j10_sync_roundtrip, OQ.j10_sql()),
    }
    for name, (fn, sql) in jobs.items():
        register(name, sql)(lambda spark, sf_dir, fn=fn: fn(ledger(spark, sf_dir)))


_register_quality()


def _register_expenses():
    from . import oracle_expenses as OX
    from . import oracle_ingest as OI
    from .plans import expenses as X
    from .plans import ingest as I

    jobs = {
        "u1_merge_bills": (lambda lg: X.monthly_load(lg).bills, OX.l3_sql("bills")),
        "l3_expenses_json": (lambda lg: X.monthly_load(lg).expenses, OX.l3_sql("expenses")),
        "l3_new_buildings": (lambda lg: X.monthly_load(lg).buildings, OX.l3_sql("buildings")),
        "l3_ordinary_details": (lambda lg: X.monthly_load(lg).ordinary, OX.l3_sql("ordinary")),
        "u2_merge_expenses": (X.merge_expenses, OX.l3_sql("merged")),
        "l2_supplier_expenses": (lambda lg: X.supplier_load(lg).expenses, OX.l2_sql("expenses")),
        "l2_ordinary_details": (lambda lg: X.supplier_load(lg).ordinary, OX.l2_sql("ordinary")),
        "l9_extraordinary": (lambda lg: X.works_load(lg).expenses.join(X.works_load(lg).extraordinary, "id_expense"), OX.l9_sql("expenses")),
        "l9_bills": (lambda lg: X.works_load(lg).bills, OX.l9_sql("bills")),
        "l9_extraordinary_all_years": (X.work_totals, OX.l9_sql("totals")),
        "k8_latest_quote": (R.latest_quotes, OX.k8_sql()),
        "k9_dollars": (R.bills_in_dollars, OX.k9_sql()),
        "u3_merge_payments": (lambda lg: I.payment_load(lg).ok.filter(F.col("action") == "INSERT"),
                              OI.with_ledger(*OI._l7_ctes(), select="SELECT * FROM ok WHERE action = 'INSERT'")),
    }
    for name, (fn, sql) in jobs.items():
        register(name, sql)(lambda spark, sf_dir, fn=fn: fn(ledger(spark, sf_dir)))


_register_expenses()


def _register_files():
    from . import oracle_ingest as OI
    from .plans import ingest as I

    def l7b(lg):
        return I.legacy_parse(lg, I.payments_from_landed_csv(lg))

    jobs = {
        "l7b_legacy_loader": (lambda lg: l7b(lg)[1], OI.l7b_sql("errors")),
        "l7b_legacy_parsed": (lambda lg: l7b(lg)[0], OI.l7b_sql("parsed")),
        "l8_quotes": (lambda lg: I.load_quotes(lg)[0], OI.l8_sql("quotes")),
        "l8_quote_rejects": (lambda lg: I.load_quotes(lg)[1], OI.l8_sql("rejects")),
        "u11_reset": (lambda lg: I.load_quotes(lg)[0], OI.l8_sql("quotes")),
        "b3_month_department_xml": (I.export_month_department_xml, OI.b3_sql()),
        "b4_payment_history_xml": (I.export_payment_history_xml, OI.b4_sql()),
    }
    for name, (fn, sql) in jobs.items():
        register(name, sql)(lambda spark, sf_dir, fn=fn: fn(ledger(spark, sf_dir)))


_register_files()


# ----------------------------------------------------- whole load
def _register_whole_load():
    from . import oracle_load as OL
    from .plans import load_run as LR

    def expenses(lg):
        st = LR.whole_load(lg)
        return st.expense.join(st.ordinary.drop("invoice"), "id_expense", "left").join(st.extraordinary, "id_expense", "left")
    for table in ("building", "unit", "person", "occupancy", "bill", "expense", "account", "payment", "reject", "log"):
        fn = expenses if table == "expense" else lambda lg, table=table: getattr(LR.whole_load(lg), table)
        register(f"l10_{table}", OL.l10_sql(table))(lambda spark, sf_dir, fn=fn: fn(ledger(spark, sf_dir)))


_register_whole_load()


# ----------------------------------------------------- pipeline and batch
PIPELINE_STEPS = ["l1_buildings", "l2_supplier_expenses", "l4_units", "l5_unit_areas", "l6_people",
                  "l3_expenses_json", "j1_accounts", "l7_payments_ok", "l9_extraordinary", "j4_interest_m2"]
REPORT_BATCH = ["r3_weekly_cash_flow", "r3_weekly_one_building", "b3_month_department_xml", "r5_origin_month",
                "r5_origin_quarter", "r6_top_months", "r7_delinquent_owners", "r7_delinquent_owners_all",
                "b4_payment_history_xml", "j6_next_bill", "r11_recent_bills"]


def _counts(spark, sf_dir, names: list[str], label: str) -> DataFrame:
    """One row per job: (step number, name, rows, level) - the run log."""
    from functools import reduce
    parts = [QUERIES[n](spark, sf_dir).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(i + 1).cast("bigint").alias("step_no"), F.lit(n).alias(label), "rows",
                     F.lit("INFO").alias("level"))
             for i, n in enumerate(names)]
    return reduce(DataFrame.unionByName, parts)


def _counts_sql(names: list[str], label: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT CAST({i + 1} AS BIGINT) AS step_no, '{n}' AS {label}, count(*) AS rows, 'INFO' AS level FROM ({SQL[n]})"
        for i, n in enumerate(names))


register("l10_pipeline_counts", _counts_sql(PIPELINE_STEPS, "step"))(
    lambda spark, sf_dir: _counts(spark, sf_dir, PIPELINE_STEPS, "step"))
register("r13_report_batch", _counts_sql(REPORT_BATCH, "report"))(
    lambda spark, sf_dir: _counts(spark, sf_dir, REPORT_BATCH, "report"))


def _register_streaming():
    from . import oracle_jobs as OJ
    from .streaming import jobs as S

    jobs = {
        "s1_affected_accounts": (S.affected_accounts_stream, OJ.s1_sql()),
        "s2_payment_stream": (S.payment_file_stream, OJ.s2_sql()),
        "s3_latest_quote_stream": (S.latest_quote_stream, OJ.s3_sql()),
        "s4_weekly_stream": (S.weekly_collection_stream, OJ.s4_sql()),
    }
    for name, (fn, sql) in jobs.items():
        register(name, sql)(lambda spark, sf_dir, fn=fn: fn(ledger(spark, sf_dir)))


_register_streaming()


# R6's two result sets under their own names (the union stays as r6_top_months)
register("r6_top_expense_months",
         f"SELECT * FROM ({O.r6_sql('blue')}) WHERE movement = 'GASTOS'")(
    lambda spark, sf_dir: R.top_expense_months(ledger(spark, sf_dir), fx_type="blue"))
register("r6_top_income_months",
         f"SELECT * FROM ({O.r6_sql('blue')}) WHERE movement = 'INGRESOS'")(
    lambda spark, sf_dir: R.top_income_months(ledger(spark, sf_dir), fx_type="blue"))
