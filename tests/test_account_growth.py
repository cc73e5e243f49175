"""What grows with units x bills is not shuffled to build the accounts (F24, F25, F27, F29, F36, F40), and R6's lists read their own table."""

import contextlib
import datetime as dt
import io
import re
import time
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from condoledger.operators import joins as J
from condoledger.operators import upsert as U
from condoledger.plans import accounts as A
from condoledger.plans import ingest as I
from condoledger.plans import quality as Q
from condoledger.plans import reports as R
from condoledger.plans import unit_loads as UL
from condoledger.sources import rawtext as RT
from condoledger.sources.ledger import Ledger, account_id, account_unit

SF_SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_accounts_move_no_rows_of_units_times_bills(spark):
    text = plan(A.recompute_accounts(Ledger(spark, SF_SMALL)))
    window = text[text.index("Window"):]
    before_join = window[:window.index("SortMergeJoin")]
    assert "Exchange hashpartitioning" not in before_join and "Generate" not in before_join


def test_account_numbers_give_their_unit(spark):
    rows = [(1,), (0,), (900_000,), (-7,), (None,)]
    df = spark.createDataFrame(rows, "u long").withColumn("a", account_id(F.col("u"), F.lit(dt.date(1999, 12, 1))))
    assert [r[0] for r in df.select(account_unit(F.col("a"))).collect()] == [r[0] for r in rows]


def test_payment_totals_reach_every_unit_with_the_number(spark):
    """A repeated unit, a unit without payments, a unit and a payment without numbers."""
    class Small:
        unit = spark.createDataFrame([(1, 5, 10), (1, 5, 10), (2, 5, 10), (None, 5, 10)], "id_unit long, id_building long, share int") \
            .withColumn("share", F.col("share").cast("decimal(5,2)"))
        payment = spark.createDataFrame([(1_200001, 3, dt.date(2000, 1, 9)), (1_200001, 4, dt.date(2000, 1, 2)), (1_200002, 5, dt.date(2000, 2, 2)),
                                         (None, 6, dt.date(2000, 1, 1))], "id_account long, amount int, pay_date date") \
            .withColumn("amount", F.col("amount").cast("decimal(10,2)"))
    got = [(r["id_unit"], r["_totals"] and {k: tuple(v) for k, v in r["_totals"].items()}) for r in A.units_with_totals(Small).collect()]
    one = {1_200001: (Decimal("7.00"), dt.date(2000, 1, 9)), 1_200002: (Decimal("5.00"), dt.date(2000, 2, 2))}
    assert sorted(got, key=str) == sorted([(1, one), (1, one), (2, None), (None, None)], key=str)


def test_owners_are_found_per_unit(spark):
    """The person table meets the units, so accounts pass one shuffle."""
    text = plan(R.account_statement(Ledger(spark, SF_SMALL)).hint("merge"))
    owner_join = text[text.index("cbu"):]
    assert "id_account" not in owner_join and "debt" not in owner_join


def test_top_expenses_do_not_build_payments(spark):
    lg = Ledger(spark, SF_SMALL)
    assert {r["movement"] for r in R.top_expense_months(lg).collect()} == {"GASTOS"}
    assert "payment" not in lg.__dict__ and "account" not in lg.__dict__
    income = Ledger(spark, SF_SMALL)
    assert {r["movement"] for r in R.top_income_months(income).collect()} == {"INGRESOS"} and "expense" not in income.__dict__


def test_joins_with_growing_tables_are_not_broadcast(spark, tmp_path):
    """Their other side is not collected in the driver, however small its files are."""
    keys = spark.range(1000).select(F.col("id").alias("id_unit"), F.col("id").alias("id_bill"), F.col("id").alias("id_building"), F.lit("a").alias("cbu"))
    keys.write.parquet(f"{tmp_path}/keys")
    stored = spark.read.parquet(f"{tmp_path}/keys")
    for df in (U.insert_absent(stored, stored, ["id_unit"]), U.update_changed(stored, stored, ["id_unit"], ["cbu"]), U.merge_upsert(stored, stored, ["id_unit"], ["cbu"]),
               U.update_nonnull(stored, stored, ["id_unit"], ["cbu"]), U.fill_nulls(stored, stored, ["id_unit"], ["cbu"]),
               U.update_guarded_unique(stored, stored, "id_unit", "cbu"), UL.null_safe_rows(stored, stored.select("id_unit"), "left_semi")):
        assert "Broadcast" not in plan(df)

    lg = Ledger(spark, SF_SMALL)
    assert "left_anti" not in plan(A.generate_accounts(lg, None)).lower()
    missing = plan(A.generate_accounts(lg, None, lg.account))
    assert [line for line in missing.splitlines() if "LeftAnti" in line and "SortMergeJoin" in line] and "BroadcastHashJoin" not in [
        line.split()[0] for line in missing.splitlines() if "LeftAnti" in line]


def test_foreign_keys_of_growing_parents_are_sorted(spark, tmp_path):
    """neither broadcast nor hashed, and orphans are counted as before."""
    spark.createDataFrame([(1,), (1,), (2,), (None,)], "id_account long").write.parquet(f"{tmp_path}/parent")
    parent = spark.read.parquet(f"{tmp_path}/parent")
    child = spark.createDataFrame([(1,), (3,), (3,), (None,)], "id_account long")
    found = Q._orphans(child, parent, "x", "id_account", "id_account", grows=True)
    text = plan(found)
    assert "SortMergeJoin" in text and "Broadcast" not in text and text.count("HashAggregate") == 2
    assert found.first()["orphans"] == 2
    lg = Ledger(spark, SF_SMALL)
    assert plan(Q.q3_referential(lg)).count("SortMergeJoin") >= 3


def test_a_file_of_few_days_meets_the_accounts_of_its_months(spark):
    """accounts of other months are left before the shuffle."""
    lg = Ledger(spark, SF_SMALL)
    raw = RT.raw_payments(lg).filter("c2 LIKE '1998-03-%'")
    load = I.load_payments(lg, raw)
    text = plan(load.ok)
    assert "LeftSemi" in text and text.index("LeftSemi") > text.index("Exchange")
    whole = {tuple(r) for r in I.payment_load(lg).ok.collect()}
    got = {tuple(r) for r in load.ok.collect()}
    assert got and got <= whole


def test_accounts_are_not_sorted(spark):
    """the previous balance comes from the bill before, so units x bills are neither sorted nor put in a window behind the join with the bills."""
    text = plan(A.recompute_accounts(Ledger(spark, SF_SMALL)))
    assert not {"Sort", "Window", "Exchange"} & set(text[:text.index("BroadcastHashJoin")].replace("(", " ").split())


def test_previous_balance_of_repeated_units_and_bills_of_a_day(spark, tmp_path):
    """each row of a unit takes the balance of its row before, in the order of its bills; rows of a repeated unit follow each other in each bill."""
    class Small:
        root, as_of = str(tmp_path), dt.date(2000, 4, 1)
        unit = spark.createDataFrame([(1, 5, 1), (2, 5, 3), (2, 5, 3), (3, 6, 1), (4, None, 1), (None, 6, 1)], "id_unit long, id_building long, share int") \
            .withColumn("share", F.col("share").cast("decimal(5,2)"))
        bill = spark.createDataFrame(
            [(5_200002, 5, dt.date(2000, 2, 1)), (5_200001, 5, dt.date(2000, 1, 1)), (5_200003, 5, dt.date(2000, 2, 1)), (6_200001, 6, dt.date(2000, 1, 1))],
            "id_bill long, id_building long, issue_date date").withColumns(
            {"month_start": F.to_date(F.substring(F.col("id_bill").cast("string"), 2, 6), "yyyyMM"), "due1": F.date_add("issue_date", 9),
             "due2": F.date_add("issue_date", 19), "total": F.lit(7).cast("decimal(18,2)")})
        expense = spark.createDataFrame([(5_200001, "Ordinario", 70), (5_200002, "Ordinario", 700), (5_200003, "Ordinario", 7000), (6_200001, "Extraordinario", 10)],
                                        "id_bill long, kind string, amount int").withColumn("amount", F.col("amount").cast("decimal(10,2)"))
        payment = spark.createDataFrame([(1_200001, 4, dt.date(2000, 1, 5)), (2_200002, 400, dt.date(2000, 2, 28))], "id_account long, amount int, pay_date date") \
            .withColumn("amount", F.col("amount").cast("decimal(10,2)"))

    def balances(**how):
        rows = A.recompute_accounts(Small, **how).collect()
        return sorted((str(r["id_unit"]), r["id_bill"], float(r["prev_balance"])) for r in rows)

    # shares 1, 3, 3 of 7: 10, 30, 30; 100, 300, 300; 1000, 3000, 3000; interest of 5 % where nothing was paid
    assert balances() == [
        ("1", 5_200001, 0), ("1", 5_200002, 6), ("1", 5_200003, 105), ("2", 5_200001, 0), ("2", 5_200001, 31.5), ("2", 5_200002, -100), ("2", 5_200002, 31.5),
        ("2", 5_200003, -100), ("2", 5_200003, 3150), ("3", 6_200001, 0), ("None", 6_200001, 0)]
    assert balances(balance="reference")[:7] == [
        ("1", 5_200001, 0), ("1", 5_200002, 10), ("1", 5_200003, 100), ("2", 5_200001, 0), ("2", 5_200001, 30), ("2", 5_200002, 30), ("2", 5_200002, 300)]


def test_payments_move_numbers_only(spark):
    """the columns that no payment shows and the texts made of its keys stay out of the shuffles."""
    lg = Ledger(spark, SF_SMALL)
    seen = []
    lg._store = lambda name, df, range_by=None: seen.append(df) or df
    lg.payment
    text = seen[0]._jdf.queryExecution().toString()
    moved = text[text.rindex("Exchange rangepartitioning"):]
    assert not any(c in moved for c in ("l_extendedprice", "l_discount", "l_tax", "l_shipdate", "concat_ws", "lpad"))


def test_payments_of_repeated_lines_are_numbered(spark, tmp_path):
    """a line there three times, twice with one quantity, is three payments."""
    spark.createDataFrame([(1, 7, 3, 1, 2.0), (1, 7, 3, 1, 1.0), (1, 7, 3, 1, 2.0), (1, 7, 3, 2, None)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 9, 5.0, dt.datetime(2000, 3, 4), "2-HIGH")],
                          "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(9, 4)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    got = sorted((r["id_payment"], r["id_account"], r["pay_date"], r["amount"] and int(r["amount"])) for r in Ledger(spark, str(tmp_path)).payment.collect())
    assert got == [("1-1-7-3-1", 9_200003, dt.date(2000, 3, 20), 200), ("1-1-7-3-2", 9_200003, dt.date(2000, 3, 20), 400),
                   ("1-1-7-3-3", 9_200003, dt.date(2000, 3, 20), 400), ("1-2-7-3-1", 9_200003, dt.date(2000, 3, 25), None)]


class LoadedLedger:
    """Units, bills and expenses of a ledger without payments, as the whole load has them."""
    def __init__(self, lg: Ledger):
        self.root, self.as_of, self.unit, self.bill, self.expense = lg.root, lg.as_of, lg.unit, lg.bill, lg.expense
        self.payment = lg.spark.createDataFrame([], "id_account long, amount decimal(12,2), pay_date date")


def test_units_are_dealt_out_by_the_rows_they_become(spark, monkeypatch):
    """F2-F13 (J2 and J1 of the whole load): units of few bytes are not put together in one task that makes all of their accounts."""
    monkeypatch.setattr(A, "ROWS_A_TASK", 20_000, raising=False)
    lg = LoadedLedger(Ledger(spark, SF_SMALL))
    lg.unit = lg.unit.crossJoin(spark.range(20)).withColumn("id_unit", F.col("id_unit") + 1000 * F.col("id")).drop("id")
    for made in (A.recompute_accounts(lg), A.generate_accounts(lg, None)):
        tasks = Counter(r["_p"] for r in made.withColumn("_p", F.spark_partition_id()).collect())
        assert len(tasks) > 3 and max(tasks.values()) < tasks.total() / 2
    assert A.deals(lg.unit, lg.bill.limit(0)) == 1


def test_account_rows_are_compiled(spark):
    """No method of J2's generated code passes the 8,000 bytes above which the JVM only interprets it."""
    lg, text = LoadedLedger(Ledger(spark, SF_SMALL)), io.StringIO()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(text):
            A.recompute_accounts(lg).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000


def test_payments_are_reconciled_once_for_three_outputs(spark):
    """F14, F15 (and F2-F13): accepted rows, rejects and counts read the stored rows; none of them meets units or accounts again."""
    lg = Ledger(spark, SF_SMALL)
    load = I.payment_load(lg)
    for df in (load.ok, load.rejects, load.summary):
        text = df._jdf.queryExecution().toString()
        assert f"{lg.root}/account" not in text and f"{lg.root}/unit" not in text
    once = I.load_payments(lg, I.payments_from_landed_csv(lg))
    for a, b in ((load.ok, once.ok), (load.rejects, once.rejects), (load.summary, once.summary)):
        assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))


def test_shuffle_files_of_a_stored_table_go_with_its_write(spark, tmp_path):
    """they are not kept until the driver collects its garbage; the session's setting stays, also after writes inside one another."""
    blocks = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = lambda: {x for x in (str(b) for b in blocks().mkString(",").split(",")) if x.startswith("shuffle_")}
    before, setting = names(), spark.conf.get(J.CLEANUP)
    J.store(spark.range(5000).selectExpr("id % 97 AS k", "id AS v").repartition(7, "k"), f"{tmp_path}/a")
    for _ in range(30):
        if not names() - before:
            break
        time.sleep(0.1)
    assert not names() - before
    with J.shuffles_freed(spark):
        with J.shuffles_freed(spark):
            pass
        assert spark.conf.get(J.CLEANUP) == "true"
    assert spark.conf.get(J.CLEANUP) == setting
