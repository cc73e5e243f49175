"""Property checks of SURVEY §5(c) on the sf0.001 ledger."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from condoledger.operators import upsert as U
from condoledger.operators.windows import global_row_number, previous_event
from condoledger.plans import ingest as I
from condoledger.sources.ledger import ledger


@pytest.fixture(scope="module")
def lg(spark):
    return ledger(spark, SF_SMALL)


def test_l7_accounts_for_every_row(lg):
    raw = I.payments_from_landed_csv(lg)
    load = I.load_payments(lg, raw)
    s = load.summary.first()
    n = raw.count()
    assert s.raw == n
    assert s.blank + s.parse_err + s.valid == n
    assert load.rejects.count() == s.blank + s.parse_err + s.match_err
    # accepted rows are distinct, so accepted <= valid - match errors
    assert s.ok <= s.valid - s.match_err


def test_l7_replay_is_idempotent(lg):
    raw = I.payments_from_landed_csv(lg)
    first = I.load_payments(lg, raw).ok
    inserted = first.filter("action = 'INSERT'").drop("action")
    existing = lg.payment.select(*I.PAYMENT_KEY).unionByName(inserted.select(*I.PAYMENT_KEY))
    again = I.load_payments(lg, raw, existing=existing).ok
    assert again.filter("action = 'INSERT'").count() == 0
    assert again.count() == first.count()


def test_upsert_twice_equals_once(lg):
    b = lg.bill.select("id_bill", "id_building", "issue_date", "due1", "due2", "total")
    src = b.filter(F.col("id_building") < 5).withColumn("total", F.col("total") + 1)
    once = U.merge_upsert(b, src, ["id_building", "issue_date"], ["total"]).drop("action")
    twice = U.merge_upsert(once, src, ["id_building", "issue_date"], ["total"]).drop("action")
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    new = U.insert_only(b, src, ["id_bill"]).filter("action = 'INSERT'")
    assert new.count() == 0


def test_global_row_number_matches_window(lg):
    a = lg.account.select("id_account", "id_building", "id_bill", "id_unit")
    ours = global_row_number(a, ["id_building", "id_bill", "id_unit"]).select("id_account", "row_id")
    w = Window.orderBy("id_building", "id_bill", "id_unit")
    plain = a.select("id_account", F.row_number().over(w).cast("bigint").alias("row_id"))
    assert ours.exceptAll(plain).count() == 0


def test_previous_event_matches_lag(lg):
    p = lg.payment.select("id_payment", "id_unit", "pay_date")
    ours = previous_event(p, "id_unit", "pay_date", "id_payment").select("id_payment", "prev_date")
    w = Window.partitionBy("id_unit").orderBy("pay_date", "id_payment")
    plain = p.select("id_payment", F.lag("pay_date").over(w).alias("prev_date"))
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def test_proration_sums_to_bill(lg):
    from condoledger.plans.accounts import filter_bills, skeleton
    sk = skeleton(lg, filter_bills(lg.bill))
    per = sk.groupBy("id_bill").agg(F.sum("ord_amount").alias("o"), F.count(F.lit(1)).alias("n"))
    from condoledger.plans.accounts import expense_totals
    tot = expense_totals(lg.expense)
    diff = per.join(tot, "id_bill").select(F.abs(F.col("o") - F.col("tot_ord")).alias("d"), "n")
    # each unit's share is rounded to the cent: the residual is at most half a cent per unit
    assert diff.filter(F.col("d") > F.col("n") * 0.005).count() == 0


def test_file_readers_roundtrip(spark, lg, tmp_path):
    from condoledger.sources import files as FL
    from condoledger.sources import rawtext as RT
    people = RT.raw_people(lg)
    p = str(tmp_path / "people")
    people.write.option("header", True).option("sep", ";").option("encoding", "iso-8859-1").csv(p)
    back = FL.read_people_semicolon(spark, p)
    assert back.count() == people.count()
    units = RT.raw_units(lg)
    u = str(tmp_path / "units")
    units.write.option("header", True).option("sep", "|").csv(u)
    assert FL.read_units_pipe(spark, u).count() == units.count()
    areas = RT.raw_areas(lg)
    a = str(tmp_path / "areas")
    areas.write.option("header", True).option("sep", "\t").csv(a)
    assert FL.read_areas_tab(spark, a).count() == areas.count()
    exp = RT.raw_expenses(lg).drop("anio")
    j = tmp_path / "exp.json"          # the reference's layout: one JSON array per file (small fixture)
    j.write_text("[" + ",\n".join(exp.toJSON().collect()) + "]", encoding="utf-8")
    assert FL.read_expenses_json(spark, str(j)).count() == exp.count()


def test_streams_match_batch(lg):
    from condoledger.streaming import jobs as S
    weeks = S.weekly_collection_stream(lg)
    p = lg.payment                      # the whole table, as the job reads it
    batch = p.groupBy(F.to_date(F.date_trunc("week", F.date_add("pay_date", 1))).alias("week_start")).agg(
        F.sum("amount").cast("decimal(18,2)").alias("total"), F.count(F.lit(1)).alias("payments"))
    assert weeks.exceptAll(batch.select(*weeks.columns)).count() == 0
    assert batch.count() == weeks.count()
    assert all(r.week_start.weekday() == 0 for r in weeks.select("week_start").collect())   # Mondays


def test_dedupe_first_and_surrogate_keys(spark):
    from condoledger.operators.upsert import dedupe_first, surrogate_keys
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z"), ("a", 1, "w")], "k string, o int, v string")
    got = {r.k: (r.o, r.v) for r in dedupe_first(df, ["k"], ["o", "v"]).collect()}
    assert got == {"a": (1, "w"), "b": (2, "z")}
    existing = spark.createDataFrame([(7,)], "id long")
    keys = surrogate_keys(spark.createDataFrame([("q",), ("c",), ("m",)], "name string"), existing, "id", ["name"])
    assert sorted((r.name, r.id) for r in keys.collect()) == [("c", 8), ("m", 9), ("q", 10)]


def test_blank_cell_of_a_repeated_key_hides_no_value(spark):
    from condoledger.operators import upsert as U
    target = spark.createDataFrame([(1, None, "old")], "k int, a string, b string")
    source = spark.createDataFrame([(1, None, "new"), (1, "x", None)], "k int, a string, b string")
    for job, want in ((U.update_nonnull, (1, "x", "new")), (U.update_changed, (1, "x", "new")), (U.fill_nulls, (1, "x", "old"))):
        assert [tuple(r)[:3] for r in job(target, source, ["k"], ["a", "b"]).collect()] == [want]
