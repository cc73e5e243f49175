"""S1 and S4 over many batches: what a batch touches, replays, late rows."""

import datetime as dt
import os
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from condoledger.plans import ingest as I
from condoledger.sources import rawtext as RT
from condoledger.sources.ledger import Ledger
from condoledger.streaming import jobs as S

from conftest import SF_SMALL

DAY0 = dt.date(2001, 1, 1)


def payment_files(spark, root, dates):
    """One Parquet file per date, in the order of the list."""
    for i, days in enumerate(dates):
        d = DAY0 + dt.timedelta(days=days)
        path = f"{root}/pay_month={d:%Y%m}"
        spark.createDataFrame([(f"p{i}", 1_000_000 + d.year * 100 + d.month, d, 10)], "id_payment string, id_account long, pay_date date, amount int").select(
            "id_payment", "id_account", "pay_date", F.col("amount").cast("decimal(10,2)").alias("amount")).coalesce(1).write.mode("append").parquet(path)
        for f in os.listdir(path):
            full = os.path.join(path, f)
            if os.stat(full).st_mtime > 1_000_200_000:
                os.utime(full, (1_000_000_000 + i, 1_000_000_000 + i))
    return str(root)


def stub(spark, path):
    return SimpleNamespace(spark=spark, _landed={"payment_files": path})


@pytest.fixture
def one_partition(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")       # 100 by default
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_late_rows_are_counted_over_more_batches_than_progress_is_kept(spark, tmp_path, one_partition):
    """The early row of the third batch is late; twelve batches follow it."""
    dates = [100, 200, 5] + [200 + i // 10 for i in range(12)]
    lg = stub(spark, payment_files(spark, tmp_path / "files", dates))
    with pytest.raises(RuntimeError, match="^1 rows"):
        S.weekly_collection_stream(lg, files_per_batch=1, watermark="10 days")


def test_late_rows_may_be_let_go(spark, tmp_path, one_partition):
    lg = stub(spark, payment_files(spark, tmp_path / "files", [100, 200, 5, 201]))
    kept = S.weekly_collection_stream(lg, files_per_batch=1, watermark="10 days", allow_late=True)
    assert kept.agg(F.sum("payments")).first()[0] == 3


def test_buckets_read_and_write_only_what_a_batch_touches(spark, tmp_path):
    lg, root = SimpleNamespace(spark=spark), str(tmp_path / "b")
    schema = "k int, n int"

    def put(batch_id, rows):
        kept = S.Buckets(lg, root, batch_id)
        buckets = sorted({k % 3 for k, _ in rows})
        new = spark.createDataFrame(rows, schema).unionByName(kept.read(buckets, schema))
        new = new.groupBy("k").agg(F.sum("n").cast("int").alias("n")).withColumn("bucket", F.col("k") % 3)
        return {(r["k"], r["n"]) for r in kept.write(buckets, new).collect()}, kept.index

    assert put(0, [(0, 1), (1, 1)]) == ({(0, 1), (1, 1)}, {0: 0, 1: 0})
    second = put(1, [(3, 5), (0, 1)])
    assert second == ({(0, 2), (3, 5)}, {0: 1, 1: 0})
    assert put(1, [(3, 5), (0, 1)]) == second                       # replayed
    assert put(2, []) == (set(), {0: 1, 1: 0})
    assert put(3, [(4, 1)]) == ({(1, 1), (4, 1)}, {0: 1, 1: 3})
    assert sorted(os.listdir(f"{root}/rows/batch_id=3"))[-1] == "bucket=1"


def test_weeks_read_the_stored_payments_themselves(spark):
    """no month folders are shuffled and written for them; the same weeks as over those."""
    lg = Ledger(spark, SF_SMALL)
    weeks = lambda: sorted(tuple(r) for r in S.weekly_collection_stream(lg).collect())
    direct = weeks()
    assert direct and "payment_files" not in lg.__dict__.get("_landed", {})
    S.landed_payment_files(lg)
    assert weeks() == direct


def test_a_batch_reads_the_accounts_of_its_own_months(spark, tmp_path):
    """with the stored keys a batch gets the same rows and reads only the folders of its months, however many accounts there are."""
    lg = Ledger(spark, SF_SMALL)
    keys = I.stored_keys(lg, f"{tmp_path}/keys")
    raw = RT.raw_payments(lg).filter("c2 LIKE '1998-03-%' OR c2 LIKE '1997-01-%' OR c2 LIKE '%/13/1996'")
    plain, load = I.load_payments(lg, raw), I.load_payments(lg, raw, keys=keys)
    for a, b in ((plain.ok, load.ok), (plain.rejects, load.rejects), (plain.summary, load.summary)):
        assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))
    assert load.months == [dt.date(1998, 3, 1), dt.date(1997, 1, 1)] or load.months == [dt.date(1997, 1, 1), dt.date(1998, 3, 1)]
    read = load.ok._jdf.queryExecution().executedPlan().toString()
    assert f"{lg.root}/account" not in read and "PartitionFilters: [isnotnull(_first" in read or "PartitionFilters: [_first" in read
    none = I.load_payments(lg, raw.filter("false"), keys=keys)
    assert none.ok.isEmpty() and none.rejects.isEmpty() and none.months == []


def test_a_bill_number_of_two_months_is_found_in_both(spark, tmp_path):
    """the stored keys hold an account once, also where a bill's number or a unit's bank id repeats."""
    day = dt.date
    bills = [(7, 1, day(2000, 1, 9)), (7, 1, day(2000, 2, 9)), (8, 1, day(2000, 3, 9)), (None, 1, day(2000, 4, 9)), (9, None, day(2000, 4, 9))]
    lg = SimpleNamespace(
        spark=spark,
        unit=spark.createDataFrame([(1, 1, "5"), (2, 1, "5"), (3, None, "6"), (None, 1, "7")], "id_unit long, id_building long, cbu string"),
        bill=spark.createDataFrame(bills, "id_bill long, id_building long, issue_date date"),
        account=spark.createDataFrame([(10, 1, 7), (10, 1, 7), (11, 2, 7), (12, 1, 8), (13, None, 7), (14, 1, None)], "id_account long, id_unit long, id_bill long"),
        payment=spark.createDataFrame([], "id_account long, id_unit long, id_building long, id_bill long, pay_date date, amount decimal(12,2), cbu string"))
    raw = spark.createDataFrame([("a", f"2000-0{m}-{d:02d}", cbu, "5") for m in range(1, 6) for d in (1, 2) for cbu in "5678"], "c1 string, c2 string, c3 string, c4 string")
    keys = I.stored_keys(lg, f"{tmp_path}/keys")
    for part in (raw, raw.filter("c2 LIKE '2000-02%'"), raw.filter("c2 LIKE '2000-04%'")):
        plain, load = I.load_payments(lg, part), I.load_payments(lg, part, keys=keys, keep=True)
        for a, b in ((plain.ok, load.ok), (plain.rejects, load.rejects), (plain.summary, load.summary)):
            assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))
