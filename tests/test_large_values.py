"""Limits that only bite above the tested size, and files that repeat keys."""

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from condoledger.functions.interest import _pct_cents
from condoledger.operators import upsert as U
from condoledger.plans.accounts import prorate_cents
from condoledger.sources.ledger import zero_padded


def test_prorate_is_exact_beyond_doubles(spark):
    rows = [(4_505_373_348_589_290, 600, 46_885_773_600), (9_999_999_999_999_999, 700, 700), (-9_999_999_999_999_999, 1, 3),
            (90_071_992_547_409_930, 350, 12_345_678_901), (5, 1, 2), (-5, 1, 2), (0, 3, 7), (10, 3, 0)]
    df = spark.createDataFrame(rows, "t long, w long, s long")
    got = [r.q for r in df.select("t", prorate_cents(F.col("t"), F.col("w"), F.col("s")).alias("q")).collect()]
    want = [None if not s else int((Decimal(t) * w / s).copy_abs().quantize(Decimal(1), ROUND_HALF_UP)) * (1 if t >= 0 else -1) for t, w, s in rows]
    # Decimal division carries 28 digits here: check the ties exactly
    exact = [None if not s else (1 if t >= 0 else -1) * ((abs(t) * w * 2 + s) // (2 * s)) for t, w, s in rows]
    assert got == exact and want[0] == exact[0] == 57_655_528


def test_interest_is_exact_beyond_doubles(spark):
    rows = [(9_007_199_254_740_993_025,), (4_611_686_018_427_387_925,), (-25,), (25,), (0,)]
    got = [r.q for r in spark.createDataFrame(rows, "a long").select(_pct_cents(2, F.col("a")).alias("q")).collect()]
    assert got == [(1 if a >= 0 else -1) * ((abs(a) * 4 + 100) // 200) for a, in rows]


def test_long_keys_stay_different(spark):
    got = [r.p for r in spark.createDataFrame([(7,), (12345678,), (123456789,), (123456788,)], "k long").select(zero_padded(F.col("k"), 8).alias("p")).collect()]
    assert got == ["00000007", "12345678", "123456789", "123456788"]


def test_repeated_source_keys_do_not_multiply(spark):
    target = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "id long, name string, more string")
    source = spark.createDataFrame([(1, "z", "p"), (1, "c", "q"), (2, None, "y"), (3, "n", "m"), (3, "n", "m")], "id long, name string, more string")
    assert U.update_changed(target, source, ["id"], ["name", "more"]).count() == 2
    assert U.update_nonnull(target, source, ["id"], ["name", "more"]).count() == 2
    assert U.fill_nulls(target, source, ["id"], ["more"]).count() == 2
    assert sorted(r.id for r in U.merge_upsert(target, source, ["id"], ["name", "more"]).collect()) == [1, 2, 3]
    assert {r.id: r.n_rows for r in U.repeated_keys(source, ["id"]).collect()} == {1: 2, 3: 2}


def test_two_claims_on_one_value(spark):
    target = spark.createDataFrame([(1, None), (2, None), (3, "held"), (4, None)], "id long, cbu string")
    source = spark.createDataFrame([(2, "new"), (1, "new"), (9, "new"), (4, "held")], "id long, cbu string")
    got = {r.id: r.cbu for r in U.update_guarded_unique(target, source, "id", "cbu").collect()}
    assert got == {1: "new", 2: None, 3: "held", 4: None}
