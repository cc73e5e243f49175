"""The cents form of the interest rules equals the decimal specification."""

import datetime as dt
from decimal import Decimal as D

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from condoledger.functions import interest as I

AS_OF = dt.date(2001, 7, 15)
dates = st.one_of(st.none(), st.dates(dt.date(2001, 5, 1), dt.date(2001, 9, 30)))
money = st.decimals(min_value=D("-5000"), max_value=D("900000"), places=2, allow_nan=False)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(money, st.one_of(st.none(), money), dates, dates, dates), min_size=60, max_size=60))
def test_cents_equal_decimal(spark, rows):
    df = spark.createDataFrame(rows, "base decimal(18,2), paid decimal(18,2), last date, due1 date, due2 date")
    c = F.col
    for rule in ("M1", "M2", "M3"):
        dec = I.interest(c("base"), c("paid"), c("last"), c("due1"), c("due2"), rule, AS_OF)
        cen = I.interest_cents((c("base") * 100).cast("long"), (c("paid") * 100).cast("long"), c("last"),
                               c("due1"), c("due2"), rule, AS_OF)
        out = df.select(dec.alias("d"), (cen.cast("decimal(18,0)") / 100).cast("decimal(18,2)").alias("c")).collect()
        assert all(r["d"] == r["c"] for r in out), rule


def test_reference_examples(spark):
    # FIXTURES §3: bill B2 (due 02-15 / 02-25), base 52000, rule M2
    rows = [(D("52000"), D("52000"), dt.date(2025, 2, 10)), (D("52000"), D("40000"), dt.date(2025, 2, 18)),
            (D("52000"), D("30000"), dt.date(2025, 3, 1)), (D("52000"), None, None)]
    df = spark.createDataFrame(rows, "base decimal(18,2), paid decimal(18,2), last date")
    e = I.interest(F.col("base"), F.col("paid"), F.col("last"), F.lit(dt.date(2025, 2, 15)),
                   F.lit(dt.date(2025, 2, 25)), "M2", AS_OF)
    assert [r[0] for r in df.select(e).collect()] == [D("0.00"), D("240.00"), D("1100.00"), D("0.00")]
