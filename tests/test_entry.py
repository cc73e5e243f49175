"""The driver contract: entry() runs on sf0.001 and the queries are registered."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from condoledger.registry import QUERIES, SQL
from condoledger.sources.ledger import ledger


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["week_start", "ordinary", "extraordinary", "total", "weekly_avg", "running_total"]


def test_every_ledger_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_l9_inserts_the_works_of_every_year(spark):
    lg = ledger(spark, E.SMOKE_DIR)
    bills = lg.bill.select("id_bill", F.year("month_start").alias("year"))
    got = E.queries()["l9_extraordinary_all_years"](spark, E.SMOKE_DIR).join(bills, "id_bill")
    urgent = lg.orders_b.filter("o_orderpriority = '1-URGENT'").select(F.year("order_date")).distinct()
    years = {r[0] for r in urgent.collect()}
    assert {r.year for r in got.select("year").distinct().collect()} == years and len(years) > 1
