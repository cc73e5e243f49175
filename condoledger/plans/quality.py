"""Data-quality jobs Q1–Q10: the reference's constraints and
test queries as jobs over whole tables. Each check is one aggregation pass
(conditional sums), never a row-by-row driver loop."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import unbounded
from ..sources.ledger import EXTRAORDINARY, Ledger
from . import secure as S
from .reports import bills_side


def _violations(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """One pass: count rows violating each rule; long form (table, rule, violations)."""
    agg = df.agg(*[F.sum(F.when(cond, 1).otherwise(0)).cast("bigint").alias(name) for name, cond in rules.items()])
    return agg.unpivot([], list(rules), "rule", "violations").select(F.lit(table).alias("tbl"), "rule", "violations")


def digits_only(c: str) -> Column:
    return F.col(c).isNotNull() & ~F.col(c).rlike("^[0-9]*$")


def q1_row_checks(lg: Ledger) -> DataFrame:
    """Q1: CHECK constraints of every table as violation counts."""
    c = F.col
    parts = [
        _violations(lg.person, "person", {"dni_range": ~((c("dni") > 0) & (c("dni") < 100_000_000)),
                                          "cbu_digits": digits_only("cbu")}),
        _violations(lg.building, "building", {"total_area_positive": c("total_area") <= 0}),
        _violations(lg.unit, "unit", {"area_non_negative": c("area") < 0, "storage_non_negative": c("storage_m2") < 0,
                                      "garage_non_negative": c("garage_m2") < 0,
                                      "share_range": (c("share") <= 0) | (c("share") > 100),
                                      "cbu_digits": digits_only("cbu")}),
        _violations(lg.bill, "bill", {"due1_after_issue": c("due1") < c("issue_date"), "due2_after_due1": c("due2") < c("due1"),
                                      "total_non_negative": c("total") < 0}),
        _violations(lg.expense, "expense", {"kind_enum": ~c("kind").isin("Ordinario", "Extraordinario"),
                                            "amount_non_negative": c("amount") < 0}),
        _violations(lg.account, "account", {"interest_non_negative": c("interest") < 0}),
        _violations(lg.payment, "payment", {"amount_positive": c("amount") <= 0, "cbu_digits": digits_only("cbu")}),
    ]
    return reduce(DataFrame.unionByName, parts)


def _dups(df: DataFrame, table: str, key: str, cols: list[str], where: Column | None = None) -> DataFrame:
    d = df if where is None else df.filter(where)
    g = d.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return g.agg(F.count(F.lit(1)).cast("bigint").alias("duplicate_keys")).select(
        F.lit(table).alias("tbl"), F.lit(key).alias("key"), "duplicate_keys")


def q2_uniqueness(lg: Ledger) -> DataFrame:
    """Q2: unique indexes and primary keys as duplicate-key counts."""
    parts = [
        _dups(lg.unit, "unit", "cbu", ["cbu"], F.col("cbu").isNotNull()),
        _dups(lg.unit, "unit", "id_unit", ["id_unit"]),
        _dups(lg.person, "person", "id_person", ["id_person"]),
        _dups(lg.occupancy, "occupancy", "id_person", ["id_person"]),
        _dups(lg.bill, "bill", "issue_date+building", ["issue_date", "id_building"]),
        _dups(lg.bill, "bill", "id_bill", ["id_bill"]),
        _dups(lg.expense, "expense", "id_expense", ["id_expense"]),
        _dups(lg.account, "account", "id_account", ["id_account"]),
        _dups(lg.payment, "payment", "id_payment", ["id_payment"]),
        _dups(lg.fx_quote, "fx_quote", "quote_ts+fx_type", ["quote_ts", "fx_type"]),
    ]
    return reduce(DataFrame.unionByName, parts)


def _orphans(child: DataFrame, parent: DataFrame, fk: str, ckey: str, pkey: str, grows: bool = False) -> DataFrame:
    """``grows``: the parent's keys grow with the ledger; they are sorted, not hashed or broadcast."""
    keys = parent.select(F.col(pkey).alias("_k"))
    o = (child.select(F.col(ckey).alias("_k")).filter(F.col("_k").isNotNull())
         .join(unbounded(keys) if grows else keys.distinct(), "_k", "left_anti"))
    return o.agg(F.count(F.lit(1)).cast("bigint").alias("orphans")).select(F.lit(fk).alias("fk"), "orphans")


def q3_referential(lg: Ledger) -> DataFrame:
    """Q3: foreign keys as orphan counts (anti joins)."""
    parts = [
        _orphans(lg.unit, lg.building, "unit.building", "id_building", "id_building"),
        _orphans(lg.occupancy, lg.person, "occupancy.person", "id_person", "id_person", grows=True),
        _orphans(lg.occupancy, lg.building, "occupancy.building", "id_building", "id_building"),
        _orphans(lg.bill, lg.building, "bill.building", "id_building", "id_building"),
        _orphans(lg.expense, lg.bill, "expense.bill", "id_bill", "id_bill"),
        _orphans(lg.account, lg.unit, "account.unit", "id_unit", "id_unit", grows=True),
        _orphans(lg.account, lg.bill, "account.bill", "id_bill", "id_bill"),
        _orphans(lg.payment, lg.account, "payment.account", "id_account", "id_account", grows=True),
        _orphans(lg.payment, lg.bill, "payment.bill", "id_bill", "id_bill"),
    ]
    return reduce(DataFrame.unionByName, parts)


def q4_building_profile(lg: Ledger) -> DataFrame:
    """Q4: has storage / has garage per building (MAX of a 1/0 flag)."""
    u = lg.unit.groupBy("id_building").agg(
        F.max(F.when(F.col("storage_m2") > 0, 1).otherwise(0)).alias("has_storage"),
        F.max(F.when(F.col("garage_m2") > 0, 1).otherwise(0)).alias("has_garage"))
    return lg.building.select("id_building", "name").join(u, "id_building")


def q5_unit_count(lg: Ledger) -> DataFrame:
    """Q5: units per building (the reference expects at least 10)."""
    u = lg.unit.groupBy("id_building").agg(F.count(F.lit(1)).alias("units"))
    return lg.building.select("id_building", "name").join(u, "id_building").withColumn(
        "at_least_10", F.col("units") >= 10)


def q6_extraordinary_bills(lg: Ledger, year: int = 2000) -> DataFrame:
    """Q6: bills of the year with their first extraordinary expense and count."""
    b = lg.bill.filter((F.col("issue_date") >= F.lit(dt.date(year, 1, 1)))
                       & (F.col("issue_date") < F.lit(dt.date(year + 1, 1, 1))))
    e = (lg.expense.filter(F.col("kind") == EXTRAORDINARY).groupBy("id_bill")
         .agg(F.min("issue_date").alias("first_extra"), F.count(F.lit(1)).alias("n_extra")))
    return b.select("id_bill", "id_building", "issue_date", "due1", "due2", "total").join(e, "id_bill")


def q7_accounts_per_bill(lg: Ledger) -> DataFrame:
    """Q7: accounts per bill."""
    return lg.account.groupBy("id_bill").agg(F.count(F.lit(1)).alias("accounts"))


def q8_interest_audit(lg: Ledger) -> DataFrame:
    """Q8: stored interest against the expected one from the last payment date
    (2 % / 5 % of the debt), labelled, with OK / ERROR."""
    last = lg.payment.groupBy("id_account").agg(F.max("pay_date").alias("last_pay"))
    b = bills_side(lg, lg.bill.select("id_bill", "due1", "due2"))
    a = (lg.account.join(b, "id_bill").join(last, "id_account", "left")
         .join(lg.unit.select("id_unit", "floor", "dept", "share"), "id_unit"))
    d, v1, v2 = F.col("last_pay"), F.col("due1"), F.col("due2")
    category = (F.when(d.isNull(), "Sin pago").when(d <= v1, "0% (En término)")
                .when((d > v1) & (v2.isNull() | (d <= v2)), "2% (Entre vtos)")
                .when(v2.isNotNull() & (d > v2), "5% (Después 2do vto)"))
    expected = (F.when(d.isNull() | (d <= v1), F.lit(0))
                .when((d > v1) & (v2.isNull() | (d <= v2)), F.round(F.lit(0.02).cast("decimal(3,2)") * F.col("debt"), 2))
                .when(v2.isNotNull() & (d > v2), F.round(F.lit(0.05).cast("decimal(3,2)") * F.col("debt"), 2))
                ).cast("decimal(18,2)")
    return a.select("id_account", "floor", "dept", "share", "id_bill", "due1", "due2", "last_pay",
                    (F.col("ord_amount") + F.col("ext_amount")).cast("decimal(18,2)").alias("base"),
                    "paid", "debt", "interest", category.alias("category"), expected.alias("expected"),
                    F.when(F.col("interest") == expected, "OK").otherwise("ERROR").alias("validation"))


def q10_owner_debt(lg: Ledger, n: int = 5) -> DataFrame:
    """Q10: top owners by the debt of their building. The reference joins
    owners to accounts by building only, so each owner carries the whole
    building's debt; here the debt is summed per building first and that one
    row per building is joined to the owners (no owner x account pairs)."""
    debt = lg.account.groupBy("id_building").agg(F.sum("debt").alias("_d"))
    owners = lg.occupancy.filter(~F.col("is_tenant")).select("id_person", "id_building")
    per = (owners.join(debt, "id_building")
           .groupBy("id_person").agg(F.sum("_d").cast("decimal(18,2)").alias("debt_total")))
    top = per.orderBy(F.col("debt_total").desc(), F.col("id_person")).limit(n)
    p = lg.person.select("id_person", "last_name", "first_name", "dni", "email", "phone")
    return top.join(p, "id_person")


# ------------------------------------------------------------ decrypted views
def j9_encrypt_roundtrip(lg: Ledger) -> DataFrame:
    """J9 on the stored people: every value as its cipher gives it back."""
    from ..functions.crypto import cipher_key, try_decrypt
    k = cipher_key(lg.spark)
    return S.secured(lg, "person").select("id_person", *[try_decrypt(F.col(f"{c}_enc"), k).alias(c) for c in S.SECRET["person"]])


def r2_safe_person(lg: Ledger) -> DataFrame:
    """R2: decrypted DNI, e-mail, phone (plain as fallback); bank id not exposed."""
    from ..functions.crypto import cipher_key
    k = cipher_key(lg.spark)
    return S.secured(lg, "person").select("id_person", "first_name", "last_name", *[S.readable(c, k).alias(c) for c in ("dni", "email", "phone")])


def k14_encrypt_roundtrip(lg: Ledger) -> DataFrame:
    from ..functions.crypto import cipher_key, encrypt, try_decrypt
    k = cipher_key(lg.spark)
    return lg.person.select("id_person", try_decrypt(encrypt(F.col("email"), k), k).alias("email"))


def q9_payments_decrypted(lg: Ledger) -> DataFrame:
    """Q9: payments with the bank id read back from its stored cipher."""
    from ..functions.crypto import cipher_key
    return S.secured(lg, "payment").select("id_payment", "pay_date", "amount", "id_bill", "id_building",
                                           S.readable("cbu", cipher_key(lg.spark)).alias("cbu"))


def j10_sync_roundtrip(lg: Ledger) -> DataFrame:
    """The stored people after the people load: each row as its ciphers
    give it back, changed rows with their new values."""
    from ..functions.crypto import cipher_key, try_decrypt
    from .loaders import load_people
    k = cipher_key(lg.spark)
    load = load_people(lg)
    new = S.in_step(S.secured(lg, "person"), load.filter(F.col("action") != "KEEP"), "id_person", S.SECRET["person"], k)
    return (new.select("id_person", *[try_decrypt(F.col(f"{c}_enc"), k).alias(c) for c in S.SECRET["person"]])
            .join(load.select("id_person", "action"), "id_person"))
