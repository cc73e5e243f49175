"""Cleaning rules against the golden values of FIXTURES.md §4."""

import datetime as dt
from decimal import Decimal as D

from conftest import values, values_df

from condoledger.functions import clean as K

AMOUNTS = ["12.345,67", "12,345.67", "$ 1.234,56", "52000,00", "52000.00", "60.000", "12.345", "1.234.567",
           "(123,45)", "(1,500.00)", "ARS 500", "12-", "5,", "", "abc"]
K3 = [D("12345.67"), D("12345.67"), D("1234.56"), D("52000.00"), D("52000.00"), D("60.00"), D("12.35"),
      D("1234.57"), D("-123.45"), D("-1500.00"), D("500.00"), D("12.00"), D("5.00"), None, None]
K4 = [D("12.35"), D("12.35"), D("1.23"), D("5200000.00"), D("52000.00"), D("60.00"), D("12.35"),
      D("1234567.00"), D("-12345.00"), D("-1500.00"), D("500.00"), None, D("5.00"), None, None]


def test_k3_flexible(spark):
    assert values_df(spark, K.amount_flexible_on("v", "o"), AMOUNTS) == K3


def test_k4_candidates(spark):
    assert values_df(spark, K.amount_candidates_on("v", "o"), AMOUNTS) == K4


def test_k2_decimal(spark):
    assert values(spark, K.to_decimal, ["12,5", " 1 234,5 ", "1.234,56", "1e3", None]) == \
        [D("12.50"), D("1234.50"), None, None, None]


def test_k1_text(spark):
    assert values(spark, lambda c: K.clean_text(c, 3), ["  abcdef ", "   ", None, "ab"]) == ["abc", None, None, "ab"]


def test_k5_email(spark):
    got = values(spark, K.email_normalise, ["Pepe @ Gmail,com", "ana@hotmail com ar", "x(at)yahoo com",
                                            "pepe arroba gmail.com"])
    assert got == ["pepe@gmail.com", "ana@hotmail.com.ar", "x@yahoo.com", "pepearrobagmail.com"]


def test_k6_email_valid(spark):
    good = ["a.b+c@x-y.com.ar"]
    bad = ["", "a b@x.com", ".a@x.com", "a..b@x.com", "a@b@c.com", "a@xcom", "a@-x.com", "a@x.c", "a@x.c0m"]
    assert values_df(spark, K.email_valid_on("v", "o"), good + bad) == [1] + [0] * len(bad)


def test_k7_cbu(spark):
    raw = ["0000-0000.0000/0000000001", "000000000000000000001", ""]
    assert values(spark, K.cbu_strict, raw) == ["0000000000000000000001", None, None]
    # the payment loader's rule does not strip '/', so the first id keeps it
    assert values(spark, K.cbu_padded, raw) == ["00000000000/0000000001", "0000000000000000000001",
                                                "0000000000000000000000"]


def test_k15_k16_k17(spark):
    assert values(spark, K.month_number, ["Septiembre", "setiembre", "ma yo", " Enero "]) == [9, None, 5, 1]
    assert values(spark, K.floor_number, ["PB", "300", " 3 ", "p.b."]) == [0, None, 3, 0]
    assert values(spark, K.tenant_flag, ["Sí", "propietario", "x"]) == [1, 0, None]


def test_k19_date(spark):
    assert values(spark, K.parse_date, ["7/2/2025", "31/02/2025", "2025-02-07", "20250207"]) == \
        [dt.date(2025, 2, 7), None, dt.date(2025, 2, 7), dt.date(2025, 2, 7)]


def test_k18_phone_and_k20(spark):
    assert values(spark, K.phone, ["(011) 4555-1234", "  "]) == ["01145551234", None]
    assert values(spark, K.clamp_amount, [D("123456789012.5"), D("-5")], "decimal(18,2)") == \
        [D("99999999.99"), D("-5.00")]
