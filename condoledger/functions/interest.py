"""Late-payment interest rules M1, M2, M3 as one column expression.

base = ordinary + extraordinary; paid = sum of payments (NULL when there are
none); last = date of the last payment; rem = base - paid.

  rule  rem <= 0  no payments           compare date   amount
  M1    0         as_of ladder on base  last payment   rem
  M2    0         0                     last payment   rem
  M3    0         as_of ladder on rem   as_of          rem

The ladder: on or before due1 -> 0; after due1 and (no due2 or on/before
due2) -> 2 %; after due2 -> 5 %; else 0. M1 compares a timestamp "now" with
the due DATE, so the due day itself is already late; with a date ``as_of``
that is ``as_of >= due`` instead of ``as_of > due``.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Interest rates of the reference.
RATE_AFTER_DUE1 = Decimal("0.02")
RATE_AFTER_DUE2 = Decimal("0.05")

MONEY = "decimal(18,2)"


def _pct(rate: Decimal, amount: Column) -> Column:
    return F.round(F.lit(rate) * amount, 2)


def ladder(day: Column, amount: Column, due1: Column, due2: Column, strict: bool = False) -> Column:
    if strict:   # timestamp "now" against a date: the due day counts as late
        on_time, late1, within2, late2 = day < due1, day >= due1, day < due2, day >= due2
    else:
        on_time, late1, within2, late2 = day <= due1, day > due1, day <= due2, day > due2
    return (F.when(on_time, F.lit(0))
            .when(late1 & (due2.isNull() | within2), _pct(RATE_AFTER_DUE1, amount))
            .when(due2.isNotNull() & late2, _pct(RATE_AFTER_DUE2, amount))
            .otherwise(F.lit(0)))


def interest(base: Column, paid: Column, last: Column, due1: Column, due2: Column,
             rule: str, as_of: dt.date) -> Column:
    """Interest column for ``rule`` in {'M1','M2','M3'}; ``paid`` NULL = no payments."""
    paid0 = F.coalesce(paid, F.lit(0))
    rem = base - paid0
    today = F.lit(as_of)
    if rule == "M1":
        e = (F.when(base <= paid0, F.lit(0))
             .when(paid.isNull(), ladder(today, base, due1, due2, strict=True))
             .otherwise(ladder(last, rem, due1, due2)))
    elif rule == "M2":
        e = (F.when((base <= paid0) | paid.isNull(), F.lit(0))
             .otherwise(ladder(last, rem, due1, due2)))
    elif rule == "M3":
        e = F.when(rem <= 0, F.lit(0)).otherwise(ladder(today, rem, due1, due2))
    else:
        raise ValueError(f"unknown interest rule {rule!r}")
    return e.cast(MONEY)


def debt(base: Column, paid: Column) -> Column:
    paid0 = F.coalesce(paid, F.lit(0))
    return F.when(base <= paid0, F.lit(0)).otherwise(base - paid0).cast(MONEY)


# ----------------------------------------------------------- cents variant
# The same rules on exact integer cents (long). Decimal arithmetic above
# precision 18 runs on java.math.BigDecimal per row; the account recompute
# touches every unit x bill, so it uses this form (tests check both agree).
RATE_PCT_DUE1 = 2
RATE_PCT_DUE2 = 5


def _pct_cents(pct: int, amount_c: Column) -> Column:
    """round_half_away(amount * pct / 100) on cents, by integer division only."""
    a, hundred = F.abs(amount_c), F.lit(100).cast("long")
    part = F.call_function("div", (a % hundred) * pct * 2 + hundred, hundred * 2)
    return F.signum(amount_c).cast("long") * (F.call_function("div", a, hundred) * pct + part)


def ladder_cents(day: Column, amount_c: Column, due1: Column, due2: Column, strict: bool = False) -> Column:
    if strict:
        on_time, late1, within2, late2 = day < due1, day >= due1, day < due2, day >= due2
    else:
        on_time, late1, within2, late2 = day <= due1, day > due1, day <= due2, day > due2
    return (F.when(on_time, F.lit(0).cast("long"))
            .when(late1 & (due2.isNull() | within2), _pct_cents(RATE_PCT_DUE1, amount_c))
            .when(due2.isNotNull() & late2, _pct_cents(RATE_PCT_DUE2, amount_c))
            .otherwise(F.lit(0).cast("long")))


def interest_cents(base_c: Column, paid_c: Column, last: Column, due1: Column, due2: Column,
                   rule: str, as_of: dt.date) -> Column:
    """``interest`` on cents: base_c, paid_c (NULL = no payments) are longs."""
    paid0 = F.coalesce(paid_c, F.lit(0).cast("long"))
    rem = base_c - paid0
    today = F.lit(as_of)
    zero = F.lit(0).cast("long")
    if rule == "M1":
        return (F.when(base_c <= paid0, zero)
                .when(paid_c.isNull(), ladder_cents(today, base_c, due1, due2, strict=True))
                .otherwise(ladder_cents(last, rem, due1, due2)))
    if rule == "M2":
        return F.when((base_c <= paid0) | paid_c.isNull(), zero).otherwise(ladder_cents(last, rem, due1, due2))
    if rule == "M3":
        return F.when(rem <= 0, zero).otherwise(ladder_cents(today, rem, due1, due2))
    raise ValueError(f"unknown interest rule {rule!r}")
