"""Stored ciphers: J9 (encrypt what lacks a readable cipher), J10 (keep the
ciphers in step with changes), D13 (join through the decrypted key).

A secured table is a ledger table with a cipher column ``<name>_enc`` beside
each sensitive one, stored as files. A cipher has a random IV, so it is
written once and then carried: J9 and J10 write new bytes only where they must.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.crypto import cipher_key, encrypt, try_decrypt
from ..operators.joins import store
from ..sources.ledger import Ledger

SECRET = {"person": ["dni", "email", "phone", "cbu"], "unit": ["cbu"], "payment": ["cbu"]}
KEYS = {"person": "id_person", "unit": "id_unit", "payment": "id_payment"}


def _enc(c: str) -> Column:
    return F.col(f"{c}_enc")


def with_ciphers(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """A new cipher where the plain value is there and the cipher is
    missing or cannot be read; every other cipher keeps its bytes."""
    new = {}
    for c in cols:
        old = _enc(c) if f"{c}_enc" in df.columns else F.lit(None).cast("binary")
        stale = F.col(c).isNotNull() & (old.isNull() | try_decrypt(old, key).isNull())
        new[f"{c}_enc"] = F.when(stale, encrypt(F.col(c), key)).otherwise(old)
    return df.withColumns(new)


def in_step(secured: DataFrame, changed: DataFrame, id_col: str, cols: list[str], key: str) -> DataFrame:
    """The secured table after rows were inserted or changed. A changed row
    takes its new plain values, and new ciphers where the old one does not say
    the same (none for a value that is gone); other rows are carried as they are."""
    old = secured.select(id_col, *[f"{c}_enc" for c in cols])
    j = changed.select(*[c for c in secured.columns if not c.endswith("_enc")]).join(old, id_col, "left")
    new = {}
    for c in cols:
        same = try_decrypt(_enc(c), key).eqNullSafe(F.col(c).cast("string"))
        new[f"{c}_enc"] = F.when(same, _enc(c)).otherwise(encrypt(F.col(c), key))
    touched = j.withColumns(new).select(*secured.columns)
    return secured.join(changed.select(id_col), id_col, "left_anti").unionByName(touched)


def readable(c: str, key: str) -> Column:
    """The decrypted value, the plain one where there is no readable cipher."""
    return F.coalesce(try_decrypt(_enc(c), key), F.col(c).cast("string"))


# ------------------------------------------------------------------ the ledger's secured tables
def _once(lg: Ledger, name: str, make) -> DataFrame:
    cache = lg.__dict__.setdefault("_secured", {})
    if name not in cache:
        cache[name] = store(make(), f"{lg.root}/secured-{name}-{uuid.uuid4().hex}")
    return cache[name]


def before(lg: Ledger, table: str) -> DataFrame:
    """The table as an earlier run left it (a fixed rule of the adapter, by the
    row's id or its hash): a third has readable ciphers and, of them, half no plain
    bank id any more; a third has ciphers of another key; a third has none."""
    def make() -> DataFrame:
        df, key = getattr(lg, table), cipher_key(lg.spark)
        kind = F.pmod(F.col(KEYS[table]) if table != "payment" else F.hash(KEYS[table]), F.lit(6))
        other = "another key 0123456789ab"       # 24 bytes; what it enciphered cannot be read
        for c in SECRET[table]:
            cipher = F.when(kind < 2, encrypt(F.col(c), key)).when(kind < 4, encrypt(F.col(c), other))
            df = df.withColumn(f"{c}_enc", cipher)
        return df.withColumn("cbu", F.when(kind != 0, F.col("cbu")))
    return _once(lg, f"before-{table}", make)


def secured(lg: Ledger, table: str) -> DataFrame:
    """The table after J9, stored."""
    return _once(lg, table, lambda: with_ciphers(before(lg, table), SECRET[table], cipher_key(lg.spark)))


def person_bank_key(lg: Ledger) -> DataFrame:
    """(person, bank id) through the stored ciphers."""
    return secured(lg, "person").select("id_person", readable("cbu", cipher_key(lg.spark)).alias("cbu"))


def refreshed(lg: Ledger, table: str) -> DataFrame:
    """What J9 did: per column the ciphers it wrote, those it kept byte for byte,
    and the rows without any; then the same for a second run over its result."""
    key, k = cipher_key(lg.spark), KEYS[table]
    rows = []
    first = secured(lg, table)
    for run, old, new in ((1, before(lg, table), first), (2, first, with_ciphers(first, SECRET[table], key))):
        j = new.select(k, *[f"{c}_enc" for c in SECRET[table]]).join(
            old.select(F.col(k), *[_enc(c).alias(f"_old_{c}") for c in SECRET[table]]), k)
        counts = []
        for c in SECRET[table]:
            kept = _enc(c).isNotNull() & (_enc(c) == F.col(f"_old_{c}"))
            counts.append(F.struct(F.lit(c).alias("col_name"), F.count_if(_enc(c).isNotNull() & ~F.coalesce(kept, F.lit(False))).alias("written"),
                                   F.count_if(kept).alias("kept"), F.count_if(_enc(c).isNull()).alias("empty")))
        rows.append(j.agg(F.array(*counts).alias("r")).select(F.lit(run).cast("bigint").alias("run"), F.inline("r")))
    return rows[0].unionByName(rows[1])
