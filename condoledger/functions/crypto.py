"""Column encryption K14 / J9 / J10 with Spark's AES functions.

The passphrase is configuration, never code: it is read from the session
conf ``condoledger.cipher.key`` (16, 24 or 32 bytes). A session without one gets
a random key for its lifetime and a warning: the ledger's secured tables lie in
that session's own folder, and what is to be read by a later session needs the
conf. GCM uses a random IV, so two
encryptions of a value differ: compare decrypted values, never ciphertext.
"""

from __future__ import annotations

import base64
import os
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY_CONF = "condoledger.cipher.key"
REDACTION_CONF = "spark.sql.redaction.string.regex"
# The key argument of an AES call as plans print it, as text, as bytes or under a cast.
KEY_IN_PLANS = r"(?<=, )[^,()\s]{16,}(?=, GCM)|(?<=, cast\()[^,()\s]{16,}(?= as binary\), GCM)"


def cipher_key(spark: SparkSession) -> str:
    key = spark.conf.get(KEY_CONF, None)
    if not key:
        warnings.warn(f"{KEY_CONF} is not set: ciphers of this session can be read in this session only", stacklevel=2)
        key = base64.b64encode(os.urandom(24)).decode()[:32]
        spark.conf.set(KEY_CONF, key)
    redacted = spark.conf.get(REDACTION_CONF, None) or ""
    if KEY_IN_PLANS not in redacted:            # keeps the key out of explain output and event logs
        spark.conf.set(REDACTION_CONF, f"{redacted}|{KEY_IN_PLANS}" if redacted else KEY_IN_PLANS)
    return key


def encrypt(c: Column, key: str) -> Column:
    """Text -> binary cipher; NULL -> NULL."""
    return F.when(c.isNotNull(), F.aes_encrypt(c.cast("string").cast("binary"), F.lit(key), F.lit("GCM")))


def try_decrypt(c: Column, key: str) -> Column:
    """Binary cipher -> text, NULL when absent or not decryptable."""
    return F.try_aes_decrypt(c, F.lit(key), F.lit("GCM")).cast("string")


def encrypt_columns(df: DataFrame, cols: list[str], key: str, suffix: str = "_enc") -> DataFrame:
    """add/refresh cipher columns where the plain value is present and the
    cipher is missing or not decryptable (idempotent on re-run)."""
    for c in cols:
        enc = f"{c}{suffix}"
        if enc in df.columns:
            stale = F.col(enc).isNull() | try_decrypt(F.col(enc), key).isNull()
            df = df.withColumn(enc, F.when(F.col(c).isNotNull() & stale, encrypt(F.col(c), key)).otherwise(F.col(enc)))
        else:
            df = df.withColumn(enc, encrypt(F.col(c), key))
    return df


def safe_view(df: DataFrame, cols: list[str], key: str, suffix: str = "_enc") -> DataFrame:
    """R2: decrypted value with the plain one as fallback; cipher columns dropped."""
    out = df
    for c in cols:
        out = out.withColumn(c, F.coalesce(try_decrypt(F.col(f"{c}{suffix}"), key), F.col(c).cast("string")))
    return out.drop(*[f"{c}{suffix}" for c in cols])
