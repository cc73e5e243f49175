"""J9, J10 and D13 on stored ciphers; the key stays out of plans."""

import pytest
from pyspark.sql import functions as F

from condoledger.functions import crypto as C
from condoledger.plans import secure as S


def bytes_of(df, c="cbu_enc"):
    return {r[0]: r[1] for r in df.select("id_unit", F.hex(c)).collect()}


def test_only_what_cannot_be_read_is_encrypted(spark, tmp_path):
    key = C.cipher_key(spark)
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d"), (5, None)], "id_unit long, cbu string")
    kind = F.col("id_unit")
    df = df.withColumn("cbu_enc", F.when(kind == 1, C.encrypt(F.col("cbu"), key)).when(kind == 2, F.lit(b"garbage"))
                       .when(kind == 5, C.encrypt(F.lit("e"), key)))
    df.write.parquet(f"{tmp_path}/0")
    old = spark.read.parquet(f"{tmp_path}/0")
    S.with_ciphers(old, ["cbu"], key).write.parquet(f"{tmp_path}/1")
    new = spark.read.parquet(f"{tmp_path}/1")
    b0, b1 = bytes_of(old), bytes_of(new)
    assert b1[1] == b0[1] and b1[5] == b0[5] and b1[3] is None and b1[2] != b0[2] and b1[4]
    assert bytes_of(S.with_ciphers(new, ["cbu"], key)) == b1              # a second run writes nothing
    got = {r[0]: r[1] for r in new.select("id_unit", S.readable("cbu", key)).collect()}
    assert got == {1: "a", 2: "b", 3: None, 4: "d", 5: "e"}
    # A changed value, an unchanged row, a value that is gone, a new row
    changed = spark.createDataFrame([(1, "A"), (2, "b"), (4, None), (6, "f")], "id_unit long, cbu string")
    S.in_step(new, changed, "id_unit", ["cbu"], key).write.parquet(f"{tmp_path}/2")
    after = spark.read.parquet(f"{tmp_path}/2")
    b2 = bytes_of(after)
    assert b2[2] == b1[2] and b2[5] == b1[5] and b2[1] != b1[1] and b2[4] is None
    got = {r[0]: r[1] for r in after.select("id_unit", S.readable("cbu", key)).collect()}
    assert got == {1: "A", 2: "b", 3: None, 4: None, 5: "e", 6: "f"}


def test_key_is_not_in_plans(spark, capsys):
    key = C.cipher_key(spark)
    df = spark.createDataFrame([(1, "a")], "id_unit long, cbu string")
    df = S.with_ciphers(df, ["cbu"], key).filter(S.readable("cbu", key) == "a")
    df.explain("formatted")
    df.explain("extended")
    shown = capsys.readouterr().out
    assert "aes" in shown and key not in shown and key.encode().hex().upper() not in shown


def test_a_cluster_session_without_a_key_gets_its_own():
    class Conf(dict):
        def set(self, k, v):
            self[k] = v

    class Cluster:
        def __init__(self, master):
            self.conf, self.sparkContext = Conf(), type("Context", (), {"master": master})()

    for master in ("spark://host:7077", "local-cluster[3,4,10240]", "yarn"):
        session = Cluster(master)
        with pytest.warns(UserWarning, match=C.KEY_CONF):
            key = C.cipher_key(session)
        assert len(key) in (16, 24, 32) and C.cipher_key(session) == key != C.cipher_key(Cluster(master))
        assert C.KEY_IN_PLANS in session.conf[C.REDACTION_CONF]
    given = Cluster("yarn")
    given.conf[C.KEY_CONF] = "0123456789abcdef"
    assert C.cipher_key(given) == "0123456789abcdef"
