"""Commits, a stopped run, replays; the sinks B5 and B6."""

import duckdb
import pytest
from pyspark.sql import functions as F

from condoledger.plans import load_run as LR
from condoledger.sources.ledger import TABLES, ledger
from condoledger.sources.versions import Versions

SF_SMALL = "/root/testdata/sf0.001"

DDL = {"t": "id bigint, v string", "a": "id bigint"}


def test_only_committed_steps_count(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "s"), DDL)
    assert v.done == 0 and v.read("t").count() == 0
    path, n = v.write(1, "t", spark.createDataFrame([(1, "x", "INSERT"), (2, "y", "UPDATE")], "id bigint, v string, action string"))
    assert n == {"rows": 2, "inserted": 1, "updated": 1}
    assert Versions(spark, v.root, DDL).done == 0              # written, not committed
    v.commit(1, {"t": (path, False)})
    again = Versions(spark, v.root, DDL)
    assert again.done == 1 and again.read("t").count() == 2
    p2, _ = again.write(2, "a", spark.createDataFrame([(1,)], "id bigint"))
    again.commit(2, {"a": (p2, True)})
    p3, _ = again.write(3, "a", spark.createDataFrame([(2,)], "id bigint"))
    p4, _ = again.write(3, "t", spark.createDataFrame([], DDL["t"]))
    again.commit(3, {"a": (p3, True), "t": (p4, False)})
    last = Versions(spark, v.root, DDL)
    assert last.done == 3 and last.read("t").count() == 0 and sorted(r[0] for r in last.read("a").collect()) == [1, 2]


def test_rejects_are_added_once(spark):
    cols = "reason string, field1 string, field2 string, field3 string, file string"
    known = spark.createDataFrame([("r", "1", None, "3", "f")], cols)
    new = spark.createDataFrame([("r", "1", None, "3", "f"), ("r", "1", None, "3", "g"), ("r", "1", "", "3", "f")], cols)
    assert {tuple(r) for r in LR.new_rejects(known, new).collect()} == {("r", "1", "", "3", "f"), ("r", "1", None, "3", "g")}


@pytest.fixture(scope="module")
def stopped(spark, tmp_path_factory):
    """A run that dies in its ninth step, after the step has written."""
    lg, root = ledger(spark, SF_SMALL), str(tmp_path_factory.mktemp("l10"))

    def dies(st):
        LR.payments(st).append["payment"].write.parquet(f"{root}/data/half")
        raise RuntimeError("lost")
    broken = [*LR.STEPS[:8], (LR.STEPS[8][0], LR.STEPS[8][1], dies), *LR.STEPS[9:]]
    with pytest.raises(RuntimeError):
        LR.run(lg, root, broken)
    return lg, root


def test_a_stopped_run_goes_on_at_its_step(spark, stopped):
    lg, root = stopped
    assert Versions(spark, root, LR.TABLES).done == 8
    (error,) = LR.errors(spark, root).collect()
    assert (error["step_no"], error["level"], error["message"], error["detail"]) == (9, LR.ERROR, "RuntimeError", "lost")

    ran = []
    steps = [(p, s, lambda st, f=f, p=p: (ran.append(p), f(st))[1]) for p, s, f in LR.STEPS]
    st = LR.run(lg, root, steps[:9])
    assert ran == [LR.STEPS[8][0]] and st.versions.done == 9
    replay = LR.payments(st)                                    # the same file once more
    assert replay.append["payment"].isEmpty() and LR.new_rejects(st.reject, replay.rejects).isEmpty()
    st = LR.run(lg, root, steps)
    assert ran == [p for p, _, _ in LR.STEPS[8:]] and st.versions.done == len(LR.STEPS)
    replay = LR.works(st)
    assert all(df.isEmpty() for df in replay.append.values())
    assert replay.replace["bill"].filter("action <> 'KEEP'").isEmpty()

    from condoledger.oracle_load import l10_sql
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    for table in ("account", "payment", "reject", "log"):
        rel = con.sql(l10_sql(table))
        got = getattr(st, table).select(*rel.columns).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, rel.fetchall())), table
    assert st.unit.filter("cbu is not null").groupBy("cbu").count().filter("count > 1").isEmpty()
    assert st.log.groupBy("step_no").count().count() == len(LR.STEPS)


@pytest.mark.parametrize("missing", [False, True])
def test_account_numbers_move_only_where_some_are_missing(spark, tmp_path, missing):
    """J1 compares its rows with the numbers of all accounts only if it has rows."""
    class St:
        root = str(tmp_path)
        unit = spark.createDataFrame([(1, 1), (2, 1)], "id_unit long, id_building long")
        bill = spark.createDataFrame([(1_200001, 1, "2000-01-03")], "id_bill long, id_building long, d string").select(
            "id_bill", "id_building", F.to_date("d").alias("issue_date"), F.to_date("d").alias("month_start"), F.to_date("d").alias("due1"))
        account = spark.createDataFrame([(1_200001, 1, 1_200001)] + [(2_200001, 2, 1_200001)] * (not missing), "id_account long, id_unit long, id_bill long")
    new = LR.missing_accounts(St).append["account"]
    assert [r["id_account"] for r in new.collect()] == [2_200001] * missing
    assert ("LeftAnti" in new._jdf.queryExecution().toString()) == missing
