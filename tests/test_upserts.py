"""Coalescing upserts on files that repeat a key."""

from condoledger.operators import upsert as U

COLS = "k int, floor int, dept string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_blanks_are_filled_and_conflicts_are_not_mixed(spark):
    src = spark.createDataFrame([(1, 1, "b"), (1, 2, "a"), (2, None, "x"), (2, 5, None), (3, None, None), (4, 7, "q"), (4, 7, "q"),
                                 (5, 3, None), (5, 2, "z")], COLS)
    assert rows(U.one_value_per_key(src, ["k"])) == rows(spark.createDataFrame(
        [(1, 1, "b"), (2, 5, "x"), (3, None, None), (4, 7, "q"), (5, 2, "z")], COLS))
    assert rows(U.conflicting_rows(src, ["k"])) == [(1, 2, "a"), (5, 3, None)]


def test_update_takes_one_row_of_a_conflict(spark):
    target = spark.createDataFrame([(1, 9, "t"), (2, 9, None), (6, 1, "u")], COLS)
    src = spark.createDataFrame([(1, 1, "b"), (1, 2, "a"), (2, None, "x"), (2, 5, None)], COLS)
    want = [(1, 1, "b", "UPDATE"), (2, 5, "x", "UPDATE"), (6, 1, "u", "KEEP")]
    assert rows(U.update_nonnull(target, src, ["k"], ["floor", "dept"])) == want
    assert rows(U.update_changed(target, src, ["k"], ["floor", "dept"])) == want
    assert rows(U.fill_nulls(target, src, ["k"], ["floor", "dept"])) == [
        (1, 9, "t", "KEEP"), (2, 9, "x", "UPDATE"), (6, 1, "u", "KEEP")]
