"""Window building blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def global_row_number(df: DataFrame, order: list[str], name: str = "row_id") -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY order...) without a single-task window (F1).

    The rows are range-partitioned on the whole order key (so even one hot
    building is split over many tasks) and sorted inside each partition;
    each row's index inside its partition comes from
    monotonically_increasing_id (partition id in the upper bits), and each
    partition's offset is the running count of the partitions before it - an
    unpartitioned window over one row per partition only. The numbered
    partitions are stored once in the shared checkpoint folder. The order key is
    expected to be unique (ties would be numbered in an arbitrary order, as
    with ROW_NUMBER).
    """
    import os
    import uuid

    from ..session import checkpoint_dir
    from .joins import store

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_ix", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    # Partition ids are only meaningful for this one evaluation (a second
    # evaluation would sample new range bounds): store them once.
    s = store(s, os.path.join(checkpoint_dir(df.sparkSession), "rownum", uuid.uuid4().hex))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    wk = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    offsets = counts.select("_pid", (F.sum("_cnt").over(wk) - F.col("_cnt")).alias("_off"))
    return (s.join(F.broadcast(offsets), "_pid")      # one row per partition: bounded by n
            .withColumn(name, (F.col("_off") + F.col("_ix") + 1).cast("bigint"))
            .drop("_pid", "_ix", "_off"))


def running_sum(value: str | Column, partition: list[str], order: list[str | Column]) -> Column:
    """SUM OVER (PARTITION BY … ORDER BY … ROWS UNBOUNDED PRECEDING)."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(value).over(w)


def previous(value: str | Column, partition: list[str], order: list[str | Column], default=None) -> Column:
    """LAG(value, 1[, default])."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return F.lag(value, 1, default).over(w)


def previous_event(df: DataFrame, key: str, date: str, tiebreak: str, name: str = "prev_date") -> DataFrame:
    """LAG(date) OVER (PARTITION BY key ORDER BY date, tiebreak), skew-safe.

    A plain window sorts all rows of a key in one task, and one key may hold
    a third of the rows. The previous date of a row is either its own date
    (an earlier row of the same key on the same day exists) or the last
    earlier day of that key. So: one row per (key, day) with its first
    tiebreak (partial aggregation), a LAG over those day rows (at most one
    row per calendar day per key), and an equi-join back.
    """
    days = df.groupBy(key, date).agg(F.min(tiebreak).alias("_first"))
    w = Window.partitionBy(key).orderBy(date)
    days = days.withColumn("_prev_day", F.lag(date).over(w))
    return (df.join(days, [key, date])
            .withColumn(name, F.when(F.col(tiebreak) == F.col("_first"), F.col("_prev_day"))
                        .otherwise(F.col(date)))
            .drop("_first", "_prev_day"))
