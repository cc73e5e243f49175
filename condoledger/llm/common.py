"""Shared pieces of the training-data operators: tables, stored steps, batches.

Every operator takes a DataFrame and the names of its id and text columns,
selects only those, and returns the id with its own output columns, so extra
columns of the input (also ones named like an output) never clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# Bytes of text that one processing slice of an Arrow batch holds at most
# (a single longer text makes a slice of its own).
SLICE_BYTES = 3 << 20
# Whether Spark removes a query's shuffle files when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, what: str) -> str:
    """A new folder in the shared checkpoint folder for one run's stored steps."""
    return f"{checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts the lineage, so that a
    lost executor costs a re-read of files and not a recomputation. The write's
    own shuffle files, which nothing reads again, go when it ends and not at
    the driver's next collection of garbage."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("errorifexists").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.parquet(path)


def fingerprint(*cols: str | Column) -> Column:
    """128-bit fingerprint as a struct of two independent 64-bit hashes."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.struct(F.xxhash64(*cs).alias("a"), F.xxhash64(F.lit("second"), *cs).alias("b"))


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of ``column`` in one slice stay
    within SLICE_BYTES; memory is bounded by the longest single text."""
    for batch in batches:
        lens = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, n in enumerate(lens):
            if total and total + n > SLICE_BYTES:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


def raw_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
