"""Structured Streaming jobs S1–S4.

The reference's event-driven parts are AFTER triggers; here they are what a
Spark user runs: a file stream (parquet / CSV / JSON files landed in the
shared folder), ``foreachBatch`` for the stateful upserts, a streaming
aggregation for the latest quote and a watermarked event-time window for the
weekly collection. Every sink write is keyed by the batch id and overwrites
its own folder, so a replayed micro-batch after a failure rewrites the same
output instead of duplicating it. Runs use ``trigger(availableNow=True)``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean as K
from ..operators.joins import shuffles_freed
from ..plans import accounts as A
from ..plans import ingest as I
from ..session import checkpoint_dir
from ..sources import files as FL
from ..sources import rawtext as RT
from ..sources.ledger import Ledger


def _run_dir(lg: Ledger, name: str) -> str:
    return os.path.join(checkpoint_dir(lg.spark), "stream", name, uuid.uuid4().hex)


def landed_payment_files(lg: Ledger) -> str:
    """All payments as parquet files, one folder per payment month."""
    def make(p: str) -> None:
        (lg.payment.withColumn("pay_month", F.date_format("pay_date", "yyyyMM"))
         .repartition("pay_month").write.mode("overwrite").partitionBy("pay_month").parquet(p))
    return I.landed(lg, "payment_files", make)


def payments_by_date(lg: Ledger) -> str:
    """Files of all payments for a job that does not ask for one file a month: the
    month folders if they have landed, else the stored table's own files by date,
    so that nothing is shuffled or written for it."""
    if "payment_files" in lg.__dict__.get("_landed", {}):
        return landed_payment_files(lg)
    _ = lg.payment                              # stored now, if it was not yet
    return lg._path("payment")


def _payment_stream(lg: Ledger, files_per_batch: int, path: str) -> DataFrame:
    schema = lg.spark.read.parquet(path).schema
    return (lg.spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .option("recursiveFileLookup", "false").parquet(path))


def _run(query_builder, ckpt: str) -> None:
    """Run to the end of the available data."""
    q = query_builder.option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


class Buckets:
    """A keyed store for foreachBatch: rows in buckets, each batch writing new
    versions of the buckets it touches and reading only those.

    ``index/batch_id=n`` names the batch that holds each bucket's current
    version after batch n (one row per bucket). A replayed batch reads the
    index before it and rewrites its own folders, so it leaves the same store.
    """

    def __init__(self, lg: Ledger, root: str, batch_id: int):
        self.spark, self.root, self.batch_id = lg.spark, root, batch_id
        self.index: dict[int, int] = {}
        if batch_id:
            rows = self.spark.read.parquet(f"{root}/index/batch_id={batch_id - 1}").collect()
            self.index = {r["bucket"]: r["batch"] for r in rows if r["bucket"] is not None}

    def read(self, buckets: list[int], schema) -> DataFrame:
        """Rows of these buckets before the batch."""
        parts = [f"{self.root}/rows/batch_id={self.index[b]}/bucket={b}" for b in buckets if b in self.index]
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*parts)

    def write(self, buckets: list[int], rows: DataFrame) -> DataFrame:
        """New versions of these buckets (``rows`` has the column bucket); read back."""
        path = f"{self.root}/rows/batch_id={self.batch_id}"
        rows.write.mode("overwrite").partitionBy("bucket").parquet(path)
        self.index.update({b: self.batch_id for b in buckets})
        entries = sorted(self.index.items()) or [(None, None)]
        (self.spark.createDataFrame(entries, "bucket int, batch int").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.root}/index/batch_id={self.batch_id}"))
        return self.spark.read.parquet(path) if buckets else rows


# ------------------------------------------------------------------ S1
TOTALS = "id_account bigint, paid_sum decimal(18,2), last_pay date, touched int"


def affected_accounts_stream(lg: Ledger, files_per_batch: int = 16) -> DataFrame:
    """Each micro-batch of payments is added to the payment totals per
    account, and only the accounts it touches are recomputed (rule M3). The
    totals are kept in buckets by the account's month (the last six digits of
    its number), so a batch reads and rewrites the months it has payments
    for, however many came before; each row says which batch touched it last.
    Final state: the latest recompute of each account."""
    run = _run_dir(lg, "s1")
    totals_at, acc_sink = os.path.join(run, "totals"), os.path.join(run, "accounts")

    def batch(df: DataFrame, batch_id: int) -> None:
        bucket = F.coalesce(F.pmod("id_account", F.lit(1_000_000)), F.lit(-1)).cast("int")
        new = A.payment_totals(df.filter(F.col("id_account").isNotNull()))
        touched = [r[0] for r in df.filter(F.col("id_account").isNotNull()).select(bucket.alias("bucket")).distinct().collect()]
        kept = Buckets(lg, totals_at, batch_id)
        both = new.withColumn("touched", F.lit(batch_id)).unionByName(kept.read(touched, TOTALS))
        totals = both.groupBy("id_account").agg(F.sum("paid_sum").cast(A.MONEY).alias("paid_sum"), F.max("last_pay").alias("last_pay"),
                                                F.max("touched").alias("touched"))
        now = kept.write(touched, totals.withColumn("bucket", bucket)).filter(F.col("touched") == batch_id).drop("touched", "bucket")
        A.recompute_changed(lg, now.select("id_account"), totals=now).write.mode("overwrite").parquet(
            os.path.join(acc_sink, f"batch_id={batch_id}"))

    _run(_payment_stream(lg, files_per_batch, landed_payment_files(lg)).writeStream.foreachBatch(batch), os.path.join(run, "_ckpt"))
    out = lg.spark.read.parquet(acc_sink)
    w = Window.partitionBy("id_account").orderBy(F.col("batch_id").desc())
    return out.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "batch_id")


# ------------------------------------------------------------------ S2
def payment_file_stream(lg: Ledger, files_per_batch: int = 4) -> DataFrame:
    """The bank CSV files streamed through the L7 loader in foreachBatch;
    accepted rows are merged insert-only against those accepted before (U3).
    The accepted rows lie in folders by batch and payment month, and a batch
    is compared with the months of its own rows only. The bank ids and the
    accounts are stored for it once, and a batch reads the accounts of its own
    months. A replayed batch rewrites its own folders. Final: all accepted rows."""
    raw_path = I.landed(lg, "payments_csv", lambda p: FL.land_csv(RT.raw_payments(lg), p))
    run = _run_dir(lg, "s2")
    ok_sink, rej_sink = os.path.join(run, "ok"), os.path.join(run, "rejects")
    keys = I.stored_keys(lg, os.path.join(run, "keys"))
    cols = ["id_account", "id_unit", "id_building", "id_bill", "pay_date", "amount", "cbu"]
    schema = "id_account bigint, id_unit bigint, id_building bigint, id_bill bigint, pay_date date, amount decimal(12,2), cbu string, month int, batch_id int"

    def batch(df: DataFrame, batch_id: int) -> None:
        # a packed file is read by one task: its rows go to all of them
        raw = df.select(*[FL.payment_cell(c) for c in FL.PAYMENTS_COLS]).repartition(lg.spark.sparkContext.defaultParallelism)
        load = I.load_payments(lg, raw, keys=keys, keep=True)
        month = (F.year("pay_date") * 100 + F.month("pay_date")).cast("int")
        ok = load.ok.select(*cols, month.alias("month"))
        months = [m.year * 100 + m.month for m in load.months]
        if batch_id and months:
            # batch 0 has nothing before it; a replayed batch does not count itself
            before = lg.spark.read.schema(schema).parquet(ok_sink).filter(
                (F.col("batch_id") < batch_id) & F.col("month").isin(months))
            ok = ok.join(before.select(*cols), cols, "left_anti")
        with shuffles_freed(lg.spark):
            ok.write.mode("overwrite").partitionBy("month").parquet(os.path.join(ok_sink, f"batch_id={batch_id}"))
        load.rejects.write.mode("overwrite").parquet(os.path.join(rej_sink, f"batch_id={batch_id}"))

    stream = (lg.spark.readStream.schema(FL.string_schema(FL.PAYMENTS_COLS)).option("header", True)
              .option("quote", '"').option("maxFilesPerTrigger", files_per_batch).csv(raw_path))
    _run(stream.writeStream.foreachBatch(batch), os.path.join(run, "_ckpt"))
    return lg.spark.read.schema(schema).parquet(ok_sink).select(*cols)


# ------------------------------------------------------------------ S3
def latest_quote_stream(lg: Ledger, files_per_batch: int = 1) -> DataFrame:
    """S3: latest sell quote per type as a streaming aggregation (max_by) in
    complete mode; each batch overwrites the small result table."""
    path = I.landed(lg, "quotes_json", lambda p: I.raw_quote_docs(lg).write.mode("overwrite").json(p))
    run = _run_dir(lg, "s3")
    sink = os.path.join(run, "latest")
    docs = (lg.spark.readStream.schema(FL.string_schema(["tipo", "fecha", "compra", "venta"]))
            .option("maxFilesPerTrigger", files_per_batch).json(path))
    typed = docs.select(F.col("tipo").alias("fx_type"), F.to_timestamp_ntz("fecha").alias("quote_ts"),
                        K.try_decimal(F.col("compra"), 10, 2).alias("buy"), K.try_decimal(F.col("venta"), 10, 2).alias("sell"))
    good = typed.filter(F.col("buy").isNotNull() & F.col("sell").isNotNull())
    agg = good.groupBy("fx_type").agg(F.max_by("sell", F.struct("quote_ts", "sell")).alias("quote"))

    def batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(sink)

    _run(agg.writeStream.outputMode("complete").foreachBatch(batch), os.path.join(run, "_ckpt"))
    return lg.spark.read.parquet(sink)


# ------------------------------------------------------------------ S4
def weekly_collection_stream(lg: Ledger, files_per_batch: int = 16, watermark: str = "20000 days",
                             allow_late: bool = False) -> DataFrame:
    """Payments per week on the event time, Sunday-to-Saturday windows
    (epoch + 3 days is a Sunday) labelled by the Monday after their start,
    as the reference's week bucket counts a Sunday in the following week.
    Update mode with a watermark; each batch upserts its changed windows.
    The file source does not promise month order, so the default watermark
    delay covers all of the data: no payment is late, and the state stays one
    row per week. A shorter delay bounds the state for ordered sources. Rows
    that came too late are those read less those in a window, over all
    batches; the run fails on any unless ``allow_late``."""
    run = _run_dir(lg, "s4")
    sink = os.path.join(run, "weeks")
    # the event time is the instant of UTC midnight of the payment date, so the
    # windows (aligned to the UTC epoch) do not depend on the session time zone
    files = payments_by_date(lg)
    p = _payment_stream(lg, files_per_batch, files).withColumn(
        "ts", F.timestamp_seconds(F.unix_date("pay_date").cast("long") * 86400))
    agg = (p.withWatermark("ts", watermark)
           .groupBy(F.window("ts", "7 days", startTime="3 days").alias("w"))
           .agg(F.sum("amount").alias("_t"), F.count(F.lit(1)).alias("payments")))

    def batch(df: DataFrame, batch_id: int) -> None:
        start_day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col("w.start")) / 86400).cast("int"))
        (df.select(F.date_add(start_day, 1).alias("week_start"),
                   F.col("_t").cast("decimal(18,2)").alias("total"), "payments")
         .write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={batch_id}")))

    _run(agg.writeStream.outputMode("update").foreachBatch(batch), os.path.join(run, "_ckpt"))
    out = lg.spark.read.parquet(sink)
    w = Window.partitionBy("week_start").orderBy(F.col("batch_id").desc())
    out = out.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "batch_id")
    read = lg.spark.read.parquet(files).filter(F.col("pay_date").isNotNull()).count()
    late = read - (out.agg(F.sum("payments")).first()[0] or 0)
    if late and not allow_late:
        raise RuntimeError(f"{late} rows came later than the watermark delay of {watermark}")
    return out
