"""Incremental per-card summaries with Structured Streaming.

New transaction files landing in a folder update the per-card count, time
span and purchase-amount statistics. The aggregate is a streaming
``groupBy(card_id)``: Spark keeps one partial-aggregate state row per card in
the state store (checkpointed in the query's checkpoint location), so a
restart after a lost executor or driver resumes from the last committed
batch. Distinct counts are not kept here (exact distinct aggregates are not
supported on streams); the order-dependent distance needs the whole card
history and stays a batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardgrain.functions.scalars import epoch_seconds


def term_stream(stream: DataFrame, key: str = "card_id") -> DataFrame:
    """Streaming per-card summary (update mode)."""
    t = epoch_seconds("purchase_date")
    amount = F.col("purchase_amount")
    return stream.groupBy(key).agg(
        F.count(F.lit(1)).alias("no_trans"),
        (F.max(t) - F.min(t)).alias("pur_term"),
        F.sum(amount).alias("purchase_amount_sum"),
        F.avg(amount).alias("purchase_amount_mean"),
        F.min(amount).alias("purchase_amount_min"),
        F.max(amount).alias("purchase_amount_max"),
        F.stddev_samp(amount).alias("purchase_amount_sd"),
    )


def read_transaction_stream(spark: SparkSession, folder: str, schema: T.StructType,
                            max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def run_to_table(agg: DataFrame, table_path: str, checkpoint: str,
                 key: str = "card_id") -> str | None:
    """Run the stream over everything available now; keep the latest row per
    card in a parquet table. Returns the folder of the newest version.

    Each micro-batch carries only the cards it updated; ``foreachBatch``
    replaces those cards' rows (left-anti join with the previous version,
    then a union) and writes the result to ``batch=<id>``. A re-run of the
    same batch after a failure rewrites the same folder, so the table never
    holds a half-applied batch; a run that finds no new files returns the
    newest version there is.
    """
    spark = agg.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        merged = batch
        if batch_id > 0:  # an unreadable previous version stops the batch
            prev = spark.read.parquet(f"{table_path}/batch={batch_id - 1}")
            merged = prev.join(batch.select(F.col(key).alias("_key")),
                               F.col(key).eqNullSafe(F.col("_key")), "left_anti").unionByName(batch)
        merged.write.mode("overwrite").parquet(f"{table_path}/batch={batch_id}")

    q = (agg.writeStream.outputMode("update").foreachBatch(merge)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return newest_version(spark, table_path)


def newest_version(spark: SparkSession, table_path: str) -> str | None:
    """Folder of the newest complete version of the table, also from earlier runs."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(table_path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    done = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(folder)
            if s.getPath().getName().startswith("batch=")
            and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return f"{table_path}/batch={max(done)}" if done else None
