"""Process genomes as their files arrive.

Rows may come in any number of batches. Each batch is kept, and every genome it touches is worked
out again from all of its rows so far; its published part is replaced. A repeated batch changes
nothing, a genome without any result is only looked at when it gets new rows, and nothing that
arrives late is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def follow(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str, job: Callable[[DataFrame], DataFrame]):
    """Run ``job(all rows of the genomes in a batch)`` and replace these genomes in ``target``.

    The rows seen so far are kept next to ``checkpoint``, a folder per batch.
    """
    seen = f"{checkpoint.rstrip('/')}-rows"

    def batch(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{seen}/batch={number}")
        touched = rows.select("genome_id").distinct()
        # the batch itself may be running again: later folders can't exist, earlier ones are complete
        so_far = spark.read.parquet(seen).filter(F.col("batch") <= number).drop("batch")
        out = job(so_far.join(touched, "genome_id", "left_semi"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("genome_id").parquet(target)

    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
