"""Small helpers shared by the text operators: words, pieces of long texts, Arrow columns, folds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, which is also what ``bytes.split()`` splits on.
SPACE = b" \t\n\x0b\x0c\r"
#: Bytes of text that a task turns into words at one time.
PIECE = 1 << 20


#: Rows of an Arrow batch; texts can be long, and a task holds a batch or two of them.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Have Spark hand texts to Python in batches of ``BATCH_ROWS``."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(key: str, parts: int) -> Column:
    """crc32 of the key written as text, modulo ``parts``; null keys count as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts


def texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each cell, one at a time; a null is empty."""
    for cell in column.cast(pa.large_binary()):
        yield cell.as_py() or b""


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """A text cut at white space into parts of about ``size`` bytes, so that very long texts need bounded memory.

    A run of more than ``size`` bytes without white space stays whole.
    """
    if len(text) <= size:
        yield text
        return
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            while end < len(text) and text[end] not in SPACE:
                end += 1
        yield text[at:end]
        at = end


def columns(batch: pa.RecordBatch, **new: pa.Array) -> pa.RecordBatch:
    """The batch's first columns followed by ``new`` ones."""
    return pa.RecordBatch.from_arrays([*batch.columns, *new.values()], names=[*batch.schema.names, *new])
