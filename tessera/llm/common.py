"""What the training-data operators share: tables in the shared folder, batches of bounded size and whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.shared import new_table, partitions_for, written

__all__ = ["bounded_batches", "documents", "new_table", "partitions_for", "sliced", "text_of", "written"]

BATCH_ROWS = 1024
BATCH_BYTES = 8 << 20
DEFAULT_BYTES = ("67108864b", "67108864", "64MB", "64m")


def sliced(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS, size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows`` rows and about ``size`` bytes (one row at least), without copying."""
    for batch in batches:
        step = max(1, min(rows, int(batch.num_rows * size / max(1, batch.nbytes))))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES``, unless the session has a limit of its own: set once, and never to anything else."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in DEFAULT_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def text_of(column: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
