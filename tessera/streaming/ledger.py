"""A fact ledger kept by a stream: records are taken in once, changed contents stay beside each other as conflicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.functions.text import digest


def fact_stream(spark: SparkSession, path: str, schema: str, files_a_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).json(path)


def accept(stream: DataFrame, ledger: str, checkpoint: str, key: str, values: list[str]) -> StreamingQuery:
    """Append records that the ledger (a Parquet folder) lacks: a known key and content is left out, a known key with
    new content is appended as ``conflict``. Each batch has its own folder, overwritten when the batch is run again, so
    a restart changes nothing."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = batch.withColumn("content", digest(*(F.col(v) for v in values))).dropDuplicates([key, "content"])
        schema = own.withColumn("decision", F.lit("new")).schema
        known = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(ledger) if number else spark.createDataFrame([], schema)
        known = known.where(~F.col("_metadata.file_path").contains(f"/batch={number}/")) if number else known
        contents = known.select(key, "content").distinct()
        keys = contents.select(key).distinct().withColumn("__known", F.lit(True))
        fresh = own.join(contents, [key, "content"], "left_anti").join(keys, key, "left")
        first = F.row_number().over(Window.partitionBy(key).orderBy("content"))
        decision = F.when(F.col("__known").isNotNull() | (first > 1), "conflict").otherwise("new")
        fresh.withColumn("decision", decision).drop("__known").select(*schema.names).write.mode("overwrite").parquet(f"{ledger}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, kind: str, lateness: str, width: str) -> DataFrame:
    """Counts by event-time window and kind; rows later than ``lateness`` are left out."""
    return stream.withWatermark(time, lateness).groupBy(F.window(time, width), kind).agg(F.count("*").alias("n"))
