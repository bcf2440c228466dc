"""Streaming feeds of canonical records.

The operators that these stand for are one-shot reads; feeds are an addition.
Predicates are plain conditions, so they hold on streams as they are, and a
feed keeps each record once by its key within a watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from citeloom.sources.schemas import SCHEMAS


def feed(spark: SparkSession, folder: str, table: str, files_per_trigger: int = 100) -> DataFrame:
    """New JSON files of a folder as canonical records, with `seen_at`, their file's time."""
    rows = spark.readStream.schema(SCHEMAS[table]).option("maxFilesPerTrigger", files_per_trigger).json(folder)
    return rows.selectExpr("*", "_metadata.file_modification_time AS seen_at")


def matching(rows: DataFrame, condition: Column, key: str, late: str = "1 hour") -> DataFrame:
    """Records under a search condition, each key once within the watermark."""
    return rows.where(condition).withWatermark("seen_at", late).dropDuplicatesWithinWatermark([key])


def store(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet and stop when what is there has been read."""
    return rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(folder)
