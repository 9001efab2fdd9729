"""Streams of extracted formulas: new files are read as they come, late rows are bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_stream(spark: SparkSession, folder: str, schema: StructType, files: int = 100) -> DataFrame:
    """Parquet files of a folder as a stream, at most ``files`` per batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def first_deliveries(stream: DataFrame, keys: list[str], time: str, late: str = "7 days") -> DataFrame:
    """Each key once within the watermark: redelivered rows are dropped, state older than ``late`` is forgotten."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def arrivals(stream: DataFrame, time: str, window: str = "1 day", late: str = "7 days") -> DataFrame:
    """Formulas and documents per window of extraction time."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window)).agg(F.count("*").alias("formulas"), F.approx_count_distinct("arxiv_id").alias("documents"))
