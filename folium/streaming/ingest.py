"""Incremental ingestion: new corpus files as a stream, exact duplicates dropped within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folium.functions.text import fingerprint


def new_texts(spark: SparkSession, folder: str, schema: str, stamp: str = "ingested_at", text: str = "text", late: str = "7 days") -> DataFrame:
    """Rows of Parquet files as they arrive, the first of each fingerprint within ``late``."""
    rows = spark.readStream.schema(schema).parquet(folder)
    hashed = rows.withColumn("content_hash", fingerprint(text)).withWatermark(stamp, late)
    return hashed.dropDuplicatesWithinWatermark(["content_hash"])


def arrivals(rows: DataFrame, stamp: str = "ingested_at", late: str = "7 days", window: str = "1 day") -> DataFrame:
    """Rows per project and window of arrival."""
    return rows.withWatermark(stamp, late).groupBy(F.window(stamp, window), "project").agg(F.count("*").alias("n"))
