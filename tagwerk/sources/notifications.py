"""Notification stream; every source is a streaming frame with ``value`` bytes.

Kafka needs the connector jar; a watched directory of text files is the
connector-free form (one message per line).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def file_notifications(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(F.col("value").cast("binary").alias("value"))


def kafka_notifications(spark: SparkSession, bootstrap_servers: str, topic: str,
                        starting_offsets: str = "latest") -> DataFrame:
    """Messages sent before the query first started are not replayed (``latest``)."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .load().select("value"))
