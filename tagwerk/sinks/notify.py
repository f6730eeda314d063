"""K7: send the "new data" message.

The file form appends one text file with the message to a watched directory;
the Kafka form needs the connector jar.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Fixed values that must equal the reference's (the message protocol):
#   agreed message text: new_data_available
#   topic name:          spark_notification
DEFAULT_WORD = "new_data_available"
DEFAULT_TOPIC = "spark_notification"


def emit_file(spark: SparkSession, inbox: str, word: str = DEFAULT_WORD) -> None:
    spark.createDataFrame([(word,)], "value string").coalesce(1).write.mode("append").text(inbox)


def emit_kafka(spark: SparkSession, bootstrap_servers: str, topic: str,
               word: str = DEFAULT_WORD) -> None:
    (spark.createDataFrame([(word,)], "value string")
          .selectExpr("CAST(value AS BINARY) AS value")
          .write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
          .option("topic", topic).save())
