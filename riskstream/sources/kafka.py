"""Topic scan. Needs the spark-sql-kafka package on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(bootstrap: str, topic: str, starting_offsets: str = "latest",
                  max_offsets_per_trigger: int = 0, fail_on_data_loss: bool = False) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger > 0:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_kafka(spark: SparkSession, bootstrap: str, topic: str, starting_offsets: str = "latest",
               max_offsets_per_trigger: int = 0, fail_on_data_loss: bool = False) -> DataFrame:
    """Raw stream of one topic: the message bytes and the broker's time.

    The single-topic job starts at "earliest" with fail_on_data_loss=True and no cap; the
    three-topic job starts at "latest" and tolerates lost offsets.
    """
    options = kafka_options(
        bootstrap, topic, starting_offsets, max_offsets_per_trigger, fail_on_data_loss)
    return (
        spark.readStream.format("kafka").options(**options).load()
        .selectExpr("CAST(value AS BINARY) AS value", "timestamp AS kafka_timestamp")
    )
