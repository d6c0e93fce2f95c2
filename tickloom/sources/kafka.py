"""Ticks on a Kafka topic. The connector comes with the cluster (spark-sql-kafka)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.config import KafkaSettings


def kafka_source_options(settings: KafkaSettings = KafkaSettings()) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": settings.servers,
        "subscribe": settings.topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }


def kafka_sink_options(settings: KafkaSettings = KafkaSettings()) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": settings.servers,
        "topic": settings.topic,
        "kafka.retries": "3",
        "kafka.retry.backoff.ms": "500",
    }


def kafka_stream(spark: SparkSession, settings: KafkaSettings = KafkaSettings()) -> DataFrame:
    """The topic as a stream of (key, value, …) records; new records only."""
    return spark.readStream.format("kafka").options(**kafka_source_options(settings)).load()
