"""Kafka topic as a streaming source of raw messages.

The result has Kafka's fixed record schema (``key``, ``value`` binary,
``topic``, ``partition``, ``offset``, ``timestamp``, ``timestampType``); the
parser needs only ``value``.  The Kafka connector jar must be on the
classpath of the cluster.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Options forwarded as-is when present in the source section.
_PASSTHROUGH = {
    "max_offsets_per_trigger": "maxOffsetsPerTrigger",
    "min_partitions": "minPartitions",
    "fail_on_data_loss": "failOnDataLoss",
    "group_id_prefix": "groupIdPrefix",
}


# Options that only a stream understands.
_STREAM_ONLY = ("maxOffsetsPerTrigger", "minOffsetsPerTrigger", "maxTriggerDelay")


def kafka_options(kafka_config: Mapping) -> dict[str, str]:
    """Reader options from the ``kafka`` section.

    ``bootstrap_servers`` and ``topic`` are required (``KeyError`` when
    missing); ``starting_offsets`` defaults to ``latest``.
    """
    servers = kafka_config["bootstrap_servers"]
    topic = kafka_config["topic"]
    opts = {
        "kafka.bootstrap.servers": str(servers),
        "subscribe": str(topic),
        "startingOffsets": str(kafka_config.get("starting_offsets", "latest")),
    }
    for key, opt in _PASSTHROUGH.items():
        if key in kafka_config:
            opts[opt] = str(kafka_config[key])
    for key, value in dict(kafka_config.get("options", {})).items():
        opts[key] = str(value)
    return opts


def read_kafka(spark: SparkSession, kafka_config: Mapping) -> DataFrame:
    """Streaming DataFrame of the raw records of a topic."""
    opts = kafka_options(kafka_config)
    reader = spark.readStream.format("kafka")
    for k, v in opts.items():
        reader = reader.option(k, v)
    return reader.load()


def read_kafka_batch(spark: SparkSession, kafka_config: Mapping) -> DataFrame:
    """The same records as a bounded batch (``earliest`` to ``latest``).

    A batch has no rate, so the stream's limits are left out; it cannot start
    at ``latest``, where nothing follows (``ValueError``)."""
    opts = kafka_options(kafka_config)
    opts.setdefault("endingOffsets", "latest")
    if "starting_offsets" not in kafka_config:
        opts["startingOffsets"] = "earliest"
    if opts["startingOffsets"].lower() == "latest":
        raise ValueError("a batch read cannot start at 'latest': set starting_offsets to 'earliest' or to offsets per partition")
    opts = {k: v for k, v in opts.items() if k not in _STREAM_ONLY}
    reader = spark.read.format("kafka")
    for k, v in opts.items():
        reader = reader.option(k, v)
    return reader.load()
