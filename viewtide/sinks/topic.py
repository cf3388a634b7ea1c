"""Publishing rows as JSON messages to a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from viewtide.sources.events import encode_json


def topic_sink_options(servers: str, topic: str, **producer: str) -> dict[str, str]:
    """Options of the Kafka sink; ``producer`` settings get their prefix.

    Acknowledgement by all replicas is the default, so that a lost broker loses
    no message.
    """
    settings = {"acks": "all"} | producer
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        **{f"kafka.{key.replace('_', '.')}": str(value) for key, value in settings.items()},
    }


def publish(df: DataFrame, servers: str, topic: str, **producer: str) -> None:
    """Write a table as messages, partition by partition; needs the Kafka connector."""
    options = topic_sink_options(servers, topic, **producer)
    encode_json(df).write.format("kafka").options(**options).save()


def publish_stream(
    df: DataFrame, servers: str, topic: str, checkpoint: str, **producer: str
) -> StreamingQuery:
    """Write a stream as messages; needs the Kafka connector."""
    options = topic_sink_options(servers, topic, **producer)
    writer = encode_json(df).writeStream.format("kafka").options(**options)
    return writer.option("checkpointLocation", checkpoint).start()
