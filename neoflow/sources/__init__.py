"""Sources: topics (Kafka or a file-backed record table), feed documents,
object-store credentials."""

from neoflow.sources.topic import (TopicSource, kafka_batch_options, kafka_stream_options,
                                   read_topic, read_topic_stream)

__all__ = ["TopicSource", "kafka_batch_options", "kafka_stream_options", "read_topic",
           "read_topic_stream"]
