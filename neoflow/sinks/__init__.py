"""Sinks: topic writers, the partitioned Parquet append sink, live views."""

from neoflow.sinks.parquet import landed_table, parquet_append_stream
from neoflow.sinks.topic import TopicSink, kafka_sink_options, write_topic, write_topic_stream
from neoflow.sinks.view import live_view

__all__ = ["landed_table", "parquet_append_stream", "TopicSink", "kafka_sink_options",
           "write_topic", "write_topic_stream", "live_view"]
