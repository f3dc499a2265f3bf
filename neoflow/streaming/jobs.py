"""Topic -> Parquet: the consumer job.

    records (Kafka / file-backed topic, streaming)
      -> [start at latest] -> decode -> from_json -> 15 columns
      -> Parquet partitioned by date, append, checkpointed

Stateless: every micro-batch reads its offset range / files in parallel,
parses in place, rebalances by date and writes; no state store. The
processing-time trigger (5 s by default) or ``availableNow`` for backfill.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from neoflow.operators.offsets import from_offsets, is_spec, start_at_latest
from neoflow.operators.parse import parse_and_flatten
from neoflow.sinks.parquet import default_checkpoint, parquet_append_stream
from neoflow.sinks.view import live_view
from neoflow.sources.topic import FILES, TopicSource, read_topic, read_topic_stream

DEFAULT_TRIGGER = {"processingTime": "5 seconds"}
AVAILABLE_NOW = {"availableNow": True}


def landing_stream(spark: SparkSession, src: TopicSource, schema="narrow",
                   checkpoint: str | None = None) -> DataFrame:
    """Streaming 15-column object table from a topic.

    A file-backed topic that isn't read from its beginning needs ``checkpoint``."""
    recs = read_topic_stream(spark, src)
    return parse_and_flatten(from_start(spark, src, recs, checkpoint), schema=schema)


def from_start(spark: SparkSession, src: TopicSource, recs: DataFrame, checkpoint: str | None) -> DataFrame:
    """The records of a stream from where the source says that it starts: at latest, at a timestamp
    or at offsets. On a file-backed topic the start table is kept in ``checkpoint``."""
    if src.kind != FILES or (src.starting == "earliest" and src.starting_timestamp is None):
        return recs
    if not checkpoint:
        raise ValueError("a file-backed topic that isn't read from its beginning needs the checkpoint folder")
    existing = read_topic(spark, replace(src, starting="earliest", starting_timestamp=None))
    spec = src.starting if is_spec(src.starting) and src.starting_timestamp is None else None
    return from_offsets(recs, start_at_latest(spark, existing, checkpoint, src.starting_timestamp, spec))


def topic_to_parquet(spark: SparkSession, src: TopicSource, out_path: str,
                     checkpoint: str | None = None, trigger: dict | None = None,
                     schema="narrow", view: str | None = None, on_preview=None,
                     query_name: str | None = None, cluster: str = "rebalance",
                     view_rows: int = 5) -> list[StreamingQuery]:
    """Start the landing query (and, if ``view`` names one, a live view as a
    second independent query on the same plan, with its own checkpoint).
    Returns the started queries, sink first.

    cluster: write layout (see ``sinks.parquet.cluster_for_write``), one
    default for every trigger."""
    trigger = trigger or DEFAULT_TRIGGER
    ckpt = checkpoint or default_checkpoint(out_path)
    stream = landing_stream(spark, src, schema=schema, checkpoint=ckpt)
    qs = [parquet_append_stream(stream, out_path, ckpt, "date", trigger,
                                query_name=query_name, cluster=cluster)]
    if view:
        qs.append(live_view(stream, view, num_rows=view_rows, on_preview=on_preview,
                            checkpoint=f"{ckpt}_view_{view}", trigger=trigger))
    return qs


def run_available_now(queries: list[StreamingQuery], timeout_s: float | None = None) -> None:
    """Block until availableNow queries finish (``awaitTermination``);
    re-raise a query's failure. A query that hasn't finished after
    ``timeout_s`` is stopped and the call raises ``TimeoutError``: what it has
    landed is a part."""
    for q in queries:
        if timeout_s is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout_s):
            for running in queries:
                running.stop()
            raise TimeoutError(f"query {q.name or q.id} hasn't finished after {timeout_s} s")
        if q.exception():
            raise q.exception()


def run_until_caught_up(queries: list[StreamingQuery]) -> None:
    """For processing-time queries in tests / one-shot runs: process all that
    is available now, then stop."""
    try:
        for q in queries:
            q.processAllAvailable()
    finally:
        for q in queries:
            q.stop()
