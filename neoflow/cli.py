"""Command line for the two jobs of the reference's notebooks.

    python -m neoflow.cli land --topic-path /data/topic --out /data/landing --available-now
    python -m neoflow.cli land --bootstrap broker:9092 --topic objects --out s3a://b/landing
    python -m neoflow.cli feed --docs /data/feed --start 2022-11-18 --end 2022-11-19 \\
        --topic-path /data/topic

``land``: topic -> 15-column table, Parquet by date (5 s trigger unless
``--available-now``). ``feed``: feed documents -> one message per object ->
topic.
"""

from __future__ import annotations

import argparse
import sys

from neoflow.session import build_session
from neoflow.sources.credentials import apply_s3a, s3a_conf, to_s3a


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="neoflow")
    sub = p.add_subparsers(dest="cmd", required=True)

    land = sub.add_parser("land", help="topic -> date-partitioned Parquet")
    land.add_argument("--topic-path", help="file-backed topic folder")
    land.add_argument("--bootstrap", help="Kafka bootstrap servers")
    land.add_argument("--topic", help="topic (or comma list)")
    land.add_argument("--pattern", help="topic regex")
    land.add_argument("--out", required=True)
    land.add_argument("--checkpoint")
    land.add_argument("--starting", default="latest")
    land.add_argument("--fail-on-data-loss", action="store_true")
    land.add_argument("--max-per-trigger", type=int)
    land.add_argument("--trigger", default="5 seconds")
    land.add_argument("--available-now", action="store_true")
    land.add_argument("--schema", choices=["narrow", "full"], default="narrow")
    land.add_argument("--starting-timestamp", type=int, help="epoch milliseconds")
    land.add_argument("--min-partitions", type=int, help="tasks a Kafka batch is split into, at least")
    land.add_argument("--view", help="name of a live view: the first rows of each batch, printed")
    land.add_argument("--view-rows", type=int, default=5)

    feed = sub.add_parser("feed", help="feed documents -> topic")
    feed.add_argument("--docs", required=True, help="folder of feed documents (one per file)")
    feed.add_argument("--start", required=True)
    feed.add_argument("--end", required=True)
    feed.add_argument("--topic-path", help="file-backed topic folder")
    feed.add_argument("--bootstrap")
    feed.add_argument("--topic", default="objects")
    feed.add_argument("--partitions", type=int, help="partitions of the topic that messages are dealt to, in order")
    feed.add_argument("--lenient", action="store_true", help="skip days missing from the feed")
    return p


#: Arguments that are paths.
_PATHS = ("topic_path", "out", "checkpoint", "docs")


def store_conf(args: argparse.Namespace, environ=None) -> dict[str, str]:
    """Turn s3:// paths into s3a:// ones; the session settings they need: keys from the
    environment where a path lies in an object store, none otherwise."""
    for name in _PATHS:
        if getattr(args, name, None):
            setattr(args, name, to_s3a(getattr(args, name)))
    remote = any((getattr(args, name, None) or "").startswith("s3a://") for name in _PATHS)
    return s3a_conf(environ=environ) if remote else {}


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    conf = store_conf(args)
    if spark is None:
        spark = build_session(extra=conf)
    elif conf:
        apply_s3a(spark, conf)
    if args.cmd == "land":
        from neoflow.sources.topic import TopicSource
        from neoflow.streaming.jobs import AVAILABLE_NOW, run_available_now, topic_to_parquet
        if args.topic_path:
            src = TopicSource(kind="files", path=args.topic_path, starting=args.starting,
                              topic=args.topic, pattern=args.pattern,
                              starting_timestamp=args.starting_timestamp,
                              fail_on_data_loss=args.fail_on_data_loss,
                              max_per_trigger=args.max_per_trigger)
        else:
            src = TopicSource(kind="kafka", bootstrap=args.bootstrap, topic=args.topic,
                              pattern=args.pattern, starting=args.starting,
                              starting_timestamp=args.starting_timestamp,
                              min_partitions=args.min_partitions,
                              fail_on_data_loss=args.fail_on_data_loss,
                              max_per_trigger=args.max_per_trigger)
        trigger = AVAILABLE_NOW if args.available_now else {"processingTime": args.trigger}
        qs = topic_to_parquet(spark, src, args.out, args.checkpoint, trigger, schema=args.schema,
                              view=args.view, view_rows=args.view_rows)
        if args.available_now:
            run_available_now(qs)
        else:
            spark.streams.awaitAnyTermination()  # a view that fails ends the job too
        return 0
    from neoflow.sinks.topic import TopicSink, create_topic
    from neoflow.fs import path_exists
    from neoflow.sources.feed import read_feed_documents
    from neoflow.streaming.feed_job import feed_to_topic
    if args.topic_path:
        sink = TopicSink(kind="files", path=args.topic_path, topic=args.topic)
        if not path_exists(spark, args.topic_path):
            create_topic(spark, sink)
    else:
        sink = TopicSink(kind="kafka", bootstrap=args.bootstrap, topic=args.topic)
    feed_to_topic(spark, read_feed_documents(spark, args.docs), args.start, args.end, sink,
                  strict=not args.lenient, num_partitions=args.partitions)
    return 0


if __name__ == "__main__":
    sys.exit(main())
