"""Topic readers.

A topic is either a Kafka topic (Spark's ``kafka`` source; needs the
connector package on the class path) or a *file-backed* topic: a directory
of Parquet files with the Kafka source's column set (``RECORD_SCHEMA``).
Both give the same DataFrame shape, batch or streaming, so everything
downstream is the same code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neoflow.operators.offsets import between_offsets, from_offsets, is_spec, offsets_for_timestamp, parse_spec, spec_bounds
from neoflow.schemas import RECORD_SCHEMA

KAFKA = "kafka"
FILES = "files"


@dataclass
class TopicSource:
    """Where a topic lives and how to start reading it.

    kind: ``"kafka"`` or ``"files"``. ``topic`` (a name, a comma list) or
    ``pattern`` (regex of the whole name) choose the topics; Kafka needs one of
    them and ``bootstrap``, files ``path`` (and read every topic without them).

    starting: ``"latest"`` (only messages arriving after the first start;
    ignored when restarting from a checkpoint), ``"earliest"``, or a JSON offset
    spec, ``{"topic": {"0": 23, "1": -1}}`` (-2 earliest, -1 latest).
    starting_timestamp: epoch milliseconds; each partition starts at its first
    record from then on, or at its end if there is none.
    fail_on_data_loss: False keeps going when wanted offsets / files are gone.
    max_per_trigger: bound on intake per micro-batch (offsets for Kafka,
    files for a file-backed topic).
    min_partitions: split a Kafka offset range into at least this many tasks.
    """

    kind: str = FILES
    path: str | None = None
    bootstrap: str | None = None
    topic: str | None = None
    pattern: str | None = None
    starting: str = "latest"
    starting_timestamp: int | None = None
    fail_on_data_loss: bool = False
    max_per_trigger: int | None = None
    min_partitions: int | None = None
    extra: dict[str, str] = field(default_factory=dict)


def _subscription(src: TopicSource) -> dict[str, str]:
    if src.pattern:
        return {"subscribePattern": src.pattern}
    if src.topic:
        return {"subscribe": src.topic}
    raise ValueError("a Kafka source needs a topic or a pattern")


def kafka_stream_options(src: TopicSource) -> dict[str, str]:
    """Option map of ``spark.readStream.format("kafka")``."""
    if not src.bootstrap:
        raise ValueError("a Kafka source needs bootstrap servers")
    opts = {"kafka.bootstrap.servers": src.bootstrap, **_subscription(src),
            "failOnDataLoss": str(src.fail_on_data_loss).lower()}
    if src.starting_timestamp is not None:
        opts["startingTimestamp"] = str(src.starting_timestamp)
        opts["startingOffsetsByTimestampStrategy"] = "latest"  # as on files: none later, start at the end
    else:
        opts["startingOffsets"] = src.starting
    if src.max_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(src.max_per_trigger)
    if src.min_partitions:
        opts["minPartitions"] = str(src.min_partitions)
    opts.update(src.extra)
    return opts


def kafka_batch_options(src: TopicSource, ending: str = "latest") -> dict[str, str]:
    """Option map of a bounded ``spark.read.format("kafka")`` replay (from
    ``earliest`` unless the source says otherwise) up to ``ending``."""
    opts = {k: v for k, v in kafka_stream_options(src).items()
            if k not in ("maxOffsetsPerTrigger",)}
    if "startingOffsets" in opts and opts["startingOffsets"] == "latest":
        opts["startingOffsets"] = "earliest"
    opts["endingOffsets"] = ending
    return opts


def _check_files(src: TopicSource) -> None:
    if src.kind != FILES or not src.path:
        raise ValueError("a file-backed topic needs kind='files' and a path")
    if is_spec(src.starting):
        parse_spec(src.starting)
    elif src.starting not in ("latest", "earliest"):
        raise ValueError(f"a file-backed topic starts at latest, earliest, a timestamp or offsets, not {src.starting!r}")


def _subscribed(records: DataFrame, src: TopicSource) -> DataFrame:
    """Records of the topics a file-backed source subscribes to (a filter that reaches the scan)."""
    if src.pattern:
        return records.filter(F.col("topic").rlike(f"^(?:{src.pattern})$"))
    if src.topic:
        return records.filter(F.col("topic").isin([t.strip() for t in src.topic.split(",")]))
    return records


def read_topic_stream(spark: SparkSession, src: TopicSource) -> DataFrame:
    """Streaming DataFrame of records (key, value, topic, partition, offset,
    timestamp, timestampType)."""
    if src.kind == KAFKA:
        return spark.readStream.format("kafka").options(**kafka_stream_options(src)).load()
    _check_files(src)
    r = spark.readStream.schema(RECORD_SCHEMA)
    if src.max_per_trigger:
        r = r.option("maxFilesPerTrigger", str(src.max_per_trigger))
    if not src.fail_on_data_loss:
        r = r.option("ignoreMissingFiles", "true")
    # The file source reads the files already present too; "latest" (or a
    # starting timestamp) on a file topic is applied by the start table of
    # neoflow.operators.offsets (see streaming.jobs.landing_stream).
    for k, v in src.extra.items():
        r = r.option(k, v)
    return _subscribed(r.parquet(src.path), src)


def read_topic(spark: SparkSession, src: TopicSource, ending: str = "latest") -> DataFrame:
    """Bounded replay (batch): from ``starting_timestamp`` or the offset spec if the source
    has one, else from the beginning; to ``ending``, the end or an offset spec (exclusive). A
    partition that a start spec doesn't name is read from its beginning, one that an end spec doesn't
    name to its end; where both are specs, only partitions that either names are read."""
    if src.kind == KAFKA:
        return spark.read.format("kafka").options(**kafka_batch_options(src, ending)).load()
    _check_files(src)
    if ending != "latest" and not is_spec(ending):
        raise ValueError(f"a replay of a file-backed topic ends at latest or at offsets, not {ending!r}")
    r = spark.read.schema(RECORD_SCHEMA)
    if not src.fail_on_data_loss:
        r = r.option("ignoreMissingFiles", "true")
    records = _subscribed(r.parquet(src.path), src)
    if src.starting_timestamp is not None:
        records = from_offsets(records, offsets_for_timestamp(records, src.starting_timestamp))
    if is_spec(src.starting) or is_spec(ending):
        starting = src.starting if src.starting_timestamp is None else "earliest"
        records = between_offsets(records, spec_bounds(spark, starting, ending),
                                  others=not (is_spec(starting) and is_spec(ending)))
    return records
