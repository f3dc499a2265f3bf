"""Offset bookkeeping on record tables: where to start reading.

``startingOffsets=latest`` means: skip what was in the topic at the first
start; a restart from a checkpoint ignores it (the checkpoint's offsets
rule). On a file-backed topic the same is done with a per-partition start
table written once into the checkpoint folder and joined to the records.
The start table has one row per (topic, partition): its size is bounded by
the topic's partition count, not by the data, so the planner's size check
turns the join into a broadcast hash join.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from neoflow.fs import path_exists

START_OFFSETS_SUBDIR = "_start_offsets"
START_SCHEMA = "topic string, partition int, start_offset long"


def next_offsets(records: DataFrame) -> DataFrame:
    """(topic, partition, start_offset = last offset + 1) - the "latest"
    position of every partition present."""
    return records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("start_offset"))


def offsets_for_timestamp(records: DataFrame, ts) -> DataFrame:
    """(topic, partition, start_offset) for ``startingTimestamp``: per
    partition the first offset whose timestamp is at or after ``ts``; a
    partition without such a record starts at its end (nothing old is
    read). ``ts``: timestamp literal text or epoch milliseconds."""
    t = F.timestamp_millis(F.lit(int(ts))) if isinstance(ts, (int, float)) else F.lit(ts).cast("timestamp")
    return records.groupBy("topic", "partition").agg(
        F.coalesce(F.min(F.when(F.col("timestamp") >= t, F.col("offset"))),
                   F.max("offset") + 1).alias("start_offset"))


def from_offsets(records: DataFrame, starts: DataFrame) -> DataFrame:
    """Records at or after each partition's start offset; partitions missing
    from ``starts`` (created later) are read from their beginning. A record without
    an offset has no place before the start: it is kept."""
    own = starts.select(F.col("topic").alias("_t"), F.col("partition").alias("_p"), "start_offset")
    j = records.join(own, F.col("topic").eqNullSafe(F.col("_t")) & F.col("partition").eqNullSafe(F.col("_p")), "left")
    return j.filter(F.col("offset").isNull() | (F.col("offset") >= F.coalesce(F.col("start_offset"), F.lit(0)))) \
        .select(*records.columns)


# ------------------------------------------------------------- offset specs
# The two positions that an offset spec names by number.
LATEST, EARLIEST = -1, -2


def is_spec(text: str) -> bool:
    return text.lstrip().startswith("{")


def parse_spec(text: str) -> dict[tuple[str, int], int]:
    """An offset spec, ``{"topic": {"0": 23, "1": -2}}``, as {(topic, partition): offset}; -2 is
    the earliest offset, -1 the end. Its size is bounded by the topic's partitions."""
    try:
        spec = {(topic, int(p)): int(o) for topic, parts in json.loads(text).items() for p, o in parts.items()}
    except (ValueError, AttributeError, TypeError) as e:
        raise ValueError(f"not an offset spec: {text!r}") from e
    if any(o < EARLIEST for o in spec.values()):
        raise ValueError(f"an offset is 0 or more, -1 or -2: {text!r}")
    return spec


def spec_bounds(spark: SparkSession, starting: str, ending: str = "latest") -> DataFrame:
    """(topic, partition, first, end, from_end) rows of a start and an end spec: read offsets first <= offset < end;
    a null bound is none, ``from_end`` says that the partition starts where it ends now. ``starting`` may also be
    "earliest" or "latest", ``ending`` "latest"; a partition that a spec doesn't name is read from
    its beginning, or to its end."""
    first = parse_spec(starting) if is_spec(starting) else {}
    end = parse_spec(ending) if is_spec(ending) else {}
    if EARLIEST in end.values():
        raise ValueError("a replay can't end at the earliest offset")
    rows = [(t, p, None if (lo := first.get((t, p), EARLIEST)) < 0 else lo,
             None if (hi := end.get((t, p), LATEST)) < 0 else hi, lo == LATEST)
            for t, p in sorted(first.keys() | end.keys())]
    return spark.createDataFrame(rows, "topic string, partition int, first long, end long, from_end boolean")


def _envelope(bounds: list) -> Column:
    """Per topic the widest range of its bounds: a filter on topic and offset that the scan's statistics serve."""
    by_topic: dict[str, list] = {}
    for b in bounds:
        by_topic.setdefault(b["topic"], []).append(b)
    parts = []
    for topic, rows in by_topic.items():
        own = F.col("topic") == topic
        if all(r["first"] is not None for r in rows):
            own &= F.col("offset") >= min(r["first"] for r in rows)
        if all(r["end"] is not None for r in rows):
            own &= F.col("offset") < max(r["end"] for r in rows)
        parts.append(own)
    return reduce(or_, parts)


def between_offsets(records: DataFrame, bounds: DataFrame, others: bool = True) -> DataFrame:
    """Records inside the bounds (from ``spec_bounds``) of their partition; those of partitions without bounds
    are kept unless ``others`` is false. Only then a range of offsets for each topic reaches the scan, so
    that files and row groups beyond it are skipped by their statistics."""
    rows = bounds.collect()  # the caller's spec: one row a partition
    if not rows:
        return records if others else records.limit(0)
    if any(r["from_end"] for r in rows):
        ends = next_offsets(records).withColumnRenamed("start_offset", "at_end")
        bounds = bounds.join(ends, ["topic", "partition"], "left").withColumn(
            "first", F.when(F.col("from_end"), F.coalesce("at_end", F.lit(0))).otherwise(F.col("first"))).drop("at_end")
    own = bounds.select(F.col("topic").alias("_t"), F.col("partition").alias("_p"), "first", "end")
    near = records if others else records.filter(_envelope(rows))
    j = near.join(own, (F.col("topic") == F.col("_t")) & (F.col("partition") == F.col("_p")), "left" if others else "inner")
    inside = (F.col("first").isNull() | (F.col("offset") >= F.col("first"))) & \
        (F.col("end").isNull() | (F.col("offset") < F.col("end")))
    return j.filter(F.coalesce(inside, F.lit(others))).select(*records.columns)


def spec_starts(spark: SparkSession, existing: DataFrame, spec: str) -> DataFrame:
    """The start table of a spec: (topic, partition, start_offset)."""
    bounds = spec_bounds(spark, spec)
    ends = next_offsets(existing).withColumnRenamed("start_offset", "at_end")
    return bounds.join(ends, ["topic", "partition"], "left").select(
        "topic", "partition", F.when(F.col("from_end"), F.coalesce("at_end", F.lit(0)))
        .otherwise(F.coalesce("first", F.lit(0))).alias("start_offset"))


def start_at_latest(spark: SparkSession, existing: DataFrame, checkpoint: str,
                    timestamp=None, spec: str | None = None) -> DataFrame:
    """The start table of a query: written from ``existing`` (the topic as it
    is now) at the first start, read back unchanged on every restart.
    With ``timestamp``, the start is by time, with ``spec`` by offsets instead of "latest"."""
    path = f"{checkpoint.rstrip('/')}/{START_OFFSETS_SUBDIR}"
    if not path_exists(spark, f"{path}/_SUCCESS"):  # a crash may have left a part of it
        if spec is not None:
            starts = spec_starts(spark, existing, spec)
        else:
            starts = next_offsets(existing) if timestamp is None else offsets_for_timestamp(existing, timestamp)
        starts.write.mode("overwrite").parquet(path)
    return spark.read.schema(START_SCHEMA).parquet(path)
