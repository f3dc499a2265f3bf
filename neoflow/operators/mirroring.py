"""Mirroring into a topic that assigns its own offsets, and translating positions.

Records are appended to the target in the order of their source offsets, partition by
partition. Where they land is kept as runs: from (source offset, target offset) on, n
records with consecutive offsets on both sides. A position (the next offset a
reader wants) is looked up in the last run that begins at or before it, either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from neoflow.fs import path_exists
from neoflow.operators.topics import mirror
from neoflow.session import scratch_path
from neoflow.sinks.topic import TopicSink, append_records

SYNC_SCHEMA = ("topic string, target_topic string, partition int, source_first long, target_first long, n long")


def _syncs_path(sink: TopicSink, source_alias: str) -> str:
    return f"{sink.path.rstrip('/')}/_syncs/{source_alias}"


def mirror_to(spark: SparkSession, records: DataFrame, sink: TopicSink, source_alias: str, target_alias: str,
              pattern: str = ".*", separator: str = ".", batch: int | None = None) -> None:
    """Appends the records that ``mirror`` chooses to the target topic folder, in source order, and keeps the
    runs of offsets. With ``batch`` (an id that grows) a batch that was mirrored before is skipped."""
    chosen = mirror(records, source_alias, target_alias, pattern, separator)
    place = ["topic", "partition", "offset"]
    ordered = chosen.repartitionByRange(*place).sortWithinPartitions(*place).withColumnRenamed("offset", "source_offset")
    append_records(spark, ordered, sink, writer=f"mirror:{source_alias}", batch=batch,
                   follow=("source_offset", _syncs_path(sink, source_alias)))


def offset_syncs(spark: SparkSession, sink: TopicSink, source_alias: str, separator: str = ".") -> DataFrame:
    """The runs kept so far: SYNC_SCHEMA rows, ``topic`` the source's name."""
    path = _syncs_path(sink, source_alias)
    if not path_exists(spark, path):
        return spark.createDataFrame([], SYNC_SCHEMA)
    return spark.read.schema("topic string, partition int, first long, target_first long, n long").parquet(path).select(
        F.substring("topic", F.lit(len(source_alias + separator) + 1), F.length("topic")).alias("topic"),
        F.col("topic").alias("target_topic"), "partition", F.col("first").alias("source_first"), "target_first", "n")


def translate(positions: DataFrame, syncs: DataFrame, back: bool = False) -> DataFrame:
    """``positions(topic, partition, position, ...)`` with ``translated``: the target's position that has the same
    records before it (``back``: from the target's topic and position to the source's). Null where
    no run begins at or before the position: nothing of it was mirrored.

    Runs and positions are put in one order, cut into ranges, and each position takes the last run
    before it, in its range or else in the ranges before: no run meets a position that isn't its own."""
    spark = positions.sparkSession
    own, other = ("target_first", "source_first") if back else ("source_first", "target_first")
    name = "target_topic" if back else "topic"
    # Of runs that begin at the same place the one with the least other side counts.
    run = F.struct(F.col(own).alias("own"), (-F.col(other)).alias("other"), "n")
    runs = syncs.select(F.col(name).alias("_t"), F.col("partition").alias("_p"), F.col(own).alias("_at"), F.lit(0).alias("_kind"),
                        run.alias("_run"))
    asked = positions.select(F.col("topic").alias("_t"), F.col("partition").alias("_p"), F.col("position").cast("long").alias("_at"),
                             F.lit(1).alias("_kind"), F.lit(None).cast(runs.schema["_run"].dataType).alias("_run")).distinct()
    path = scratch_path(spark, "positions")
    (runs.unionByName(asked).filter(F.col("_at").isNotNull()).repartitionByRange("_t", "_p", "_at", "_kind")
     .withColumn("_range", F.spark_partition_id()).write.parquet(path))
    placed = spark.read.parquet(path)
    before = Window.partitionBy("_t", "_p").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (placed.groupBy("_range", "_t", "_p").agg(F.max("_run").alias("_last"))
               .select(F.col("_range").alias("_r"), F.col("_t").alias("_et"), F.col("_p").alias("_ep"), F.max("_last").over(before).alias("_earlier")))
    within = Window.partitionBy("_range", "_t", "_p").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    last = placed.withColumn("_own", F.max("_run").over(within)).filter("_kind = 1")
    there = (F.col("_range") == F.col("_r")) & F.col("_t").eqNullSafe(F.col("_et")) & F.col("_p").eqNullSafe(F.col("_ep"))
    found = (last.join(earlier, there).withColumn("_found", F.coalesce("_own", "_earlier")).filter("_found is not null")
             .select("_t", "_p", F.col("_at").alias("_q"),
                     (F.least(F.col("_at") - F.col("_found.own"), F.col("_found.n")) - F.col("_found.other")).alias("translated")))
    same = (F.col("topic").eqNullSafe(F.col("_t")) & F.col("partition").eqNullSafe(F.col("_p"))
            & F.col("position").eqNullSafe(F.col("_q")))
    return positions.join(found, same, "left").select(*positions.columns, "translated")
