"""The landed table: Parquet partitioned by ``date``, appended by a streaming
query with a checkpoint (exactly-once file output), and its batch reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from neoflow.schemas import OUTPUT_COLUMNS, OUTPUT_SCHEMA

CHECKPOINT_SUBDIR = "_checkpoints"


def default_checkpoint(path: str, name: str = "landing") -> str:
    """Checkpoint inside the output folder; readers skip ``_``-prefixed names."""
    return f"{path.rstrip('/')}/{CHECKPOINT_SUBDIR}/{name}"


def cluster_for_write(df: DataFrame, partition_by: list[str], cluster: str) -> DataFrame:
    """Lay rows out so that each write task holds few folder values.

    ``rebalance``: one exchange on the folder columns whose partitions AQE then
    sizes by bytes: a hot value is split over several files, small ones share a
    task. The input is read once (a range partitioning would read it a second
    time to sample it). ``none``: map-only; every task writes one file per
    folder value it holds (tasks x values files per batch)."""
    if cluster == "none" or not partition_by:
        return df
    if cluster == "rebalance":
        return df.hint("rebalance", *partition_by)
    raise ValueError(f"unknown cluster mode {cluster!r}")


def parquet_append_stream(df: DataFrame, path: str, checkpoint: str | None = None,
                          partition_by: str | list[str] | None = "date",
                          trigger: dict | None = None, query_name: str | None = None,
                          max_records_per_file: int | None = None,
                          cluster: str = "rebalance") -> StreamingQuery:
    """Start the append-mode Parquet sink. Rows route to ``date=<value>``
    folders by their own value (NULL -> the default partition).

    trigger: e.g. ``{"processingTime": "5 seconds"}`` (default) or
    ``{"availableNow": True}`` for backfill / tests. ``cluster``: the write
    layout (see ``cluster_for_write``), the same for every trigger."""
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    df = cluster_for_write(df, cols, cluster)
    w = (df.writeStream.format("parquet").outputMode("append").option("compression", "zstd")
         .option("checkpointLocation", checkpoint or default_checkpoint(path))
         .trigger(**(trigger or {"processingTime": "5 seconds"})))
    if cols:
        w = w.partitionBy(*cols)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if query_name:
        w = w.queryName(query_name)
    return w.start(path)


def landed_table(spark: SparkSession, path: str, typed_date: bool = False) -> DataFrame:
    """Read the landed table back in output column order. ``date`` stays a
    string like in the stream unless ``typed_date`` (then DATE, as partition
    type inference would give)."""
    df = spark.read.schema(OUTPUT_SCHEMA).parquet(path).select(*OUTPUT_COLUMNS)
    if typed_date:
        df = df.withColumn("date", F.to_date("date"))
    return df
