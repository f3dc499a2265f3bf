"""Session construction and the shared scratch folder.

The job never invents a machine-local folder on a cluster: scratch output
(file-backed topics, stream sinks, stream checkpoints) goes under the shared
folder named by ``spark.checkpoint.dir``. Only when that setting is absent and
the master is local (tests, a laptop) is a temporary folder created and
registered as the checkpoint dir.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every neoflow session wants. ANSI stays at the Spark 4 default (on);
# the casts in neoflow.functions are written to be tolerant under it.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (post-shuffle, measured) size limit under which AQE turns a
    # sort-merge join into a broadcast join. Small per-day / per-partition
    # tables hit it; anything that grows with the data falls back to SMJ.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "neoflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session with neoflow's defaults applied."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). If unset: on a local master, create a temp folder and
    register it; on a cluster, refuse, since a local folder would not be
    visible to other executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared folder "
            "(HDFS / object store) that all executors can reach")
    d = tempfile.mkdtemp(prefix="neoflow-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path under the shared folder (not created)."""
    base = shared_dir(spark)
    return f"{base}/neoflow/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["DEFAULT_CONF", "build_session", "scratch_path", "shared_dir"]
