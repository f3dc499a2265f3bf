"""Object-store credentials for source / sink paths, from the environment.

Keys go to the Hadoop configuration of the session (``spark.hadoop.fs.s3a.*``
at build time, or the live Hadoop conf of a running session). Paths must use
the ``s3a://`` scheme for these keys to apply.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# The S3A property names and the default endpoint.
ACCESS_KEY_PROP = "fs.s3a.access.key"
SECRET_KEY_PROP = "fs.s3a.secret.key"
ENDPOINT_PROP = "fs.s3a.endpoint"
DEFAULT_ENDPOINT = "s3.amazonaws.com"


def s3a_conf(access_env: str = "AWS_ACCESS_KEY", secret_env: str = "AWS_SECRET_ACCESS_KEY",
             endpoint: str = DEFAULT_ENDPOINT, environ=None) -> dict[str, str]:
    """Builder config map (``spark.hadoop.`` prefixed). Raises KeyError
    naming the variable when one is unset."""
    env = os.environ if environ is None else environ
    missing = [v for v in (access_env, secret_env) if v not in env]
    if missing:
        raise KeyError(f"environment variable(s) not set: {', '.join(missing)}")
    return {f"spark.hadoop.{ACCESS_KEY_PROP}": str(env[access_env]),
            f"spark.hadoop.{SECRET_KEY_PROP}": str(env[secret_env]),
            f"spark.hadoop.{ENDPOINT_PROP}": endpoint}


def apply_s3a(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set the keys on a running session's Hadoop configuration."""
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    for k, v in conf.items():
        hconf.set(k.removeprefix("spark.hadoop."), v)


def to_s3a(path: str) -> str:
    """``s3://bucket/x`` -> ``s3a://bucket/x`` (the scheme the keys apply to)."""
    return "s3a://" + path[len("s3://"):] if path.startswith("s3://") else path
