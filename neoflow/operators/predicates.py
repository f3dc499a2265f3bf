"""Row predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """Rows with ``start <= col <= end`` (closed on both ends). ``col`` may be
    a DATE or a 'yyyy-MM-dd' string; start > end selects nothing. On a
    partitioned Parquet table this becomes a partition filter."""
    return df.filter(F.col(col).between(F.lit(start), F.lit(end)))
