"""Keeping and dropping rows of a documents table by (doc_id, text hash)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neoflow.session import shared_dir

#: Listed rows (20 bytes each) up to which the list is broadcast; beyond it Spark joins by a shuffle.
BROADCAST_ROWS = 400_000


def select_rows(docs: DataFrame, verdict: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that ``verdict(doc_id, tkey, keep)`` lets stay.

    ``tkey`` is xxhash64 of the text. Rows it doesn't list stay; of rows listed with keep 1
    that repeat id and text one stays; with keep 0 none. Further columns of ``docs`` may have any names.
    """
    shared_dir(docs.sparkSession)  # where checkpoint() writes
    verdict = verdict.select(F.col("doc_id").alias("of"), F.col("tkey").alias("at"), F.col("keep").alias("keep")).checkpoint()
    if verdict.count() <= BROADCAST_ROWS:
        verdict = F.broadcast(verdict)
    # The row travels as one value, so that no column of it can clash with a name used here.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("id"),
                       F.xxhash64("text").alias("own"))
    joined = rows.join(verdict, F.col("id").eqNullSafe(F.col("of")) & (F.col("own") == F.col("at")), "left")
    rest = joined.filter("keep is null").select("row.*")
    once = joined.filter("keep = 1").dropDuplicates(["id", "own"]).select("row.*")
    return rest.unionByName(once)
