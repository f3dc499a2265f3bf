"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows of each class that a classifier is fitted on, at most (chosen by id hash).
TRAIN_PER_CLASS = 6_000


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; fold 0 is held out. Null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def hashed_share(of: Column, want: int, n: int) -> Column:
    """True for about 0.95 * want of n rows, by hash (all if there are no more than want): no sort, no limit.
    That more than ``want`` are chosen is out of the question for want in the thousands."""
    if n <= want:
        return F.lit(True)
    return F.pmod(F.xxhash64(of), F.lit(1 << 30)) < int((1 << 30) * 0.95 * want / n)


def training_rows(docs: DataFrame, labels: DataFrame, label: str,
                  per_class: int = TRAIN_PER_CLASS) -> DataFrame:
    """(doc_id, label, fold, text) of at most ``per_class`` labelled documents of each class
    outside fold 0. Ids with contradicting labels are left out; repeated rows count once."""
    one = (labels.select("doc_id", F.col(label).cast("int").alias("label"))
           .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
           .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
           .filter("label = other").select("doc_id", "label", fold(F.col("doc_id")).alias("fold"))
           .filter("fold <> 0"))
    counts = {r["label"]: r["n"] for r in one.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = F.lit(False)
    for y, n in counts.items():
        chosen = chosen | ((F.col("label") == y) & hashed_share(F.col("doc_id"), per_class, n))
    ids = one.filter(chosen)
    texts = docs.select(F.col("doc_id"), F.col("text"))
    # ids: at most 2 * per_class rows of 16 bytes.
    return texts.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])
