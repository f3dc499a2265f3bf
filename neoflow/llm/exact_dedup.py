"""Exact dedup by a Golomb-coded fingerprint exchange.

1. Each partition hashes its texts (ASCII lower case, SHA-256) and writes, per
   hash owner, its sorted fingerprints as Golomb-Rice codes (a table in the
   shared folder, so that senders stay as they are when a task is run again).
2. Owners decode, find values that occur twice and answer with bitmaps.
3. Only suspects' texts are shuffled: they are grouped by the bytes
   themselves, pre-aggregated on the map side, so a group of copies of any
   size is one row per task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neoflow.llm.golomb import Universe, answered, shuffle_width, with_bitmaps
from neoflow.llm.rows import select_rows
from neoflow.session import scratch_path

#: Rows of a partition whose fingerprints are coded together.
CHUNK = 200_000
#: Suspects up to which their ids (8 bytes each) are broadcast; beyond it Spark joins by a shuffle.
BROADCAST_IDS = 500_000
#: Groups of copies up to which they are broadcast (about 60 bytes each); beyond it suspects are joined by a shuffle.
BROADCAST_GROUPS = 200_000

_MESSAGE = ("sender long, chunk long, owner long, blob binary, uid array<long>, "
            "doc_id array<long>, tkey array<long>, sha array<binary>")


def _sender(universe: Universe):
    def run(batches):
        sender = TaskContext.get().partitionId()
        ids, tkeys, shas, first, chunk = [], [], [], 0, 0

        def flush():
            fp = np.frombuffer(b"".join(s[:8] for s in shas), dtype=">u8").astype(np.uint64)
            rows = []
            for owner, at, blob in universe.messages(fp):
                rows.append({"sender": sender, "chunk": chunk, "owner": owner, "blob": blob,
                             "uid": [(sender << 33) + first + int(i) for i in at],
                             "doc_id": [ids[i] for i in at], "tkey": [tkeys[i] for i in at], "sha": [shas[i] for i in at]})
            return pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("sender", pa.int64()), ("chunk", pa.int64()), ("owner", pa.int64()),
                ("blob", pa.binary()), ("uid", pa.list_(pa.int64())),
                ("doc_id", pa.list_(pa.int64())), ("tkey", pa.list_(pa.int64())), ("sha", pa.list_(pa.binary()))]))

        for batch in batches:
            for doc_id, tkey, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                tkeys.append(tkey)
                shas.append(hashlib.sha256((text.as_py() or b"").lower()).digest())
                if len(ids) == CHUNK:
                    yield flush()
                    first, chunk, ids, tkeys, shas = first + len(ids), chunk + 1, [], [], []
        if ids:
            yield flush()
    return run


def _unpack(batches):
    for batch in batches:
        for r in batch.to_pylist():
            hit = answered(r["blob"], r["bitmap"])[1]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(r[c], pa.int64()) for c in ("uid", "doc_id", "tkey")),
                 pa.array(r["sha"], pa.binary()), pa.array(hit)],
                names=["uid", "doc_id", "tkey", "sha", "suspect"])


def _normalised(batches):
    for batch in batches:
        low = [(t.as_py() or b"").lower() for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([hashlib.sha256(t).digest() for t in low], pa.binary()),
             pa.array(low, pa.binary())], names=["sha", "bytes"])


def exact_dedup(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> (doc_id, tkey, keep_id, group_size, kept, sha), ``tkey`` the text's xxhash64.

    One row per input row. A null text is the empty text; empty texts are
    equal to each other. The row with the largest doc_id stays (null ids come
    last); of rows that repeat that id, one. An empty table gives no rows;
    further columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("tkey"))
    n = docs.select("doc_id").count()
    universe = Universe(n, shuffle_width(docs))
    path = scratch_path(spark, "exact-dedup-messages")
    docs.mapInArrow(_sender(universe), _MESSAGE).write.parquet(path)

    done = scratch_path(spark, "exact-dedup-rows")
    (with_bitmaps(spark.read.parquet(path), n)
     .select("uid", "doc_id", "tkey", "sha", "blob", "bitmap")
     .mapInArrow(_unpack, "uid long, doc_id long, tkey long, sha binary, suspect boolean")
     .write.parquet(done))
    rows = spark.read.parquet(done)
    suspects = rows.filter("suspect")

    ids = suspects.select("doc_id").distinct()
    null_safe = docs["doc_id"].eqNullSafe(ids["doc_id"])
    if suspects.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = (docs.join(ids, null_safe, "left_semi").select("text")
             .mapInArrow(_normalised, "sha binary, bytes binary")
             .groupBy("sha", "bytes").agg(F.count("*").alias("n"))
             .groupBy("sha").agg(F.count("*").alias("n_texts")))
    last = F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "uid")
    groups = (suspects.groupBy("sha")
              .agg(F.max(last).alias("last"), F.count("*").alias("group_size"))
              .join(texts, "sha")
              .select("sha", F.col("last.doc_id").alias("keep_id"), F.col("last.uid").alias("keep_uid"),
                      F.when(F.col("n_texts") == 1, F.col("group_size"))
                      .otherwise(F.raise_error(F.lit("two texts have one SHA-256")).cast("long"))
                      .alias("group_size"))
              .filter("group_size > 1"))
    path = scratch_path(spark, "exact-dedup-groups")
    groups.write.parquet(path)
    groups = spark.read.parquet(path)
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    # Only suspects are joined; a text that is no suspect has no copy.
    own = F.col("keep_uid").isNull()
    copies = suspects.join(groups, "sha", "left").select(
        "doc_id", "tkey", F.when(own, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("uid") == F.col("keep_uid"), F.lit(True)).alias("kept"), "sha")
    single = rows.filter("not suspect").select(
        "doc_id", "tkey", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "sha")
    return copies.unionByName(single)


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that exact dedup keeps."""
    found = exact_dedup(docs).filter("group_size > 1")
    return select_rows(docs, found.groupBy("doc_id", "tkey").agg(F.max(F.col("kept").cast("int")).alias("keep")))
