"""Hard-negative mining by slot-decomposed selection.

An anchor's positives are its best rows of the same label; a positive's negatives
are the best rows of other labels whose scores lie in a window below the positive's
score. An anchor's windows overlap, but their upper limits cut the scores into
disjoint slots: slot j holds the scores above the (j+1)-th limit up to the j-th. The
best k below the j-th limit are among the best k of slots j and lower, so a row
is kept in its one slot only, combiners keep k rows a slot, and merging slots from
the lowest up answers all windows; a window's lower limit then cuts its answer short.

Rows and anchors meet in a grid of cells (a block of anchors, a share of the rows): a
cell gets its anchors first and streams its rows against them as matrix products,
holding k rows for each anchor and slot. Each cell sends its anchors' few rows on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from neoflow.llm.golomb import shuffle_width
from neoflow.session import scratch_path

#: Anchors of a cell: 64 components of 8 bytes make 2 MB.
ANCHORS = 4096
#: Rows met at a time; a score matrix holds at most ANCHORS times as many.
ROWS = 1024
#: Scores up to here are exact in floating point; up to LARGEST their percentages fit in 64 bits.
EXACT, LARGEST = float(1 << 53), float(1 << 55)

_VECTOR = "array<long>"


@dataclass(frozen=True)
class Mining:
    """``positives`` an anchor, ``negatives`` a positive; a negative's score times 100 lies between
    ``low`` and ``high`` times the positive's."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95

    def limits(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest integer score in the window of a positive."""
        return -((-self.low * score) // 100), (self.high * score) // 100


def quantised(vector: Column, scale: int = 256) -> Column:
    """Each component x as floor(scale * x), x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def finite(vector: Column) -> Column:
    """The vector isn't null and each component is a finite number."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Integer vectors as rows of one matrix, short ones padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths),
        np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` and ``b``; scores that could pass LARGEST fail."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < EXACT:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound >= LARGEST:
        raise OverflowError("scores may pass 2**55")
    return a @ b.T


class Kept:
    """The best ``k`` rows (score down, id up) of each group, as rows stream by."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.group = self.score = self.id = np.empty(0, np.int64)
        self.worst = np.full(groups, np.iinfo(np.int64).min)  # below it nothing can enter a full group

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        enters = score >= self.worst[group]
        if not enters.any():
            return
        group = np.concatenate([self.group, group[enters]])
        score = np.concatenate([self.score, score[enters]])
        ids = np.concatenate([self.id, ids[enters]])
        order = np.lexsort((ids, -score, group))
        group = group[order]
        first = np.flatnonzero(np.diff(group, prepend=-1))
        rank = np.arange(len(group)) - np.repeat(first, np.diff(first, append=len(group)))
        top = rank < self.k
        self.group, self.score, self.id = group[top], score[order][top], ids[order][top]
        full = rank[top] == self.k - 1
        self.worst[self.group[full]] = self.score[full]


def slots(score: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Slot of each score of an anchor (a row of the matrices): how many of the anchor's upper
    limits are no lower, less one; -1 above all."""
    out = np.full(score.shape, -1, np.int8)
    for j in range(limits.shape[1]):
        out += (score <= limits[:, j, None]).astype(np.int8)
    return out


def suffix_answers(positives: list[tuple[int, int]], rows: list[tuple[int, int, int]], mining: Mining):
    """An anchor's windows. ``positives`` as (id, score), best first; ``rows`` as (slot, score, id), the
    best of each slot. -> (positive id, positive score, [(id, score), ..]) for each positive."""
    by_slot: dict[int, list[tuple[int, int]]] = {}
    for slot, score, row in rows:
        by_slot.setdefault(slot, []).append((-score, row))
    out, best = [], []
    for j in range(len(positives) - 1, -1, -1):  # from the lowest slot up
        best = sorted(best + by_slot.get(j, []))[:mining.negatives]
        pid, score = positives[j]
        low = int(mining.limits(np.int64(score))[0])
        out.append((pid, score, [(row, -s) for s, row in best if -s >= low]))
    return out[::-1]


# Rows of a cell: its anchors (kind 0) come first, then the rows they meet (kind 1).
_CELL = ["cell", "kind", "id", "label", "vector", "limits"]


def _met(mining: Mining, positives: bool, width: int):
    """Streams the cells of a partition: (anchor, slot, score, id) of the best rows. For ``positives``
    those of the same label, all in slot 0; else those of other labels, by slot of their anchor's limits."""
    many = 1 if positives else mining.positives

    def meet(kept, anchors, ids, labels, vectors):
        a_ids, a_labels, a_vectors, highs, lows = anchors
        score = products(a_vectors, vectors)
        same = a_labels[:, None] == labels[None, :]
        if positives:
            which, row = np.nonzero(same & (a_ids[:, None] != ids[None, :]))
            kept.add(which, score[which, row], ids[row])
            return
        slot = slots(score, highs)
        which, row = np.nonzero((slot >= 0) & (score >= lows[:, None]) & ~same)
        kept.add(which * many + slot[which, row], score[which, row], ids[row])

    def sent(kept, anchors):
        which, slot = kept.group // many, kept.group % many
        return pa.RecordBatch.from_arrays(
            [pa.array(anchors[0][which]), pa.array(slot.astype(np.int32)), pa.array(kept.score), pa.array(kept.id)],
            names=["anchor", "slot", "score", "id"])

    def anchors_of(parts):
        ids, labels, vectors = (np.concatenate([p[i] for p in parts]) for i in range(3))
        low = np.full((len(ids), mining.positives), np.iinfo(np.int64).max)
        high = np.full((len(ids), mining.positives), np.iinfo(np.int64).min)
        at = 0
        for limits in (x for p in parts for x in p[3]):
            if limits:
                low[at, :len(limits)], high[at, :len(limits)] = mining.limits(np.array(limits, np.int64))
            at += 1
        return ids, labels, vectors, high, low.min(1)

    def run(batches):
        now, parts, anchors, kept = None, [], None, None
        for batch in batches:
            cells, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(kinds) != 0)) + 1
            for first, end in zip([0, *cuts], [*cuts, len(cells)]):
                piece, cell, kind = batch.slice(first, end - first), cells[first], kinds[first]
                if cell != now:
                    if kept is not None:
                        yield sent(kept, anchors)
                    now, parts, anchors, kept = cell, [], None, None
                ids, labels = piece.column(2).to_numpy(), piece.column(3).to_numpy()
                vectors = _matrix(piece.column(4), width)
                if kind == 0:
                    parts.append((ids, labels, vectors, piece.column(5).to_pylist()))
                    continue
                if not parts:
                    continue  # no anchor in this cell
                if kept is None:
                    anchors = anchors_of(parts)
                    kept = Kept(len(anchors[0]) * many, mining.positives if positives else mining.negatives)
                for i in range(0, len(ids), ROWS):
                    meet(kept, anchors, ids[i:i + ROWS], labels[i:i + ROWS], vectors[i:i + ROWS])
        if kept is not None:
            yield sent(kept, anchors)
    return run


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"negatives-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _cells(rows: DataFrame, anchors: DataFrame, blocks: int, shares: int) -> DataFrame:
    """Each anchor in the cells of its block, each row in those of its share, anchors first."""
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    share = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shares))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    a = (anchors.withColumn("other", upto(shares))
         .select((block * shares + F.col("other")).cast("int").alias("cell"), F.lit(0).alias("kind"), "id", "label", "vector", "limits"))
    b = (rows.withColumn("other", upto(blocks))
         .select((F.col("other") * shares + share).cast("int").alias("cell"), F.lit(1).alias("kind"), "id", "label", "vector",
                 F.lit(None).cast(_VECTOR).alias("limits")))
    return a.unionByName(b).repartitionById(blocks * shares, "cell").sortWithinPartitions("cell", "kind").select(*_CELL)


def hard_negatives(rows: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """``rows(id, label, vector: array<long>, anchor: boolean)`` -> (anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score), the scores inner products.

    Rows with a null id, label, vector or component take no part; of rows that repeat an id one
    does (least label, then vector). Vectors of different lengths are padded with zeros. Equal
    scores go by the smaller id. An anchor without a row of its label, and a positive
    without a row in its window, give no rows; nor does an empty table.
    """
    clean = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
                        & ~F.exists("vector", lambda x: x.isNull()))
    once = clean.groupBy(F.col("id").cast("long").alias("id")).agg(
        F.min(F.struct(F.col("label").cast("long").alias("label"), "vector", F.coalesce("anchor", F.lit(False)).alias("anchor")))
        .alias("x")).select("id", "x.label", "x.vector", "x.anchor")
    rows = _written(once, "rows")
    n = rows.agg(F.count_if("anchor").alias("anchors"), F.max(F.size("vector")).alias("width")).first()
    blocks = max(1, -(-n["anchors"] // ANCHORS))
    shares = max(1, shuffle_width(rows) // blocks)
    rows = rows.withColumn("limits", F.lit(None).cast(_VECTOR))
    anchors = rows.filter("anchor")
    kept = "anchor long, slot int, score long, id long"

    def best(cells: DataFrame, positives: bool, k: int) -> DataFrame:
        met = cells.mapInArrow(_met(mining, positives, n["width"] or 0), kept)
        order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "id")
        return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    first = best(_cells(rows, anchors, blocks, shares), True, mining.positives)
    positives = _written(first.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives")), "positives")
    limited = anchors.drop("limits").join(
        positives.select(F.col("anchor").alias("id"), F.col("positives.score").alias("limits")), "id")
    second = best(_cells(rows, limited, blocks, shares), False, mining.negatives)
    slotted = second.groupBy("anchor").agg(F.collect_list(F.struct("slot", "score", "id")).alias("rows"))

    def answers(batches):
        for batch in batches:
            out = []
            for anchor, pos, got in zip(*(c.to_pylist() for c in batch.columns)):
                found = suffix_answers([(p["id"], p["score"]) for p in pos],
                                       [(r["slot"], r["score"], r["id"]) for r in got], mining)
                out += [(anchor, pid, rank, row, score, s) for pid, score, best in found
                        for rank, (row, s) in enumerate(best, 1)]
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["anchor_id", "positive_id", "rank", "negative_id",
                                                    "positive_score", "negative_score"])

    return positives.join(slotted, "anchor").select("anchor", "positives", "rows").mapInArrow(
        answers, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
