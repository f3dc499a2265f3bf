"""Keyed state over a topic stream: gaps in the offsets, and the latest value of each key.

Both reduce what a task has read before anything is shuffled (runs of
consecutive offsets; the last record of a key), so that a hot partition or key reaches
its state as a few rows a task. They need the RocksDB state store
(``STATE_STORE``), and go on from their checkpoint after a restart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Session setting (spark.sql.streaming.stateStore.providerClass) that keyed state with timers needs.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# ------------------------------------------------------------------- SRC-4

_RUN = "topic string, partition int, first long, last long"
GAP = "topic string, partition int, expected long, found long, missing long"


def _offset_runs(batches):
    """(topic, partition, first, last) of each run of consecutive offsets of a batch; repeats count once."""
    for batch in batches:
        table = pa.Table.from_batches([batch]).filter(pc.is_valid(batch.column(2)))
        table = table.sort_by([("topic", "ascending"), ("partition", "ascending"), ("offset", "ascending")])
        if not table.num_rows:
            continue
        offset = table.column("offset").to_numpy()
        place = [table.column(c).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
                 for c in ("topic", "partition")]
        new = (np.diff(offset, prepend=offset[0]) > 1) | sum((np.diff(p, prepend=p[0]) != 0 for p in place), np.zeros(len(offset), bool))
        first = np.flatnonzero(new | (np.arange(len(offset)) == 0))
        last = np.append(first[1:], len(offset)) - 1
        got = table.select(["topic", "partition"]).take(pa.array(first)).combine_chunks()
        yield pa.RecordBatch.from_arrays(
            [*(got.column(c).combine_chunks() for c in ("topic", "partition")), pa.array(offset[first]), pa.array(offset[last])],
            names=["topic", "partition", "first", "last"])


class GapFinder(StatefulProcessor):
    """State: the offset that is expected next of each (topic, partition)."""

    def __init__(self, fail: bool):
        self.fail = fail

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.next = handle.getValueState("next", "next long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        topic, partition = key
        known = self.next.get()
        expected = known[0] if known is not None else None
        for first, last in sorted((r["first"], r["last"]) for r in rows):
            if expected is not None and first > expected:
                if self.fail:
                    raise RuntimeError(f"offsets {expected} to {first - 1} of {topic}-{partition} are gone")
                yield Row(topic=topic, partition=partition, expected=expected, found=first, missing=first - expected)
            expected = last + 1 if expected is None else max(expected, last + 1)
        self.next.update((expected,))

    def close(self) -> None:
        pass


def find_gaps(records: DataFrame, fail: bool = False) -> DataFrame:
    """Stream of records -> (topic, partition, expected, found, missing): one row where a partition's offsets
    go on later than at the next one, also from one micro-batch to another and over restarts. With
    ``fail`` (failOnDataLoss) the query fails on the first. A partition begins where it is first read;
    offsets that come late or again are no gap, records without an offset are not looked at."""
    runs = records.select("topic", "partition", "offset").mapInArrow(_offset_runs, _RUN)
    return runs.groupBy("topic", "partition").transformWithState(GapFinder(fail), GAP, "Append", "None")


# ------------------------------------------------------------------- TOP-7

CHANGE = "topic string, partition int, key binary, offset long, value binary, timestamp timestamp"


#: Bytes of last records that a task holds before it passes them on.
HELD = 32 << 20
_KEY = ["topic", "partition", "key"]


def _last_records(table: pa.Table) -> pa.Table:
    """Of each key the record with the highest offset, of equal ones the first."""
    table = table.filter(pc.and_(pc.is_valid(table["key"]), pc.greater_equal(table["offset"], 0)))  # null: no
    order = np.argsort(-table["offset"].to_numpy(), kind="stable")
    found = (table.select(_KEY).take(pa.array(order)).append_column("at", pa.array(np.arange(len(order))))
             .group_by(_KEY).aggregate([("at", "min")]))
    return table.take(pa.array(order[found["at_min"].to_numpy()])).combine_chunks()


def _last_of_keys(batches):
    """Of each key of a task the record with the highest offset; where the keys' records take more than
    HELD bytes, of each part of the task."""
    held, size = [], 0
    for batch in batches:
        held.append(_last_records(pa.Table.from_batches([batch])))
        size += held[-1].nbytes
        if size > HELD:
            held = [_last_records(pa.concat_tables(held))]
            size = held[0].nbytes
            if size > HELD // 2:
                yield from held[0].to_batches()
                held, size = [], 0
    if held:
        yield from _last_records(pa.concat_tables(held)).to_batches()


class LatestValue(StatefulProcessor):
    """State: offset of each key's last record and, if that was a tombstone, until when it is known
    (``keep_ms`` after it was met)."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "offset long, until long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best = max(rows, key=lambda r: r["offset"])
        known = self.last.get()
        if known is not None and known[0] >= best["offset"]:
            return
        if best["value"] is not None:
            self.last.update((best["offset"], None))
        elif self.keep_ms:
            until = timerValues.getCurrentProcessingTimeInMs() + self.keep_ms
            self.last.update((best["offset"], until))
            self.handle.registerTimer(until)
        elif known is not None:
            self.last.clear()
        yield Row(topic=key[0], partition=key[1], key=best["key"], offset=best["offset"], value=best["value"],
                  timestamp=best["timestamp"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.last.get()
        # A key written again since then lives; a later tombstone has a timer of its own.
        if known is not None and known[1] is not None and known[1] <= expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def latest_changes(records: DataFrame, delete_retention_ms: int = 86_400_000) -> DataFrame:
    """Stream of records -> a row (topic, partition, key, offset, value, timestamp) whenever a key's latest
    record changes, a null value for a deletion. The state holds one row a live key, and a
    deleted key's for ``delete_retention_ms`` more, in which an older record of it that comes late is
    still known to be old; with 0 it goes at once. Records without a key or offset are dropped. With a
    retention the query waits for its timers: give it a processing-time trigger, an ``availableNow``
    run would not end."""
    last = records.select("topic", "partition", "key", "offset", "value", "timestamp").mapInArrow(_last_of_keys, CHANGE)
    return last.groupBy("topic", "partition", "key").transformWithState(
        LatestValue(delete_retention_ms), CHANGE, "Append", "ProcessingTime" if delete_retention_ms else "None")
