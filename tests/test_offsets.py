"""Offsets that a topic assigns, offset bounds, gaps, keyed state, compaction, retention,
mirroring, described messages and growing files."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from neoflow.operators.compaction import compact, merged, snapshot, tail_by_key
from neoflow.operators.envelope import decode_described, describe, message_schemas, payload, undescribed
from neoflow.operators.mirroring import mirror_to, offset_syncs, translate
from neoflow.operators.offsets import next_offsets, parse_spec, spec_bounds
from neoflow.operators.retention import expired_segments, retention_by_size, segments
from neoflow.operators.topics import lines_to_records
from neoflow.plans.q_offsets import rocksdb_state
from neoflow.schemas import RECORD_SCHEMA
from neoflow.session import scratch_path
from neoflow.sinks import topic as topic_sink
from neoflow.sinks.commits import CommitLog
from neoflow.sinks.topic import FILES, TopicSink, append_records, create_topic, topic_ends, write_topic
from neoflow.sources.growing import Part, last_line_end, lines_of, read_growing_lines
from neoflow.sources.topic import TopicSource, read_topic, read_topic_stream
from neoflow.streaming.feed_job import Numbers
from neoflow.streaming.jobs import AVAILABLE_NOW, from_start, run_available_now
from neoflow.streaming.topic_state import find_gaps, latest_changes

T0 = dt.datetime(2024, 1, 10)


def recs(spark, rows):
    """(key, value, topic, partition, offset, hours) rows as records."""
    full = [(k.encode() if k else None, v.encode() if v is not None else None, t, p, o,
             T0 + dt.timedelta(hours=h), 0) for k, v, t, p, o, h in rows]
    return spark.createDataFrame(full, RECORD_SCHEMA)


def new(spark, name, **more):
    sink = TopicSink(kind=FILES, path=scratch_path(spark, f"t-{name}"), topic=name, **more)
    create_topic(spark, sink)
    return sink


def stored(spark, sink):
    return read_topic(spark, TopicSource(kind=FILES, path=sink.path))


def places(spark, sink):
    """{(topic, partition): sorted offsets}"""
    out = {}
    for r in stored(spark, sink).select("topic", "partition", "offset").collect():
        out.setdefault((r.topic, r.partition), []).append(r.offset)
    return {k: sorted(v) for k, v in out.items()}


def to_parquet(stream, out, ckpt):
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt) \
        .trigger(**AVAILABLE_NOW).start()
    run_available_now([q])
    return q


# ------------------------------------------------------------------ appends

def test_several_tasks_write_into_the_same_partitions(spark):
    sink = new(spark, "dense")
    msgs = spark.range(1000, numPartitions=4).select(F.col("id").cast("string").alias("value"), (F.col("id") % 2).cast("int").alias("partition"))
    append_records(spark, msgs, sink)
    append_records(spark, msgs, sink)
    assert places(spark, sink) == {("dense", 0): list(range(1000)), ("dense", 1): list(range(1000))}
    # within a task and partition offsets follow the messages' order
    first = stored(spark, sink).filter("offset < 500 and partition = 0").orderBy("offset")
    values = [int(r.value.decode()) for r in first.collect()]
    assert values == sorted(values)
    assert {r.next_offset for r in topic_ends(spark, sink).collect()} == {1000}


def test_replayed_batch_writes_nothing(spark):
    sink = new(spark, "replay")
    msgs = spark.range(10, numPartitions=3).select(F.col("id").cast("string").alias("value"))
    for batch in (0, 1, 1, 0):
        append_records(spark, msgs, sink, writer="w", batch=batch)
    append_records(spark, msgs, sink, writer="other", batch=0)
    assert stored(spark, sink).count() == 30
    assert all(v == list(range(len(v))) for v in places(spark, sink).values())


@pytest.mark.parametrize("written", [False, True])
def test_cut_off_append_is_finished(spark, monkeypatch, written):
    sink = new(spark, "cut")
    msgs = spark.range(6, numPartitions=2).select(F.col("id").cast("string").alias("value"), F.lit(0).alias("partition"))
    append_records(spark, msgs, sink, writer="w", batch=0)
    finish = topic_sink._finish

    def fails(spark, sink, log, commit, again):
        if written:  # the records are there, the mark isn't
            monkeypatch.setattr(CommitLog, "finish", lambda self, version: None)
            finish(spark, sink, log, commit, again)
            monkeypatch.undo()
        raise OSError("lost")

    monkeypatch.setattr(topic_sink, "_finish", fails)
    with pytest.raises(OSError):
        append_records(spark, msgs, sink, writer="w", batch=1)
    monkeypatch.setattr(topic_sink, "_finish", finish)
    append_records(spark, msgs, sink, writer="w", batch=1)  # the replay of the batch
    append_records(spark, msgs, sink, writer="w", batch=2)
    assert places(spark, sink) == {("cut", 0): list(range(18))}


def test_cut_off_move_is_finished(spark, monkeypatch):
    """Messages whose tasks have partitions of their own are written once and moved, also after a half of the move."""
    sink = new(spark, "moved")
    msgs = spark.range(90, numPartitions=3).select(F.col("id").cast("string").alias("value"))
    append_records(spark, msgs, sink, writer="w", batch=0)
    move = topic_sink._move_files

    def half(spark, source, target):
        folder = source.removeprefix("file:")
        files = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
        os.rename(f"{folder}/{files[0]}", f"{target.removeprefix('file:')}/{files[0]}")
        raise OSError("lost")

    monkeypatch.setattr(topic_sink, "_move_files", half)
    with pytest.raises(OSError):
        append_records(spark, msgs, sink, writer="w", batch=1)
    monkeypatch.setattr(topic_sink, "_move_files", move)
    append_records(spark, msgs, sink, writer="w", batch=1)  # the replay of the batch
    append_records(spark, msgs, sink, writer="w", batch=2)
    assert places(spark, sink) == {("moved", p): list(range(90)) for p in range(3)}
    assert not os.listdir(f"{sink.path.removeprefix('file:')}/_staged")


def test_topic_with_offsets_of_its_own_goes_on(spark):
    sink = new(spark, "own")
    recs(spark, [("a", "1", "own", 0, 41, 0), ("a", "1", "own", 1, 7, 0)]).write.mode("append").parquet(sink.path)
    append_records(spark, spark.createDataFrame([("x", 0), ("y", 1), ("z", 2)], "value string, partition int").coalesce(1), sink)
    assert places(spark, sink) == {("own", 0): [41, 42], ("own", 1): [7, 8], ("own", 2): [0]}


def test_partition_by_key_and_empty_append(spark):
    sink = new(spark, "keyed", num_partitions=3)
    msgs = spark.range(60, numPartitions=4).select((F.col("id") % 5).cast("string").alias("key"), F.col("id").cast("string").alias("value"))
    append_records(spark, msgs, sink)
    append_records(spark, msgs.limit(0), sink)
    by_key = stored(spark, sink).groupBy("key").agg(F.count_distinct("partition").alias("n"))
    assert {r.n for r in by_key.collect()} == {1} and {p for _, p in places(spark, sink)} <= {0, 1, 2}
    assert stored(spark, sink).filter("timestamp is null or timestampType <> 1").count() == 0


def test_lines_are_read_after_a_latest_start(spark):
    sink = new(spark, "lines")
    src = TopicSource(kind=FILES, path=sink.path, starting="latest")
    ckpt, out = scratch_path(spark, "t-ck"), scratch_path(spark, "t-out")
    to_parquet(from_start(spark, src, read_topic_stream(spark, src), ckpt), out, ckpt)
    write_topic(lines_to_records(spark.createDataFrame([("l1",), ("l2",)], "value string"), "lines"), sink)
    to_parquet(from_start(spark, src, read_topic_stream(spark, src), ckpt), out, ckpt)
    assert sorted(r.value.decode() for r in spark.read.parquet(out).collect()) == ["l1", "l2"]


def test_records_without_an_offset_are_kept(spark):
    sink = new(spark, "nowhere")
    recs(spark, [("a", "1", "nowhere", 0, 3, 0), ("a", "2", "nowhere", None, None, 0)]).write.mode("append").parquet(sink.path)
    src = TopicSource(kind=FILES, path=sink.path, starting="latest")
    ckpt, out = scratch_path(spark, "t-ck"), scratch_path(spark, "t-out")
    to_parquet(from_start(spark, src, read_topic_stream(spark, src), ckpt), out, ckpt)
    assert [r.value.decode() for r in spark.read.parquet(out).collect()] == ["2"]


def test_commit_versions_are_taken_once(spark):
    log = CommitLog(spark, scratch_path(spark, "t-log"))
    assert log.last() is None
    log.begin(0, {"a": 1})
    with pytest.raises(FileExistsError):
        log.begin(0, {"a": 2})
    assert log.last().payload == {"a": 1} and not log.last().done
    for v in range(6):
        if v:
            log.begin(v, {"v": v})
        log.finish(v)
    assert log.last().version == 5 and log.last().done and len(log._names()) <= 6


def test_numbers_of_a_batch_sent_again(spark):
    numbers = Numbers(spark, scratch_path(spark, "t-numbers"))
    assert [numbers.take(0, 5), numbers.take(1, 3), numbers.take(1, 3), numbers.take(2, 1)] == [0, 5, 5, 8]


# ------------------------------------------------------------------- bounds

def test_specs(spark):
    assert parse_spec('{"t": {"0": 5, "1": -1}}') == {("t", 0): 5, ("t", 1): -1}
    for bad in ('{"t": 5}', "[1]", '{"t": {"0": -3}}', '{"t": {"x": 1}}'):
        with pytest.raises(ValueError):
            parse_spec(bad)
    with pytest.raises(ValueError, match="earliest"):
        spec_bounds(spark, "earliest", '{"t": {"0": -2}}')


def test_bounded_replay_and_what_reaches_the_scan(spark):
    sink = new(spark, "b")
    rows = [("k", str(o), t, p, o, 0) for t in ("b", "c") for p in (0, 1) for o in range(20)]
    recs(spark, rows).write.mode("append").parquet(sink.path)
    got = lambda starting, ending="latest": sorted(
        (r.topic, r.partition, r.offset) for r in read_topic(spark, TopicSource(kind=FILES, path=sink.path, starting=starting), ending).collect())
    both = got('{"b": {"0": 5, "1": -1}}', '{"b": {"0": 8}}')
    assert both == [("b", 0, 5), ("b", 0, 6), ("b", 0, 7)]
    # a partition that a start spec alone doesn't name is read from its beginning
    assert len(got('{"b": {"0": 15, "1": -1}}')) == 5 + 40
    assert len(got("earliest", '{"b": {"0": 2, "1": 0}}')) == 2 + 40
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = read_topic(spark, TopicSource(kind=FILES, path=sink.path, starting='{"b": {"0": 5}}'), '{"b": {"0": 8}}') \
        ._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(offset,5)" in plan and "LessThan(offset,8)" in plan and "EqualTo(topic,b)" in plan


# --------------------------------------------------------------------- gaps

def test_gaps_over_batches_and_a_failing_query(spark):
    sink = new(spark, "g")
    src = TopicSource(kind=FILES, path=sink.path, starting="earliest")
    out, ckpt = scratch_path(spark, "t-gaps"), scratch_path(spark, "t-gaps-ck")
    with rocksdb_state(spark):
        for offsets in ([3, 4, 7], [9, 8, 9], [20]):
            recs(spark, [("k", "v", "g", 0, o, 0) for o in offsets] + [("k", "v", "g", None, None, 0)]).write.mode("append").parquet(sink.path)
            to_parquet(find_gaps(read_topic_stream(spark, src)), out, ckpt)
        found = sorted((r.expected, r.found, r.missing) for r in spark.read.parquet(out).collect())
        assert found == [(5, 7, 2), (10, 20, 10)]
        with pytest.raises(Exception, match="offsets 5 to 6 of g-0 are gone"):
            to_parquet(find_gaps(read_topic_stream(spark, src), fail=True), scratch_path(spark, "t-x"), scratch_path(spark, "t-y"))


# -------------------------------------------------------------- keyed state

def _state_keys(spark, ckpt):
    return {bytes(r.key.key).decode() for r in spark.read.format("statestore").option("stateVarName", "last").load(ckpt).collect()}


def test_state_holds_live_keys_only(spark):
    sink = new(spark, "state")
    src = TopicSource(kind=FILES, path=sink.path, starting="earliest")
    out, ckpt = scratch_path(spark, "t-state"), scratch_path(spark, "t-state-ck")
    with rocksdb_state(spark):
        for rows in ([("a", "1", 0), ("b", "1", 1), ("c", "1", 2), (None, "x", 3)], [("a", None, 4), ("b", "2", 5)], [("c", None, 6), ("a", "3", 7)]):
            recs(spark, [(k, v, "state", 0, o, 0) for k, v, o in rows]).write.mode("append").parquet(sink.path)
            to_parquet(latest_changes(read_topic_stream(spark, src), 0), out, ckpt)
        assert _state_keys(spark, ckpt) == {"a", "b"}
    changes = sorted((r.offset, r.key.decode(), r.value and r.value.decode()) for r in spark.read.parquet(out).collect())
    assert changes == [(0, "a", "1"), (1, "b", "1"), (2, "c", "1"), (4, "a", None), (5, "b", "2"), (6, "c", None), (7, "a", "3")]


def test_a_task_passes_on_each_keys_last_record_once(monkeypatch):
    import pyarrow as pa

    from neoflow.streaming import topic_state

    fields = pa.schema([("topic", pa.string()), ("partition", pa.int32()), ("key", pa.binary()), ("offset", pa.int64()),
                        ("value", pa.binary()), ("timestamp", pa.timestamp("us", "UTC"))])
    rows = [(t, 0, k, o, v, 0) for t, k, o, v in [
        ("x", b"a", 0, b"1"), ("x", b"b", 1, b"2"), (None, b"a", 7, b"3"), ("x", None, 9, b"4"),
        ("x", b"a", 5, b"5"), ("x", b"a", 5, b"6"), ("x", b"b", None, b"7"), ("x", b"b", 3, None),
        ("x", b"a", 4, b"8"), (None, b"a", 6, b"9"), ("x", b"c", -1, b"0")]]
    batches = [pa.RecordBatch.from_pylist([dict(zip(fields.names, r)) for r in rows[i:i + 4]], schema=fields) for i in (0, 4, 8)]
    last = lambda: sorted(((r["topic"] or "", r["key"], r["offset"], r["value"])
                           for b in topic_state._last_of_keys(iter(batches)) for r in b.to_pylist()), key=str)
    want = [("", b"a", 7, b"3"), ("x", b"a", 5, b"5"), ("x", b"b", 3, None)]
    assert last() == want
    monkeypatch.setattr(topic_state, "HELD", 1)  # nothing is held: one row a key and batch, none lost
    assert set(want) <= set(last())
    assert list(topic_state._last_of_keys(iter([]))) == [] and not sum(
        b.num_rows for b in topic_state._last_of_keys(iter([batches[0].slice(3)])))


def test_tombstone_stays_for_its_retention(spark):
    sink = new(spark, "stone")
    src = TopicSource(kind=FILES, path=sink.path, starting="earliest")

    def run(ckpt, rows, keep, want):
        """One run until the state holds the keys ``want``, at most a minute."""
        recs(spark, [(k, v, "stone", 0, o, 0) for k, v, o in rows]).write.mode("append").parquet(sink.path)
        q = latest_changes(read_topic_stream(spark, src), keep).writeStream.format("noop") \
            .option("checkpointLocation", ckpt).trigger(processingTime="1 second").start()
        try:
            for _ in range(60):
                q.awaitTermination(1)
                if os.path.isdir(f"{ckpt}/commits") and os.listdir(f"{ckpt}/commits") and _state_keys(spark, ckpt) == want:
                    return
        finally:
            q.stop()
        assert _state_keys(spark, ckpt) == want

    with rocksdb_state(spark):
        ckpt = scratch_path(spark, "t-stone")
        run(ckpt, [("a", "1", 0), ("a", None, 5)], 3_600_000, {"a"})
        run(ckpt, [("a", "late", 3), ("b", "1", 6)], 3_600_000, {"a", "b"})  # older than the tombstone: no change
        run(scratch_path(spark, "t-stone"), [("c", "1", 8)], 1, {"b", "c"})  # the timer goes off


# --------------------------------------------------------------- compaction

def test_compaction_reads_snapshot_and_tail(spark):
    sink = new(spark, "comp")
    base = scratch_path(spark, "t-comp")
    assert snapshot(spark, base) is None
    write = lambda rows: recs(spark, [(k, v, "comp", 0, o, 0) for k, v, o in rows]).write.mode("append").parquet(sink.path)
    state = lambda df: {r.key.decode(): (r.offset, r.value.decode()) for r in df.collect()}
    write([("a", "1", 0), ("b", "1", 1), ("a", "2", 2), (None, "x", 3)])
    assert state(compact(spark, stored(spark, sink), base, 4)) == {"a": (2, "2"), "b": (1, "1")}
    write([("b", None, 4), ("c", "1", 5)])
    assert state(compact(spark, stored(spark, sink), base, 4)) == {"a": (2, "2"), "c": (5, "1")}
    assert state(compact(spark, stored(spark, sink), base, 4)) == {"a": (2, "2"), "c": (5, "1")}  # nothing new
    old, tail = snapshot(spark, base), tail_by_key(stored(spark, sink), next_offsets(stored(spark, sink)))
    plan = merged(old, tail.repartition(4, "topic", "partition", "key"))._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan parquet spark_catalog"):] if "FileScan parquet spark_catalog" in plan else plan
    assert "Bucketed: true" in scan and "SelectedBucketsCount: 4 out of 4" in plan
    left = plan[:plan.index("FileScan parquet spark_catalog")]
    assert "Exchange" not in left[left.rindex("SortMergeJoin"):]  # nothing is shuffled above the snapshot's scan


# ---------------------------------------------------------------- retention

def test_retention_by_size_against_brute_force(spark):
    rows = [("k", "x" * (1 + (o * 7) % 11), "r", o % 2, o, 0) for o in range(200)]
    df = recs(spark, rows)
    for limit in (0, 1, 37, 200, 10_000):
        want = set()
        for p in (0, 1):
            later = 0
            for k, v, _, q, o, _ in reversed(rows):
                if q == p:
                    if later < limit:
                        want.add(o)
                    later += len(k) + len(v)
        assert {r.offset for r in retention_by_size(df, limit, span=16).collect()} == want
    assert retention_by_size(df, -1).count() == 200


def test_files_expire_whole(spark):
    sink = new(spark, "seg")
    for i in range(4):
        recs(spark, [("k", "0123456789", "seg", 0, 2 * i + j, 100 * i) for j in (0, 1)]).coalesce(1).write.mode("append").parquet(sink.path)
    files = segments(spark, sink.path)
    assert sorted((r.first_offset, r.last_offset, r.bytes) for r in files.collect()) == [(2 * i, 2 * i + 1, 22) for i in range(4)]
    gone = lambda **kw: sorted(r.first_offset for r in expired_segments(files, (T0 + dt.timedelta(hours=300)).isoformat(sep=" "), **kw)
                               .filter("expired").collect())
    assert gone(hours=250) == [0] and gone(hours=1000, max_bytes=44) == [0, 2] and gone(hours=250, max_bytes=45) == [0]


# ---------------------------------------------------------------- mirroring

def test_translated_positions_both_ways(spark):
    sink = new(spark, "mir")
    source = [3, 4, 5, 9, 10, 20]
    for batch, part in enumerate((source[:4], source[4:], source[4:])):
        mirror_to(spark, recs(spark, [("k", str(o), "mir", 0, o, 0) for o in part]), sink, "A", "B", batch=min(batch, 1))
    syncs = offset_syncs(spark, sink, "A")
    assert places(spark, sink) == {("A.mir", 0): list(range(6))}
    asked = [None, 0, 3, 4, 6, 8, 9, 11, 20, 21, 99]
    pos = spark.createDataFrame([("mir", 0, p) for p in asked], "topic string, partition int, position long")
    got = {r.position: r.translated for r in translate(pos, syncs).collect()}
    assert got == {p: None if p is None or p < 3 else sum(o < p for o in source) for p in asked}
    back = spark.createDataFrame([("A.mir", 0, p) for p in range(7)], "topic string, partition int, position long")
    assert {r.position: r.translated for r in translate(back, syncs, back=True).collect()} == {
        **dict(enumerate(source)), 6: 21}
    assert translate(pos, offset_syncs(spark, sink, "Z")).filter("translated is not null").count() == 0


# ---------------------------------------------------------------- envelopes

FULL = T.StructType([
    T.StructField("d", T.DateType()), T.StructField("t", T.TimestampType()), T.StructField("n", T.DecimalType(10, 3)),
    T.StructField("b", T.BinaryType()), T.StructField("l", T.ArrayType(T.DecimalType(18, 0))),
    T.StructField("m", T.MapType(T.StringType(), T.DateType())), T.StructField("s", T.StructType([T.StructField("x", T.DateType())]))])


def test_logical_types_round_trip(spark):
    rows = [(dt.date(1969, 12, 31), T0, Decimal("-1234.567"), b"\x00\xff", [Decimal(255), Decimal(-128), None], {"a": dt.date(2024, 2, 29)}, (dt.date(1, 1, 1),)),
            (None, None, None, None, None, None, None), (dt.date(2000, 1, 1), T0, Decimal("0.000"), b"", [], {}, (None,))]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", FULL)]))
    env = df.select("i", "v", describe(F.col("v"), FULL).alias("e"))
    back = env.withColumn("back", payload(F.col("e"), FULL)).collect()
    assert len(back) == len(rows) and all(r.v == r.back for r in back)
    first = json.loads(env.orderBy("i").first().e)
    assert first["payload"]["d"] == -1 and first["schema"]["fields"][0] == {
        "type": "int32", "name": "org.apache.kafka.connect.data.Date", "version": 1, "optional": True, "field": "d"}
    assert first["schema"]["fields"][2]["parameters"] == {"scale": "3"}
    with pytest.raises(TypeError):
        describe(F.lit(None), T.DecimalType(30, 2))


def test_decimal_bytes_of_any_length(spark):
    texts = {"AQ==": Decimal("0.01"), "/w==": Decimal("-0.01"), "AIA=": Decimal("1.28"), "////////////gA==": Decimal("-1.28"), "f/////////8AAAA=": None}
    df = spark.createDataFrame([(f'{{"payload":"{t}"}}', t) for t in texts], "e string, t string")
    got = {r.t: r.v for r in df.select("t", payload(F.col("e"), T.DecimalType(18, 2)).alias("v")).collect()}
    assert got == texts


def test_messages_decoded_by_their_schemas(spark):
    a = spark.range(3).select(describe(F.struct(F.col("id").alias("n")), T.StructType([T.StructField("n", T.LongType(), False)])).alias("value"))
    b = spark.range(2).select(describe(F.lit("x"), T.StringType()).alias("value"))
    c = spark.createDataFrame([('{"payload":1}',), ("junk",), (None,)], "value string")
    msgs = a.unionByName(b).unionByName(c)
    got = {t.simpleString(): sorted(str(r.payload) for r in d.collect()) for t, d in decode_described(msgs)}
    assert got == {"struct<n:bigint>": [f"Row(n={i})" for i in range(3)], "string": ["x", "x"]}
    assert undescribed(msgs).count() == 3
    with pytest.raises(ValueError, match="more than 1"):
        message_schemas(msgs, most=1)


# ------------------------------------------------------------ growing files

def test_lines_appended_to_a_read_file_arrive_once(spark, tmp_path):
    folder, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    os.makedirs(folder)

    def grow(name, text):
        with open(os.path.join(folder, name), "a", encoding="utf-8") as f:
            f.write(text)
        to_parquet(read_growing_lines(spark, folder), out, ckpt)
        return sorted(r.value for r in spark.read.parquet(out).collect())

    assert grow("a.log", "one\ntwo\npar") == ["one", "two"]
    assert grow("b.log", "über\r\n") == ["one", "two", "über"]
    assert grow("a.log", "t\nthree\n") == ["one", "part", "three", "two", "über"]
    with open(os.path.join(folder, "a.log"), "w", encoding="utf-8") as f:
        f.write("one\n")
    with pytest.raises(Exception, match="shorter"):
        to_parquet(read_growing_lines(spark, folder), out, ckpt)


def test_parts_own_the_lines_that_begin_in_them(tmp_path):
    path = str(tmp_path / "x")
    text = "".join(f"{i:0{i % 9}d}\n" for i in range(400)) + "open"
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    stop = last_line_end(path, 0)
    assert stop == len(text) - 4 and last_line_end(path, stop) == stop
    for size in (1, 7, 64, 10_000):
        got = [v for at in range(0, stop, size) for b in lines_of(Part(path, at, min(at + size, stop), stop)) for v in b.column(2).to_pylist()]
        assert got == text[:-5].split("\n")


def test_positions_take_the_last_run_before_them(spark):
    """Many runs in several ranges and partitions, positions between, before and after them, nulls: by brute force. No
    run is joined with positions by a range condition."""
    rows = [("s", "A.s", p, 7 * i + (p or 0), 3 * i, 3) for p in (0, 1, None) for i in range(40)] + [("s", "A.s", 5, 4, 0, 1)]
    runs = spark.createDataFrame(rows, "topic string, target_topic string, partition int, source_first long, target_first long, n long")
    asked = [("s", p, q) for p in (0, 1, None, 2, 5) for q in range(0, 300, 3)] * 2 + [("s", 0, None), ("t", 0, 9)]
    pos = spark.createDataFrame(asked, "topic string, partition int, position long")

    def expected(t, p, q):
        first = [r for r in rows if r[0] == t and r[2] == p and q is not None and r[3] <= q]
        return max(((r[3], r[4] + min(q - r[3], r[5])) for r in first), default=(None, None))[1]

    found = translate(pos.repartition(5), runs.repartition(3))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(str((*a, expected(*a))) for a in asked)
    assert " <= " not in found._jdf.queryExecution().optimizedPlan().toString()
