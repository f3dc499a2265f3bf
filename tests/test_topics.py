"""Record-table jobs, Kafka option maps, credentials, session helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from neoflow.operators.topics import (connect_schema, envelope_decode, envelope_encode,
                                      latest_per_key, lines_to_records, mirror, offset_ranges,
                                      records_to_lines, retention)
from neoflow.schemas import RECORD_SCHEMA
from neoflow.session import shared_dir
from neoflow.sinks.topic import TopicSink, kafka_sink_options
from neoflow.sources.credentials import s3a_conf, to_s3a
from neoflow.sources.topic import TopicSource, kafka_batch_options, kafka_stream_options

T0 = dt.datetime(2024, 1, 10)


def recs(spark, rows):
    full = [(k.encode() if k else None, v.encode() if v is not None else None, t, p, o,
             T0 + dt.timedelta(hours=h), 0) for k, v, t, p, o, h in rows]
    return spark.createDataFrame(full, RECORD_SCHEMA)


def test_latest_per_key_with_tombstones(spark):
    df = recs(spark, [("a", "1", "t", 0, 0, 0), ("a", "2", "t", 0, 5, 1), ("b", "x", "t", 0, 1, 0),
                      ("b", None, "t", 0, 7, 2), (None, "nokey", "t", 0, 8, 3), ("a", "9", "t", 1, 0, 0)])
    out = {(r.partition, r.key.decode()): (r.offset, r.value.decode())
           for r in latest_per_key(df).collect()}
    assert out == {(0, "a"): (5, "2"), (1, "a"): (0, "9")}


def test_offset_ranges_with_gaps(spark):
    df = recs(spark, [("a", "1", "t", 0, 3, 0), ("a", "1", "t", 0, 10, 0), ("a", "1", "u", 2, 0, 0)])
    got = {(r.topic, r.partition): (r.first_offset, r.last_offset, r.next_offset, r.n_records)
           for r in offset_ranges(df).collect()}
    assert got == {("t", 0): (3, 10, 11, 2), ("u", 2): (0, 0, 1, 1)}


def test_retention_asof(spark):
    df = recs(spark, [("a", "old", "t", 0, 0, 0), ("a", "new", "t", 0, 1, 200)])
    assert [r.value.decode() for r in retention(df, 168).collect()] == ["new"]
    asof = (T0 + dt.timedelta(hours=100)).isoformat(sep=" ")
    assert retention(df, 168, asof).count() == 2


def test_mirror_cycle_and_pattern(spark):
    df = recs(spark, [("k", "1", "orders", 0, 0, 0), ("k", "2", "B.orders", 0, 0, 0),
                      ("k", "3", "logs", 0, 0, 0)])
    out = sorted(r.topic for r in mirror(df, "A", "B", "orders|B\\..*").collect())
    assert out == ["A.orders"]


def test_lines_records_round_trip(spark):
    lines = spark.createDataFrame([("l1",), ("l2",)], "value string")
    r = lines_to_records(lines, "t")
    assert r.filter(F.col("key").isNotNull()).count() == 0
    back = records_to_lines(r, ["t"]).collect()
    assert sorted(x.value for x in back) == ["l1", "l2"]
    assert records_to_lines(r, ["other"]).count() == 0


def test_envelope_schema_types():
    st = T.StructType([T.StructField("k", T.LongType(), False),
                       T.StructField("tags", T.ArrayType(T.StringType()), True)])
    assert connect_schema(st) == {
        "type": "struct", "optional": True,
        "fields": [{"type": "int64", "optional": False, "field": "k"},
                   {"type": "array", "items": {"type": "string", "optional": True},
                    "optional": True, "field": "tags"}]}
    with pytest.raises(TypeError):
        connect_schema(T.TimestampType())


def test_envelope_round_trip_string_and_struct(spark):
    df = spark.createDataFrame([("a\"b", 1), (None, 2)], "s string, n long")
    out = df.select(envelope_encode(F.col("s"), T.StringType()).alias("e"),
                    envelope_encode(F.col("s"), T.StringType(), False).alias("b"))
    rows = out.select(envelope_decode(F.col("e"), T.StringType()).alias("d"),
                      envelope_decode(F.col("b"), T.StringType(), False).alias("db"), "e").collect()
    assert [r.d for r in rows] == ["a\"b", None] and [r.db for r in rows] == ["a\"b", None]
    assert rows[0].e.startswith('{"schema":{"type":"string","optional":true},"payload":')


def test_kafka_option_maps():
    src = TopicSource(kind="kafka", bootstrap="localhost:9092", topic="objects")
    assert kafka_stream_options(src) == {"kafka.bootstrap.servers": "localhost:9092",
                                         "subscribe": "objects", "failOnDataLoss": "false",
                                         "startingOffsets": "latest"}
    b = kafka_batch_options(src)
    assert b["startingOffsets"] == "earliest" and b["endingOffsets"] == "latest"
    p = TopicSource(kind="kafka", bootstrap="h:1", pattern="a.*", max_per_trigger=10,
                    min_partitions=64, starting_timestamp=1700000000000)
    o = kafka_stream_options(p)
    assert o["subscribePattern"] == "a.*" and o["maxOffsetsPerTrigger"] == "10"
    assert o["minPartitions"] == "64" and o["startingTimestamp"] == "1700000000000"
    assert "startingOffsets" not in o
    with pytest.raises(ValueError):
        kafka_stream_options(TopicSource(kind="kafka", topic="x"))
    s = kafka_sink_options(TopicSink(kind="kafka", bootstrap="h:1", topic="t", compression="zstd"))
    assert s == {"kafka.bootstrap.servers": "h:1", "topic": "t", "kafka.compression.type": "zstd"}


def test_kafka_source_not_on_classpath(spark):
    # No connector jar here: the adapter is option building only.
    from neoflow.sources.topic import read_topic_stream
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic_stream(spark, TopicSource(kind="kafka", bootstrap="h:1", topic="t"))


def test_s3a_conf():
    env = {"AWS_ACCESS_KEY": "AK", "AWS_SECRET_ACCESS_KEY": "SK"}
    assert s3a_conf(environ=env) == {"spark.hadoop.fs.s3a.access.key": "AK",
                                     "spark.hadoop.fs.s3a.secret.key": "SK",
                                     "spark.hadoop.fs.s3a.endpoint": "s3.amazonaws.com"}
    with pytest.raises(KeyError, match="AWS_SECRET_ACCESS_KEY"):
        s3a_conf(environ={"AWS_ACCESS_KEY": "AK"})
    assert to_s3a("s3://b/k") == "s3a://b/k" and to_s3a("/x") == "/x"


def test_shared_dir_comes_from_session(spark):
    d = shared_dir(spark)
    assert d and d.rstrip("/").split("/")[-1]


def test_lines_to_topic_and_back_streaming(spark):
    import os
    from neoflow.operators.topics import lines_to_topic_stream, topic_to_lines_stream
    from neoflow.session import scratch_path
    from neoflow.sinks.topic import FILES, create_topic
    from neoflow.sources.topic import read_topic_stream
    lines_dir = scratch_path(spark, "t-lines").replace("file:", "")
    os.makedirs(lines_dir)
    with open(os.path.join(lines_dir, "a.txt"), "w") as fh:
        fh.write("one\ntwo\nthree\n")
    sink = TopicSink(kind=FILES, path=scratch_path(spark, "t-lines-topic"), topic="lines")
    create_topic(spark, sink)
    q = lines_to_topic_stream(spark, lines_dir, "lines", sink, scratch_path(spark, "t-ck1"),
                              {"availableNow": True})
    q.awaitTermination()
    out = scratch_path(spark, "t-lines-out")
    src = TopicSource(kind=FILES, path=sink.path, starting="earliest")
    q2 = topic_to_lines_stream(read_topic_stream(spark, src), ["lines"], out,
                               scratch_path(spark, "t-ck2"), {"availableNow": True})
    q2.awaitTermination()
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["one", "three", "two"]


def test_record_aggregates_on_a_stream(spark):
    """offset_ranges / latest_per_key run unchanged as streaming aggregations."""
    from neoflow.session import scratch_path
    from neoflow.sinks.topic import FILES, TopicSink, create_topic
    from neoflow.sources.topic import read_topic_stream
    sink = TopicSink(kind=FILES, path=scratch_path(spark, "t-agg-topic"), topic="t")
    create_topic(spark, sink)
    recs(spark, [("a", "1", "t", 0, 0, 0), ("a", "2", "t", 0, 5, 1), ("b", "x", "t", 0, 1, 0),
                 ("b", None, "t", 0, 7, 2)]).write.mode("append").parquet(sink.path)
    stream = read_topic_stream(spark, TopicSource(kind=FILES, path=sink.path, starting="earliest"))
    q1 = offset_ranges(stream).writeStream.format("memory").queryName("t_ranges") \
        .outputMode("complete").trigger(availableNow=True).start()
    q2 = latest_per_key(stream).writeStream.format("memory").queryName("t_latest") \
        .outputMode("complete").trigger(availableNow=True).start()
    q1.awaitTermination()
    q2.awaitTermination()
    [r] = spark.table("t_ranges").collect()
    assert (r.first_offset, r.last_offset, r.n_records) == (0, 7, 4)
    assert [(x.key.decode(), x.value.decode()) for x in spark.table("t_latest").collect()] == [("a", "2")]


def test_offsets_for_timestamp(spark):
    from neoflow.operators.offsets import from_offsets, offsets_for_timestamp
    df = recs(spark, [("a", "old", "t", 0, 0, 0), ("a", "new", "t", 0, 1, 10), ("a", "late", "t", 0, 2, 5),
                      ("a", "p1", "t", 1, 0, 1)])
    ts = (T0 + dt.timedelta(hours=8)).isoformat(sep=" ")
    starts = {(r.topic, r.partition): r.start_offset for r in offsets_for_timestamp(df, ts).collect()}
    assert starts == {("t", 0): 1, ("t", 1): 1}
    # from the start offset on, later offsets are read even with older timestamps
    assert sorted(r.value.decode() for r in from_offsets(df, offsets_for_timestamp(df, ts)).collect()) == \
        ["late", "new"]


def test_mirror_both_directions_no_loop(spark):
    from neoflow.operators.topics import mirror_both
    a = recs(spark, [("k", "1", "orders", 0, 0, 0)])
    b = recs(spark, [("k", "2", "orders", 0, 0, 0)])
    to_b, to_a = mirror_both(a, b, "A", "B")
    b2, a2 = b.unionByName(to_b), a.unionByName(to_a)
    assert sorted(r.topic for r in b2.collect()) == ["A.orders", "orders"]
    assert sorted(r.topic for r in a2.collect()) == ["B.orders", "orders"]
    # a second round sends nothing new back: copies never return home
    again_b, again_a = mirror_both(a2, b2, "A", "B")
    assert sorted(r.topic for r in again_b.collect()) == ["A.orders"]
    assert sorted(r.topic for r in again_a.collect()) == ["B.orders"]
