"""Streaming: stream/batch equality, restart without duplicates, rate limit,
two queries on one plan, start at latest, partition routing."""

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from neoflow.operators.parse import parse_and_flatten
from neoflow.plans import fixtures as fx
from neoflow.plans.topics_fixture import new_topic, payload_slices, payload_topic
from neoflow.session import scratch_path
from neoflow.sinks.commits import CommitLog
from neoflow.sinks.parquet import landed_table
from neoflow.sinks.topic import append_records
from neoflow.sinks.view import live_view, memory_view_for_tests
from neoflow.sources.topic import (FILES, TopicSource, kafka_stream_options, read_topic,
                                   read_topic_stream)
from neoflow.streaming.jobs import (AVAILABLE_NOW, landing_stream, run_available_now,
                                    run_until_caught_up, topic_to_parquet)


def _multiset(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_stream_equals_batch(spark):
    topic = payload_topic(spark, SF001)
    src = TopicSource(kind=FILES, path=topic, starting="earliest")
    out = scratch_path(spark, "t-landed")
    run_available_now(topic_to_parquet(spark, src, out, trigger=AVAILABLE_NOW))
    batch = parse_and_flatten(read_topic(spark, src))
    assert _multiset(landed_table(spark, out)) == _multiset(batch)
    # partition folders by date, checkpoint inside the output folder
    local = out.replace("file:", "")
    assert any(d.startswith("date=") for d in os.listdir(local))
    assert os.path.isdir(os.path.join(local, "_checkpoints"))


def test_restart_no_loss_no_duplicates(spark):
    sink = new_topic(spark, "t-restart", "objects")
    src = TopicSource(kind=FILES, path=sink.path, starting="earliest")
    out = scratch_path(spark, "t-landed-restart")
    slices = payload_slices(spark, SF001)
    counts = []
    for part in slices[:2], slices[2:], []:
        for p in part:
            append_records(spark, p, sink)
        run_available_now(topic_to_parquet(spark, src, out, trigger=AVAILABLE_NOW))
        counts.append(landed_table(spark, out).count())
    total = fx.payload_messages(spark, SF001).count()
    assert counts[-1] == total and counts[1] == total  # third start adds nothing
    assert counts[0] < total
    # offsets continue across appends: positions are unique
    recs = read_topic(spark, src)
    assert recs.select("partition", "offset").distinct().count() == recs.count()


def test_rate_limit_one_file_per_batch(spark):
    topic = payload_topic(spark, SF001)
    n_files = sum(1 for f in os.listdir(topic.replace("file:", "")) if f.endswith(".parquet"))
    src = TopicSource(kind=FILES, path=topic, starting="earliest", max_per_trigger=1)
    out = scratch_path(spark, "t-landed-rate")
    [q] = topic_to_parquet(spark, src, out, trigger=AVAILABLE_NOW)
    run_available_now([q])
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == n_files


def test_live_view_and_sink_two_queries(spark):
    topic = payload_topic(spark, SF001)
    src = TopicSource(kind=FILES, path=topic, starting="earliest")
    out = scratch_path(spark, "t-landed-view")
    trigger = {"processingTime": "1 second"}
    qs = topic_to_parquet(spark, src, out, trigger=trigger)
    qs.append(memory_view_for_tests(landing_stream(spark, src), "t_view", trigger))
    assert len(qs) == 2 and qs[0].id != qs[1].id
    run_until_caught_up(qs)
    view = spark.table("t_view")
    assert _multiset(view) == _multiset(landed_table(spark, out))


def test_live_view_brings_few_rows_to_the_driver(spark):
    """A view of 60,257 messages hands over five, and prints two."""
    src = TopicSource(kind=FILES, path=payload_topic(spark, SF01), starting="earliest")
    shown = []
    q = live_view(landing_stream(spark, src), "t_bounded", num_rows=5, trigger=AVAILABLE_NOW,
                  on_preview=lambda batch, rows: shown.append((batch, rows)))
    run_available_now([q])
    assert [len(rows) for _, rows in shown] == [5]
    printed = live_view(landing_stream(spark, src), "t_printed", num_rows=2, trigger=AVAILABLE_NOW)
    run_available_now([printed])


def test_landing_reads_each_message_once_and_splits_a_hot_date(spark):
    """A third of the rows on one date: read once, the date over several files, the others one each."""
    path, out = scratch_path(spark, "t-hot-topic"), scratch_path(spark, "t-hot-landed")
    day = F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(
        F.concat(F.lit("2024-02-1"), (F.col("id") % 7).cast("string")))
    value = F.to_json(F.struct(day.alias("current_date"), F.col("id").cast("string").alias("id"),
                               F.sha2(F.col("id").cast("string"), 256).alias("name")))
    spark.range(30_000).select(value.alias("value")).select(
        F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType")).write.parquet(path)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "256k")
    try:
        [q] = topic_to_parquet(spark, TopicSource(kind=FILES, path=path, starting="earliest"), out, trigger=AVAILABLE_NOW)
        run_available_now([q])
    finally:
        spark.conf.unset(size)
    assert sum(p["numInputRows"] for p in q.recentProgress) == 30_000
    table = landed_table(spark, out)
    files = _files_by_date(out)
    assert table.count() == 30_000
    assert files["2024-01-01"] > 1 and sum(files.values()) <= 4 * len(files)


def _files_by_date(out):
    local = out.replace("file:", "")
    return {d.removeprefix("date="): sum(f.endswith(".parquet") for f in os.listdir(os.path.join(local, d)))
            for d in os.listdir(local) if d.startswith("date=")}


def test_a_run_cut_off_by_its_time_limit_fails(spark):
    src = TopicSource(kind=FILES, path=payload_topic(spark, SF001), starting="earliest")
    q = topic_to_parquet(spark, src, scratch_path(spark, "t-cut"), trigger={"processingTime": "1 second"})
    with pytest.raises(TimeoutError):
        run_available_now(q, timeout_s=1)
    assert not q[0].isActive


def test_file_topics_honour_or_refuse_source_settings(spark):
    recs = fx.event_records(spark, SF001)
    path = scratch_path(spark, "t-settings")
    recs.write.parquet(path)
    source = lambda **more: TopicSource(kind=FILES, path=path, **{"starting": "earliest", **more})
    topics = lambda **more: {r[0] for r in read_topic(spark, source(**more)).select("topic").distinct().collect()}
    assert topics(topic="click") == {"click"}
    assert topics(topic="click, view") == {"click", "view"}
    assert topics(pattern="cl.*") == {"click"} and topics(pattern="cl") == set()
    assert len(topics()) > 2
    assert read_topic(spark, source(starting_timestamp=4_102_444_800_000)).count() == 0
    assert read_topic(spark, source(starting_timestamp=0)).count() == recs.count()
    # offset specs are honoured (tests/test_offsets.py); anything else is refused
    assert 0 < read_topic(spark, source(topic="click", starting='{"click":{"0":500}}')).count() < recs.filter("topic = 'click'").count()
    with pytest.raises(ValueError):
        read_topic(spark, source(starting="5"))
    with pytest.raises(ValueError):
        read_topic_stream(spark, source(starting='{"click":5'))
    with pytest.raises(ValueError):
        read_topic(spark, source(), ending="earliest")
    stream = read_topic_stream(spark, source(topic="view"))
    run_until_caught_up([memory_view_for_tests(stream.select("topic"), "t_subscribed")])
    assert {r[0] for r in spark.table("t_subscribed").distinct().collect()} == {"view"}
    assert kafka_stream_options(TopicSource(kind="kafka", bootstrap="b", topic="t", starting_timestamp=5))[
        "startingOffsetsByTimestampStrategy"] == "latest"


def test_start_table_survives_a_crash_in_its_first_write(spark):
    from neoflow.operators.offsets import START_OFFSETS_SUBDIR, start_at_latest
    ckpt = scratch_path(spark, "t-crash")
    os.makedirs(os.path.join(ckpt.replace("file:", ""), START_OFFSETS_SUBDIR, "_temporary"))
    existing = fx.event_records(spark, SF001)
    n = existing.select("topic", "partition").distinct().count()
    assert start_at_latest(spark, existing, ckpt).count() == n
    assert start_at_latest(spark, existing.limit(0), ckpt).count() == n  # read back, not written again


def test_start_at_latest_skips_existing_and_survives_restart(spark):
    sink = new_topic(spark, "t-latest", "objects")
    slices = payload_slices(spark, SF001)
    append_records(spark, slices[0], sink)
    src = TopicSource(kind=FILES, path=sink.path, starting="latest")
    out = scratch_path(spark, "t-landed-latest")
    run_available_now(topic_to_parquet(spark, src, out, trigger=AVAILABLE_NOW))
    assert landed_table(spark, out).count() == 0
    append_records(spark, slices[1], sink)
    run_available_now(topic_to_parquet(spark, src, out, trigger=AVAILABLE_NOW))
    assert landed_table(spark, out).count() == slices[1].count()


def test_processing_time_landing_stream_is_streaming(spark):
    src = TopicSource(kind=FILES, path=payload_topic(spark, SF001), starting="earliest")
    s = landing_stream(spark, src)
    assert s.isStreaming and s.columns[0] == "date"


def test_null_dates_route_to_default_partition(spark):
    sink = new_topic(spark, "t-route", "objects")
    bad = spark.createDataFrame([("not json",), ("{}",)], "value string")
    append_records(spark, bad, sink)
    out = scratch_path(spark, "t-landed-route")
    run_available_now(topic_to_parquet(spark, TopicSource(kind=FILES, path=sink.path, starting="earliest"),
                                       out, trigger=AVAILABLE_NOW))
    local = out.replace("file:", "")
    assert "date=__HIVE_DEFAULT_PARTITION__" in os.listdir(local)
    rows = landed_table(spark, out).collect()
    assert len(rows) == 2 and all(v is None for r in rows for v in r)
    typed = landed_table(spark, out, typed_date=True)
    assert dict(typed.dtypes)["date"] == "date"
    assert typed.filter(F.col("date").isNull()).count() == 2


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns[:2] == ["date", "object_id"] and len(df.columns) == 15
    assert df.count() > 0
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)


def test_slices_share_one_join_and_messages_are_not_shuffled(spark, tmp_path, monkeypatch):
    from neoflow.plans import topics_fixture
    for part in payload_slices(spark, SF001):
        assert "Join" not in part._jdf.queryExecution().optimizedPlan().toString()
    plans = []
    append = topics_fixture.append_records
    monkeypatch.setattr(topics_fixture, "_CACHE", {})
    monkeypatch.setattr(topics_fixture, "append_records", lambda spark, msgs, sink, *a, **k: (
        plans.append((msgs._jdf.queryExecution().optimizedPlan().toString(), a, k)), append(spark, msgs, sink, *a, **k)))
    path = topics_fixture.payload_topic(spark, SF001)
    (plan, more, named), = plans
    assert not re.search(r"Repartition \d+, true", plan)  # coalesced at most
    assert not more and not named.get("num_partitions")
    commit = CommitLog(spark, f"{path}/_commits").last()
    assert "moved" in commit.payload and commit.done  # written once, not staged and written again
