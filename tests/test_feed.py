"""Feed fan-out: documents -> messages."""

import json
import os

import pytest
from pyspark.sql import functions as F

from neoflow.operators.feed import (calendar, fan_out, first_numbers, missing_days, number_messages,
                                    object_counts, parse_feed, require_all_days)
from neoflow.operators.parse import parse_and_flatten
from neoflow.session import scratch_path
from neoflow.sinks.topic import FILES, TopicSink, create_topic
from neoflow.sources.feed import read_feed_documents
from neoflow.sources.topic import TopicSource, read_topic
from neoflow.streaming.feed_job import feed_to_topic

DOC = {
    "links": {"next": "x"},
    "element_count": 4,
    "near_earth_objects": {
        "2022-11-19": [{"id": "3", "name": "c\u00e9", "extra": {"deep": [1, None]}},
                       {"id": "4", "name": None}],
        "2022-11-18": [{"id": "1", "name": "a", "current_date": "old"}, {}],
        "2022-11-20": [],
        "2022-11-25": [{"id": "99"}],
    },
}


def _land(spark, docs):
    path = scratch_path(spark, "t-feed")
    local = path.replace("file:", "")
    os.makedirs(local)
    for i, d in enumerate(docs):
        with open(os.path.join(local, f"doc{i:03d}.json"), "w") as fh:
            fh.write(d if isinstance(d, str) else json.dumps(d, indent=2, ensure_ascii=False))
    return read_feed_documents(spark, path)


def test_calendar_inclusive_and_empty(spark):
    assert [r.day_str for r in calendar(spark, "2022-11-18", "2022-11-20").collect()] == \
        ["2022-11-18", "2022-11-19", "2022-11-20"]
    assert calendar(spark, "2022-11-20", "2022-11-18").count() == 0


def test_fan_out_pretty_printed_days_out_of_order(spark):
    docs = _land(spark, [DOC])
    days = parse_feed(docs, key_cols=["doc_path"])
    msgs = number_messages(fan_out(days, "2022-11-18", "2022-11-20", ["doc_path"]),
                           object_counts(days, "2022-11-18", "2022-11-20", "doc_path"), "doc_path")
    rows = sorted(msgs.select("number", "value").collect())
    assert [r.number for r in rows] == [1, 2, 3, 4]
    objs = [json.loads(r.value) for r in rows]
    assert [o.get("id") for o in objs] == ["1", None, "3", "4"]
    assert [o["current_date"] for o in objs] == ["2022-11-18", "2022-11-18", "2022-11-19", "2022-11-19"]
    assert objs[1] == {"current_date": "2022-11-18"}            # empty object
    assert objs[2]["name"] == "c\u00e9" and objs[2]["extra"] == {"deep": [1, None]}
    assert "name" in objs[3] and objs[3]["name"] is None        # explicit null kept


def test_day_outside_range_ignored_and_start_after_end(spark):
    days = parse_feed(_land(spark, [DOC]), key_cols=["doc_path"])
    assert fan_out(days, "2022-11-25", "2022-11-25", ["doc_path"]).count() == 1
    assert fan_out(days, "2022-11-20", "2022-11-18", ["doc_path"]).count() == 0


def test_missing_day_strict_and_lenient(spark):
    days = parse_feed(_land(spark, [DOC]), key_cols=["doc_path"])
    miss = missing_days(spark, days, "2022-11-18", "2022-11-22")
    assert sorted(r.day_str for r in miss.collect()) == ["2022-11-21", "2022-11-22"]
    msgs = fan_out(days, "2022-11-18", "2022-11-22", ["doc_path"])
    with pytest.raises(Exception, match="2022-11-2[12]"):
        require_all_days(spark, msgs, days, "2022-11-18", "2022-11-22").collect()
    ok = require_all_days(spark, fan_out(days, "2022-11-18", "2022-11-20", ["doc_path"]),
                          days, "2022-11-18", "2022-11-20")
    assert ok.count() == 4


def test_body_without_member_gives_no_messages(spark):
    days = parse_feed(_land(spark, [{"error": "rate limited"}, "not json"]), key_cols=["doc_path"])
    assert days.count() == 0


def test_feed_to_topic_strict_sends_nothing(spark):
    docs = _land(spark, [DOC])
    sink = TopicSink(kind=FILES, path=scratch_path(spark, "t-feed-strict"), topic="neo")
    create_topic(spark, sink)
    with pytest.raises(KeyError, match="2022-11-21"):
        feed_to_topic(spark, docs, "2022-11-18", "2022-11-22", sink)
    assert read_topic(spark, TopicSource(kind=FILES, path=sink.path)).count() == 0


def test_feed_to_topic_round_trip(spark):
    docs = _land(spark, [DOC])
    sink = TopicSink(kind=FILES, path=scratch_path(spark, "t-feed-topic"), topic="neo")
    create_topic(spark, sink)
    feed_to_topic(spark, docs, "2022-11-18", "2022-11-20", sink)
    recs = read_topic(spark, TopicSource(kind=FILES, path=sink.path))
    assert recs.filter(F.col("key").isNotNull()).count() == 0
    out = parse_and_flatten(recs)
    per_day = {r["date"]: r["count"] for r in out.groupBy("date").count().collect()}
    assert per_day == {"2022-11-18": 2, "2022-11-19": 2}
    assert sorted(r.object_id for r in out.collect() if r.object_id) == [1, 3, 4]


def test_feed_to_topic_stream(spark):
    from neoflow.streaming.feed_job import feed_to_topic_stream
    docs = _land(spark, [DOC, {"near_earth_objects": {"2022-11-20": [{"id": "7"}]}}])
    path = docs.select("doc_path").first().doc_path.rsplit("/", 1)[0]
    sink = TopicSink(kind=FILES, path=scratch_path(spark, "t-feed-stream"), topic="neo")
    create_topic(spark, sink)
    q = feed_to_topic_stream(spark, path, "2022-11-18", "2022-11-20", sink,
                             checkpoint=scratch_path(spark, "t-feed-stream-ckpt"),
                             trigger={"availableNow": True}, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    recs = read_topic(spark, TopicSource(kind=FILES, path=sink.path))
    ids = sorted(r.object_id for r in parse_and_flatten(recs).collect() if r.object_id)
    assert ids == [1, 3, 4, 7]
    # offsets continue across micro-batches
    assert recs.select("partition", "offset").distinct().count() == recs.count() == 5


def test_stamp_field_raw_cases(spark):
    from neoflow.functions.json import stamp_field_raw
    rows = [('{"a":1}',), ("{}",), ("{ }",), ("[1]",), ('{"current_date":"old","b":"x\\"y"}',), (None,)]
    df = spark.createDataFrame(rows, "o string")
    out = [r[0] for r in df.select(stamp_field_raw("o", "current_date", F.lit("2022-11-18"))).collect()]
    assert out[0] == '{"a":1,"current_date":"2022-11-18"}'
    assert out[1] == out[2] == '{"current_date":"2022-11-18"}'
    assert out[3] == "[1]" and out[5] is None
    parsed = spark.createDataFrame([(out[4],)], "v string") \
        .select(F.from_json("v", "current_date string, b string").alias("j")).first().j
    assert parsed.current_date == "2022-11-18" and parsed.b == 'x"y'


def test_cli_feed_then_land(spark):
    from neoflow.cli import main
    from neoflow.sinks.parquet import landed_table
    docs = _land(spark, [DOC])
    folder = docs.select("doc_path").first().doc_path.rsplit("/", 1)[0]
    topic = scratch_path(spark, "t-cli-topic")
    out = scratch_path(spark, "t-cli-out")
    assert main(["feed", "--docs", folder, "--start", "2022-11-18", "--end", "2022-11-20",
                 "--topic-path", topic], spark=spark) == 0
    assert main(["land", "--topic-path", topic, "--out", out, "--starting", "earliest",
                 "--available-now"], spark=spark) == 0
    got = sorted(((r.date, r.object_id) for r in landed_table(spark, out).collect()),
                 key=lambda t: (t[0], -1 if t[1] is None else t[1]))
    assert got == [("2022-11-18", None), ("2022-11-18", 1), ("2022-11-19", 3), ("2022-11-19", 4)]


def _days(spark, texts):
    docs = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "doc string, value string")
    return parse_feed(docs, key_cols=["doc"])


def _values(days, start, end):
    return [json.loads(r.value) for r in fan_out(days, start, end, ["doc"]).orderBy("doc", "day_str", "pos").collect()]


def test_only_exact_day_keys_are_looked_up(spark):
    days = _days(spark, [json.dumps({"near_earth_objects": {
        "2022-11-18T00": [{"id": "no"}], "2022-11-8": [{"id": "no"}], " 2022-11-18": [{"id": "no"}],
        "2022-11-31": [{"id": "no"}], "2022-11-18": [{"id": "yes"}]}})])
    assert [v["id"] for v in _values(days, "2022-11-01", "2022-11-30")] == ["yes"]


def test_the_last_of_repeated_day_keys_counts(spark):
    text = '{"near_earth_objects":{"2022-11-18":[{"id":"1"},{"id":"2"}],"2022-11-19":[{"id":"4"}],"2022-11-18":[{"id":"3"}]}}'
    days = _days(spark, [text])
    starts = first_numbers(days, "2022-11-18", "2022-11-19", "doc")
    rows = fan_out(days, "2022-11-18", "2022-11-19", ["doc"], starts).orderBy("number").collect()
    assert [(r.number, json.loads(r.value)["id"]) for r in rows] == [(1, "3"), (2, "4")]


def test_the_stamp_replaces_an_old_one(spark):
    obj = '{"current_date":"old","n":1.50,"deep":{"current_date":"stays","x":[1,null]},"s":"\\"current_date\\"","none":null}'
    [value] = _values(_days(spark, ['{"near_earth_objects":{"2022-11-18":[' + obj + ']}}']), "2022-11-18", "2022-11-18")
    assert value == {"n": 1.5, "deep": {"current_date": "stays", "x": [1, None]}, "s": '"current_date"', "none": None,
                     "current_date": "2022-11-18"}
    raw = fan_out(_days(spark, ['{"near_earth_objects":{"2022-11-18":[{"current_date":"old"}]}}']),
                  "2022-11-18", "2022-11-18", ["doc"]).first().value
    assert raw == '{"current_date":"2022-11-18"}'


def test_one_digit_dates(spark):
    assert [r.day_str for r in calendar(spark, "2022-1-8", "2022-01-09").collect()] == ["2022-01-08", "2022-01-09"]
    days = _days(spark, ['{"near_earth_objects":{"2022-01-08":[{"id":"1"}]}}'])
    assert len(_values(days, "2022-1-8", "2022-1-8")) == 1


@pytest.mark.parametrize("element", ["null", "3", '"text"', "[1]"])
def test_elements_that_are_not_objects_are_refused(spark, element):
    days = _days(spark, ['{"near_earth_objects":{"2022-11-18":[{"id":"1"},' + element + ']}}'])
    with pytest.raises(Exception, match="not a JSON object"):
        _values(days, "2022-11-18", "2022-11-18")


def test_numbers_follow_day_document_and_position(spark):
    texts = [json.dumps({"near_earth_objects": {f"2022-11-{18 + (i + k) % 3}": [{"id": f"{i}.{k}.{j}"} for j in range((i * k) % 4)]
                                                for k in range(3)}}) for i in range(40)]
    days = _days(spark, texts)
    starts = first_numbers(days, "2022-11-18", "2022-11-20", "doc")
    rows = fan_out(days, "2022-11-18", "2022-11-20", ["doc"], starts).collect()
    ordered = sorted(rows, key=lambda r: (r.day_str, r.doc, r.pos))
    assert [r.number for r in ordered] == list(range(1, len(rows) + 1)) and len(rows) > 40


def test_no_exchange_above_the_explode(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        days = _days(spark, ['{"near_earth_objects":{"2022-11-18":[{"id":"1"}]}}'])
        numbered = fan_out(days, "2022-11-18", "2022-11-18", ["doc"], first_numbers(days, "2022-11-18", "2022-11-18", "doc"))
        plan = numbered._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above = plan[:plan.index("Generate posexplode")]
    assert "Exchange" not in above and "Exchange" in plan


def test_a_topic_partition_is_a_run_of_numbers(spark):
    docs = _land(spark, [{"near_earth_objects": {"2022-11-18": [{"id": str(100 * i + k)} for k in range(9)]}} for i in range(6)])
    sink = TopicSink(kind=FILES, path=scratch_path(spark, "t-runs"), topic="neo")
    feed_to_topic(spark, docs, "2022-11-18", "2022-11-18", sink, num_partitions=4)
    recs = read_topic(spark, TopicSource(kind=FILES, path=sink.path)).orderBy("partition", "offset").collect()
    assert [json.loads(r.value)["id"] for r in recs] == [str(100 * i + k) for i in range(6) for k in range(9)]
    assert sorted({r.partition for r in recs}) == [0, 1, 2, 3]


def test_cli_takes_keys_for_object_stores_only(monkeypatch):
    from neoflow import cli
    parse = lambda *a: cli._parser().parse_args(["land", *a])
    env = {"AWS_ACCESS_KEY": "k", "AWS_SECRET_ACCESS_KEY": "s"}
    args = parse("--topic-path", "/t", "--out", "s3://bucket/x", "--checkpoint", "s3a://bucket/c", "--view", "v")
    conf = cli.store_conf(args, env)
    assert conf["spark.hadoop.fs.s3a.access.key"] == "k" and args.out == "s3a://bucket/x" and args.view_rows == 5
    assert cli.store_conf(parse("--topic-path", "/t", "--out", "/o"), {}) == {}
    with pytest.raises(KeyError):
        cli.store_conf(parse("--topic-path", "/t", "--out", "s3://b/x"), {})
    seen = {}

    def build(extra=None):
        seen.update(extra)
        raise SystemExit(0)
    monkeypatch.setattr(cli, "build_session", build)
    for k, v in env.items():
        monkeypatch.setenv(k, v)
    with pytest.raises(SystemExit):
        cli.main(["land", "--topic-path", "/t", "--out", "s3://bucket/x"])
    assert seen["spark.hadoop.fs.s3a.secret.key"] == "s"


def test_one_topic_partition_is_written_in_order_by_several_tasks(spark, monkeypatch):
    from neoflow.session import scratch_path
    from neoflow.sinks.topic import FILES, TopicSink
    from neoflow.streaming import feed_job
    monkeypatch.setattr(feed_job, "TASK_MESSAGES", 5)
    docs = [(f"d{i}", '{"near_earth_objects": {"2024-01-01": [%s]}}' % ", ".join(f'{{"n": {7 * i + k}}}' for k in range(7)))
            for i in range(6)]
    sink = TopicSink(kind=FILES, path=scratch_path(spark, "topic-tasks"), topic="feed")
    sent = scratch_path(spark, "sent-tasks")
    feed_job.feed_to_topic(spark, spark.createDataFrame(docs, "doc_path string, value string"), "2024-01-01", "2024-01-01",
                           sink, num_partitions=1, sent_path=sent)
    rows = spark.read.parquet(sink.path).orderBy("offset").collect()
    assert [(r.partition, r.offset) for r in rows] == [(0, i) for i in range(42)]
    assert [r.value.decode() for r in rows] == [f'{{"n":{i},"current_date":"2024-01-01"}}' for i in range(42)]
    from pyspark.sql import functions as F
    assert spark.read.parquet(sent).select(F.input_file_name()).distinct().count() > 1  # not one task's file
