
import json
import math

import pytest

from neoflow.operators.parse import parse_and_flatten
from neoflow.schemas import NARROW_MESSAGE_SCHEMA, OUTPUT_COLUMNS, narrowed, MESSAGE_SCHEMA


def approach(kps="1.5", full="2022-11-18 10:00"):
    return {"close_approach_date": full[:10], "close_approach_date_full": full,
            "epoch_date_close_approach": 1668765600000,
            "relative_velocity": {"kilometers_per_second": kps, "kilometers_per_hour": "5400",
                                  "miles_per_hour": "3355"},
            "miss_distance": {"astronomical": "0.1", "lunar": "38.9", "kilometers": "1495978",
                              "miles": "929558"}, "orbiting_body": "Earth"}


def obj(**kw):
    base = {"links": {"self": "http://x"}, "id": "2000001", "neo_reference_id": "2000001",
            "name": "object one", "nasa_jpl_url": "http://y", "absolute_magnitude_h": 10.3,
            "estimated_diameter": {"kilometers": {"estimated_diameter_min": 1.5,
                                                  "estimated_diameter_max": 3.5}},
            "is_potentially_hazardous_asteroid": False,
            "close_approach_data": [approach(), approach("9.9", "2023-01-01 00:00")],
            "is_sentry_object": False, "current_date": "2022-11-18"}
    base.update(kw)
    return json.dumps(base)


def run(spark, texts, schema="narrow"):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return [r.asDict() for r in parse_and_flatten(df, schema=schema).collect()]


@pytest.mark.parametrize("schema", ["narrow", "full"])
def test_complete_object_first_approach_only(spark, schema):
    [r] = run(spark, [obj(extra_field={"a": 1})], schema)
    assert r["object_id"] == 2000001 and r["object_name"] == "object one"
    assert r["estimated_diameter_min_km"] == 1.5 and r["estimated_diameter_max_km"] == 3.5
    assert r["close_approach_date_full"] == "2022-11-18 10:00"
    assert r["relative_velocity_km_per_sec"] == 1.5
    assert r["relative_velocity_km_per_hour"] == 5400.0
    assert r["miss_distance_lunar"] == 38.9 and r["miss_distance_kilometers"] == 1495978.0
    assert r["date"] == "2022-11-18" and r["is_sentry_object"] is False
    assert list(r) == OUTPUT_COLUMNS


@pytest.mark.parametrize("arr", [[], None, "absent"])
def test_empty_null_or_absent_approaches(spark, arr):
    d = json.loads(obj())
    if arr == "absent":
        del d["close_approach_data"]
    else:
        d["close_approach_data"] = arr
    [r] = run(spark, [json.dumps(d)])
    assert r["close_approach_date_full"] is None and r["relative_velocity_km_per_sec"] is None
    assert r["object_id"] == 2000001 and r["date"] == "2022-11-18"


@pytest.mark.parametrize("idv,expected", [("abc", None), ("3000000000", None), ("12.7", 12),
                                          (" 12 ", 12), (77, 77)])
def test_id_casts(spark, idv, expected):
    [r] = run(spark, [obj(id=idv)])
    assert r["object_id"] == expected


def test_bad_magnitude_nulls_only_that_field(spark):
    [r] = run(spark, [obj(absolute_magnitude_h="x")])
    assert r["absolute_magnitude_h"] is None and r["object_id"] == 2000001


def test_magnitude_nan_and_int(spark):
    rows = run(spark, [obj(absolute_magnitude_h=3), obj().replace('"absolute_magnitude_h": 10.3',
                                                                  '"absolute_magnitude_h": NaN')])
    assert rows[0]["absolute_magnitude_h"] == 3.0
    assert math.isnan(rows[1]["absolute_magnitude_h"])


def test_bad_velocity(spark):
    d = json.loads(obj())
    d["close_approach_data"][0]["relative_velocity"]["kilometers_per_second"] = "fast"
    [r] = run(spark, [json.dumps(d)])
    assert r["relative_velocity_km_per_sec"] is None and r["relative_velocity_km_per_hour"] == 5400.0


@pytest.mark.parametrize("text", ['{"id": "1", "h": ', "hello", "null", "", None, "[{\"id\": \"1\"}]"])
def test_unparseable_messages_are_kept_as_null_rows(spark, text):
    [r] = run(spark, [text])
    assert all(v is None for v in r.values())


def test_duplicate_key_last_wins_and_case_matters(spark):
    t = obj()[:-1] + ', "id": "5"}'
    [r] = run(spark, [t])
    assert r["object_id"] == 5
    d = json.loads(obj())
    d["ID"] = d.pop("id")
    [r2] = run(spark, [json.dumps(d)])
    assert r2["object_id"] is None


def test_text_after_closing_brace_ignored(spark):
    [r] = run(spark, [obj() + " trailing"])
    assert r["object_id"] == 2000001


def test_bytes_values(spark):
    df = spark.createDataFrame([(bytearray(obj().encode()),)], "value binary")
    [r] = parse_and_flatten(df).collect()
    assert r.object_id == 2000001


def test_narrow_equals_full_on_edge_cases(spark):
    d = json.loads(obj())
    d["estimated_diameter"]["meters"] = "garbage"
    d["links"] = 5
    texts = [obj(), json.dumps(d), obj(id="12.7"), "junk", obj(close_approach_data=[])]
    assert run(spark, texts, "narrow") == run(spark, texts, "full")


def test_narrowed_schema_keeps_only_used_leaves():
    s = NARROW_MESSAGE_SCHEMA
    assert [f.name for f in s.fields] == [
        "id", "neo_reference_id", "name", "absolute_magnitude_h", "estimated_diameter",
        "is_potentially_hazardous_asteroid", "close_approach_data", "is_sentry_object", "current_date"]
    with pytest.raises(ValueError):
        narrowed(MESSAGE_SCHEMA, ["id.x"])


def test_parse_plan_is_map_only(spark):
    df = spark.createDataFrame([(obj(),)], "value string")
    plan = parse_and_flatten(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
