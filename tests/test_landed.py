"""Landed files of differing columns, empty files and bad records in one scan."""

import json
import os

from courtview.sources import landed

SCHEMA = "video_id string, n long, text string, score decimal(9,4)"


def _write(folder, name, lines):
    os.makedirs(os.path.dirname(os.path.join(folder, name)), exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("".join(x + "\n" for x in lines))


def _folder(tmp_path):
    folder = str(tmp_path / "in")
    _write(folder, "a/1.json", [json.dumps({"video_id": "v1", "n": 3, "text": "a\nb \u2028 \"q\""}), json.dumps({"n": None, "video_id": "v2", "other": [1]})])
    _write(folder, "b/2.json", [json.dumps({"video_id": "v3", "score": -0.25}), "", "   "])
    _write(folder, "b/empty.json", [])
    _write(folder, "c/3.json", ['{"video_id": "v4", "n": 5', json.dumps({"video_id": "v5", "n": "many"}), "not json", "[1, 2]", "7", json.dumps({}), json.dumps({"video_id": "v6", "n": 9})])
    return folder


def test_good_and_bad_records(spark, tmp_path):
    from pyspark.sql import types as T
    schema = T.StructType(spark.createDataFrame([], SCHEMA).schema.fields)
    df = landed.read_landed(spark, _folder(tmp_path), schema)
    from decimal import Decimal
    assert sorted(map(tuple, landed.good_rows(df).collect()), key=str) == sorted([
        ("v1", 3, "a\nb \u2028 \"q\"", None), ("v2", None, None, None), ("v3", None, None, Decimal("-0.2500")), (None, None, None, None), ("v6", 9, None, None)], key=str)
    bad = {(os.path.basename(r["_file"]), r["_bad_record"]) for r in landed.bad_records(df).collect()}
    assert bad == {("3.json", x) for x in ('{"video_id": "v4", "n": 5', '{"video_id": "v5", "n": "many"}', "not json", "[1, 2]", "7")}
    plan = landed.good_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_schema_is_merged_from_the_files(spark, tmp_path):
    df = landed.read_landed(spark, _folder(tmp_path))
    assert {"video_id", "n", "text", "score", "other"} <= set(df.columns)
    assert {r["video_id"] for r in landed.good_rows(df).collect()} >= {"v1", "v2", "v3"}


def test_only_empty_files(spark, tmp_path):
    folder = str(tmp_path / "none")
    _write(folder, "x.json", [])
    df = landed.read_landed(spark, folder, spark.createDataFrame([], SCHEMA).schema)
    assert df.count() == 0 and df.columns == ["video_id", "n", "text", "score", "_file", "_bad_record"]


def test_round_trip_of_differing_frames(spark):
    a = spark.createDataFrame([("v1", "x\r\ny"), (None, None)], "video_id string, text string")
    b = spark.createDataFrame([("v2", 4)], "video_id string, n long")
    path = landed.land([a, b, b.limit(0)], "test")
    got = landed.good_rows(landed.read_landed(spark, path, spark.createDataFrame([], "video_id string, text string, n long").schema))
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("v1", "x\r\ny", None), (None, None, None), ("v2", None, 4)], key=str)
