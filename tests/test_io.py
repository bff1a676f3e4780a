"""Sources and sinks round trips (SRC-4, SRC-9, SNK-1..6)."""

import glob
import json
import os
import tempfile

from pyspark.sql import functions as F

from kenning.operators import relational as rel
from kenning.sinks import writers as W
from kenning.sources import readers as R


def tmp():
    return tempfile.mkdtemp(prefix="kenning-io-", dir="/tmp")


def test_json_dict_object_and_lines(spark):
    d = tmp()
    with open(os.path.join(d, "obj.json"), "w") as f:
        json.dump({"a@x.test": "A X", "b@x.test": "B X"}, f, indent=2)
    with open(os.path.join(d, "lines.jsonl"), "w") as f:
        f.write('{"key": "a@x.test", "value": "A X"}\n{"key": "b@x.test", "value": "B X"}\n')
    a = sorted(tuple(r) for r in R.read_json_dict(spark, os.path.join(d, "obj.json")).collect())
    b = sorted(tuple(r) for r in R.read_json_dict(spark, os.path.join(d, "lines.jsonl"), lines=True).collect())
    assert a == b == [("a@x.test", "A X"), ("b@x.test", "B X")]


def test_nested_profile_import(spark):
    d = tmp()
    with open(os.path.join(d, "uid.json"), "w") as f:
        f.write(json.dumps({"u@x.test": {"TOPICS": {"gpu": 3, "rtl": 1}, "PEOPLE": {"bo": 2}}}) + "\n")
    got = sorted(tuple(r) for r in R.nested_profile_to_rows(spark, os.path.join(d, "uid.json")).collect())
    assert got == [("u@x.test", "PEOPLE", "bo", 2), ("u@x.test", "TOPICS", "gpu", 3), ("u@x.test", "TOPICS", "rtl", 1)]


def test_pieces_of_n_records(spark):
    d = os.path.join(tmp(), "out")
    W.write_json(spark.range(0, 5000).withColumn("x", F.col("id") * 2).coalesce(1), d, max_records_per_file=2000)
    files = glob.glob(os.path.join(d, "part-*.json"))
    assert len(files) == 3
    assert spark.read.json(d).count() == 5000


def test_csv_with_nested_columns(spark):
    d = os.path.join(tmp(), "csv")
    df = spark.createDataFrame([("u", ["a", "b"])], "u string, l array<string>")
    W.write_csv(df, d)
    back = spark.read.option("header", True).csv(d).collect()
    assert back[0]["l"] == '["a","b"]'


def test_state_versions_and_pointer(spark):
    root = os.path.join(tmp(), "state")
    assert W.current_state_path(spark, root) is None
    p1 = W.write_state(spark, spark.createDataFrame([("u", 1)], "u string, n int"), root, "00000001")
    p2 = W.write_state(spark, spark.createDataFrame([("u", 3)], "u string, n int"), root, "00000002")
    assert W.current_state_path(spark, root) == p2
    assert spark.read.parquet(p1).first()["n"] == 1          # the earlier version stays as the backup


def test_distinct_count_and_first_rows(spark):
    df = spark.range(0, 1000).withColumn("k", F.col("id") % 37)
    assert rel.distinct_count(df, "k").first()[0] == 37
    assert abs(rel.distinct_count(df, "k", approx=True).first()[0] - 37) <= 2
    assert [r.id for r in rel.first_rows(df, 3, F.col("id").desc()).collect()] == [999, 998, 997]


def test_directory_order_is_file_order(spark, tmp_path):
    from kenning.operators.directory import dedupe_directory
    from kenning.sources.readers import read_directory
    head = "cognitoSubjectId (S),email (S),displayName (S)\n"
    (tmp_path / "a.csv").write_text(head + "s1,x@y.test,First\ns2,x@y.test,Second\n")
    (tmp_path / "b.csv").write_text(head + "s3,x@y.test,Third\n" + "".join(f"t{i},u{i}@y.test,U\n" for i in range(500)))
    got = dedupe_directory(read_directory(spark, str(tmp_path))).filter("email_id = 'x@y.test'").collect()
    assert [(r.sub_id, r.user_name) for r in got] == [("s1", "First")]
