"""Cases in which rows or counts were once lost without an error."""

import datetime as dt
import os
import tempfile

import pytest
from kenning import config
from kenning.functions.dates import date_clean, parse_date_strict
from kenning.functions.text import clean_content
from kenning.operators import gazetteer as gz
from kenning.operators.directory import lists_with_directory
from kenning.operators.state import merge_profiles
from kenning.plans import interests
from kenning.sinks import writers as W
from pyspark.sql import functions as F


def test_rows_with_empty_lists_stay(spark):
    people = spark.createDataFrame([("a@x.test", "u1", "A")], "email string, user_id string, display string")
    df = spark.createDataFrame([(1, ["a@x.test", "b@x.test"], []), (2, [], None), (3, None, None)],
                               "k int, x array<string>, y array<string>")
    got = {r.k: r for r in lists_with_directory(df, "k", {"x": "x", "y": "y"}, people).collect()}
    assert [(e.email, e.user_id) for e in got[1].x] == [("a@x.test", "u1"), ("b@x.test", None)] and got[1].y == []
    assert got[2].x == [] and got[2].y is None and got[3].x is None


def test_messages_count_per_row_not_per_id(spark):
    cfg = config.TenantConfig(**{**config.TENANT_A.__dict__, "domains": ("@x.test",), "as_of": dt.date(2024, 1, 1)})
    g = gz.from_rows(spark, [("PROG_SCRIPT_LANG", "python", "python", False, False, 1)])
    cols = interests_columns()
    base = {"batch_id": "b", "subject": "s", "body": "we like python", "from_email": "ann.lee@x.test", "to": [], "cc": [],
            "date": "2023-12-30T10:00:00Z"}
    rows = [{**base, "conversation_id": c, "message_id": m} for c, m in (("c1", "1"), ("c2", "1"), ("c3", None))]
    msgs = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows],
                                 ", ".join(f"{c} {'array<string>' if c in ('to', 'cc') else 'string'}" for c in cols))
    d = spark.createDataFrame([], "email_id string, sub_id string, user_name string, ord bigint")
    out = interests.new_profile(msgs, g, d, cfg)
    got = {(r.user_id, r.value): r.frequency for r in out["profile"].collect()}
    assert got["ann.lee@x.test", "python"] == 3
    assert out["annotated"].count() == 3


def interests_columns():
    return ["batch_id", "conversation_id", "message_id", "subject", "body", "from_email", "to", "cc", "date"]


def test_damaged_pointer_is_an_error(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="kenning-ptr-", dir="/tmp"), "state")
    W.write_state(spark, spark.range(1), root, "1")
    with open(os.path.join(root, "_pointer", "part-x.json"), "w") as f:
        f.write("{damaged")
    with pytest.raises(Exception):
        W.current_state_path(spark, root)


def test_pointer_of_an_earlier_release_is_read_and_batches_are_told_apart(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="kenning-ptr-", dir="/tmp"), "state")
    spark.createDataFrame([("20261202205542000000", "old")], "version string, path string").write.json(f"{root}/_pointer")
    assert W.current_state_path(spark, root) == "old"
    assert not W.applied(spark, root, "s:0")
    new = W.write_state(spark, spark.range(1), root, "s-0", "s:0")
    assert W.current_state_path(spark, root) == new and W.applied(spark, root, "s:0") and not W.applied(spark, root, "t:0")


def test_both_sides_are_completed_over_the_original_names(spark):
    schema = "user_id string, category string, value string, frequency bigint, decay_frequency bigint"
    stored = spark.createDataFrame([("u", config.PEOPLE, "ann", 4, 4)], schema)
    new = spark.createDataFrame([("u", config.PEOPLE, "ann lee", 1, 1), ("u", config.PEOPLE, "ann kay", 2, 2)], schema)
    got = {r.value: r.frequency for r in merge_profiles(stored, new, complete_people=True).collect()}
    assert sum(got.values()) == 7 and got["ann lee"] == 1 and got["ann kay"] == 2


@pytest.mark.parametrize("raw, out", [
    ("Tue, 14 Aug 2018 10:00:00 +0000", "2018-08-14T10:00:00Z"), ("Tue, 14 Aug 2018 10:00:00 GMT", "2018-08-14T10:00:00Z"),
    ("14 Aug 2018 12:00:00 +0200", "2018-08-14T10:00:00Z"), ("14 August 2018", "2018-08-14T00:00:00Z"),
    ("5 Jan 2024", "2024-01-05T00:00:00Z"), ("2024-01-05 10:00", "2024-01-05T10:00:00Z"),
    ("2024-01-05T10:00:00+0000", "2024-01-05T10:00:00Z"), ("January 5, 2024", "2024-01-05T00:00:00Z"), ("nonsense", None)])
def test_more_date_forms(spark, raw, out):
    assert spark.createDataFrame([(raw,)], "d string").select(date_clean("d")).first()[0] == out


def test_strict_dates_raise(spark):
    df = spark.createDataFrame([(None,), ("2024-01-05",)], "d string")
    assert df.select(parse_date_strict("d")).count() == 2
    with pytest.raises(Exception, match="no date format"):
        spark.createDataFrame([("nonsense",)], "d string").select(parse_date_strict("d")).collect()


def test_unicode_blanks(spark):
    text = "see http://x.test/a tail end"
    got = spark.createDataFrame([(text,)], "t string").select(clean_content(F.col("t"), stopwords=("see",))).first()[0]
    assert got.split() == ["tail", "end"]
