"""One test per decided quirk of SURVEY §7.2 not already pinned elsewhere."""

import datetime as dt

from pyspark.sql import functions as F

from kenning import config
from kenning.operators import gazetteer as gz
from kenning.operators import scoring
from kenning.operators.directory import dedupe_directory, resolve_mails
from kenning.sources import readers as R


def test_q7_every_line_of_shape_a_is_read(spark, fx_paths):
    ids = {r.message_id for r in R.read_conversations_a(spark, fx_paths["conv_a"]).collect()}
    assert ids == {"m1", "m2", "m3", "m4"}


def test_missing_subject_is_na(spark, fx_paths):
    subj = {r.message_id: r.subject for r in R.read_conversations_a(spark, fx_paths["conv_a"]).collect()}
    assert subj["m2"] == "NA"


def test_q24_q25_empty_rule_rejected_and_rules_lowered(spark):
    g = gz.from_rows(spark, [("TOPICS", "", None, False, False, 1), ("TOPICS", "Secure Vault", None, False, False, 1)])
    got = [(r.key, r.canonical) for r in gz.expand(g).collect()]
    assert got == [("secure vault", "secure vault")]


def test_q17_own_name_missing_falls_back_to_own_frequency(spark):
    p = spark.createDataFrame([("u", "PEOPLE", "x", 4, 4, "X", "Nobody"), ("v", "PEOPLE", "x", 1, 1, "X", None)],
                              "user_id string, category string, value string, frequency long, decay_frequency long, "
                              "entityName string, userName string")
    w = {r.user_id: r for r in scoring.interest_weights(p, categories=("PEOPLE",), materialize=False).collect()}
    assert w["u"].lookup_freq == 5 and w["u"].weight == 1.0 and w["v"].weight == 0.0


def test_q12_q30_address_equality_and_first_directory_row(spark):
    d = spark.createDataFrame([("s1", "ana@x.test", "Ana One", 1), ("s2", "ana@x.test", "Ana Two", 2),
                               ("s3", "bo@x.test", "Bo", 3)], "sub_id string, email_id string, user_name string, ord long")
    assert {r.email_id: r.sub_id for r in dedupe_directory(d).collect()} == {"ana@x.test": "s1", "bo@x.test": "s3"}
    mails = spark.createDataFrame([("ana@x.test",), ("na@x.test",), ("zed.q@y.test",)], "value string")
    known = spark.createDataFrame([("zed.q@y.test",)], "address string")
    got = {r.value: (r.mail_id, r.mail_display) for r in resolve_mails(mails, d, known).collect()}
    assert got == {"ana@x.test": ("s1", "Ana One"), "na@x.test": ("na@x.test", None),   # no substring hit
                   "zed.q@y.test": ("zed.q@y.test", "Zed Q")}


def test_tenant_b_schedule_keeps_count_without_mail_day(spark):
    from kenning.operators import profile as prof
    counts = spark.createDataFrame([("u", "T", "a", 3)], "user_id string, category string, value string, frequency long")
    days = spark.createDataFrame([("u", None)], "user_id string, modal_day date")
    got = prof.age_counts(counts, days, "v3", dt.date(2024, 2, 1), null_day_keeps_count=True).first()
    assert got.decay_frequency == 3
    got_a = prof.age_counts(counts, days, "v2", dt.date(2024, 2, 1)).first()
    assert got_a.decay_frequency is None


def test_config_fixed_values():
    assert config.STOPWORDS[:3] == ("i", "re:", "fwd:") and "wouldn't" in config.STOPWORDS
    assert config.DECAY_V2[0].ref_days == 183 and config.DECAY_V3[-1].a == -0.1
