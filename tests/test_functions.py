"""Column functions: a few invented rows each, expected values written by hand."""

import math

from pyspark.sql import functions as F

from kenning import config
from kenning.functions import arrays as A
from kenning.functions import dates as D
from kenning.functions import mathx as M
from kenning.functions import text as T


def one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_title_case_like_python(spark):
    vals = ["mary-jane o'brien", "ECONOMY brand#12", "3rd floor", "", "élan vital"]
    got = one(spark, T.title_case(F.col("s")), [(v,) for v in vals], "s string")
    assert got == [v.title() for v in vals]


def test_clean_content_stopwords_urls(spark):
    got = one(spark, T.clean_content(F.col("s")),
              [("Re: The  GPU\tis in http://x.y/z the\nVault",), (None,)], "s string")
    assert got[0] == "Re: GPU  Vault".replace("Re: ", "") or got[0] == "GPU  Vault"
    assert got[1] is None


def test_clean_content_keeps_case_and_drops_fwd(spark):
    got = one(spark, T.clean_content(F.col("s")), [("FWD: Hello World",)], "s string")
    assert got == ["Hello World"]


def test_strip_brackets_and_lower(spark):
    got = one(spark, T.lower_clean_body(F.col("s")), [("<B>Bold</B>",)], "s string")
    assert got == [" b bold /b "]


def test_name_tokens(spark):
    got = one(spark, F.array_join(T.name_tokens(F.col("s")), "|"),
              [("ana.lima@acme.test",), ("x..y@z.test",), ("solo@z.test",)], "s string")
    assert got == ["ana|lima", "x|y", "solo"]


def test_rank_key_beyond_9999(spark):
    got = one(spark, T.rank_key(F.lit("TOPICS"), F.col("r")), [(1,), (12345,)], "r int")
    assert got == ["TAG_TOPICS_0001", "TAG_TOPICS_12345"]


def test_parse_list_literal_and_malformed(spark):
    got = one(spark, T.parse_list_literal(F.col("s")),
              [("['a@x.test', 'b@x.test']",), ('["c@x.test"]',), ("[broken",)], "s string")
    assert got[0] == ["a@x.test", "b@x.test"] and got[1] == ["c@x.test"] and got[2] is None


def test_iso8601(spark):
    got = one(spark, T.is_iso8601(F.col("s")),
              [("2018-08-14T:00:00:00",), ("2018-08-14T00:00:00",), ("2018-08-14T00:00:00+02:00",), (None,)],
              "s string")
    assert got == [False, True, True, False]


def test_extract_mails_wide_and_strict(spark):
    txt = "to a.b@mail5.acme.co.uk and c@d.org, again a.b@mail5.acme.co.uk"
    wide = one(spark, T.extract_mails(F.col("s")), [(txt,)], "s string")[0]
    strict = one(spark, T.extract_mails(F.col("s"), config.MAIL_PATTERN_STRICT), [(txt,)], "s string")[0]
    assert wide == ["a.b@mail5.acme.co.uk", "c@d.org"]
    assert strict == ["c@d.org"]


def test_append_mentions(spark):
    got = one(spark, T.append_mentions(F.col("t"), F.col("m")), [("hi ", ["Ana", "Bo"]), ("x", [])],
              "t string, m array<string>")
    assert got == ["hi @Ana @Bo ", "x"]


def test_recipients_merge_substring_rule(spark):
    # cc entries contained in the sender string are dropped (substring test)
    got = one(spark, A.recipients_merge(F.col("to"), F.col("cc"), F.col("s")),
              [(["a@x"], ["b@x", "ana@x", "na@x"], "ana@x")], "to array<string>, cc array<string>, s string")
    assert got == [["a@x", "b@x"]]


def test_without_sender_keeps_repeats(spark):
    got = one(spark, A.without_sender(F.col("p"), F.col("s")), [(["a", "b", "a", "c", "b"], "b")],
              "p array<string>, s string")
    assert got == [["a", "a", "c"]]


def test_complete_names_in_row(spark):
    names = ["ana", "ana lima", "lima", "bo", "bo chen", "chen", "ana lima"]
    got = one(spark, A.complete_names_in_row(F.col("n")), [(names,)], "n array<string>")[0]
    assert got == ["ana lima", "ana lima", "ana lima", "bo chen", "bo chen", "bo chen", "ana lima"]


def test_date_clean_formats_and_null(spark):
    got = one(spark, D.date_clean(F.col("s")),
              [("2024-01-05 10:00:00",), ("05 Jan 2024",), ("2024-01-05T10:00:00+02:00",), ("junk",), (None,)],
              "s string")
    assert got == ["2024-01-05T10:00:00Z", "2024-01-05T00:00:00Z", "2024-01-05T08:00:00Z", None, None]


def test_shift_after(spark):
    rows = [("2024-01-10 12:00:00", "2024-01-01 06:00:00"),   # comment 9.25 days after mail
            ("2024-01-01 00:00:00", "2024-01-03 18:00:00")]   # comment 2.75 days before mail
    df = spark.createDataFrame(rows, "c string, r string")
    got = [r[0] for r in df.select(D.format_out(D.shift_after(F.to_timestamp("c"), F.to_timestamp("r")))).collect()]
    assert got == ["2024-01-01T12:00:00Z", "2024-01-04T00:00:00Z"]


def _py_decay(freq, d, schedule):
    d = max(d, 1)
    for s in schedule:
        if s.max_days is None or d <= s.max_days:
            if s.form == "log10":
                e = s.a * math.log10(d)
            elif s.form == "ln":
                e = s.a * math.log(d)
            elif s.form == "sqrt":
                e = s.a * math.sqrt(d)
            else:
                e = s.a * (math.log(s.ref_days) - math.log(d))
            return math.ceil(round(freq * math.exp(e), 9))


def test_decay_schedules_match_formula(spark):
    days = [-3, 0, 1, 2, 7, 21, 31, 60, 62, 183, 365, 730, 1000]
    for name, sched in config.DECAY_SCHEDULES.items():
        rows = [(f, d) for f in (1, 7, 40) for d in days]
        got = one(spark, M.aged_count(F.col("f"), F.col("d"), sched), rows, "f bigint, d int")
        assert got == [_py_decay(f, d, sched) for f, d in rows], name


def test_decay_null_day(spark):
    got = one(spark, M.aged_count(F.col("f"), F.col("d"), config.DECAY_V3, null_day_keeps_count=True),
              [(5, None)], "f bigint, d int")
    assert got == [5]


def test_minmax_equal_values(spark):
    got = one(spark, M.minmax(F.col("x"), F.lit(2.0), F.lit(2.0), 0.1), [(2.0,)], "x double")
    assert got == [0.1]


def test_rtrim_list_and_build_content(spark):
    got = one(spark, T.rtrim_list(F.col("l")), [(["a@x ", "b@x  "],)], "l array<string>")
    assert got == ["a@x, b@x"]
    got = one(spark, T.build_content(F.col("s"), F.col("b"), F.col("to"), F.col("cc")),
              [("Hi", None, ["a@x"], ["b@x", "c@x"])], "s string, b string, to array<string>, cc array<string>")
    assert got == ["Hi a@x b@x c@x"]


def test_now_string_and_sigmoid(spark):
    import re
    got = spark.range(1).select(D.now_string().alias("n"), M.sigmoid(F.lit(0.0)).alias("s")).first()
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", got.n) and got.s == 0.5
