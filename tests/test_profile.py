"""Profiles: counts, modal day, ranks, merge properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kenning.operators import directory as dirops
from kenning.operators import profile as prof
from kenning.operators import relational as rel
from kenning.operators import scoring, state

AS_OF = dt.date(2024, 2, 1)


def test_modal_day_tie_takes_least(spark):
    m = spark.createDataFrame([("u", "2024-01-03 10:00:00"), ("u", "2024-01-02 10:00:00"),
                               ("u", "2024-01-03 11:00:00"), ("u", "2024-01-02 09:00:00"),
                               ("v", "2024-01-05 00:00:00")], "user_id string, ts string") \
        .withColumn("ts", F.to_timestamp("ts"))
    got = {r.user_id: str(r.modal_day) for r in prof.modal_day(m).collect()}
    assert got == {"u": "2024-01-02", "v": "2024-01-05"}


def test_rank_ties_by_value(spark):
    c = spark.createDataFrame([("u", "T", "b", 2), ("u", "T", "a", 2), ("u", "T", "c", 5), ("u", "P", "x", 1)],
                              "user_id string, category string, value string, frequency long")
    got = sorted((r.value, r.rank, r.sk) for r in prof.rank_values(c).collect())
    assert got == [("a", 2, "TAG_T_0002"), ("b", 3, "TAG_T_0003"), ("c", 1, "TAG_T_0001"), ("x", 1, "TAG_P_0001")]


def test_drop_self_mentions(spark):
    r = spark.createDataFrame([("ana.lima@x.test", "Ana Lima "), ("ana.lima@x.test", "Limas"),
                               ("ana.lima@x.test", "Bo Chen")], "user_id string, value string")
    got = sorted(x.value for x in prof.drop_self_mentions(r).collect())
    assert got == ["bo chen"]


def _profile(spark, rows):
    return spark.createDataFrame(rows, "user_id string, category string, value string, frequency long, "
                                       "decay_frequency long")


def test_merge_keeps_new_categories_and_users(spark):
    stored = _profile(spark, [("u", "T", "gpu", 2, 3), ("w", "T", "x", 1, 1)])
    new = _profile(spark, [("u", "T", "gpu", 1, 2), ("u", "P", "bo", 1, 1), ("n", "T", "y", 4, 5)])
    got = sorted(tuple(r) for r in state.merge_profiles(stored, new).collect())
    assert got == [("n", "T", "y", 4, 5, "new"), ("u", "P", "bo", 1, 1, "new"), ("u", "T", "gpu", 3, 5, "both"),
                   ("w", "T", "x", 1, 1, "stored")]


def test_merge_then_merge_equals_union(spark):
    a = _profile(spark, [("u", "T", "gpu", 2, 2), ("u", "T", "cpu", 1, 1)])
    b = _profile(spark, [("u", "T", "gpu", 3, 3), ("v", "T", "gpu", 1, 1)])
    c = _profile(spark, [("u", "T", "cpu", 5, 5)])
    ab_c = state.merge_profiles(state.merge_profiles(a, b).drop("origin"), c)
    a_bc = state.merge_profiles(a, state.merge_profiles(b, c).drop("origin"))
    key = lambda df: sorted((r.user_id, r.value, r.frequency) for r in df.collect())
    assert key(ab_c) == key(a_bc) == [("u", "cpu", 6), ("u", "gpu", 5), ("v", "gpu", 1)]


def test_merge_completes_people_and_sums_collisions(spark):
    stored = _profile(spark, [("u", "PEOPLE", "ana", 2, 2)])
    new = _profile(spark, [("u", "PEOPLE", "ana lima", 1, 1), ("u", "PEOPLE", "lima", 4, 4)])
    got = sorted(tuple(r)[:5] for r in state.merge_profiles(stored, new, complete_people=True).collect())
    assert got == [("u", "PEOPLE", "ana lima", 7, 7)]


def test_group_completion_prefix_suffix_and_ties(spark):
    names = spark.createDataFrame([("g", "ana"), ("g", "ana lima"), ("g", "ana ruiz"), ("g", "lima"),
                                   ("g", "ruiz"), ("g", "bo")], "grp string, value string")
    got = {r.value: r.completed for r in dirops.complete_names(names, ["grp"], "value").collect()}
    assert got == {"ana": "ana lima ana ruiz", "ana lima": "ana lima", "ana ruiz": "ana ruiz",
                   "lima": "ana lima", "ruiz": "ana ruiz", "bo": "bo"}


def test_weights_in_unit_range_and_equal_values(spark):
    p = spark.createDataFrame([("u", "T", "a", 3, 4, "A", None), ("v", "PEOPLE", "b", 1, 1, "B", "B"),
                               ("w", "T", "a", 7, 9, "A", None)],
                              "user_id string, category string, value string, frequency long, decay_frequency long, "
                              "entityName string, userName string")
    w = scoring.interest_weights(p, people_category="PEOPLE", categories=("T", "PEOPLE"), materialize=False)
    vals = [r.weight for r in w.collect()] + [r.d_weight for r in w.collect()]
    assert all(0.0 <= v <= 1.0 for v in vals) and max(vals) == 1.0
    same = spark.createDataFrame([("u", "T", "a", 2, 2, "A", None), ("v", "T", "a", 2, 2, "A", None)],
                                 p.schema)
    assert {r.weight for r in scoring.interest_weights(same, categories=("T",), materialize=False).collect()} == {0.0}


def test_first_per_group_and_nesting(spark):
    m = spark.createDataFrame([("c1", 2, "b"), ("c1", 1, "a"), ("c1", 3, "c"), ("c2", 5, "z")],
                              "conv string, seq int, txt string")
    first = rel.first_per_group(m, "conv", "seq", ["seq", "txt"])
    reps = rel.replies(m, "conv", "seq")
    nested = rel.nest_replies(first, reps, "conv", "seq", [F.col("txt")])
    got = {r.conv: (r.txt, [x.txt for x in r.replies]) for r in nested.collect()}
    assert got == {"c1": ("a", ["b", "c"]), "c2": ("z", [])}


def test_repartitioning_changes_nothing(spark):
    m = spark.createDataFrame([("u%d" % (i % 7), "T", "v%d" % (i % 5)) for i in range(200)],
                              "user_id string, category string, value string")
    a = sorted(tuple(r) for r in prof.mention_counts(m).collect())
    b = sorted(tuple(r) for r in prof.mention_counts(m.repartition(13)).collect())
    assert a == b and sum(r[3] for r in a) == 200


def test_rank_within_hot_group_matches_window(spark):
    from pyspark.sql import Window
    rows = [("hot", "T", "v%05d" % i, (i * 7919) % 13) for i in range(3000)] + \
           [("u%d" % j, "T", "w%d" % k, k % 3) for j in range(20) for k in range(5)]
    df = spark.createDataFrame(rows, "user_id string, category string, value string, frequency long")
    order = [F.col("frequency").desc(), F.col("value").asc()]
    got = {(r.user_id, r.value): r.rank for r in prof.rank_within(df, ["user_id", "category"], order,
                                                                  partitions=16).collect()}
    small = {(r.user_id, r.value): r.rank for r in prof.rank_within(df, ["user_id", "category"], order).collect()}
    w = Window.partitionBy("user_id", "category").orderBy(*order)
    exp = {(r.user_id, r.value): r.rank for r in df.withColumn("rank", F.row_number().over(w)).collect()}
    assert got == exp and small == exp


def test_nest_replies_pages_keep_every_reply(spark):
    m = spark.createDataFrame([("c1", i, "r%d" % i) for i in range(1, 8)] + [("c2", 1, "z")],
                              "conv string, seq int, txt string")
    first = rel.first_per_group(m, "conv", "seq", ["seq", "txt"])
    reps = rel.replies(m, "conv", "seq")
    paged = rel.nest_replies(first, reps, "conv", "seq", [F.col("txt")], page_size=2)
    got = sorted((r.conv, r.page, [x.txt for x in r.replies]) for r in paged.collect())
    assert got == [("c1", 0, ["r2", "r3"]), ("c1", 1, ["r4", "r5"]), ("c1", 2, ["r6", "r7"]), ("c2", 0, [])]


def test_nest_replies_pages_by_default(spark):
    """A hot conversation is cut without being asked; ``None`` makes one record of it."""
    m = spark.range(1, 2 * rel.REPLY_PAGE + 12).select(F.lit("c1").alias("conv"), F.col("id").alias("seq"))
    first, reps = rel.first_per_group(m, "conv", "seq", ["seq"]), rel.replies(m, "conv", "seq")

    def pages(**kw):
        n = rel.nest_replies(first, reps, "conv", "seq", [F.col("seq").alias("at")], **kw)
        return sorted((r.n, r.lo, r.hi) for r in n.select(
            F.size("replies").alias("n"), F.array_min("replies.at").alias("lo"), F.array_max("replies.at").alias("hi")).collect())

    last = 2 * rel.REPLY_PAGE + 11
    assert pages() == [(10, last - 9, last), (rel.REPLY_PAGE, 2, rel.REPLY_PAGE + 1), (rel.REPLY_PAGE, rel.REPLY_PAGE + 2, last - 10)]
    assert pages(page_size=None) == [(last - 1, 2, last)]


def test_reage_by_day(spark):
    from kenning.functions.mathx import aged_count  # noqa: F401
    a = spark.createDataFrame([("u", "T", "gpu", dt.date(2024, 1, 10), 3)],
                              "user_id string, category string, value string, modal_day date, frequency long")
    b = spark.createDataFrame([("u", "T", "gpu", dt.date(2024, 1, 30), 2), ("u", "T", "gpu", dt.date(2024, 1, 10), 1)],
                              a.schema)
    by_day = state.merge_by_day(a, b)
    assert sorted((str(r.modal_day), r.frequency) for r in by_day.collect()) == [("2024-01-10", 4), ("2024-01-30", 2)]
    later = state.reage(by_day, "v3", dt.date(2024, 3, 1)).first()
    # each day aged separately at the new as-of date, then added
    one = prof.age_counts(spark.createDataFrame([("u", "T", "gpu", 4)], "user_id string, category string, "
                                                "value string, frequency long"),
                          spark.createDataFrame([("u", dt.date(2024, 1, 10))], "user_id string, modal_day date"),
                          "v3", dt.date(2024, 3, 1)).first().decay_frequency
    two = prof.age_counts(spark.createDataFrame([("u", "T", "gpu", 2)], "user_id string, category string, "
                                                "value string, frequency long"),
                          spark.createDataFrame([("u", dt.date(2024, 1, 30))], "user_id string, modal_day date"),
                          "v3", dt.date(2024, 3, 1)).first().decay_frequency
    assert later.frequency == 6 and later.decay_frequency == one + two


@pytest.mark.parametrize("name", ["nested_replies", "team_conversations"])
def test_registered_queries_page_their_replies(spark, monkeypatch, name):
    """No record holds more than a page of replies, and the pages hold them all."""
    from kenning.plans import standins
    sf = "/root/testdata/sf0.001"
    col = {"nested_replies": ("num_replies", "reply_turns", ","), "team_conversations": ("n_replies", "replies", ";")}[name]

    def replies():
        rows = standins.QUERIES[name](spark, sf).select("conversation_id", *col[:2]).collect()
        each = sorted((r[0], x) for r in rows if r[1] for x in r[2].split(col[2]))
        return max(r[1] for r in rows), sum(r[1] for r in rows), {r[0] for r in rows}, each

    whole = replies()
    monkeypatch.setattr(standins, "REPLY_PAGE", 2, raising=False)
    paged = replies()
    assert whole[0] > 2 and paged[0] == 2 and paged[1:] == whole[1:]


def test_completion_collects_only_the_longest(spark):
    """A short name that begins and ends many others gathers those of the greatest length alone."""
    many = ["al" + f"{i:04d}" for i in range(3000)] + [f"{i:04d}al" for i in range(3000)]
    names = spark.createDataFrame([("g", n) for n in ["al", "al longest b", "al longest a", *many]], "grp string, value string")
    got = dirops.complete_names(names, ["grp"], "value")
    assert {r.value: r.completed for r in got.collect()} == {
        n: n for n in many} | {n: n for n in ("al longest a", "al longest b")} | {"al": "al longest a al longest b"}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # read from the bottom: the cut to the longest comes before the collection
    assert plan.index("collect_set(") < plan.index("WindowGroupLimit")
