"""Plans and results that must hold when a table grows (round 3 findings)."""

from pyspark.sql import functions as F

from kenning.operators import extract as ext
from kenning.operators import gazetteer as gz
from kenning.operators.directory import lists_with_directory


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_repeat_rules_are_sent_to_the_texts(spark):
    """the texts were sent whole to one task, as the planner guessed them small."""
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(
        F.repeat(F.lit("very "), (F.col("id") % 4).cast("int")), F.lit("good")).alias("text"))
    docs = docs.unionByName(spark.sql("SELECT 200L AS doc_id, '' AS text UNION ALL SELECT 201L, CAST(NULL AS string)"))
    out = ext.match(docs, gz.from_rows(spark, [("A", "{very}+ good", None, False, False, 1)]))
    p = plan_of(out)
    assert "BuildLeft" not in p and "SortMergeJoin" not in p and p.count("BuildRight") == 2
    assert sorted((r.doc_id, r.start, r.n_tokens) for r in out.collect()) == [
        (i, 1, i % 4 + 1) for i in range(200) if i % 4]


def test_large_rule_table_is_joined_by_shuffle(spark):
    """beyond the row bound neither side is sent whole, with the same matches."""
    docs = spark.range(20).select(F.col("id").alias("doc_id"), F.concat(
        F.repeat(F.lit("very "), (F.col("id") % 4).cast("int")), F.lit("good")).alias("text"))
    rules = gz.from_rows(spark, [("A", "{very}+ good", None, False, False, 1)])
    out = ext.match(docs, rules, broadcast_rows=1)
    assert "Broadcast" not in plan_of(out)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, ext.match(docs, rules).collect()))


PEOPLE = "email string, user_id string, display string"


def test_an_address_that_most_rows_hold_is_not_sorted(spark):
    """the directory is the hashed side, and only its hits come back."""
    from kenning.operators.directory import with_directory_lists
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        people = spark.createDataFrame([("a", "u1", "A"), ("a", "u0", "B"), ("b", None, "C")], PEOPLE)
        df = spark.createDataFrame([(1, ["x", "a", None, "x"], None), (2, [], ["b"]), (2, ["a"], []), (None, ["a"], [])],
                                   "k int, x array<string>, y array<string>")
        out = with_directory_lists(df, "k", {"xs": "x", "ys": "y"}, people, df, F.concat("x", F.coalesce("y", F.array().cast("array<string>"))))
        assert "ShuffledHashJoin" in plan_of(out)
        got = {(r.k, tuple(r.x)): r for r in out.collect()}
        old = {r.k: r for r in lists_with_directory(df, "k", {"xs": "x", "ys": "y"}, people).collect()}
        assert "ShuffledHashJoin" in plan_of(lists_with_directory(df, "k", {"xs": "x"}, people))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(got) == 3 and len(old) == 3
    a0, a1 = ("a", "u0", "B"), ("a", "u1", "A")
    assert list(map(tuple, got[1, ("x", "a", None, "x")].xs)) == [("x", None, None), a0, a1, (None, None, None), ("x", None, None)]
    assert got[1, ("x", "a", None, "x")].ys is None
    # rows of one key share their lists
    for key in ((2, ()), (2, ("a",))):
        assert list(map(tuple, got[key].xs)) == [a0, a1] and list(map(tuple, got[key].ys)) == [("b", None, "C")]
    assert all(old[k].xs == r.xs and old[k].ys == r.ys for (k, _), r in got.items())
    assert list(map(tuple, old[None].xs)) == [a0, a1]


def test_team_rows_are_sent_once(spark):
    """head and replies of a conversation come from one grouping; pages lose nothing."""
    from kenning.plans.teams import team_conversations
    n = 50
    msgs = spark.createDataFrame([(i, i // 40, str(i), "s", "b%d" % i, "2024-01-02 10:00:00", "['a']", "[]", "[]", "c%d" % i, "['b']", "['a', 'b']")
                                  for i in range(n)],
                                 "row_seq long, conversationId long, id string, subject string, body_content string, receivedDateTime string, "
                                 "fromEmailAddress string, toRecipients string, ccRecipients string, comment string, commentBy string, "
                                 "_allow_permissions string")
    comp = spark.createDataFrame([(i, "2024-01-01", "x") for i in range(n)], "row_seq long, commentDate string, component string")
    people = spark.createDataFrame([("a", "u1", "A"), ("b", "u2", "B")], PEOPLE)
    whole = {r.conversation_id: r for r in team_conversations(msgs, comp, people, page_size=None).collect()}
    df = team_conversations(msgs, comp, people, page_size=7)
    paged = {}
    for r in sorted(df.collect(), key=lambda r: (r.conversation_id, r.page)):
        assert len(r.replies) <= 7 and r.message == whole[r.conversation_id].message
        paged.setdefault(r.conversation_id, []).append(r)
    assert {k: [x for r in v for x in r.replies] for k, v in paged.items()} == {k: r.replies for k, r in whole.items()}
    assert {k: [r.page for r in v] for k, v in paged.items()} == {"0": list(range(6)), "1": [0, 1]}
    assert [x.id for x in whole["0"].replies] == [str(i) for i in range(1, 40)]
    # wide rows: one exchange by conversation and page
    p = plan_of(team_conversations(msgs, comp, people, page_size=None))
    assert p.count("hashpartitioning(conversation_id") == 1


def test_date_clean_reads_each_table_once(spark, tmp_path):
    """the orders were read once for every form they are written in."""
    import __spark_entry__ as E
    d = str(tmp_path)
    spark.sql("SELECT id AS o_orderkey, timestamp'2024-03-05 10:00:00' AS o_orderdate, '1-URGENT' AS o_orderpriority FROM range(3)"
              ).write.parquet(d + "/orders.parquet")
    spark.sql("SELECT id AS l_orderkey, 1 AS l_linenumber, timestamp'2024-03-05 10:00:00' AS l_shipdate FROM range(3)"
              ).write.parquet(d + "/lineitem.parquet")
    df = E.queries()["date_clean"](spark, d)
    assert plan_of(df).count("FileScan") == 2
    got = {(r.source, r.k1): r.clean for r in df.collect()}
    assert len(got) == 21 * 3
    assert {s for (s, _), c in got.items() if c is None} == {"priority", "left_over"}


def test_dates_at_the_edges_of_the_grammar(spark):
    """what the cheap tests before each pattern must not let slip."""
    from kenning.functions.dates import date_clean
    cases = {"5 sept 2024": "2024-09-05T00:00:00Z", "5 an 2024": None, "5 anf 2024": None, "5 janx 2024": None, "5 JANUAR 2024": "2024-01-05T00:00:00Z",
             "20240305": "2024-03-05T00:00:00Z", "20240305T1011": "2024-03-05T10:11:00Z", "2024-03-05 10am": "2024-03-05T10:00:00Z",
             "2024-03-05 10 P.M.": "2024-03-05T22:00:00Z", "2024-03-05 10:11:12.5 -0130": "2024-03-05T11:41:12Z", "2024-03-05 10:11 (x)": "2024-03-05T10:11:00Z",
             "2024-03-05 10:11\x01": None, "2024-03-05 \x0110:11": None, "2024-03-05 25:00": None, "2024-03-05 13 pm": None, "5th of March 2024": "2024-03-05T00:00:00Z",
             "Tue, 5 Mar 2024 10:00 EST": "2024-03-05T15:00:00Z", "10:00 2024-03-05": "2024-03-05T10:00:00Z", "": None, "2024-02-30": None, None: None}
    rows = spark.createDataFrame([(v,) for v in cases], "v string").select("v", date_clean("v").alias("c")).collect()
    assert {r.v: r.c for r in rows} == cases
