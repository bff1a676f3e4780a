"""Dictionary matching and span selection, including a brute-force check of the
longest non-overlapping span rule."""

import random

from kenning.operators import extract as ext
from kenning.operators import gazetteer as gz

G = [
    ("PROG_SCRIPT_LANG", "c++", None, False, False, 1),
    ("PROG_SCRIPT_LANG", "c#", None, False, False, 1),
    ("PROG_SCRIPT_LANG", "objective-c", None, False, False, 1),
    ("OS", "windows", None, False, True, 5),
    ("TOPICS", "{gpu|gfx}", "gpu", False, False, 2),
    ("TOPICS", "graphics processing unit", "gpu", False, False, 2),
    ("TOPICS", "secure vault", None, False, False, 2),
    ("COMPONENTS", "secure", None, False, False, 4),
    ("TEAMS", "core team?", None, False, False, 6),
    ("PEOPLE", "Core", "core", True, False, 3),
]


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_expand_rules(spark):
    gx = gz.expand(gz.from_rows(spark, G))
    keys = rows(gx, "category", "key")
    assert ("TOPICS", "gpu") in keys and ("TOPICS", "gfx") in keys
    assert ("TOPICS", "graphics processing unit") in keys
    assert ("TEAMS", "core team") in keys and ("TEAMS", "core") in keys
    assert ("PROG_SCRIPT_LANG", "c + +") in keys


def test_punctuation_phrases_and_versions(spark):
    docs = spark.createDataFrame([(1, "We write C++, c# and Objective-C on Windows10 and windows 10 and WINDOWS.")],
                                 "doc_id long, text string")
    got = rows(ext.entities(docs, gz.from_rows(spark, G)), "category", "value")
    assert got == [("OS", "WINDOWS"), ("OS", "Windows10"), ("OS", "windows 10"), ("PROG_SCRIPT_LANG", "C++"),
                   ("PROG_SCRIPT_LANG", "Objective-C"), ("PROG_SCRIPT_LANG", "c#")]


def test_longest_wins_and_priority(spark):
    docs = spark.createDataFrame([(1, "the secure vault and the secure door; Core team met, core met")],
                                 "doc_id long, text string")
    got = rows(ext.entities(docs, gz.from_rows(spark, G)), "start", "category", "value")
    # 'secure vault' beats 'secure'; 'Core team' (2 tokens) beats 'Core' (PEOPLE, case-sensitive);
    # lone 'core' is TEAMS (case-insensitive), 'Core' alone would be PEOPLE by priority
    assert got == [(2, "TOPICS", "secure vault"), (6, "COMPONENTS", "secure"), (9, "TEAMS", "Core team"),
                   (13, "TEAMS", "core")]


def test_case_sensitive_priority(spark):
    docs = spark.createDataFrame([(1, "Core")], "doc_id long, text string")
    got = rows(ext.entities(docs, gz.from_rows(spark, G)), "category", "value")
    assert got == [("PEOPLE", "Core")]


def _greedy(spans):
    kept = []
    for s in sorted(spans, key=lambda x: (-x[1], x[0], x[2], x[3])):
        if all(not (a[0] < s[0] + s[1] and s[0] < a[0] + a[1]) for a in kept):
            kept.append(s)
    return sorted(kept)


def test_longest_spans_brute_force(spark):
    rnd = random.Random(7)
    data = []
    for doc in range(30):
        for _ in range(rnd.randint(0, 25)):
            start, n = rnd.randint(1, 40), rnd.randint(1, 4)
            cat = rnd.choice(["A", "B", "C"])
            data.append((doc, start, n, cat, ord(cat), "x"))
    m = spark.createDataFrame(data, "doc_id long, start int, n_tokens int, category string, priority int, value string") \
        .dropDuplicates(["doc_id", "start", "n_tokens", "category"])
    m = m.withColumn("canonical", m["value"])
    got = {}
    for r in ext.longest_spans(m).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["n_tokens"], r["priority"], r["category"]))
    exp = {}
    for r in m.collect():
        exp.setdefault(r["doc_id"], []).append((r["start"], r["n_tokens"], r["priority"], r["category"]))
    for doc, spans in exp.items():
        assert sorted(got.get(doc, [])) == _greedy(spans)
        kept = sorted(got.get(doc, []))
        for i, a in enumerate(kept):          # property: kept spans never overlap
            for b in kept[i + 1:]:
                assert not (a[0] < b[0] + b[1] and b[0] < a[0] + a[1])


def test_mail_entities_known_only(spark):
    docs = spark.createDataFrame([(1, "ask ana.lima@acme.test or zed@other.test")], "doc_id long, text string")
    known = spark.createDataFrame([("ana.lima@acme.test",)], "address string")
    got = rows(ext.mail_entities(docs, known=known), "value", "category")
    assert got == [("ana.lima@acme.test", "EMAIL")]


def test_optional_punctuation_rule(spark):
    g = gz.from_rows(spark, [("PROG_SCRIPT_LANG", "objective -? c", "objective-c", False, False, 1)])
    docs = spark.createDataFrame([(1, "objective-c and Objective C and objective - c")], "doc_id long, text string")
    got = rows(ext.entities(docs, g), "value", "canonical")
    assert got == [("Objective C", "objective-c"), ("objective - c", "objective-c"), ("objective-c", "objective-c")]


def test_lone_question_mark_is_literal(spark):
    keys = sorted(r.key for r in gz.expand(gz.from_rows(spark, [("TOPICS", "why ?", None, False, False, 1)])).collect())
    assert keys == ["why ?"]


def test_term_met_by_token_and_by_stripped_name_is_one_match(spark):
    from kenning.operators import extract, gazetteer
    rows = [("OS", "mail", "mail", False, True, 1), ("OS", "mail5", "mail", False, False, 1), ("OS", "Mail5", "mail", True, False, 1),
            ("OS", "mail 5", "mail", False, False, 1), ("TOPICS", "mail5", None, False, False, 2)]
    docs = spark.createDataFrame([(1, "mail5 MAIL5 mail 5 mail")], "doc_id int, text string")
    got = sorted((r.start, r.n_tokens, r.category, r.canonical, r.value)
                 for r in extract.match(docs, gazetteer.from_rows(spark, rows)).collect())
    assert got == [(1, 1, "OS", "mail", "mail5"), (1, 1, "TOPICS", "mail5", "mail5"), (2, 1, "OS", "mail", "MAIL5"),
                   (2, 1, "TOPICS", "mail5", "MAIL5"), (3, 1, "OS", "mail", "mail"), (3, 2, "OS", "mail", "mail 5"),
                   (5, 1, "OS", "mail", "mail")]


def test_spans_of_one_very_long_document(spark):
    from kenning.operators import extract, gazetteer
    rows = [("A", "red green", None, False, False, 1), ("B", "green blue", None, False, False, 2), ("C", "blue", None, False, False, 3)]
    docs = spark.createDataFrame([(1, "red green blue grey " * 30000)], "doc_id int, text string")
    spans = extract.entities(docs, gazetteer.from_rows(spark, rows))
    assert {(r.category, r["count"]) for r in spans.groupBy("category").count().collect()} == {("A", 30000), ("C", 30000)}
