"""One-or-more rules against every stretch of every text; a state whose untouched buckets stay."""
import glob
import os
import random
import re

import pytest

from kenning.operators import extract as ext
from kenning.operators import gazetteer as gz
from kenning.sinks import writers as W

RULES = ["{a}+", "{a}+ b", "b {a}+", "{a|c}+ b", "a {a}+ b", "b {a}+ c? b", "a a {b}+ a a", "{b}+ {c}+"]


def brute(rule, tokens):
    """(start, length) of the stretches that the rule spells, none inside another."""
    words = rule.split()

    def spells(part):
        def fit(w, p):
            if not w:
                return not p
            several, opt = w[0].endswith("}+"), w[0].endswith("?")
            for x in w[0].strip("{}+?").split("|"):
                n = 0
                while n < len(p) and p[n] == x:
                    n += 1
                    if fit(w[1:], p[n:]):
                        return True
                    if not several:
                        break
            return opt and fit(w[1:], p)
        return fit(words, part)

    found = [(i, j - i) for i in range(len(tokens)) for j in range(i + 1, len(tokens) + 1) if spells(tokens[i:j])]
    return {(i, n) for i, n in found if not any((k, m) != (i, n) and k <= i and i + n <= k + m for k, m in found)}


@pytest.mark.parametrize("rule", RULES)
def test_rules_with_repeated_words(spark, rule):
    rng = random.Random(rule)
    texts = [["b", *["a"] * n, "b"] for n in range(1, 21)]
    texts += [[rng.choice("aab" if rng.random() < 0.7 else "abc") for _ in range(rng.randint(0, 14))] for _ in range(60)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id int, text string")
    got = {}
    for r in ext.match(df, gz.from_rows(spark, [("C", rule, "x", False, False, 1)])).collect():
        assert " ".join(texts[r.doc_id][r.start - 1:r.start - 1 + r.n_tokens]) == r.value
        got.setdefault(r.doc_id, set()).add((r.start - 1, r.n_tokens))
    for i, t in enumerate(texts):
        # the longest spans of both agree (a place may have several matches)
        spans = got.get(i, set())
        assert {(s, n) for s, n in spans if not any((k, m) != (s, n) and k <= s and s + n <= k + m for k, m in spans)} == brute(rule, t)


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    root, n = str(tmp_path / "state"), 8
    schema = "user_id string, value string, frequency bigint"
    first = spark.createDataFrame([(f"u{i}", f"v{j}", 1) for i in range(40) for j in range(3)], schema)
    W.write_buckets(spark, first, root, "1", "s:1", range(n), n)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{root}/version=*/bucket=*/*.parquet")}
    users = ["u1", "u2", "new"]
    touched = [r[0] for r in spark.createDataFrame([(u,) for u in users], "u string").select(W.bucket_of("u", n)).distinct().collect()]
    part = W.read_buckets(spark, root, touched)
    assert part.where("user_id = 'u1'").count() == 3 and part.count() < first.count()
    merged = part.unionByName(spark.createDataFrame([(u, "w", 5) for u in users], schema)).checkpoint()
    W.write_buckets(spark, merged, root, "2", "s:2", touched, n)
    assert {f: os.path.getmtime(f) for f in before} == before
    assert {int(re.search(r"bucket=(\d+)", f)[1]) for f in glob.glob(f"{root}/version=2/bucket=*/*.parquet")} == set(touched)
    now = spark.read.parquet(W.current_state_path(spark, root))
    assert now.columns == first.columns
    assert sorted(map(tuple, now.collect())) == sorted([*map(tuple, first.collect()), *[(u, "w", 5) for u in users]])
    assert W.applied(spark, root, "s:2") and W.state_buckets(spark, root) == n
    assert W.read_buckets(spark, str(tmp_path / "none"), [1]) is None


def test_stream_rewrites_only_the_buckets_of_a_batch(spark, tmp_path):
    from kenning import config
    from kenning.streaming.profile_stream import merge_batch
    import dataclasses
    import datetime
    cfg = dataclasses.replace(config.TENANT_A, domains=("@example.com",), as_of=datetime.date(2024, 2, 1))
    g = gz.from_rows(spark, [("TOPICS", "budget", None, False, False, 1)])
    d = spark.createDataFrame([], "sub_id string, email_id string, user_name string, ord int")
    root = str(tmp_path / "state")

    def batch(epoch, *people):
        msg = [{"conversation_id": "c", "id": f"{epoch}-{p}", "subject": "s", "body": "the budget", "date": "2024-01-05",
                "from_email": f"{p}@example.com", "to_recipients": [], "cc_recipients": []} for p in people]
        import json
        text = spark.createDataFrame([(json.dumps({"c": msg}), f"f{epoch}")], "value string, batch_id string")
        merge_batch(spark, text, epoch, g, d, cfg, "a", root, stream="s")

    batch(0, *[f"person{i}" for i in range(30)])
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{root}/version=*/bucket=*/*.parquet")}
    batch(1, "person1", "another")
    batch(1, "person1", "another")                       # replayed: skipped
    assert {f: os.path.getmtime(f) for f in before} == before
    new = glob.glob(f"{root}/version=s-00000001/bucket=*")
    assert 1 <= len(new) <= 2
    rows = {r.user_id: r.frequency for r in spark.read.parquet(W.current_state_path(spark, root)).collect()}
    assert rows == {f"person{i}@example.com": 1 + (i == 1) for i in range(30)} | {"another@example.com": 1}
