"""One document, name, surname or user that holds much of the data."""
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from kenning.operators import directory as dirops
from kenning.operators import extract as ext
from kenning.operators import profile as prof


def plan(df):
    return df._jdf.queryExecution().toString()


def spans(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, start bigint, n_tokens int, category string, priority int, canonical string, value string")


def greedy(rows):
    """Longest first, each against all kept ones."""
    out = []
    for doc in {r[0] for r in rows}:
        kept = []
        for r in sorted((r for r in rows if r[0] == doc), key=lambda r: (-r[2], r[1], r[4], r[3], r[5], r[6])):
            if all(r[1] + r[2] <= k[1] or k[1] + k[2] <= r[1] for k in kept):
                kept.append(r)
        out += kept
    return sorted(map(str, out))


def test_chain_of_overlapping_spans(spark):
    n = 100_000
    rows = [("chain", i, 2, "C", 1, "c", "c") for i in range(n)] + [("next", 5, 3, "C", 1, "c", "c")]
    t0 = time.time()
    got = sorted(r.start for r in ext.longest_spans(spans(spark, rows)).where("doc_id = 'chain'").collect())
    assert got == list(range(0, n, 2))
    assert time.time() - t0 < 60


def test_random_spans_over_small_batches(spark):
    rng = random.Random(5)
    rows = []
    for d in range(40):
        for _ in range(rng.randint(1, 120)):
            rows.append((rng.choice([f"d{d}", None]) if d % 7 == 0 else f"d{d}", rng.randint(0, 150), rng.randint(1, 5),
                         rng.choice("AB"), rng.randint(1, 2), rng.choice("xy"), "v"))
    rows = list(set(rows))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    for size in ("1", "7", "10000"):
        spark.conf.set(key, size)
        got = sorted(str((r.doc_id, r.start, r.n_tokens, r.category, r.priority, r.canonical, r.value))
                     for r in ext.longest_spans(spans(spark, rows)).collect())
        assert got == greedy(rows)
    spark.conf.set(key, before)
    assert ext.longest_spans(spans(spark, rows[:1]).limit(0)).count() == 0


def test_surname_of_a_third(spark, monkeypatch):
    monkeypatch.setattr(dirops._first_hits, "__defaults__", (50,))
    rng = random.Random(2)
    first = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(400)]
    people = [(i, f"u{i}", f"{first[i % 400]} {'smith' if i % 3 == 0 else first[(i * 7) % 400]}") for i in range(900)]
    names = [(f"{first[i]} smith",) for i in range(150)] + [("smith",), ("smith smith",), ("nobody smith",), ("smi",), (None,)]
    directory = spark.createDataFrame(people, "ord int, sub_id string, user_name string").withColumn("email_id", F.col("sub_id"))
    known = spark.createDataFrame([("zz.smith@x.org",), ("nobody.smith@x.org",)], "address string")
    seen = []
    sent = spark.createDataFrame([], "s string").__class__.join

    def spy(self, other, on=None, how=None):
        out = sent(self, other, on, how) if how else sent(self, other, on)
        if isinstance(on, list) and on == ["s", "_slot"]:
            seen.append(other)
        return out
    monkeypatch.setattr(type(directory), "join", spy)
    got = {r.value: r.name_id for r in dirops.resolve_names(spark.createDataFrame(names, "value string"), directory, known).collect()}
    monkeypatch.undo()

    def want(name):
        w = name.lower().split()[:2]
        for _, sub, user in people:
            if all(x in user for x in w):
                return sub
        for a in ("nobody.smith@x.org", "zz.smith@x.org"):
            if all(x in a.split("@")[0].split(".") for x in w):
                return a
        return name
    assert got == {n: want(n) for (n,) in names if n}
    slots = seen[0].groupBy("s", "_slot").count()
    assert slots.where("s = 'smith'").count() >= 6
    assert slots.agg(F.max("count")).first()[0] < 2 * 50  # 300 rows hold the surname


def test_short_name_of_a_third(spark):
    names = [("g", "A")] + [("g", f"A{'x' * (i % 50)} {i}") for i in range(3000)] + [("g", f"B{i}") for i in range(50)] + [("h", "A")]
    df = dirops.complete_names(spark.createDataFrame(names, "grp string, value string"), ["grp"])
    got = {(r.grp, r.value): r.completed for r in df.collect()}

    def want(g, x):
        ys = [y for h, y in names if h == g and (y.startswith(x) or (" " not in x and y.endswith(x)))]
        most = max(map(len, ys))
        return " ".join(sorted({y for y in ys if len(y) == most}))
    assert got == {(g, x): want(g, x) for g, x in names}
    physical = plan(df.select("*")).split("== Physical Plan ==")[1]
    assert "WindowGroupLimit" in physical
    assert len(re.findall(r"Generate explode\(_k", physical)) == 1  # the keys are made once


@pytest.mark.parametrize("k", [3, 2000])
def test_top_k_of_a_hot_user(spark, k):
    rows = [("hot", "C", f"v{i}", i % 977) for i in range(6000)] + [(f"u{i}", "C", "v", 1) for i in range(50)]
    df = prof.top_k(spark.createDataFrame(rows, "user_id string, category string, value string, frequency bigint"), k)
    got = {(r.user_id, r["rank"]): r.value for r in df.collect()}
    order = sorted((r for r in rows if r[0] == "hot"), key=lambda r: (-r[3], r[2]))[:k]
    assert {i: got["hot", i] for i in range(1, k + 1)} == {i + 1: r[2] for i, r in enumerate(order)}
    assert len(got) == k + 50
    if k == 3:
        physical = plan(df).split("== Physical Plan ==")[1]
        assert physical.index("WindowGroupLimit") < physical.index("Exchange") < physical.rindex("WindowGroupLimit")
