"""Periodic runs against every period tried on every text."""
import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from llm_cases import SF

from kenning.llm import periodic_runs as P
from kenning.llm.queries import op13_periodic_runs


def brute_runs(w, least=24):
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, 3 * q):
                part = w[i:i + length]
                if all(any(x != y for x, y in zip(part, part[d:])) for d in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ")
             .replace("\r", " ").split(" ") if w]
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


COLS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("least", [24, 8, 3])
def test_runs_of_random_texts(least):
    rng = random.Random(least)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 4)):
            w, size = [], rng.randint(0, 200)
            while len(w) < size:
                block = [rng.choice("abcdefgh"[:rng.randint(1, 8)]) for _ in range(rng.randint(1, rng.choice([2, 5, 20, 40])))]
                if rng.random() < 0.3:
                    block = block[:len(block) // 2] * 2 + block
                w += (block * rng.randint(1, 7))[:rng.randint(1, 150)]
            texts.append([c.encode() for c in w])
        number = np.concatenate([P.number_words(w)[1] for w in texts])
        text_of = np.repeat(np.arange(len(texts)), [len(w) for w in texts])
        first = np.cumsum([0, *map(len, texts)])
        found = [[] for _ in texts]
        for s, length, q in P.find_runs(number, text_of, least):
            found[text_of[s]].append((s - int(first[text_of[s]]), length, q))
        assert found == [brute_runs(w, least) for w in texts]


def test_nested_and_overlapping_runs(lspark):
    inner = "a b " * 13 + "c "
    rows = [(1, inner * 4), (2, "a " * 24), (3, "a " * 23), (4, "x y z " * 8 + "x y"), (5, "p q r s " * 9 + "r s r s r s " * 6),
            (6, "k " * 30 + "l " * 30), (7, None), (8, ""), (9, "\t\n"), (None, "u v " * 40), (None, None), (1, inner * 4),
            (10, "one\ttwo\nthree\x0b" * 20), (11, "nb\xa0sp \u3000 " * 20)]
    rows += [(i, " ".join(f"w{j % 37}" for j in range(i))) for i in range(100, 160)]
    df = lspark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for c in ("id", "runs", "best", "collapsed", "start"):
        df = df.selectExpr("*", f"'clash' as {c}")
    got = [tuple(r) for r in P.digest_columns(P.periodic_runs(df)).select(COLS).collect()]
    assert Counter(got) == Counter(brute_row(*r) for r in rows)
    assert any(r[1] > 1 for r in got)


def test_query_against_brute_force(lspark):
    rows = [(r.doc_id, r.text) for r in lspark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 20000").collect()]
    got = {r.doc_id: tuple(r) for r in op13_periodic_runs(lspark, SF).select(COLS).collect()}
    want = {r[0]: brute_row(*r) for r in rows}
    assert {i: got[i] for i in want} == want
    assert sum(r[1] > 0 for r in want.values()) > 3


def test_very_long_text():
    words = [b"w%d" % (i % 5000) for i in range(200_000)]
    ((_, runs),) = P.runs_of_texts([b" ".join(words)], [None])
    assert runs == [(0, 200_000, 5000)]
    ((_, runs),) = P.runs_of_texts([b"x " * 300_000], [None])
    assert runs == [(0, 300_000, 1)]


def test_parts_do_not_change_results(monkeypatch):
    texts = [(" ".join(f"w{j % q}" for j in range(90))).encode() for q in range(1, 40)] + [b""]
    whole = P.runs_of_texts(texts, list(range(40)))
    monkeypatch.setattr(P, "PART_WORDS", 50)
    cut = [x for s, e in P._parts(texts) for x in P.runs_of_texts(texts[s:e], list(range(40))[s:e])]
    assert whole == cut


def test_empty(empty):
    assert P.digest_columns(P.periodic_runs(empty)).count() == 0
