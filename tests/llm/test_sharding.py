"""Extendible hashing: directory against a plain recursion, overflow pages, limits."""

import hashlib
from collections import Counter, defaultdict

import pytest
from kenning.llm.sharding import extendible_shards


def bits(key, text):
    part = lambda v: format(int(hashlib.md5(v.encode()).hexdigest()[:15], 16), "060b")
    return part("" if key is None else str(key)) + part(text or "")


def brute(rows, limit, depth=0, prefix=""):
    size = sum(len((t or "").encode()) for _, t, _ in rows)
    if size <= limit or len(rows) == 1:
        return [(i, prefix, size, len(rows)) for i, _, _ in rows]
    if depth == 120:
        return [(i, None, None, None) for i, _, _ in rows]  # overflow
    sides = defaultdict(list)
    for r in rows:
        sides[r[2][depth]].append(r)
    return [x for s, part in sides.items() for x in brute(part, limit, depth + 1, prefix + s)]


@pytest.mark.parametrize("limit", [100, 700, 5000, 10**9])
def test_shards_match_recursion(docs, limit):
    rows = [(r.doc_id, r.text, bits(r.doc_id, r.text)) for r in docs.select("doc_id", "text").collect()]
    got = extendible_shards(docs, limit).collect()
    want = Counter(brute(rows, limit))
    seen = Counter((r.doc_id, None, None, None) if "-" in r.shard_id else (r.doc_id, r.shard_id, r.shard_bytes, r.shard_rows) for r in got)
    assert seen == want


def test_overflow_pages_hold_the_limit(lspark):
    df = lspark.createDataFrame([(1, "abcdefgh")] * 1000 + [(2, "z")] * 3, "doc_id bigint, text string")
    got = extendible_shards(df, 80).collect()
    assert len(got) == 1003
    per = defaultdict(int)
    for r in got:
        per[r.shard_id] += r.n_bytes
    assert max(per.values()) <= 80 and all(per[r.shard_id] == r.shard_bytes for r in got)


def test_empty(empty):
    assert extendible_shards(empty, 10).count() == 0
    with pytest.raises(ValueError):
        extendible_shards(empty, 0)
