"""Exact dedup, SimHash and substring dedup against brute force."""

import hashlib
import itertools
from collections import Counter

import xxhash
from llm_cases import SF
from kenning.llm import exact_dedup as E
from kenning.llm import simhash as S
from kenning.llm import substring as B
from kenning.llm.components import connected_components

LAST = float("inf")


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_exact_dedup(docs):
    norm = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    groups = {}
    for i, t in rows_of(docs):
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i or 0, i))
    want = Counter()
    for t, members in groups.items():
        members.sort(key=lambda m: m[:3])
        for k, m in enumerate(members):
            want[m[3], members[0][3], len(members), k == 0, hashlib.sha256(t.encode()).hexdigest()] += 1
    got = Counter(map(tuple, E.exact_dedup(docs, digest="sha").collect()))
    assert got == want


def test_drop_exact_duplicates_keeps_one_whole_row(docs):
    out = E.drop_exact_duplicates(docs)
    assert out.columns == docs.columns
    kept = Counter(r.doc_id for r in out.collect())
    want = Counter(r.doc_id for r in E.exact_dedup(docs).where("kept").collect())
    assert kept == want
    assert {r.kept for r in out.collect()} == {"clash"}


def simhash_brute(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    w = min(width, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + w]), 42) for i in range(len(words) - w + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """Fingerprint list -> index of component representative per entry."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(range(len(fps)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 2:
            root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(len(fps))]


def check_simhash(df):
    rows = rows_of(df)
    fps = [simhash_brute(t) for _, t in rows]
    comp = brute_components(fps)
    low = {}
    for (i, _), c in zip(rows, comp):
        low[c] = min(low.get(c, LAST), LAST if i is None else i)
    want = Counter((i, f"{f:016x}", None if low[c] == LAST else low[c]) for (i, _), f, c in zip(rows, fps, comp))
    assert Counter(map(tuple, S.simhash_groups(df).collect())) == want


def test_simhash_groups(docs):
    check_simhash(docs)


def test_simhash_on_the_given_table(lspark):
    check_simhash(lspark.read.parquet(f"{SF}/documents.parquet"))


def test_links_find_every_pair_and_only_those(lspark):
    base = [xxhash.xxh64_intdigest(str(i)) for i in range(40)]
    fps = set(base)
    for b in base:
        for i, j in ((0, 1), (0, 63), (15, 16), (31, 47), (20, 20), (5, 40)):
            fps |= {b ^ (1 << i), b ^ (1 << i) ^ (1 << j), b ^ (1 << i) ^ (1 << j) ^ (1 << 33)}
    signed = {f - (1 << 64) if f >> 63 else f for f in fps}
    got = {frozenset((r.a, r.b)) for r in S.links(lspark.createDataFrame([(f,) for f in signed], "fp bigint")).collect()}
    mask = (1 << 64) - 1
    want = {frozenset((a, b)) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & mask).bit_count() <= 2}
    assert got == want


def test_drop_near_duplicates_keeps_one_of_each_component(docs):
    out = S.drop_near_duplicates(E.drop_exact_duplicates(docs))
    assert out.columns == docs.columns
    fps = [simhash_brute(t) for _, t in rows_of(out)]
    assert len(set(brute_components(fps))) == len(fps)
    assert {r[c] for r in out.collect() for c in docs.columns[3:]} == {"clash"}


def test_components_of_a_path_and_a_star(lspark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in connected_components(lspark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)}


def substring_brute(rows, window=50):
    first = {}
    words = [(LAST if i is None else i, i, (t or "").encode().split()) for i, t in rows]
    for k, _, w in words:
        for p in range(len(w) - window + 1):
            s = b" ".join(w[p:p + window])
            first[s] = min(first.get(s, LAST), k)
    for k, i, w in words:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[b" ".join(w[p:p + window])] < k:
                gone[p:p + window] = [True] * window
        yield i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()


def test_substring_dedup(docs):
    got = B.substring_dedup(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == Counter(substring_brute(rows_of(docs)))
    for r in got:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))  # maximal: neighbours do not touch


def test_substring_dedup_short_windows(docs):
    got = B.substring_dedup(docs, window=7, gram=3).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == Counter(substring_brute(rows_of(docs), 7))


def test_remove_repeats_keeps_columns_and_untouched_texts(docs):
    out = B.remove_repeats(docs)
    assert out.columns == docs.columns
    brute = Counter((i, kept if gone else None) for i, _, gone, kept in substring_brute(rows_of(docs)))
    cut = Counter((r.doc_id, r.text) for r in out.collect())
    for (i, kept), n in brute.items():
        assert kept is None or cut[i, kept] == n
    assert cut[5, None] == 1 and cut[7, " \t\r\n"] == 1


def test_empty_tables(empty):
    assert E.exact_dedup(empty).count() == 0 and E.drop_exact_duplicates(empty).count() == 0
    assert S.simhash_groups(empty).count() == 0 and S.drop_near_duplicates(empty).count() == 0
    assert B.substring_dedup(empty).count() == 0 and B.remove_repeats(empty).count() == 0
