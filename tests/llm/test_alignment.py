"""Cross-tokenizer alignment against the tokenizers' own libraries and a plain count."""
import hashlib
from collections import Counter

import numpy as np
import pytest
from llm_cases import SF, plain

from kenning.llm import alignment as A
from kenning.llm.queries import op12_alignment, tokenizer_path

BYTE, PIECE = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer
    from kenning.llm.packing import _byte_of_char
    a = Tokenizer.from_file(tokenizer_path(BYTE))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE))
    raw = _byte_of_char()

    def encode(text):
        """[(id, start, end)] per side."""
        if not text:
            return [], []
        ids = a.encode(" " + text, add_special_tokens=False).ids
        left = [(i, bytes(raw[c] for c in a.id_to_token(i))) for i in ids]
        right = [(i, bytes((int(b.id_to_piece(i)[3:5], 16),)) if b.is_byte(i) else b.id_to_piece(i).replace("\u2581", " ").encode())
                 for i in b.encode(text)]
        out = []
        for side in (left, right):
            if b"".join(x for _, x in side) != b" " + text.encode():
                return [], []
            at, spans = 0, []
            for i, x in side:
                spans.append((i, at, at + len(x)))
                at += len(x)
            out.append(spans)
        return tuple(out)
    return encode


def brute(rows, encode):
    docs, count = [], Counter()
    for i, text in rows:
        a, b = encode(text)
        links = []
        j = 0
        for x, s, e in a:  # spans are in order: skip what ends before
            while j < len(b) and b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                links.append((x, b[k][0]))
                k += 1
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, ia, ib = [], 0, 0
        for end in ends:
            ga, gb = [], []
            while ia < len(a) and a[ia][2] <= end:
                ga.append(a[ia][0])
                ia += 1
            while ib < len(b) and b[ib][2] <= end:
                gb.append(b[ib][0])
                ib += 1
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        docs.append((i, len(a), len(b), groups, links))
        count.update(links)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    return [(i, n_a, n_b, len(groups), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "") for i, n_a, n_b, groups, links in docs], count, best


COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["", None, " ", "  two  blanks ", "tab\tline\n\nend\r\n", "\u2581 spelt", "a\u2581b", "<s> </s> <unk> <0x41> <|endoftext|>", "\x00nul",
       "ﬁ½ é e\u0301 \u3000 \xa0x", "漢字かな交じり文 👩‍👩‍👧 emoji", "don't can't 'll", "x" * 5000, "12345678901234567890", "naïve façade — “quotes”…"]


def test_odd_texts_against_brute_force(lspark, encoders, docs):
    rows = [(n, t) for n, t in enumerate(ODD)] + [(3, "same id"), (3, "same id"), (None, "no id"), (None, None)]
    df = lspark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for c in ("id", "row_key", "slice", "radix", "pairs", "n_a", "best"):
        df = df.selectExpr("*", f"'clash' as {c}")
    got = [tuple(r) for r in A.align_documents(df, tokenizer_path(BYTE), tokenizer_path(PIECE)).select(COLS).collect()]
    assert Counter(got) == Counter(brute(rows, encoders)[0])
    rows = plain(docs)
    got = [tuple(r) for r in A.align_documents(docs, tokenizer_path(BYTE), tokenizer_path(PIECE)).select(COLS).collect()]
    assert Counter(got) == Counter(brute(rows, encoders)[0])


def test_query_against_brute_force(lspark, encoders):
    rows = plain(lspark.read.parquet(f"{SF}/documents.parquet"))
    want, count, best = brute(rows, encoders)
    assert Counter(tuple(r) for r in op12_alignment(lspark, SF).select(COLS).collect()) == Counter(want)
    pairs = A.pair_counts(lspark.read.parquet(f"{SF}/documents.parquet"), tokenizer_path(BYTE), tokenizer_path(PIECE)).collect()
    assert {(r.a, r.b): (r["count"], r.best) for r in pairs} == {p: (n, n == best[p[1]]) for p, n in count.items()}


def test_runs_and_levels(lspark, encoders, monkeypatch):
    """Small runs, merges of two slices at a time and totals too large to broadcast."""
    monkeypatch.setattr(A, "RUN_LINKS", 500)
    monkeypatch.setattr(A, "PART_BYTES", 2000)
    monkeypatch.setattr(A, "FAN_IN", 2)
    monkeypatch.setattr(A, "SMALL", 0)
    df = lspark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60").repartition(5, "doc_id")
    got = A.align_documents(df, tokenizer_path(BYTE), tokenizer_path(PIECE), with_groups=True).collect()
    want = brute(plain(df), encoders)[0]
    assert Counter(tuple(r[c] for c in COLS) for r in got) == Counter(want)
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in got if r.n_a)


def test_spill_and_merge():
    rng = np.random.default_rng(3)
    runs, want = [], Counter()
    for _ in range(5):
        a, b, doc = rng.integers(0, 50000, 4000) // 1000, rng.integers(0, 32000, 4000) // 500, rng.integers(0, 9, 4000)
        keys = A.pair_key(a, b)
        assert all((x == y).all() for x, y in zip(A.pair_of(keys), (a, b)))
        want.update(keys.tolist())
        runs.append(list(A.spill(keys.astype(np.uint64) << np.uint64(32) | doc.astype(np.uint64))))
    got = {}
    for radix in {r for run in runs for r, *_ in run}:
        keys, total = A.merge_runs([p for run in runs for r, p, _ in run if r == radix])
        assert (np.diff(keys.astype(np.int64)) > 0).all()
        best = A.mark_best(keys, total)
        top = Counter()
        for k, n in zip(keys.tolist(), total.tolist()):
            top[k >> 16] = max(top[k >> 16], n)
        assert best.tolist() == [n == top[k >> 16] for k, n in zip(keys.tolist(), total.tolist())]
        got.update(zip(keys.tolist(), total.tolist()))
    assert got == dict(want)


def test_empty(empty):
    out = A.align_documents(empty, tokenizer_path(BYTE), tokenizer_path(PIECE))
    assert out.columns == COLS and out.count() == 0
