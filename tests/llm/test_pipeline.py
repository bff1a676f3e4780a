"""The pipeline's stages against plain Python on the given table and on odd rows; oracles."""

from collections import Counter
from zlib import crc32

import __spark_entry__ as E
import corpus_pipeline as P
import numpy as np
import pytest
from llm_cases import SF
from kenning.llm import quality
from kenning.llm.common import known_tables
from kenning.llm.queries import ORACLE, QUERIES, tokenizer_path
from oracle_harness import compare, duck
from tokenizers import Tokenizer
from test_dedup import brute_components, simhash_brute, substring_brute


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(lspark, name):
    info = compare(lspark, duck(SF), name, QUERIES[name], ORACLE[name], SF)
    assert info["ok"], info


def test_registered():
    assert {"pipeline", *QUERIES} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "substring_dedup", "packing"]


def check_pieces(pieces, rows):
    """Every id of every document lies in exactly one piece, sequences are gapless and padded little."""
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    ids = Counter()
    for i, t in rows:
        whole = tok.encode(t or "", add_special_tokens=False).ids + [0]
        ids.update((i, len(whole), p) for p in range(len(whole)))
    assert Counter((r.doc_id, r.doc_tokens, r.start + p) for r in pieces for p in range(r.length)) == ids
    places = {}
    for r in pieces:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    by_doc = {i: [crc32(np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes())] for i, t in rows}
    assert all(r.ids_crc32 in by_doc[r.doc_id] for r in pieces if r.length == r.doc_tokens and list(i for i, _ in rows).count(r.doc_id) == 1)


def test_stages_against_plain_python(lspark):
    docs = lspark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(docs, quality.not_held_out(lspark.read.parquet(f"{SF}/labels.parquet")))
    words = quality._Words()
    rows = [(r.doc_id, r.text) for r in docs.collect() if model.score((r.text or "").encode(), words) >= 0.5]
    best = {}
    for i, t in rows:
        k = "".join((t or "").encode().decode().translate({ord(c): None for c in " \t\n\x0b\x0c\r"}))
        best[k] = min(best.get(k, (1, 0, None)), (-len(t or ""), i, t), key=lambda x: x[:2])
    rows = sorted((i, t) for _, i, t in best.values())
    comp = brute_components([simhash_brute(t) for _, t in rows])
    rows = [r for k, r in enumerate(rows) if comp[k] == k]
    want = {i: (kept if gone else t) for (i, t), (_, _, gone, kept) in zip(rows, substring_brute(rows))}
    frame = docs
    for _, stage in P.STAGES[:-1]:
        frame = stage(lspark, frame, SF)
        assert frame.columns == docs.columns
    assert {r.doc_id: r.text for r in frame.collect()} == want
    pieces = P.run(lspark, SF).collect()
    check_pieces(pieces, want.items())


def test_stages_on_odd_rows(lspark, docs, empty):
    for frame in (docs, empty):
        for _, stage in P.STAGES[:-1]:
            out = stage(lspark, frame, SF)
            assert out.columns == docs.columns
            frame = out
        check_pieces(P.STAGES[-1][1](lspark, frame, SF).collect(), [(r.doc_id, r.text) for r in frame.collect()])


def test_stage_tables_do_not_pile_up(lspark):
    before = known_tables()
    out = P.run(lspark, SF)
    left = known_tables() - before
    assert len(left) == 1 and out.count() > 0  # what the last stage reads
