"""Classifier, packing, BPE, license scan and HTML extraction."""

import zlib

import numpy as np
import pytest
from llm_cases import plain
from kenning.llm import bpe, license_scan, packing, quality
from kenning.llm.html_extract import extract_main_text, main_text
from kenning.llm.queries import op4_quality, tokenizer_path
from tokenizers import Tokenizer

ODD = ["", "  ", "Hello WORLD's it'll <|endoftext|>x<|startoftext|>", "ΣΑΣ İstanbul é \x1c a\x1fb \x85 \xa0x",
       "日本語 テスト 12345 ½ ²", "a" * 700, "\x00 \x01 don't\t\r\n  re", "ﬁ ǅ ẞ ß", "<|endoftext|><|endoftext|> <|endoftext",
       " ̀ ́a", "🙂👩‍👩‍👧 flag🇩🇪"]


# classifier -----------------------------------------------------------------

def test_classifier_held_out_accuracy(lspark):
    sf = "/root/testdata/sf0.1"
    got = op4_quality(lspark, sf).join(lspark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    good = [r for r in got if r.quality == 1]
    bad = [r for r in got if r.quality == 0]
    assert sum(r.predicted for r in good) / len(good) > 0.98
    assert sum(1 - r.predicted for r in bad) / len(bad) > 0.7
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_score_is_a_sparse_dot_product():
    words = quality._Words()
    slot, value = quality.features("the cat, the cat!! sat".encode(), words)
    assert len(set(slot.tolist())) == len(slot) and abs(value @ value - 1) < 1e-12
    model = quality.Model()
    model.weights[slot] = 1.0
    assert abs(model.score(b"the cat, the cat!! sat", words) - 1 / (1 + np.exp(-value.sum()))) < 1e-6
    assert model.score(b"", words) == 0.5


def test_ftrl_learns_and_keeps_unused_weights_at_zero():
    rows = [(k % 2, np.array([1 + k % 2]), np.array([1.0])) for k in range(200)]
    w = quality.ftrl(rows)
    assert w[1] < 0 < w[2] and not w[3:].any()


def test_training_bound_holdout_and_odd_rows(lspark, docs, empty):
    labels = lspark.createDataFrame([(1, 1), (2, 0), (9, 0), (None, 1), (10, None), (8, 7)], "doc_id bigint, quality int")
    kept = {r.doc_id for r in quality.not_held_out(labels).collect()}
    assert kept == {i for i in (1, 2, 9, 10, 8) if zlib.crc32(str(i).encode()) % 3 != 1}
    model = quality.train(docs, labels)
    out = quality.score(docs, model).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    kept = quality.keep_quality(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.score >= 0.5 for r in out)
    assert quality.score(empty, quality.train(empty, labels)).count() == 0
    assert quality.train(docs, labels.where("quality = 1")).score(b"x", quality._Words()) > 0.5


def plain_model(rows, epochs):
    """Feature hashing and follow-the-regularised-leader, one weight at a time."""
    import math
    import re

    import xxhash

    def vector(text):
        h = [xxhash.xxh3_64_intdigest(t) for w in text.split() for t in re.findall(rb"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff]+", w)]
        pairs = []
        for a, b in zip(h, h[1:]):
            x = (a * 0x9E3779B97F4A7C15 & (1 << 64) - 1) ^ b
            pairs.append(x ^ x >> 31)
        count = {}
        for x in h + pairs:
            slot = (x >> 7) % (quality.SLOTS - 1) + 1
            count[slot] = count.get(slot, 0) + 1
        size = math.sqrt(sum(math.log1p(c) ** 2 for c in count.values()))
        return {s: math.log1p(c) / size for s, c in count.items()}

    z, n = {}, {}

    def weight(i):
        a, rate = z.get(i, 0.0), (quality.BETA + math.sqrt(n.get(i, 0.0))) / quality.ALPHA
        if i == 0:
            return -a / rate
        return 0.0 if abs(a) <= quality.L1 else -(a - math.copysign(quality.L1, a)) / (rate + quality.L2)

    def score(text):
        x = vector(text) | {0: 1.0}
        return 1 / (1 + math.exp(-sum(weight(i) * v for i, v in x.items())))

    for _ in range(epochs):
        for y, text in rows:
            x = vector(text) | {0: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / quality.ALPHA * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return score


def test_classifier_against_plain_loops(lspark):
    sf = "/root/testdata/sf0.001"
    docs = lspark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 3000")
    labels = quality.not_held_out(lspark.read.parquet(f"{sf}/labels.parquet"))
    from pyspark.sql import functions as F
    rows = [(r.quality, (r.text or "").encode()) for r in docs.join(labels.where("quality in (0, 1)"), "doc_id")
            .withColumn("h", F.xxhash64("doc_id")).orderBy("h").collect()]
    assert len({y for y, _ in rows}) == 2
    want = plain_model(rows, quality.EPOCHS)
    got = quality.score(docs, quality.train(docs, labels)).collect()
    texts = dict(plain(docs))
    assert all(abs(r.score - want(texts[r.doc_id].encode())) < 1e-4 for r in got)


# packing --------------------------------------------------------------------

def test_packing_round_trip(docs):
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    got = packing.pack(docs, tokenizer_path("byte_bpe_50k.json"), with_ids=True).collect()
    sequences = {}
    for r in got:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append((r.start, r.doc_tokens, r.ids))
    texts = {}
    for i, t in plain(docs):
        texts.setdefault(i, []).append(tok.encode(t, add_special_tokens=False).ids + [0])
    for i, whole in texts.items():
        want = sorted((p, len(ids), ids[p]) for ids in whole for p in range(len(ids)))
        assert sorted((s + k, n, x) for s, n, ids in pieces[i] for k, x in enumerate(ids)) == want
    lengths = [sum(n for _, n in p) for p in sequences.values()]
    assert sum(map(packing.padding, lengths)) <= 0.03 * sum(lengths) + 64


@pytest.mark.parametrize("seed", range(40))
def test_cuts_are_optimal(seed, monkeypatch):
    """The padding and cut costs of the windows are the least of all ways to cut."""
    rng = np.random.default_rng(seed)
    width = int(rng.choice([1, 4, 8, 16, 20, 64, 100]))
    monkeypatch.setattr(packing, "FORCED_CUT", int(rng.choice([1, 3, 24])))
    lengths = rng.integers(1, 40, rng.integers(1, 12))
    is_end = rng.random(lengths.sum()) < rng.choice([0, 0.05, 0.3])
    cost = packing.cut_costs(lengths, is_end).tolist()
    best = [0]
    for i in range(1, len(cost)):
        best.append(cost[i] + min(best[i - n] + packing.padding(n, width) for n in range(1, min(width, i) + 1)))
    assert packing.window_costs(np.array(cost), width).tolist() == best
    ends = packing.windows(lengths, is_end, width)
    assert sum(packing.padding(e - s, width) + cost[e] for s, e in zip([0, *ends], ends)) == best[-1]


@pytest.mark.parametrize("tokens, sizes", [(1536, [1024, 512]), (2048, [1024, 1024]), (1024, [1024]), (3 * 1024 + 256, [1024] * 3 + [256])])
def test_one_sentence_without_padding(tokens, sizes):
    ends = packing.windows(np.array([tokens]), np.zeros(tokens, bool))
    assert sorted(np.diff([0, *ends]).tolist(), reverse=True) == sizes


def test_very_long_text_and_small_blocks(lspark, monkeypatch):
    """A text of 120,000 ids; blocks that end in the middle of a batch."""
    rows = [(i, f"word{i} and some more. " * (i % 7)) for i in range(300)] + [(999, "pad " * 120_000)]
    df = lspark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    for block in (packing.BLOCK_TOKENS, 3000):
        monkeypatch.setattr(packing, "BLOCK_TOKENS", block)
        got = packing.pack(df, tokenizer_path("byte_bpe_50k.json")).collect()
        held = {}
        for r in got:
            held.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
        assert set(held) == {i for i, _ in rows}
        for parts in held.values():
            at = 0
            for start, length, total in sorted(parts):
                assert start == at and total == parts[0][2]
                at += length
            assert at == parts[0][2]
        sizes = {}
        for r in got:
            sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + r.length
        assert max(sizes.values()) <= 1024 and sum(map(packing.padding, sizes.values())) <= 0.01 * sum(sizes.values()) + 200


def test_windows_cover_everything():
    lengths = np.array([1, 5000, 1, 1, 3, 1024, 2047])
    ends = packing.windows(lengths, np.zeros(lengths.sum(), bool))
    assert ends[-1] == lengths.sum() and max(np.diff([0, *ends])) <= 1024
    assert packing.windows(np.zeros(0, np.int64), np.zeros(0, bool)) == []


def test_second_sentence_end_of_a_stretch():
    """Only a cut at 1,020 makes two windows of 2,044 tokens."""
    is_end = np.zeros(2044, bool)
    is_end[[1008, 1019, 2042]] = True
    assert packing.windows(np.array([2044]), is_end) == [1020, 2044]


def test_packing_empty(empty):
    assert packing.pack(empty, tokenizer_path("byte_bpe_50k.json")).count() == 0


# BPE ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def words():
    return bpe.WordBpe(tokenizer_path("word_bpe_49k.json"))


def test_bpe_matches_the_library(lspark, docs):
    path = tokenizer_path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    given = lspark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = lspark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string")
    df = docs.select("doc_id", "text").union(given).union(odd)
    rows = df.collect()
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), " ".join(map(str, ids)), lib.decode(ids, skip_special_tokens=False)))
    got = bpe.encode_decode(df, path).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_compiled_merges_equal_pair_merges(words):
    for w in ["a", "the", "zzzz", "antidisestablishmentarianism", "naïve", "日本", "x" * 60]:
        assert words.merge(w.encode()) == words.merge_pairs(w.encode())


def test_every_token_is_merged_from_its_own_pair(words):
    """The premise of the compiled merges, for the whole file."""
    for left, right in words.ranks:
        tok = left + right
        parts = list(tok[:-4] if tok.endswith("</w>") else tok)
        if tok.endswith("</w>"):
            parts[-1] += "</w>"
        while len(parts) > 2:
            rank, at = min((words.ranks.get(p, bpe.NO_RANK), i) for i, p in enumerate(zip(parts, parts[1:])))
            assert rank < bpe.NO_RANK
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        assert parts == [left, right]


def test_transducer_is_minimal_and_exact():
    entries = {w.encode(): [n, n + 1] for n, w in enumerate(["tap", "taps", "top", "tops", "stop", "stops", "é", ""])}
    t = bpe.Transducer(bpe.build_transducer(entries))
    assert all(t.get(w) == ids for w, ids in entries.items())
    assert t.get(b"ta") is None and t.get(b"tapsx") is None and t.get(b"x") is None
    # "p", "ps" endings are shared: root, s, st, t, ta/to -> p -> s, and the two of the accent
    assert len(t.final) <= 9
    assert bpe.Transducer(bpe.build_transducer({})).get(b"a") is None


def test_frequent_words_are_cut_at_a_frequency(lspark):
    text = " ".join(w for n, w in enumerate(["the", "of", "and", "a", "b", "c", "once"]) for _ in range([5000, 1500, 40, 7, 7, 7, 1][n]))
    df = lspark.createDataFrame([(text,), (None,), ("",)], "text string")
    for words, want in ((10, {"the", "of", "and", "a", "b", "c"}), (5, {"the", "of", "and"}), (2, {"the", "of"}), (0, set())):
        assert {r.word for r in bpe.frequent_words(df, words=words).collect()} == want


def test_bpe_empty(empty):
    assert bpe.encode_decode(empty, tokenizer_path("word_bpe_49k.json")).count() == 0


# license scan ---------------------------------------------------------------

def test_license_scan_finds_spans(lspark, empty):
    filler = "lorem ipsum dolor sit amet " * 40
    mit = license_scan.TEMPLATES["mit-terms"]
    near = mit.replace("free of charge", "without charge").replace("merge, publish", "merge and publish")
    df = lspark.createDataFrame([
        (1, filler + "Released under the MIT License. " + filler), (2, filler), (3, None), (4, ""),
        (5, filler + near + " " + filler + mit), (6, "licensed UNDER the apache license, version 2.0"),
        (6, "licensed UNDER the apache license, version 2.0"), (None, "Licensed under CC BY-NC 4.0."),
        (7, "This is a license for the public, under no version of the terms."), (8, "x " * 20000 + mit)], "doc_id bigint, text string")
    got = license_scan.license_scan(df.selectExpr("*", "1 as license", "2 as matched")).collect()
    found = sorted((r.doc_id or 0, r.license) for r in got)
    assert found == [(0, "cc-by-nc-4.0"), (1, "mit"), (5, "mit-terms"), (5, "mit-terms"), (6, "apache-2.0"), (6, "apache-2.0"), (8, "mit-terms")]
    one = next(r for r in got if r.doc_id == 1)
    assert (one.first_word, one.end_word, one.coverage) == (200, 205, 1.0)
    assert min(r.coverage for r in got if r.doc_id == 5) >= 0.8
    assert license_scan.license_scan(empty).count() == 0
    assert license_scan.license_scan(df, templates={}).count() == 0


def align(template: list[int], text: list[int], low: int, high: int) -> tuple[int, int, int] | None:
    """(matched words, start, end in ``text``) of the best alignment of a part of the
    template with a part of the text whose diagonals (text minus template position)
    lie in low..high: match +1, anything else -1, never below zero."""
    best, where = 0, None
    above: dict[int, tuple[int, int, int]] = {}  # text position -> (score, matches, start)
    for i, a in enumerate(template):
        row: dict[int, tuple[int, int, int]] = {}
        for j in range(max(0, i + low), min(len(text), i + high + 1)):
            s, m, b = above.get(j - 1, (0, 0, j))
            if s <= 0:
                s, m, b = 0, 0, j
            cell = (s + 1, m + 1, b) if a == text[j] else (s - 1, m, b)
            for side in (above.get(j), row.get(j - 1)):
                if side and side[0] - 1 > cell[0]:
                    cell = (side[0] - 1, side[1], side[2])
            if cell[0] > 0:
                row[j] = cell
                if cell[0] > best:
                    best, where = cell[0], (cell[1], cell[2], j + 1)
        above = row
    return where


def test_license_scan_against_full_alignment(lspark):
    """Every document of the given table: the index misses no template that an
    alignment over the whole text finds."""
    rows = plain(lspark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    index = license_scan.Index(license_scan.TEMPLATES)
    for _, t in rows:
        words = license_scan.words_of(t.encode())
        codes = [index.code.get(w, 0) for w in words]
        got = {x[0] for x in index.scan(t.encode())}
        for k, template in enumerate(index.codes):
            if set(template.tolist()) <= set(codes):
                best = align(template.tolist(), codes, -len(template), len(codes))
                assert not best or best[0] < len(template) or k in got


def all_spans(template, codes):
    """Spans by full alignment of the whole text, again before and after each."""
    best = align(template, codes, -len(template), len(codes))
    if not best or best[0] < license_scan.LEAST * len(template):
        return []
    m, s, e = best
    after = [(x + e, y + e, k) for x, y, k in all_spans(template, codes[e:])]
    return all_spans(template, codes[:s]) + [(s, e, m)] + after


@pytest.mark.parametrize("between", ["", "and", "see also", "one two three", "a b c d e f g h"])
@pytest.mark.parametrize("name", ["mit", "cc-by-4.0", "cc-by-nc-4.0", "cc-by-sa-4.0", "cc0-1.0", "gpl-3.0"])
def test_license_scan_counts_adjacent_notices(name, between):
    index = license_scan.Index(license_scan.TEMPLATES)
    k = index.names.index(name)
    for times in (1, 2, 3, 40):
        text = f" {between} ".join([license_scan.TEMPLATES[name]] * times).encode()
        codes = [index.code.get(w, 0) for w in license_scan.words_of(text)]
        want = all_spans(index.codes[k].tolist(), codes)
        assert len(want) == times
        assert [x[1:] for x in index.scan(text) if x[0] == k] == want


def test_license_scan_repeated_line():
    index = license_scan.Index(license_scan.TEMPLATES)
    got = index.scan(b"Released under the MIT License.\n" * 1000)
    assert [x[1:] for x in got if index.names[x[0]] == "mit"] == [(5 * k, 5 * k + 5, 5) for k in range(1000)]


def test_license_scan_finds_what_full_alignment_finds():
    """Words replaced, inserted or left out at every place of every template: at LEAST of
    the words, the scan has each span that a full alignment has."""
    index = license_scan.Index(license_scan.TEMPLATES)
    rng, lost, seen = np.random.default_rng(3), [], 0
    other = [b"zz", b"the", b"license", b"under"]
    for k, name in enumerate(index.names):
        words = license_scan.words_of(license_scan.TEMPLATES[name].encode())
        texts = [words[:i] + [w] + words[i:] for i in range(len(words) + 1) for w in other]
        texts += [words[:i] + [w] + words[i + 1:] for i in range(len(words)) for w in other]
        texts += [words[:i] + words[i + 1:] for i in range(len(words))]
        for _ in range(30):  # many insertions and replacements
            texts.append([x for w in words for x in ([w] if rng.random() > 0.15 else [b"zz"]) + [b"zz"] * int(rng.random() < 0.25)])
        for text in texts:
            codes = [index.code.get(w, 0) for w in text]
            want = align(index.codes[k].tolist(), codes, -len(words), len(codes))
            if want[0] >= license_scan.LEAST * len(words):
                seen += 1
                got = [x for x in index.scan(b"x y " * 7 + b" ".join(text) + b" x y") if x[0] == k]
                if not any(x[3] >= want[0] for x in got):
                    lost.append((name, text))
    assert seen > 1000 and lost == []


@pytest.mark.parametrize("text, name", [("Licensed under a CC BY 4.0", "cc-by-4.0"), ("Licensed under the Apach License, Version 2.0", "apache-2.0")])
def test_license_scan_one_wrong_word(text, name):
    index = license_scan.Index(license_scan.TEMPLATES)
    assert name in [index.names[x[0]] for x in index.scan(text.encode())]


def long_templates(count=8, words=3000, vocabulary=900):
    """Full-length templates of one vocabulary, sharing stretches with each other."""
    rng = np.random.default_rng(11)
    shared = [f"t{x}" for x in rng.zipf(1.3, 400) % vocabulary]
    return {f"long{k}": " ".join(["t%d" % x for x in rng.zipf(1.3, words - 400) % vocabulary][:words // 2] + shared
                                 + ["t%d" % x for x in rng.zipf(1.3, words) % vocabulary][:words - 400 - words // 2]) for k in range(count)}


def changed(words, share, rng, other):
    out = []
    for w in words:
        x = rng.random()
        out += [] if x < share / 3 else [other(), w] if x < 2 * share / 3 else [other()] if x < share else [w]
    return out


def test_full_length_templates():
    """Licences of 3,000 words, verbatim, changed and twice, among words of their own kind."""
    templates = long_templates()
    index, rng = license_scan.Index(templates), np.random.default_rng(4)
    noise = lambda: "t%d" % (rng.zipf(1.3) % 900)
    for k, name in enumerate(index.names):
        words = templates[name].split()
        near = changed(words, 0.12, rng, noise)
        text = [noise() for _ in range(700)] + words + [noise() for _ in range(50)] + near + [noise() for _ in range(300)]
        got = [x[1:] for x in index.scan(" ".join(text).encode()) if x[0] == k]
        assert len(got) == 2 and got[0] == (700, 3700, 3000)
        s, e, matched = got[1]
        assert abs(s - 3750) < 30 and abs(e - 3750 - len(near)) < 30 and 0.8 * 3000 <= matched < 3000
        codes = np.array([index.code.get(w.encode(), 0) for w in near], np.uint64)
        banded = license_scan.best_ends(index.codes[k], codes, -800, 800)
        assert (banded.max() == license_scan.best_ends(index.codes[k], codes).max())
    # words of the same kind without a licence: nothing is aligned
    text = " ".join(noise() for _ in range(8000)).encode()
    codes = np.array([index.code.get(w, 0) for w in license_scan.words_of(text)], np.uint64)
    assert index.scan(text) == [] and sum(1 for _ in index.chains(codes)) <= len(templates)


def test_a_fifth_of_a_long_template_may_differ():
    """Every fifth word wrong leaves runs of four: still found."""
    templates = long_templates(3, 500)
    index = license_scan.Index(templates)
    for k, name in enumerate(index.names):
        words = templates[name].split()
        text = " ".join("zz" if i % 5 == 4 else w for i, w in enumerate(words))
        assert [x for x in index.scan(f"a b {text} c d".encode()) if x[0] == k and x[3] >= 400]


# HTML -----------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies, many.</div>
<div id=main><article><h1>Title &amp; more</h1><p>First, with <b>bold</b>&nbsp;text,
 and   blanks.<br><p>Second <a href="x">link</a>.<ul><li>one<li>two</ul><form><p>Mail</p></form><div class="ad">Buy</div>
</article></div><aside>Side, side, side.</aside><section class=comments><p>A reader says, well, this.</p></section>
<footer>&copy; me</footer></body></html>"""


def test_main_text():
    assert main_text(PAGE) == "Title & more\nFirst, with bold text, and blanks.\nSecond link.\none\ntwo"


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain words", "plain words"), ("<p>a</p><p>b", "a\nb"), ("<script>x", ""), ("<!-- never closed <p>x", ""),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<p>x &lt;b&gt; &amp &#233; &nosuch;</p>", "x <b> & é &nosuch;"),
    ("<body><div class=sidebar><p>s</p></div><div class='post content'><p>long, text, here</p></div></body>", "long, text, here"),
    ('<p title="a>b">q</p>', "q"), ('<p title="open>q</p>', "q")])
def test_main_text_cases(page, text):
    assert main_text(page) == text


def test_extract_rows(lspark):
    df = lspark.createDataFrame([(1, "u", PAGE), (2, None, None), (2, None, None), (None, "v", "")],
                                "page_id bigint, url string, html string").selectExpr("*", "'c' as text", "'c' as id")
    got = extract_main_text(df).collect()
    assert sorted((r.page_id or 0, len(r.text)) for r in got) == [(0, 0), (1, len(main_text(PAGE))), (2, 0), (2, 0)]
    assert extract_main_text(df.limit(0)).count() == 0


LONG = "A long paragraph, with commas, words, more words, and still more words, so that it scores well. " * 4


@pytest.mark.parametrize("n", [1, 12, 40])
@pytest.mark.parametrize("head, tail", [("<article>", "</article>"), ("<main>", "</main>"), ("<main><div><article>", "</article></div></main>"),
                                        ("<div class=post>", "</div>"), ("<div><div>", "</div></div>"), ("", "")])
def test_one_long_section_does_not_drop_the_rest(n, head, tail):
    parts = [f"<section>{f'<p>{LONG}</p>' * n}</section>", "<h2>Heading</h2>", "<section><p>Short one.</p></section>",
             "Loose <b>bold</b> text.", "<p>Lead.</p>", "<section><h3>Sub</h3><p>Last words.</p></section>"]
    menu = "<div><a href=/a>One link</a> <a href=/b>Other link</a></div>"
    want = ["Heading", "Short one.", "Loose bold text.", "Lead.", "Sub", "Last words."]
    for k in range(len(parts)):  # the long section at every place
        order = parts[1:k + 1] + parts[:1] + parts[k + 1:]
        got = main_text(f"<body>{menu}{head}{''.join(order)}{tail}{menu}</body>").split("\n")
        assert [x for x in got if x != LONG.strip()] == want and got.count(LONG.strip()) == n


@pytest.mark.parametrize("inner", ['<p class="social">Social movements rose in 1848.</p>', '<div class="promotion-rules">Rules of promotion.</div>',
                                   '<p class="related">Related species live on islands.</p>', '<h2 class="banner">The banner</h2>'])
def test_class_words_drop_nothing_of_an_article(inner):
    page = f"<body><nav><a href=/>x</a></nav><article><h1>T</h1><p>{LONG}</p>{inner}<p>{LONG}</p></article></body>"
    import re
    assert main_text(page).split("\n") == ["T", LONG.strip(), re.sub("<[^>]*>", "", inner), LONG.strip()]


@pytest.mark.parametrize("name", ["promo", "promo-box", "social share", "subscribe", "newsletter-signup", "ad", "cookie-notice", "comments", "related"])
def test_boilerplate_classes_are_left_out(name):
    page = f'<body><article><p>{LONG}</p><div class="{name}"><p>Buy this, now, it is good.</p></div></article></body>'
    assert main_text(page) == LONG.strip()


def test_closing_line_beside_the_article():
    page = f"<body><article><p>{LONG}</p></article><p>Short closing line.</p><p>&copy; 2024 We.</p><p><a href=/>Home.</a></p></body>"
    assert main_text(page) == LONG.strip() + "\nShort closing line."


def test_equal_containers_and_a_very_long_page():
    one = f"<div><p>{LONG}</p></div>"
    assert main_text(f"<body><ul><li><a href=/>m</a></ul>{one}{one}</body>") == (LONG.strip() + "\n") * 1 + LONG.strip()
    assert main_text(f"<body><article>{f'<p>{LONG}</p>' * 20000}</article></body>").count("\n") == 19999


@pytest.mark.parametrize("page", ["<div>" * 60000 + "deep", "<div>" * 40000 + "</span>" * 40000 + "x", "<div>x" * 40000,
                                  "<b><i>" * 30000 + "<p>x", "<div><p>a" * 30000, "<li><div>" * 30000 + "x"])
def test_work_is_linear_in_the_depth(page):
    import time
    t = time.time()
    assert main_text(page)
    assert time.time() - t < 10


def plain_article(page):
    """The article's text by the standard library's parser: blocks end at block tags."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.depth, self.words, self.out = 0, [], []

        def flush(self):
            text = " ".join("".join(self.words).split())
            self.words = []
            if text:
                self.out.append(text)

        def handle_starttag(self, tag, attrs):
            if tag == "article":
                self.depth += 1
            elif tag == "br":
                self.words.append(" ")
            elif tag not in ("a", "b", "i", "em", "strong", "span", "img"):
                self.flush()

        def handle_endtag(self, tag):
            if tag == "article":
                self.flush()
                self.depth -= 1
            elif tag not in ("a", "b", "i", "em", "strong", "span"):
                self.flush()

        def handle_data(self, data):
            if self.depth:
                self.words.append(data)
    r = Reader()
    r.feed(page or "")
    return "\n".join(r.out)


def test_whole_pages_table_against_the_standard_parser(lspark):
    df = lspark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in extract_main_text(df).collect()}
    want = {r.page_id: plain_article(r.html) for r in df.collect()}
    assert got == want
