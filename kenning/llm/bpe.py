"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The most frequent words of the corpus (runs without white space, counted over all
texts; of equally frequent ones all or none) are compiled into a minimal acyclic automaton: common prefixes and common suffixes share states, and
numbers on the arcs add up to a word's place in an id table. The bytes are written
to an unnamed file in each worker and memory-mapped. A word found in it yields its
ids; any other is normalised, split by the file's pattern and merged exactly, by the
ranks of the tokenizer file (a parameter). ``WORDS`` bounds the lexicon and with it what passes through the
driver; it only decides which words are looked up instead of merged.

Tokens cross no white space, so a text is split there first, and the result of each
recent piece is remembered by its worker.

Defined results: a null or empty text has no ids; a very long text is held whole by its
task, with its ids; special tokens spelt out in a
text become their ids, as the file says; rows that repeat are each returned; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import mmap
import tempfile
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.llm.common import scratch

WORDS = 50_000
CACHE = 200_000
NO_RANK = 1 << 30


class WordBpe:
    """A BPE file whose words end in a suffix: normaliser (composed form, lower case),
    word pattern, byte stand-ins, exact merges, decoding."""

    def __init__(self, path: str):
        import regex
        from kenning.llm.packing import _byte_of_char
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ranks = {tuple(m): n for n, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.cut = regex.compile("|".join(map(regex.escape, self.special)) or "(?!)")
        self.blank = regex.compile(r"\p{White_Space}+")
        raw = _byte_of_char()
        self.chars = {b: c for c, b in raw.items()}
        self.id_text = {i: str(i) for i in self.tokens}
        self.fast = self._merger(raw)

    def words(self, piece: str) -> list[str]:
        """Words of a piece without white space. Lower case is taken character by
        character (no special final sigma)."""
        if not piece.isascii():
            piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
        return self.pattern.findall(piece.lower())

    def pieces(self, text: str) -> list[str]:
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # white space to str.split only
            return [p for p in self.blank.split(text) if p]
        return text.split()

    def _merger(self, raw):
        """The same merges by a compiled library that joins parts by the rank of their
        concatenation. A word's end is one more byte that UTF-8 never has, joined to
        the last byte before anything else. Parts that together spell a token were
        joined in the order in which that token alone is, so the rank of the
        concatenation and the rank of the pair agree (the tests compare both)."""
        import tiktoken
        end = len(self.suffix)
        if not end:
            return None
        ranks = {bytes((b,)): b for b in raw.values()} | {b"\xff": 255}
        ids = [self.vocab.get(self.chars[b], -1) for b in range(256)]
        for c, b in raw.items():  # last bytes come first of all
            if b != 255:
                ranks[bytes((b, 255))] = 256 + b
        ids += [self.vocab.get(self.chars[b] + self.suffix, -1) for b in range(256)]
        for pair in self.ranks:  # in order of rank
            tok = "".join(pair)
            stem, tail = (tok[:-end], b"\xff") if tok.endswith(self.suffix) else (tok, b"")
            ranks[bytes(raw[c] for c in stem) + tail] = len(ids)
            ids.append(self.vocab[tok])
        return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}), ids

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word."""
        if self.fast is None:
            return self.merge_pairs(word)
        encoding, ids = self.fast
        return [ids[r] for r in encoding._encode_single_piece(word + b"\xff") if ids[r] >= 0]

    def merge_pairs(self, word: bytes) -> list[int]:
        """Ids of one word by repeatedly joining its best ranked, leftmost pair."""
        parts = [self.chars[b] for b in word]
        parts[-1] += self.suffix
        rank = self.ranks.get
        found = [rank(p, NO_RANK) for p in zip(parts, parts[1:])]
        while found:
            best = min(found)
            if best == NO_RANK:
                break
            at = found.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del found[at]
            if at:
                found[at - 1] = rank((parts[at - 1], parts[at]), NO_RANK)
            if at < len(found):
                found[at] = rank((parts[at], parts[at + 1]), NO_RANK)
        return [self.vocab[p] for p in parts if p in self.vocab]

    def piece_ids(self, piece: str) -> list[int]:
        out = []
        for word in self.words(piece):
            out += self.merge(word.encode())
        return out

    def segments(self, text: str):
        """(text, None) and (None, special id) in order."""
        at = 0
        for m in self.cut.finditer(text):
            yield text[at:m.start()], None
            yield None, self.special[m[0]]
            at = m.end()
        yield text[at:], None

    def decode(self, ids) -> str:
        """The file names no decoder: tokens joined by one space, special ones too."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


def build_transducer(entries: dict[bytes, list[int]]) -> bytes:
    """The minimal acyclic transducer of word -> ids, as one block of bytes.

    Words are added in order; when the path of the last word is left, its states are
    folded from the end into equal states already known. The size of a state's
    language is then counted once, which gives each arc the number of words that sort
    before it and so each word its place in the id table."""
    states: list[tuple[bool, tuple]] = []  # (final, ((label, target), ...))
    known: dict[tuple, int] = {}

    def fold(state):
        key = (state[0], tuple(state[1]))
        if key not in known:
            known[key] = len(states)
            states.append(key)
        return known[key]

    path = [[False, []]]  # states of the current word, arcs to folded states only
    last = b""
    for word in sorted(entries):
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        while len(path) > same + 1:
            done = path.pop()
            path[-1][1].append((last[len(path) - 1], fold(done)))
        path += [[False, []] for _ in word[same:]]
        path[-1][0] = True
        last = word
    while len(path) > 1:
        done = path.pop()
        path[-1][1].append((last[len(path) - 1], fold(done)))
    root = fold(path[0])
    size = []
    first, label, target, skip = [0], bytearray(), [], []
    for final, arcs in states:  # targets come before the states that use them
        before = int(final)
        for c, t in arcs:
            label.append(c)
            target.append(t)
            skip.append(before)
            before += size[t]
        size.append(before)
        first.append(len(target))
    ids = [entries[w] for w in sorted(entries)]
    start = np.cumsum([0, *map(len, ids)])
    parts = [np.array(first, "<u4"), np.array([f for f, _ in states], "<u4"), np.array(target, "<u4"), np.array(skip, "<u4"),
             start.astype("<u4"), np.array([i for x in ids for i in x], "<u4")]
    head = np.array([root, *map(len, parts)], "<u4")
    return b"".join([head.tobytes(), *[p.tobytes() for p in parts], bytes(label)])


class Transducer:
    """A memory-mapped lexicon."""

    def __init__(self, data: bytes):
        with tempfile.TemporaryFile() as f:  # no name: nothing stays behind
            f.write(data)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        view = memoryview(self.map)
        head = view[:28].cast("I")
        self.root, at, arrays = head[0], 28, []
        for n in head[1:]:
            arrays.append(view[at:at + 4 * n].cast("I"))
            at += 4 * n
        self.first, self.final, self.target, self.skip, self.start, self.ids = arrays
        self.labels = at
        self.read: dict[int, dict[int, tuple[int, int]]] = {}  # states met so far; at most all of the lexicon

    def arcs(self, state: int) -> dict[int, tuple[int, int]]:
        """Label -> (target, words skipped) of a state, read from the map once."""
        s, e = self.first[state], self.first[state + 1]
        out = self.read[state] = dict(zip(self.map[self.labels + s:self.labels + e], zip(self.target[s:e], self.skip[s:e])))
        return out

    def get(self, word: bytes) -> list[int] | None:
        state, place, known = self.root, 0, self.read.get
        for c in word:
            hit = (known(state) or self.arcs(state)).get(c)
            if hit is None:
                return None
            state = hit[0]
            place += hit[1]
        if not self.final[state]:
            return None
        return self.ids[self.start[place]:self.start[place + 1]].tolist()


class _Pieces(dict):
    """Piece -> (count, ids as text, decoded text), filled on demand. Words of the lexicon
    stay; of the others two generations of at most ``CACHE``, so the common ones survive."""

    def __init__(self, encoder):
        super().__init__()
        self.encoder, self.old, self.lexicon = encoder, {}, {}

    def __missing__(self, piece):
        told = self.old.get(piece)
        if told is None:
            ids = self.encoder.lexicon.get(piece.encode())
            if ids is not None:
                told = self[piece] = self.lexicon[piece] = self.encoder.told(ids)
                return told
            told = self.encoder.told(self.encoder.bpe.piece_ids(piece))
        if len(self) - len(self.lexicon) >= CACHE:
            self.old = dict(self)
            self.clear()
            self.update(self.lexicon)
        self[piece] = told
        return told


class Encoder:
    """Texts to (count, ids as text, decoded text), with a bounded memory of pieces."""

    def __init__(self, path: str, lexicon: bytes):
        self.bpe, self.lexicon = WordBpe(path), Transducer(lexicon)
        self.cache = _Pieces(self)

    def told(self, ids):
        return len(ids), " ".join(map(self.bpe.id_text.__getitem__, ids)), " ".join(map(self.bpe.tokens.__getitem__, ids))

    def tell(self, text: str) -> tuple[int, str, str]:
        out = []
        parts = self.bpe.segments(text) if any(s in text for s in self.bpe.special) else [(text, None)]
        for part, special in parts:
            if part is None:
                out.append(self.told([special]))
            else:
                out += map(self.cache.__getitem__, self.bpe.pieces(part))
        if not out:
            return 0, "", ""
        n, ids, decoded = zip(*out)
        if 0 in n:  # pieces without a word
            out = [x for x in out if x[0]]
            if not out:
                return 0, "", ""
            n, ids, decoded = zip(*out)
        return sum(n), " ".join(ids), " ".join(decoded)


def frequent_words(df: DataFrame, text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(word, n) of the words that occur at least f times, twice at least, f the least for
    which they are at most ``words``. Frequencies are counted first, in some 2,000
    classes of about equal frequency, so no task sorts or holds the candidates: the cut
    is one filter."""
    word = F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "[ \n]")).alias("word")
    # exact up to 1,024, then sixteen classes for each doubling
    level = F.when(F.col("n") < 1024, F.col("n")).otherwise((F.log2("n") * 16).cast("bigint") + 864)
    counted = scratch(df.select(word).groupBy("word").agg(F.count("*").alias("n")).where("n > 1 and word <> ''")
                      .withColumn("level", level), "words")
    cut, held = None, 0
    for r in counted.groupBy("level").agg(F.count("*").alias("k")).orderBy(F.desc("level")).toLocalIterator():
        held += r.k
        if held > words:
            break
        cut = r.level
    return counted.where(F.col("level") >= cut if cut is not None else F.lit(False)).select("word", "n")


def build_lexicon(df: DataFrame, tokenizer: str, text_col: str = "text", words: int = WORDS) -> bytes:
    """The transducer of the most frequent words (runs without white space) of all texts
    of ``df``, counted with map-side sums; at most ``words``, see ``frequent_words``."""
    bpe, entries = WordBpe(tokenizer), {}
    for r in frequent_words(df, text_col, words).toLocalIterator():  # at most ``words`` words
        if bpe.pieces(r.word) == [r.word] and not bpe.cut.search(r.word):
            entries[r.word.encode()] = bpe.piece_ids(r.word)
    return build_transducer(entries)


def encode_decode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  lexicon: bytes | None = None) -> DataFrame:
    """One row per input row: id, ``n_tokens``, ``ids`` (decimal, joined by one space),
    ``decoded``. Without ``lexicon`` it is built from the same texts."""
    if lexicon is None:
        lexicon = build_lexicon(df, tokenizer, text_col)
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))

    def run(batches):
        import pyarrow as pa
        enc = Encoder(tokenizer, lexicon)
        for b in batches:
            rows = [enc.tell(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.string())], ["id", "n_tokens", "ids", "decoded"])

    schema = f"id {src.schema['id'].dataType.simpleString()}, n_tokens bigint, ids string, decoded string"
    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)
