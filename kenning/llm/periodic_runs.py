"""Runs of words that repeat with a period, by a dictionary of basic factors.

For each power of two L the word stretches of length L (basic factors) get a number,
equal stretches of one document the same one; a number at length 2L is the pair of the
numbers at its two halves. A factor that occurs once in its document can be part of no
longer repeated factor, so only positions whose factor repeats are carried on and
numbered again: an ordinary text leaves the table after two or three lengths.

The successor of a position is the next position of the same factor. Successors
farther than 2L are no candidates at L; neighbouring positions with the same successor
distance q form a progression i, i + q, ... that proposes the period q. With L/2 < q
<= L a stretch of period q shows at every one of its positions the distance q, its
smallest period (two smaller periods would add up within the factor), so the block of
such positions, extended by the factor and the period behind its last one, is the
whole run: no word before or after it keeps the period. Distances between L and 2L are
left to the next length, where the factor is long enough to prove them, and smaller
ones were settled at the length before, which keeps every run once. The shortest length
that proposes is 8: runs have ``MIN_WORDS`` words at least, so it serves all q <= 8.

Work is a sort of the carried positions per length, n log n words in the worst case
(a text that is one word repeated), all texts of ``PART_WORDS`` words together; a longer
text is one part of some 100 bytes a word in its task. Nothing is shuffled.

Defined results: null and empty texts have no words and no run; a null id is never
periodised; rows that repeat, or share an id, are each returned; of runs with the same
length over period the first, then the shorter period is the strongest; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.llm.common import text_bytes

MIN_WORDS = 24
MIN_PERIODS = 3
PART_WORDS = 1 << 18


def periodise(n: int, doc_id) -> tuple[int, int] | None:
    """(first word, period) of the words that the id makes periodic, if it does."""
    if doc_id is None or not n:
        return None
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return None
    start = g % n
    return start, 1 + (n - start) // (3 + g % 8)


def number_words(words: list[bytes], doc_id=None) -> tuple[np.ndarray, np.ndarray]:
    """Per word the place of the original word that it is, and the number of its spelling."""
    known: dict[bytes, int] = {}
    number = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    place = np.arange(len(words))
    made = periodise(len(words), doc_id)
    if made:
        start, period = made
        place[start:] = start + (place[start:] - start) % period
    return place, number[place]


def _repeated(number: np.ndarray) -> np.ndarray:
    """Which entries of the sorted ``number`` are not alone."""
    same = number[1:] == number[:-1]
    return np.concatenate(([False], same)) | np.concatenate((same, [False]))


def _progressions(pos: np.ndarray, gap: np.ndarray, length: int):
    """(first position, words, period) of each block of neighbouring positions (sorted)
    with one successor distance."""
    if not len(pos):
        return
    new = np.flatnonzero(np.concatenate(([True], (pos[1:] != pos[:-1] + 1) | (gap[1:] != gap[:-1]))))
    for s, e in zip(new.tolist(), [*new[1:].tolist(), len(pos)]):
        q = int(gap[s])
        yield int(pos[s]), e - s - 1 + length + q, q


def find_runs(number: np.ndarray, text_of: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in texts laid end to end, by start and
    period. ``number``: word numbers, ``text_of``: the text that a word belongs to."""
    if min_words < 2:
        raise ValueError("a run has two words at least")
    lowest = 1
    while 4 * lowest <= min_words:  # both the factor and its period fit the shortest run
        lowest *= 2
    out, length = [], 1
    pos = np.arange(len(number))
    # equal numbers of different texts must differ
    base = int(number.max()) + 1 if len(number) else 1
    name = text_of.astype(np.int64) * base + number
    while len(pos):
        order = np.argsort(name, kind="stable")  # positions ascend within a name
        sorted_name, sorted_pos = name[order], pos[order]
        keep = _repeated(sorted_name)
        sorted_name, sorted_pos = sorted_name[keep], sorted_pos[keep]
        if not len(sorted_pos):
            break
        if length >= lowest:
            gap = np.diff(sorted_pos)
            low = 0 if length == lowest else length // 2
            near = np.flatnonzero((sorted_name[1:] == sorted_name[:-1]) & (gap > low) & (gap <= length))
            at = sorted_pos[near]
            by_pos = np.argsort(at, kind="stable")
            out += [r for r in _progressions(at[by_pos], gap[near][by_pos], length)
                    if r[1] >= max(min_words, MIN_PERIODS * r[2])]
        # dense numbers at this length, then pairs of halves
        dense = np.cumsum(np.concatenate(([0], sorted_name[1:] != sorted_name[:-1])))
        at_pos = np.full(len(number), -1, np.int64)
        at_pos[sorted_pos] = dense
        left = np.sort(sorted_pos)
        left = left[left + length < len(number)]
        right = at_pos[left + length]
        ok = (right >= 0) & (text_of[left] == text_of[np.minimum(left + 2 * length - 1, len(number) - 1)]) \
            & (left + 2 * length <= len(number))
        pos = left[ok]
        name = at_pos[pos] * (int(dense[-1]) + 1) + right[ok]
        length *= 2
    return sorted(out, key=lambda r: (r[0], r[2]))


def strongest(runs):
    """The run with the greatest length / period, then the first, then the shorter period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(n: int, runs) -> np.ndarray:
    """Which words stay when of each run only the first period is kept."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def _parts(texts: list[bytes]):
    """Ranges of texts with about ``PART_WORDS`` words together (by bytes: a word and its
    blank are two at least)."""
    size, first = 0, 0
    for i, t in enumerate(texts):
        size += len(t) // 2 + 1
        if size >= PART_WORDS:
            yield first, i + 1
            size, first = 0, i + 1
    if first < len(texts):
        yield first, len(texts)


def runs_of_texts(texts: list[bytes], ids: list) -> list[tuple]:
    """Per text: its words (periodised by its id), and its runs."""
    words = [t.split() for t in texts]  # on bytes: the six blanks only
    numbered = [number_words(w, i) for w, i in zip(words, ids)]
    sizes = [len(w) for w in words]
    start = [0, *accumulate(sizes)]
    found: list[list] = [[] for _ in texts]
    if start[-1]:
        number = np.concatenate([x for _, x in numbered])
        text_of = np.repeat(np.arange(len(texts)), sizes)
        for s, length, q in find_runs(number, text_of):
            k = int(text_of[s])
            found[k].append((s - start[k], length, q))
    return [([w[p] for p in place.tolist()], runs) for w, (place, _), runs in zip(words, numbered, found)]


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", id_periods: bool = True) -> DataFrame:
    """One row per input row: id, ``runs`` (array of start, length, period),
    ``collapsed`` (the text with each run's first period only, words joined by one
    space), ``best`` (the strongest run) and the SHA-256 of the run list and the
    collapsed text. ``id_periods``: some ids make their text periodic first (test data)."""
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    run_type = "struct<start:bigint,length:bigint,period:bigint>"
    schema = f"id {src.schema['id'].dataType.simpleString()}, runs array<{run_type}>, best {run_type}, collapsed string"

    def run(batches):
        import pyarrow as pa
        one = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

        def told(r):
            return None if r is None else dict(zip(("start", "length", "period"), r))

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), text_bytes(batch.column(1))
            for s, e in _parts(texts):
                got = runs_of_texts(texts[s:e], ids[s:e] if id_periods else [None] * (e - s))
                short = []
                for words, runs in got:
                    if runs:
                        keep = collapsed(len(words), runs)
                        words = [w for w, k in zip(words, keep.tolist()) if k]
                    short.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(s, e - s), pa.array([[told(r) for r in runs] for _, runs in got], pa.list_(one)),
                     pa.array([told(strongest(runs)) for _, runs in got], one), pa.array(short, pa.string())],
                    ["id", "runs", "best", "collapsed"])

    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def digest_columns(found: DataFrame) -> DataFrame:
    """The result of ``periodic_runs`` as counts and digests."""
    line = F.concat_ws("", F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(line, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
