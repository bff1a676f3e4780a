"""Substring de-duplication: repeated fixed-length word windows.

Every window of ``window`` consecutive words has a Rabin-Karp hash (polynomial
over 64-bit word hashes, arithmetic modulo 2^64). A window is removable if its
word sequence also starts in a document with a smaller id; the words it covers
go, and overlapping windows merge into maximal intervals.

The windows are not shuffled one by one. Within a window the smallest hash of its
``gram``-word pieces is its anchor; consecutive windows with the same anchor
position form a run (about one run per twenty words). Equal windows have equal
anchors at the same offset, so they always lie in runs with the same anchor.

1. One scan gives a row per different run of a document: anchor, Rabin-Karp hash of
   the whole span of the run, document, position. A text that says the same thing
   over and over has one row for all its equal runs, with their further positions.
   Spark aggregates the rows: a run whose span also occurs in a smaller document
   is removable as a whole.
2. Only anchors with several different spans can hide partly equal runs. For
   these, and only for the first document of each span (the others are covered by
   it), a second scan emits the hash of every window, and Spark takes the smallest
   document per hash. Which runs these are reaches the scan as a bitmap of fixed
   size; a false hit emits a few windows more and changes nothing.
3. The removable windows of a document become intervals, and one more scan cuts
   them out. Only documents that have any are shuffled with their text.

All hashes that decide are 128 bits (two independent polynomials).

Defined results: words are runs of characters other than space and
\\t \\n \\v \\f \\r, unchanged; a null text has none; texts with fewer words than a
window lose nothing; a null id counts as larger than every other; rows that
share an id are one document for the comparison (none is smaller than the other)
but keep their own texts; an empty table gives an empty result; other columns are
ignored or carried.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kenning.llm.common import bitmap, bitmap_array, bitmap_has, flag_by_bitmap, scratch, signed, text_bytes

WINDOW = 50
GRAM = 10
SEED = 42
NULL_ID = (1 << 63) - 1
# Fixed odd multipliers of the two polynomials (odd: they have inverses modulo 2^64).
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_M64 = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Rolling:
    """Hashes of any word span of one text from prefix sums: span(p, q) covers
    words p..q-1 and does not depend on where the span lies."""

    def __init__(self, words: np.ndarray, base: int):
        n = len(words)
        self.inverse = _powers(pow(base, -1, 1 << 64), n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(words * _powers(base, n), out=self.prefix[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.inverse[start]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class _Runs:
    """The runs of one text: anchor value, first window, last window, span hashes."""

    def __init__(self, words: list[bytes], window: int, gram: int):
        h = _word_hashes(words)
        n = len(h)
        self.roll = _Rolling(h, BASES[0])
        self.roll2 = _Rolling(_mix(h), BASES[1])
        at = np.arange(n - gram + 1)
        g = _mix(self.roll.spans(at, at + gram))
        width = window - gram + 1  # grams per window
        # leftmost minimum of every window of grams: doubling over positions
        best, size = at.copy(), 1
        while size * 2 <= width:
            left, right = best[:len(best) - size], best[size:]
            best = np.where(g[right] < g[left], right, left)
            size *= 2
        if size < width:
            left, right = best[:n - window + 1], best[width - size:width - size + n - window + 1]
            best = np.where(g[right] < g[left], right, left)
        first = np.flatnonzero(np.concatenate(([True], best[1:] != best[:-1])))
        self.first = first
        self.last = np.concatenate((first[1:], [n - window + 1])) - 1
        self.anchor = g[best[first]]
        end = self.last + window
        # the offset of the anchor in the span is part of the key: equal spans agree on it anyway
        self.h1, self.h2 = self.roll.spans(first, end), self.roll2.spans(first, end)


    def equal(self) -> tuple[np.ndarray, list[list[int] | None]]:
        """The first run of each different span, and where its further ones start (None: nowhere)."""
        order = np.lexsort((self.h2, self.h1))  # stable: equal runs stay in text order
        a, b = self.h1[order], self.h2[order]
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        if new.all():
            return np.arange(len(order)), [None] * len(order)
        groups = np.split(order, np.flatnonzero(new)[1:])
        return order[new], [self.first[g[1:]].tolist() if len(g) > 1 else None for g in groups]


def _src(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)).alias("id"), F.col(text_col).alias("t"))


def _runs(src: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches):
        import pyarrow as pa
        import xxhash
        names = ["id", "th", "anchor", "h1", "h2", "first", "last", "more"]
        for b in batches:
            ids, parts, more = b.column(0).to_pylist(), [], []
            for i, t in zip(ids, text_bytes(b.column(1))):
                words = t.split()
                if len(words) >= window:
                    r = _Runs(words, window, gram)
                    th = signed(xxhash.xxh64_intdigest(t, SEED))
                    at, further = r.equal()
                    m = len(at)
                    parts.append((np.full(m, i, np.int64), np.full(m, th, np.int64), r.anchor[at].view(np.int64),
                                  r.h1[at].view(np.int64), r.h2[at].view(np.int64),
                                  r.first[at].astype(np.int32), r.last[at].astype(np.int32)))
                    more += further
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)]
                                                 + [pa.array(more, pa.list_(pa.int32()))], names)

    return src.mapInArrow(run, "id bigint, th bigint, anchor bigint, h1 bigint, h2 bigint, first int, last int, more array<int>")


def _windows(src: DataFrame, bits: np.ndarray, window: int, gram: int) -> DataFrame:
    """Every window of the runs whose (span, document) key is set in ``bits``."""
    def run(batches):
        import pyarrow as pa
        import xxhash
        names = ["id", "th", "w1", "w2", "pos"]
        for b in batches:
            ids, parts = b.column(0).to_pylist(), []
            for i, t in zip(ids, text_bytes(b.column(1))):
                words = t.split()
                if len(words) < window:
                    continue
                r = _Runs(words, window, gram)
                hit = bitmap_has(bits, _run_key(r.h1, i))
                if not hit.any():
                    continue
                lo, count = r.first[hit], (r.last - r.first + 1)[hit]
                pos = np.repeat(lo - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
                m = len(pos)
                parts.append((np.full(m, i, np.int64), np.full(m, signed(xxhash.xxh64_intdigest(t, SEED)), np.int64),
                              r.roll.spans(pos, pos + window).view(np.int64),
                              r.roll2.spans(pos, pos + window).view(np.int64), pos.astype(np.int32)))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], names)

    return src.mapInArrow(run, "id bigint, th bigint, w1 bigint, w2 bigint, pos int")


def _run_key(h1: np.ndarray, doc: int) -> np.ndarray:
    return _mix(h1 ^ np.uint64((doc * BASES[1]) & _M64))


def _run_keys(df: DataFrame) -> DataFrame:
    """``_run_key`` over the columns h1 and id, as bigint column ``key``."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            h, i = b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_mix(h ^ (i * np.uint64(BASES[1]))).view(np.int64))], ["key"])
    return df.select("h1", "id").mapInArrow(run, "key bigint")


def repeated_ranges(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    gram: int = GRAM) -> DataFrame:
    """(id, th, first, last, more): ranges of window starts that are removable, per row
    text (``th`` is the XXH64 of the text; a null id is the largest bigint). ``more``
    holds the first starts of further ranges of the same length (null: none)."""
    if not 1 <= gram <= window:
        raise ValueError("gram must be between 1 and window")
    src = _src(df, id_col, text_col)
    runs = scratch(_runs(src, window, gram), "runs")
    spans = scratch(runs.groupBy("anchor", "h1", "h2").agg(F.min("id").alias("id"), F.max("id").alias("top")), "spans")
    whole = (runs.join(spans.where("id < top").select("anchor", "h1", "h2", F.col("id").alias("low")), ["anchor", "h1", "h2"])
             .where("low < id").select("id", "th", "first", "last", "more"))
    several = spans.groupBy("anchor").agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).where("n > 1 and lo < hi")
    firsts = spans.join(several, "anchor", "left_semi").select("h1", "id")
    bits = bitmap_array(bitmap(_run_keys(firsts), "key"))
    wins = scratch(_windows(src, bits, window, gram), "windows")
    low = wins.groupBy("w1", "w2").agg(F.min("id").alias("low"), F.max("id").alias("top")).where("low < top").drop("top")
    partly = (wins.join(low, ["w1", "w2"]).where("low < id")
              .select("id", "th", F.col("pos").alias("first"), F.col("pos").alias("last"),
                      F.lit(None).cast("array<int>").alias("more")))
    return whole.unionByName(partly)


def _cut(words: list[bytes], ranges, window: int) -> tuple[list[bytes], list[tuple[int, int]]]:
    """Words left, and the maximal removed intervals (start, end)."""
    edge = np.zeros(len(words) + 1, np.int64)
    starts = [(s, r["last"] - r["first"]) for r in ranges for s in (r["first"], *(r["more"] or ()))]
    first, size = np.array(starts, np.int64).T
    np.add.at(edge, first, 1)
    np.add.at(edge, first + size + window, -1)
    gone = np.concatenate(([0], np.cumsum(edge[:-1]) > 0, [0])).astype(np.int8)
    step = np.diff(gone)
    spans = list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()))
    kept, at = [], 0
    for s, e in spans:
        kept += words[at:s]
        at = e
    return kept + words[at:], spans


def _with_ranges(df: DataFrame, id_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    """``df`` as struct ``r`` with the removable ranges of its text (null: none)."""
    ranges = repeated_ranges(df, id_col, text_col, window, gram)
    per_text = scratch(ranges.distinct().groupBy("id", "th").agg(F.collect_list(F.struct("first", "last", "more")).alias("ranges")), "ranges")
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID))
    th = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("r"), key.alias("id"), th.alias("th"))
    bits = scratch(bitmap(per_text.select(F.xxhash64("id", "th").alias("k")), "k"), "cut-bits")
    rows = flag_by_bitmap(rows, F.xxhash64("id", "th"), bits, "cut")
    clear = rows.where("not cut").select("r", F.lit(None).cast(per_text.schema["ranges"].dataType).alias("ranges"))
    return clear.unionByName(rows.where("cut").join(per_text, ["id", "th"], "left").select("r", "ranges"))


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    gram: int = GRAM) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_removed``, ``kept_text`` (words left,
    joined by one space) and ``spans`` (maximal removed word intervals, end exclusive)."""
    src = _with_ranges(df.select(F.col(id_col), F.col(text_col)), id_col, text_col, window, gram)
    src = src.select(F.col(f"r.`{id_col}`").alias("id"), F.col(f"r.`{text_col}`").alias("t"), "ranges")

    def run(batches):
        import pyarrow as pa
        for b in batches:
            n, removed, kept, spans = [], [], [], []
            for t, ranges in zip(text_bytes(b.column(1)), b.column(2).to_pylist()):
                words = t.split()
                left, cut = _cut(words, ranges, window) if ranges else (words, [])
                n.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
                spans.append([{"start": s, "end": e} for s, e in cut])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                ["id", "n_words", "n_removed", "kept_text", "spans"])

    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(run, f"id {kind}, n_words bigint, n_removed bigint, kept_text string, spans array<struct<start:int,end:int>>")
    return out.withColumnRenamed("id", id_col)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   gram: int = GRAM) -> DataFrame:
    """``df`` with the repeated windows cut out of its texts. Texts that lose nothing
    stay as they are (white space included, null too)."""
    cols = df.columns
    src = _with_ranges(df, id_col, text_col, window, gram)
    clear = src.where("ranges is null").select("r.*")
    rest = src.where("ranges is not null").select("r", F.col(f"r.`{text_col}`").alias("t"), "ranges")
    names = ["c" + str(i) for i in range(len(cols))]
    flat = rest.select(*[F.col(f"r.`{c}`").alias(n) for c, n in zip(cols, names)], "ranges")
    at = cols.index(text_col)

    def run(batches):
        import pyarrow as pa
        for b in batches:
            texts = [b" ".join(_cut(t.split(), r, window)[0]).decode()
                     for t, r in zip(text_bytes(b.column(at)), b.column(len(names)).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(len(names))], names)

    schema = ", ".join(f"{n} {df.schema[c].dataType.simpleString()}" for n, c in zip(names, cols))
    cut = flat.mapInArrow(run, schema).select(*[F.col(n).alias(c) for n, c in zip(names, cols)])
    return clear.unionByName(cut)
