"""Order-preserving packing of token streams into windows of at most 1024.

Texts become ids (byte-level BPE, the file is a parameter) followed by id 0. The
documents of a block (consecutive documents of about ``BLOCK_TOKENS`` ids, in table
order) form a stream; dynamic programming chooses where to cut it. Every position is a
candidate: a cut costs nothing at a document end, ``SENTENCE_CUT`` at a sentence end and
``FORCED_CUT`` inside a sentence (truncation); a window costs its padding to the width,
or nothing if its length is a power of two. ``window_costs`` finds the least total.

With c the cost of a cut, the cheapest way to a cut at i is
c[i] + min(min over j of dp[j] + width - (i - j), min over k of dp[i - 2^k]).
The first minimum is the front of a monotone queue over dp[j] + j. A window that would
need more padding than cuts into powers of two would cost is never best, so that queue
holds a range of some 240 positions that lie at least ``width - 240`` back; half a
window of positions is therefore settled at once, their queue fronts by running minima
from both ends. The small powers reach back into the same half and are relaxed until
nothing changes. The work is linear in the ids, and the result the true minimum.

Rows stay in their input split and order: no shuffle. Memory is some 40 bytes an id of
a block; a block ends with the document that fills it, so a very long text is a block
of its own. ``sequence_id`` is the split's number times 2^33 plus a running number, the
same in any re-run of a task.

Defined results: a null or empty text is the single id 0; repeated rows are each
packed; null ids are carried; of equally cheap cuts the one that leaves the longest last
window is taken; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH = 1024
SENTENCE_CUT = 2
FORCED_CUT = 24
BLOCK_TOKENS = 1 << 19


class ByteTokenizer:
    """Ids of a byte-level BPE file, as its own library gives them without added
    special tokens (special tokens spelt out in a text become their ids)."""

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        raw = _byte_of_char()
        ranks = {bytes(raw[c] for c in tok): i for tok, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        for content in self.special:
            ranks.pop(content.encode(), None)
        self.encoder = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=self.special)
        self.ends = np.zeros(max([*ranks.values(), *self.special.values()]) + 1, bool)
        for tok, i in ranks.items():
            self.ends[i] = tok[-1:] in (b".", b"!", b"?", b"\n")

    def ids(self, text: str) -> np.ndarray:
        """Ids of the text, then id 0."""
        if any(s in text for s in self.special):
            out = self.encoder.encode(text, allowed_special="all")
        else:
            out = self.encoder.encode_ordinary(text)
        out.append(0)
        return np.array(out, np.uint32)


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins byte-level BPE files use for bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    out.update({chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(plain))})
    return out


def padding(length: int, width: int = WIDTH) -> int:
    return 0 if length & (length - 1) == 0 else width - length


def cut_costs(lengths: np.ndarray, is_end: np.ndarray) -> np.ndarray:
    """Per position of the stream (0 to its length) what a cut there costs; ``is_end``
    marks the ids after which a sentence ends."""
    cost = np.full(int(lengths.sum()) + 1, FORCED_CUT, np.int64)
    cost[np.flatnonzero(is_end) + 1] = SENTENCE_CUT
    cost[np.cumsum(lengths)] = 0
    return cost


def _shortest_padded(width: int) -> int:
    """No window shorter than this is best padded: powers of two cost less."""
    return max(1, width - FORCED_CUT * width.bit_length())


def _running_min(a: np.ndarray, size: int) -> np.ndarray:
    """The minimum of each ``size`` neighbours: the front of a monotone queue at every
    step, from minima running forwards and backwards between every size-th place."""
    n = len(a) - size + 1
    whole = np.append(a, np.full(-len(a) % size, a.max(initial=0))).reshape(-1, size)
    ahead = np.minimum.accumulate(whole, axis=1).ravel()
    behind = np.minimum.accumulate(whole[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[size - 1:size - 1 + n])


def window_costs(cost: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The least cost of cutting the stream up to each position that ends in a cut there."""
    n, least = len(cost), _shortest_padded(width)
    step = max(1, min(width // 2, least))
    powers = [1 << k for k in range(width.bit_length()) if 1 << k <= width]
    far = np.iinfo(np.int64).max // 4
    dp = np.full(width + n, far)  # position i is at width + i: nothing lies before the stream
    dp[width] = 0
    place = np.arange(len(dp))
    for s in range(1, n, step):
        e = min(s + step, n)
        at, c = place[width + s:width + e], cost[s:e]
        back = slice(s, width + e - least)  # windows of least to width ids
        best = _running_min(dp[back] + place[back], width - least + 1) + width - at
        for p in powers:
            if p >= e - s:
                np.minimum(best, dp[at - p], out=best)
        now = dp[width + s:width + e]
        now[:] = np.minimum(best + c, far)
        near = [p for p in reversed(powers) if p < e - s]
        while near:
            before = now.copy()
            for p in near:
                np.minimum(now, dp[width + s - p:width + e - p] + c, out=now)
            if (before == now).all():
                break
    return dp[width:]


def windows(lengths: np.ndarray, is_end: np.ndarray, width: int = WIDTH) -> list[int]:
    """Window ends for documents of the given token counts."""
    if not lengths.sum():
        return []
    cost = cut_costs(lengths, is_end)
    dp = window_costs(cost, width)
    least = _shortest_padded(width)
    powers = [1 << k for k in range(width.bit_length() - 1, -1, -1)]
    out, i = [], len(cost) - 1
    while i:
        out.append(i)
        want = dp[i] - cost[i]
        full = [p for p in powers if p <= min(i, width) and dp[i - p] == want]
        low = max(0, i - width)
        j = np.arange(low, max(low, i - least + 1))
        padded = j[dp[j] + width - i + j == want]
        i = min([i - p for p in full[:1]] + padded[:1].tolist())
    return out[::-1]


def pack(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``; with ``with_ids`` also the ids themselves."""
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext
        tok = ByteTokenizer(tokenizer)
        sequence = TaskContext.get().partitionId() << 33
        names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
        def packed(held):
            nonlocal sequence
            ids, docs = pa.chunked_array([i for i, _ in held]).combine_chunks(), [d for _, ds in held for d in ds]
            lengths = np.array([len(d) for d in docs], np.int64)
            stream = np.concatenate(docs)
            ends = windows(lengths, tok.ends[stream], width)
            doc_end = np.cumsum(lengths)
            edges = np.union1d(doc_end, ends)  # every piece ends at one of these
            begin = np.concatenate(([0], edges[:-1]))
            doc = np.searchsorted(doc_end, begin, "right")
            win = np.searchsorted(ends, begin, "right")
            win_start = np.concatenate(([0], ends[:-1]))[win]
            raw = stream.astype("<u4")
            pieces = [raw[s:e] for s, e in zip(begin.tolist(), edges.tolist())]
            cols = [ids.take(pa.array(doc)), pa.array(begin - (doc_end - lengths)[doc]), pa.array(edges - begin),
                    pa.array([zlib.crc32(x.tobytes()) for x in pieces], pa.int64()), pa.array(lengths[doc]),
                    pa.array(sequence + win), pa.array(begin - win_start)]
            if with_ids:
                cols.append(pa.array([x.astype(np.int32) for x in pieces], pa.list_(pa.int32())))
            sequence += len(ends)
            return pa.RecordBatch.from_arrays(cols, names)

        held, size = [], 0  # (ids, tokens) of consecutive documents
        for b in batches:
            texts, at = b.column(1).to_pylist(), 0
            while at < len(texts):
                to, docs = at, []
                while to < len(texts) and size < BLOCK_TOKENS:
                    docs.append(tok.ids(texts[to] or ""))
                    size += len(docs[-1])
                    to += 1
                held.append((b.column(0).slice(at, to - at), docs))
                at = to
                if size >= BLOCK_TOKENS:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    schema = (f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
              + ", ids array<int>" * with_ids)
    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)
