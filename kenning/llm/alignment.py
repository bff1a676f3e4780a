"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Every text is encoded twice, as a space and the text by a byte-level BPE (A) and as
the text by a piece model that adds the space (B). With the byte offsets where tokens
end, the offsets both share cut the tokens into groups, and each stretch between two
neighbouring ends of either side is one link, an A and a B occurrence that overlap.
How often the corpus links an id pair is counted by external spilling:

* a task sorts its links and spills runs: per run and radix (low bits of the B id) the
  sorted pairs with their counts, and the pair-document records, as zstd blocks;
* runs of one radix are merged by a k-way heap, ``FAN_IN`` slices of the input at a
  time until one is left, so a frequent id is merged in slices and no task holds a
  radix of the whole corpus; a slice is the part of the input that one task read;
* pairs are ordered B id first, so the last merge sees a B id's pairs together and
  marks those with its greatest count;
* the runs are read once more, and each streams its documents' sums back.

The counts of all pairs grow with the two vocabularies, not with the corpus; they are
broadcast only if they measure at most ``SMALL`` bytes and are otherwise joined to the
runs by radix and slice.

Defined results: a null or empty text, or one whose tokens' bytes are not the space
and the text (it spells U+2581 itself), has zeros and the empty string; special tokens
spelt out are plain text; rows that repeat, or share an id, or have none, are each
returned; of pairs that tie for a B id's greatest count all count as best; a very long
text is held whole by its task with some 60 bytes a token, and its links are spilled in
runs of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kenning.llm.common import scratch

RADIX_BITS = 6
# Links sorted together: a run is 8 bytes a link in memory.
RUN_LINKS = 1 << 22
# Bytes of text aligned together; a longer text alone.
PART_BYTES = 1 << 21
FAN_IN = 16
BLOCK = 4096
SMALL = 32 << 20
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# a document's columns, in the order the tasks write them
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


class Tokenizers:
    """Both encoders and the bytes of every token."""

    def __init__(self, path_a: str, path_b: str):
        import json
        import sentencepiece
        import tiktoken
        from kenning.llm.packing import _byte_of_char
        raw = _byte_of_char()
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(raw[c] for c in tok): i for tok, i in spec["model"]["vocab"].items() if tok not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for tok, i in ranks.items():
            self.bytes_a[i] = tok
        self.bytes_b = [bytes((int(p[3:5], 16),)) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size()) for p in (self.b.id_to_piece(i),)]
        if len(self.bytes_a) > 1 << 16 or len(self.bytes_b) > 1 << 16:
            raise ValueError("ids of both tokenizers must be below 65536")
        if not all(bytes((x,)) in ranks for x in range(256)):
            raise ValueError("the byte-level tokenizer must know every byte")
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        a, b = range(len(self.bytes_a)), range(len(self.bytes_b))
        self.told = [f"{i}," for i in a] + [f"{i}|" for i in a] + [f"{i}," for i in b] + [f"{i};" for i in b]

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of both sides, none if either side's bytes are not the space and the text.
        A's always are: it knows every byte and joins neighbours only."""
        if not text:
            return [], []
        b = self.b.encode(text)
        if b"".join(map(self.bytes_b.__getitem__, b)) != b" " + text.encode():
            return [], []
        return self.a.encode_ordinary(" " + text), b

    def align(self, texts: list[str]):
        """Counts per text (columns ``COUNTS``), each text's groups spelt out, and the
        links of all as (text number, A id, B id)."""
        pairs = [self.encode(t) for t in texts]
        n_a = np.array([len(a) for a, _ in pairs], np.int64)
        n_b = np.array([len(b) for _, b in pairs], np.int64)
        a = np.array([i for x, _ in pairs for i in x], np.int64)
        b = np.array([i for _, x in pairs for i in x], np.int64)
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")  # two ascending stretches: a merge
        ends = ends[np.concatenate(([True], ends[1:] != ends[:-1]))] if len(ends) else ends
        at_a, at_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        is_a, is_b = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
        is_a[at_a] = is_b[at_b] = 1
        both = is_a & is_b
        group = np.cumsum(both) - both  # ends of both before this one
        # number of the text in which a byte offset ends, texts without tokens skipped
        live = np.flatnonzero(n_a)
        doc = np.repeat(live, np.diff(at_a[np.cumsum(n_a)[live] - 1], prepend=-1))
        # spelt groups: A tokens, then B tokens of each group, with what follows each
        size_a, size_b = len(self.bytes_a), len(self.bytes_b)
        code = np.concatenate([a + size_a * both[at_a], 2 * size_a + b + size_b * both[at_b]])
        code = code[np.argsort(np.concatenate([2 * group[at_a], 2 * group[at_b] + 1]), kind="stable")]
        cut = np.concatenate(([0], np.cumsum(n_a + n_b)))
        groups = ["".join(map(self.told.__getitem__, code[s:e].tolist()))[:-1] for s, e in zip(cut[:-1], cut[1:])]
        counts = [n_a, n_b, np.bincount(doc[both > 0], minlength=len(texts)), np.bincount(doc, minlength=len(texts))]
        return counts, groups, (doc, a[np.cumsum(is_a) - is_a], b[np.cumsum(is_b) - is_b])


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Radix (low bits of the B id), rest of the B id, A id: 32 bits."""
    low = (1 << RADIX_BITS) - 1
    return ((b & low) << (32 - RADIX_BITS)) | ((b >> RADIX_BITS) << 16) | a


def pair_of(key):
    """(A id, B id) of a key, or of an array of keys."""
    return key & 0xFFFF, ((key >> 16) & ((1 << (16 - RADIX_BITS)) - 1)) << RADIX_BITS | key >> (32 - RADIX_BITS)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns as one zstd block, bytes of the same place in their numbers side by side."""
    import zstandard
    parts = [np.array([len(c) for c in columns], "<u8").tobytes()]
    parts += [np.ascontiguousarray(c).view(np.uint8).reshape(-1, c.dtype.itemsize).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(data: bytes, *types: str) -> list[np.ndarray]:
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    at, out = 8 * len(types), []
    for n, t in zip(raw[:at].view("<u8").tolist(), types):
        width = np.dtype(t).itemsize
        out.append(np.ascontiguousarray(raw[at:at + n * width].reshape(width, n).T).view(t).ravel())
        at += n * width
    return out


def spill(links: np.ndarray):
    """Runs of links (pair key << 32 | document number), one per radix: (radix, pairs
    with counts, records), the records ordered by pair and document."""
    links = np.sort(links)
    first = np.flatnonzero(np.concatenate(([True], links[1:] != links[:-1])))
    times = np.diff(np.append(first, len(links))).astype("<u4")
    pair, doc = (links[first] >> np.uint64(32)).astype("<u4"), (links[first] & np.uint64(0xFFFFFFFF)).astype("<u4")
    edge = np.searchsorted(pair, np.arange(1 << RADIX_BITS, dtype=np.uint64) << np.uint64(32 - RADIX_BITS)).tolist()
    for radix, (s, e) in enumerate(zip(edge, [*edge[1:], len(pair)])):
        if s == e:
            continue
        p = pair[s:e]
        new = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
        keys, total = p[new], np.add.reduceat(times[s:e], new, dtype="<u8")
        yield radix, _pack(np.diff(keys, prepend=keys.dtype.type(0)), total), _pack(
            np.diff(np.append(new, e - s)).astype("<u4"), doc[s:e], times[s:e])


def run_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    step, total = _unpack(data, "<u4", "<u8")
    return np.cumsum(step, dtype="<u4"), total


def _entries(data: bytes):
    keys, total = run_pairs(data)
    for at in range(0, len(keys), BLOCK):
        yield from zip(keys[at:at + BLOCK].tolist(), total[at:at + BLOCK].tolist())


def merge_runs(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted pairs and their counts over all runs, by a heap of the runs' next pairs."""
    from array import array
    keys, total = array("I"), array("Q")
    last = None
    for key, n in heapq.merge(*map(_entries, runs)):
        if key == last:
            total[-1] += n
        else:
            keys.append(key)
            total.append(n)
            last = key
    return np.array(keys, "<u4"), np.array(total, "<u8")


def mark_best(keys: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Which pairs have their B id's greatest count; a B id's pairs are neighbours."""
    side = keys >> np.uint32(16)
    first = np.flatnonzero(np.concatenate(([True], side[1:] != side[:-1])))
    return total == np.repeat(np.maximum.reduceat(total, first), np.diff(np.append(first, len(keys))))


def _spilled(df: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str, with_groups: bool) -> DataFrame:
    """One row per document and, with ``radix`` set, one per run and radix."""
    src = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    id_type = src.schema["id"].dataType.simpleString()
    schema = (f"row_key bigint, id {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string,"
              " groups string, slice int, radix int, pairs binary, records binary")

    struct = StructType.fromDDL(schema)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema
        both = Tokenizers(path_a, path_b)
        slice_no = TaskContext.get().partitionId()
        base = slice_no << 33
        arrow = to_arrow_schema(struct)
        names = arrow.names
        held, n_held, first, row = [], 0, 0, 0

        def rows(**columns):
            n = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays([pa.array(columns[c], arrow.field(c).type) if c in columns
                                               else pa.nulls(n, arrow.field(c).type) for c in names], schema=arrow)

        def flush():
            for radix, pairs, records in spill(np.concatenate(held)):
                yield rows(row_key=[base + first], slice=[slice_no], radix=[radix], pairs=[pairs], records=[records])

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                to, size = at + 1, len(texts[at])
                while to < len(texts) and size + len(texts[to]) <= PART_BYTES:
                    size += len(texts[to])
                    to += 1
                counts, groups, (doc, a, b) = both.align(texts[at:to])
                told = dict(zip(COUNTS, counts))
                told["groups_sha256"] = [hashlib.sha256(g.encode()).hexdigest() if n else "" for g, n in zip(groups, counts[0])]
                if with_groups:
                    told["groups"] = groups
                yield rows(row_key=np.arange(base + row, base + row + to - at), id=ids.slice(at, to - at), **told)
                if not held:
                    first = row
                if len(doc):
                    held.append(pair_key(a, b).astype(np.uint64) << np.uint64(32) | (doc + (row - first)).astype(np.uint64))
                    n_held += len(doc)
                row, at = row + to - at, to
                if n_held >= RUN_LINKS:
                    yield from flush()
                    held, n_held = [], 0
        if held:
            yield from flush()

    return src.mapInArrow(run, schema)


def _totals(runs: DataFrame) -> DataFrame:
    """(radix, pairs, best): per radix all pairs with their counts, and a flag for each."""
    def merge(last):
        def run(pdf):
            import pandas as pd
            keys, total = merge_runs(pdf["pairs"].tolist())
            best = mark_best(keys, total) if last else np.zeros(0, bool)
            return pd.DataFrame({"slice": [int(pdf["slice"].iloc[0])], "radix": [int(pdf["radix"].iloc[0])],
                                 "pairs": [_pack(np.diff(keys, prepend=keys.dtype.type(0)), total)],
                                 "best": [_pack(best.astype(np.uint8))]})
        return run

    slices = (runs.agg(F.max("slice")).first()[0] or 0) + 1
    out = runs.select("slice", "radix", "pairs")
    while True:
        slices = -(-slices // FAN_IN)
        out = scratch(out.withColumn("slice", F.floor(F.col("slice") / FAN_IN).cast("int")).groupBy("slice", "radix")
                      .applyInPandas(merge(slices == 1), "slice int, radix int, pairs binary, best binary"), "pair-counts")
        if slices == 1:
            return out.select("radix", "pairs", "best")


def _sums(runs: DataFrame, totals: DataFrame) -> DataFrame:
    """(row_key, count_sum, n_best): what each run adds to its documents."""
    size = totals.agg(F.sum(F.length("pairs") + F.length("best"))).first()[0] or 0
    small = totals.select(F.col("radix"), F.col("pairs").alias("all_pairs"), F.col("best"))
    big = runs.select("row_key", "radix", "slice", "pairs", "records")
    if size <= SMALL:
        joined = big.join(F.broadcast(small), "radix")
    else:  # a radix may hold a third of all links: its slices go to different tasks
        spots = 256
        small = small.withColumn("spot", F.explode(F.sequence(F.lit(0), F.lit(spots - 1))))
        joined = big.withColumn("spot", F.col("slice") % spots).join(small, ["radix", "spot"])

    def run(batches):
        import pyarrow as pa
        known, base, count, best = {}, None, None, None

        def told():
            here = np.flatnonzero(count)
            return pa.RecordBatch.from_arrays([pa.array(here + base), pa.array(count[here]), pa.array(best[here])],
                                              ["row_key", "count_sum", "n_best"])

        for batch in batches:
            for r in range(batch.num_rows):
                key, radix = batch.column(0)[r].as_py(), batch.column(1)[r].as_py()
                if radix not in known:
                    known[radix] = (*run_pairs(batch.column(4)[r].as_py()), _unpack(batch.column(5)[r].as_py(), "u1")[0])
                all_keys, totals_of, flags = known[radix]
                keys, _ = run_pairs(batch.column(2)[r].as_py())
                n, doc, times = _unpack(batch.column(3)[r].as_py(), "<u4", "<u4", "<u4")
                if key != base:
                    if base is not None:
                        yield told()
                    base, count, best = key, np.zeros(0, np.int64), np.zeros(0, np.int64)
                top = int(doc.max()) + 1
                if top > len(count):
                    grow = np.zeros(max(top, 2 * len(count)) - len(count), np.int64)
                    count, best = np.concatenate([count, grow]), np.concatenate([best, grow])
                at = np.searchsorted(all_keys, keys)
                np.add.at(count, doc, np.repeat(totals_of[at].astype(np.int64), n) * times)
                np.add.at(best, doc, np.repeat(flags[at].astype(np.int64), n) * times)
        if base is not None:
            yield told()

    cols = ["row_key", "radix", "pairs", "records", "all_pairs", "best"]
    return (joined.select(*cols).mapInArrow(run, "row_key bigint, count_sum bigint, n_best bigint")
            .groupBy("row_key").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best")))


def align_documents(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                    with_groups: bool = False) -> DataFrame:
    """One row per input row: id, the four counts, ``n_best`` (links whose pair has its
    B id's greatest count), ``count_sum`` (over the links, how often their pair is
    linked), ``groups_sha256`` and, if asked, ``groups`` spelt as ``a1,a2|b1;a3|b2``."""
    out = scratch(_spilled(df, path_a, path_b, id_col, text_col, with_groups), "alignment")
    runs, rows = out.where(F.col("radix").isNotNull()), out.where(F.col("radix").isNull())
    sums = _sums(runs, _totals(runs))
    zero = F.lit(0).cast("bigint")
    return (rows.join(sums, "row_key", "left")
            .select(F.col("id").alias(id_col), *COUNTS, F.coalesce("n_best", zero).alias("n_best"),
                    F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256", *(["groups"] if with_groups else [])))


def pair_counts(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b, count, best) for every id pair that the corpus links."""
    out = scratch(_spilled(df, path_a, path_b, id_col, text_col, False), "alignment")

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for pairs, best in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, total = run_pairs(pairs)
                a, b = pair_of(keys.astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(total.astype(np.int64)),
                                                  pa.array(_unpack(best, "u1")[0].astype(bool))], ["a", "b", "count", "best"])

    totals = _totals(out.where(F.col("radix").isNotNull()))
    return totals.select("pairs", "best").mapInArrow(run, "a bigint, b bigint, count bigint, best boolean")
